"""K1: surrogate ids that survive every refresh, for keys of any number.

A ``KeyMap`` is a folder with the ids of all natural keys seen so far, spread
over hash buckets of the key.  A run adds one folder ``run=<n>`` that holds its
new keys only, by bucket; the manifest of the run names its buckets and the
largest id.  Nothing in force is ever rewritten, so a crash at any point leaves
the last complete run.

``assign`` looks up a table's keys: it reads the buckets that the keys fall in
and no others, numbers the keys it does not find after the largest id (in the
order given, by ``dense_ids``), writes these, and joins the ids to the rows.
Old keys keep their id whether or not a run has them.  ``compact`` joins the
runs' files into one folder when they have become many.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.operators.keys import _numbered, join_on, pinned
from pricelake.operators.order import Term
from pricelake.operators.versions import Versions

KEYS_PER_FILE = 1_000_000


class KeyMap:
    def __init__(self, spark: SparkSession, root: str, natural: list[T.StructField], id_col: str,
                 buckets: int | None = None):
        """``natural``: the fields of the key.  ``buckets``: by default as many as
        shuffle partitions; fixed for the life of a map."""
        self.spark = spark
        self.versions = Versions(spark, root)
        self.natural = [f.name for f in natural]
        self.id_col = id_col
        newest = self.versions.newest()
        self.buckets = newest[1]["buckets"] if newest else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in natural] + [T.StructField(id_col, T.LongType())])

    def _bucket(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_b", F.pmod(F.xxhash64(*self.natural), F.lit(self.buckets)).cast("int"))

    def read(self, only: list[int] | None = None) -> DataFrame:
        """The known keys with their ids, of some buckets (other files are
        pruned) or of all."""
        newest = self.versions.newest()
        runs = [f"{self.versions.root}/{run}" for run in newest[1]["runs"]] if newest else []
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        schema = T.StructType([*self.schema.fields, T.StructField("_b", T.IntegerType())])
        held = reduce(DataFrame.unionByName, [self.spark.read.schema(schema).parquet(run) for run in runs])
        return (held if only is None else held.where(F.col("_b").isin(only))).drop("_b")

    def _write(self, folder: str, keys: DataFrame) -> list[int]:
        """Keys by bucket in one folder; the buckets that got some.  A bucket of
        many keys is written by many tasks."""
        put = pinned(self._bucket(keys.select(*self.natural, self.id_col)))
        held = sorted(r._b for r in put.select("_b").distinct().collect())  # at most ``buckets`` numbers
        if held:
            tasks = put.count() // (self.buckets * KEYS_PER_FILE) + 1
            salt = F.pmod(F.xxhash64(self.id_col), F.lit(tasks))
            (put.repartition("_b", salt).write.mode("overwrite").partitionBy("_b")
             .parquet(f"{self.versions.root}/{folder}"))
        return held

    def assign(self, df: DataFrame, order: list[Term], start: int = 0) -> DataFrame:
        """``df`` with its ids; new keys are numbered in ``order`` (columns that
        the natural key determines) after the largest id, the first run's after
        ``start``."""
        more = [t.col for t in order if t.col not in self.natural]
        keys = pinned(self._bucket(df.select(*self.natural, *more).dropDuplicates(self.natural)))
        touched = [r._b for r in keys.select("_b").distinct().collect()]  # at most ``buckets`` numbers
        newest = self.versions.newest()
        number, manifest = newest if newest else (0, {"buckets": self.buckets, "largest": start, "runs": {}})
        known = self.read(touched).drop(self.id_col)
        new = join_on(keys.drop("_b"), known, self.natural, "left_anti")
        ids = _numbered(new, order, self.id_col, manifest["largest"], None)
        held = self._write(f"run={number + 1:012d}", ids)
        if held:
            runs = {**manifest["runs"], f"run={number + 1:012d}": held}
            largest = self.spark.read.parquet(f"{self.versions.root}/run={number + 1:012d}").agg(F.max(self.id_col)).first()[0]
            self.versions.publish(number + 1, {"buckets": self.buckets, "largest": largest, "runs": runs})
        return join_on(df, self.read(touched), self.natural)

    def compact(self) -> None:
        """One folder with all keys in force, published as a version of its own."""
        newest = self.versions.newest()
        if newest is None:
            return
        number, manifest = newest
        folder = f"run={number + 1:012d}"
        held = self._write(folder, self.read())
        self.versions.publish(number + 1, {**manifest, "runs": {folder: held}})
