"""Surrogate keys without a single-task window.

``dense_ids`` (K2) equals ``row_number() OVER (ORDER BY <order>) + start``
but runs distributed, and only the order columns are pinned:

1. range-partition the order columns (sampled boundaries, so many rows with
   one leading value are still split by the later columns) and sort inside
   each partition;
2. write them with their partition and position to the shared folder, so the
   numbers are fixed even if tasks are re-run or an executor is lost;
3. count rows per partition (one row per partition), turn the counts into
   running offsets (a window over at most ``spark.sql.shuffle.partitions``
   rows) and broadcast that table back -- its size is bounded by the
   partition count, not by the data;
4. join the ids to the whole rows on the order columns.  The wide rows are
   never range-partitioned or written.

``prefix_sums`` is the same for a running sum.

``assign_keys`` (K1) keeps the ids of natural keys already present in an
existing map and numbers only the new ones after the current maximum.
``operators.keymap`` keeps such a map over runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake.operators.order import Term
from pricelake.session import scratch


def _sort_col(t: Term) -> Column:
    c = F.col(t.col)
    return c.desc_nulls_last() if t.descending else c.asc_nulls_last()


def pinned(df: DataFrame) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read back."""
    path = scratch(df.sparkSession, "pinned")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pinned_by(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df``, whose rows are hash-partitioned on ``keys`` into the session's
    shuffle partitions, pinned in as many buckets: joins on ``keys`` read it
    without a shuffle."""
    spark, path = df.sparkSession, scratch(df.sparkSession, "pinned")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.write.format("parquet").option("path", path).option("compression", "zstd")
     .bucketBy(buckets, *keys).saveAsTable(name))
    return spark.table(name)


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join on ``keys``; the columns of ``left``, then the others of ``right``."""
    named = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    out = left.join(named, cond, how)
    return out if how in ("left_anti", "left_semi") else out.drop(*[f"_k_{k}" for k in keys])


def ranged_keys(keys: DataFrame, order: list[Term], partitions: int | None) -> DataFrame:
    """``keys`` in order over partitions, with partition and position, pinned."""
    n = partitions or int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = [_sort_col(t) for t in order]
    return pinned(keys.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
                  .withColumn("_pid", F.spark_partition_id())
                  .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)))


def _offsets(ranged: DataFrame, amount: Column) -> DataFrame:
    """(_pid, _off): the sum of ``amount`` over the partitions before."""
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    per = ranged.groupBy("_pid").agg(F.sum(amount).alias("_n"))
    return F.broadcast(per.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))


def _numbered(keys: DataFrame, order: list[Term], id_col: str, start: int | Column, partitions: int | None) -> DataFrame:
    ranged = ranged_keys(keys, order, partitions)
    start_col = start if isinstance(start, Column) else F.lit(start)
    return (ranged.join(_offsets(ranged, F.lit(1)), "_pid")
            .withColumn(id_col, (start_col + F.col("_off") + F.col("_pos") + F.lit(1)).cast("long"))
            .drop("_pid", "_pos", "_off"))


def dense_ids(df: DataFrame, order: list[Term], id_col: str, start: int | Column = 0,
              partitions: int | None = None) -> DataFrame:
    """Number the rows 1..n (plus ``start``) in ``order``.  The order columns
    must identify a row, unless the rows have no others."""
    names = [t.col for t in order]
    ids = _numbered(df.select(*names), order, id_col, start, partitions)
    return ids.select(*df.columns, id_col) if set(df.columns) == set(names) else join_on(df, ids, names)


def prefix_sums(rows: DataFrame, order: list[Term], amount: str, out: str, partitions: int | None = None) -> DataFrame:
    """Add ``out``: the sum of ``amount`` over all rows before this one in ``order``."""
    ranged = ranged_keys(rows, order, partitions)
    before = Window.partitionBy("_pid").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    return (ranged.withColumn("_sum", F.coalesce(F.sum(amount).over(before), F.lit(0)))
            .join(_offsets(ranged, F.col(amount)), "_pid")
            .withColumn(out, (F.col("_off") + F.col("_sum")).cast("long")).drop("_pid", "_pos", "_sum", "_off"))


def assign_keys(df: DataFrame, natural: list[str], id_col: str, order: list[Term],
                existing: DataFrame | None = None, start: int = 0) -> DataFrame:
    """K1: persistent surrogate keys.

    Rows whose natural key is in ``existing`` keep that id; the others are
    numbered in ``order`` after max(existing id) (or ``start``)."""
    if existing is None:
        return dense_ids(df, order, id_col, start)
    known = existing.select(*natural, id_col)
    old = df.join(known, natural, "inner")
    new = df.join(known, natural, "left_anti")
    base = F.coalesce(existing.agg(F.max(id_col)).scalar(), F.lit(start))
    return old.unionByName(dense_ids(new, order, id_col, base).select(*old.columns))
