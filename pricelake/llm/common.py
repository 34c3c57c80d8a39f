"""Shared pieces of the llm operators: tables, scratch tables, text rules."""

from __future__ import annotations

import ctypes
import gc
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pricelake.session import ensure_checkpoint_dir

# White space of the text contracts: space, tab, newline, VT, FF, CR.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The named columns of a test-data table; other columns are never read,
    so extra columns (clashing names included) cannot matter."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def scratch(spark: SparkSession) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    so a lost executor costs one table read and not the whole history, and a
    table used more than once is computed once."""
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def normalized(col: str = "text") -> Column:
    """Each run of white space becomes one space; null counts as empty."""
    return F.regexp_replace(text_or_empty(col), SPACES, " ")


def n_words(col: str = "text") -> Column:
    """Number of words of the text; null has 0."""
    return F.regexp_count(text_or_empty(col), F.lit(WORD)).cast("long")


_KEPT: dict[str, object] = {}


def kept(key: str, make):
    """What ``make`` gave to an earlier task of this Python worker, or gives now."""
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def release_memory(keep: str | None = None) -> None:
    """Drops what earlier stages kept in this Python worker, but for ``keep``,
    and gives what is free back to the system: workers live on over stages, and
    all they hold counts against the executor."""
    for key in [k for k in _KEPT if k != keep]:
        del _KEPT[key]
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def fresh(run, keep: str | None = None):
    """``run`` over batches, beginning with ``release_memory``."""
    def task(batches):
        release_memory(keep)
        yield from run(batches)
    return task


def map_in_pandas(df: DataFrame, run, schema: str, ids: tuple[str, ...] = ("doc_id",), keep: str | None = None) -> DataFrame:
    """``mapInPandas`` with the nullable id columns carried as text: pandas
    makes a column of longs with nulls a column of floats.  Tasks are ``fresh``."""
    fields = StructType.fromDDL(schema).fields
    ddl = ", ".join(f"`{f.name}` {'string' if f.name in ids else f.dataType.simpleString()}" for f in fields)
    out = df.withColumns({c: F.col(c).cast("string") for c in ids}).mapInPandas(fresh(run, keep), ddl)
    return out.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in fields if f.name in ids})
