"""De-duplication of wide rows that moves few of them.

``keep_one`` carries whole rows through a sort and a shuffle, also those that
lose or have no rival.  Here a first pass over the key columns alone (fixed-width
buffers: a hash aggregate) finds which keys matter; ``among`` then picks their
rows before anything wide is computed or moved, and ``keep_one`` decides among
those.

``among`` compares hashes of the keys in a bitmap, 16 bits a key, not rows.  It
lets a few other rows through (one in 16 or less) and never misses one, so what
follows it has to be exact by itself; ``keep_one`` is.  The bitmap is a scalar
subquery: unlike a semi join, the filter sinks below the columns that are costly
to compute.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.operators.keys import pinned
from pricelake.operators.order import Term, keep_one

# Bits of a bitmap for each key, and in all (16 MB): with more keys than that
# holds, more other rows pass.
BITS_PER_KEY = 16
MAX_BITS = 1 << 27


def among(found: DataFrame, cols: list[str], count: int) -> Column:
    """TRUE for rows whose ``cols`` are in ``found`` (``count`` rows), and for a few others."""
    size = min(MAX_BITS, max(1 << 10, count * BITS_PER_KEY)) // 64 * 64
    at = F.pmod(F.xxhash64(*cols), F.lit(size))
    no, bit = F.floor(at / 64), F.pmod(at, F.lit(64)).cast("int")
    words = (found.select(no.alias("_no"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("_bit"))
             .groupBy("_no").agg(F.bit_or("_bit").alias("_word")))
    every = found.sparkSession.range(size // 64).withColumnRenamed("id", "_no").join(words, "_no", "left")
    bitmap = every.agg(F.transform(F.sort_array(F.collect_list(F.struct("_no", F.coalesce("_word", F.lit(0).cast("long")).alias("_word")))),
                                   lambda x: x["_word"])).scalar()
    return F.call_function("shiftright", F.get(bitmap, no.cast("int")), bit).bitwiseAND(F.lit(1)) == 1


def keep_latest(df: DataFrame, keys: list[str], order: list[Term]) -> DataFrame:
    """``keep_one`` for an ``order`` that begins with the latest time: only rows at
    the last time of their key are compared."""
    time = order[0].col
    last = pinned(df.groupBy(*keys).agg(F.max(time).alias(time)))
    return keep_one(df.where(among(last, [*keys, time], last.count())), keys, order)


def keep_one_of_few(df: DataFrame, keys: list[str], order: list[Term]) -> DataFrame:
    """``keep_one`` where most keys have one row: only rows of the others are compared."""
    many = pinned(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).drop("_n"))
    n = many.count()
    if not n:
        return df
    seen = among(many, keys, n)
    return df.where(~seen).unionByName(keep_one(df.where(seen), keys, order))
