"""Join helpers: broadcast only behind a size check or not at all, and joins beside the SKU.

Facts that carry a ``store_sku`` lie in partitions by it (``by_sku``, or buckets
of as many).  What is joined to them on the SKU and more columns is brought into
the same partitions, so that it moves alone and the facts stay where they are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Planned size, in bytes, up to which a join side is sent whole to every task.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
SKU = "store_sku"


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; no job runs.  A table read back from
    files has its file size, a plan with joins an estimate from above."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``F.broadcast(df)`` when its planned size is at most ``max_bytes``;
    otherwise ``df`` unchanged, and the planner keeps a shuffle join."""
    return F.broadcast(df) if planned_bytes(df) <= max_bytes else df


def moved(df: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """``df`` as a join side that is shuffled and sorted, never sent whole to every
    task.  For tables with a row per product: Spark plans by the size of their
    files, some tenth of what a broadcast holds in the driver.  Unchanged if the
    result meets ``facts`` that do not lie by SKU: their joins are united in the
    partitions of this one, which Spark 4.1 then counts wrong."""
    return df.hint("merge") if facts is None or SKU in facts.columns else df


def by_sku(df: DataFrame) -> DataFrame:
    """``df`` in the session's shuffle partitions by ``store_sku`` alone: all that is
    keyed by the SKU and more columns needs no further shuffle.  Joins take such
    partitions only if the session lets them be by a part of the join's keys."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return df.repartition(int(conf.get("spark.sql.shuffle.partitions")), SKU)


def beside(df: DataFrame, facts: DataFrame) -> DataFrame:
    """``df`` in the partitions of ``facts``, if these lie by SKU; else unchanged."""
    return by_sku(df) if SKU in facts.columns else df


def join_facts(small: DataFrame, facts: DataFrame, key: str, keep_unmatched: bool = False) -> DataFrame:
    """``small`` joined to ``facts`` on ``key`` without shuffling the facts
    when they lie by SKU (which ``key`` determines) or ``small`` passes the size
    check.  ``keep_unmatched=True`` gives the left outer join; without SKUs that is
    the inner join plus the rows of ``small`` whose key has
    no fact (found against the facts' distinct keys, a partial aggregate)."""
    if SKU in facts.columns:
        return facts.join(by_sku(small), [key, SKU], "right" if keep_unmatched else "inner")
    inner = facts.join(broadcast_if_small(small), key)
    if not keep_unmatched:
        return inner
    missing = small.join(facts.select(key).distinct(), key, "left_anti")
    fact_cols = [c for c in facts.columns if c != key]
    missing = missing.select(*small.columns, *[F.lit(None).cast(facts.schema[c].dataType).alias(c)
                                                for c in fact_cols])
    return inner.unionByName(missing)
