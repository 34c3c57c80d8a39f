"""Change-data-capture operators: SCD type 2 history and SCD type 1 upsert.

C1 ``scd2``: one version per key and sequence value (ties broken by
``tie``), ordered by the sequence even when rows arrive late;
``__START_AT`` = own sequence, ``__END_AT`` = the next version's sequence,
NULL for the open version.

Where no key has more than ``HOT_ROWS`` rows (counted first, on the keys alone),
versions and ends are one window over the key: one shuffle and one sort of the
rows.  Else the "next sequence per key" is computed in two levels so that a key
with a huge history is not one window task: rows are first windowed per
(key, split bucket) -- by default the day of the sequence -- and only the
last row of each bucket looks up the first sequence of the key's next
bucket in a table with one row per (key, bucket).  Both the window and the
join hash-partition on (key, bucket), so they share one exchange.

A bucket may still hold a large part of all rows (one key, one day).  If a
(key, bucket) has more than
``HOT_ROWS``, versions come from a partial aggregate and their ends from a
carry scan (``carried_next``): (key, sequence) pairs are range-partitioned,
each partition looks up its rows' successors alone, and only the first pair
of a partition is carried to the partition before.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake.operators.keys import join_on, ranged_keys
from pricelake.operators.order import Term, asc, desc, keep_one

START = "__START_AT"
END = "__END_AT"
# Rows of one (key, bucket) that a single window task may sort.
HOT_ROWS = 1_000_000


def _sort_col(t: Term) -> Column:
    c = F.col(t.col)
    return c.desc_nulls_last() if t.descending else c.asc_nulls_last()


def _bucket_ends(b: DataFrame, keys: list[str], seq: str, out: str,
                 firsts_from: DataFrame | None = None) -> DataFrame:
    """``b`` has one row per (keys, seq) and a ``_bkt`` column.  Adds ``out``:
    the next ``seq`` of the key -- inside the bucket by window, across buckets
    from a table with one row per (key, bucket).  ``firsts_from`` may give
    the same (keys, seq, _bkt) values before de-duplication, so the table
    comes from a partial hash aggregate instead of a second window pass."""
    inner = Window.partitionBy(*keys, "_bkt").orderBy(F.col(seq))
    b = b.withColumn("_nxt", F.lead(seq).over(inner))
    firsts = (firsts_from if firsts_from is not None else b).groupBy(*keys, "_bkt").agg(F.min(seq).alias("_first"))
    nxt = (firsts.select(*keys, "_bkt", F.lead("_first").over(
        Window.partitionBy(*keys).orderBy("_bkt")).alias("_next_first"))
        .where(F.col("_next_first").isNotNull()))
    joined = b.join(nxt, [*keys, "_bkt"], "left")
    return joined.withColumn(out, F.coalesce(F.col("_nxt"), F.col("_next_first"))).drop("_bkt", "_nxt", "_next_first")


def next_in_key(df: DataFrame, keys: list[str], seq: str, out: str,
                split: Column | None = None) -> DataFrame:
    """Add ``out`` = smallest ``seq`` of the same key that is larger than
    this row's ``seq`` (rows are unique per (keys, seq))."""
    bucket = split if split is not None else F.to_date(F.col(seq))
    return _bucket_ends(df.withColumn("_bkt", bucket), keys, seq, out)


def carried_next(df: DataFrame, keys: list[str], seq: str, out: str, partitions: int | None = None) -> DataFrame:
    """``next_in_key`` without a task per key: a scan over range partitions of
    (keys, seq), pinned, with one boundary row for each partition."""
    names = [*keys, seq]
    ranged = ranged_keys(df.select(*names), [asc(c) for c in names], partitions)
    pair = F.struct(*names)
    edges = ranged.where(F.col("_pos") == 0).select(
        "_pid", F.lead(pair).over(Window.orderBy("_pid")).alias("_edge"))
    inside = F.lead(pair).over(Window.partitionBy("_pid").orderBy("_pos"))
    after = ranged.withColumn("_inside", inside).join(F.broadcast(edges), "_pid").select(
        *names, F.coalesce("_inside", "_edge").alias("_after"))
    same = reduce(lambda a, b: a & b, [F.col(f"_after.{k}").eqNullSafe(F.col(k)) for k in keys])
    ends = after.select(*names, F.when(same, F.col(f"_after.{seq}")).alias(out))
    return join_on(df, ends, names)


def _has_hot(df: DataFrame, keys: list[str], rows: int) -> bool:
    return not df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows).isEmpty()


def _by_key(events: DataFrame, keys: list[str], seq: str, tie: list[Term]) -> DataFrame:
    """Versions and their ends by one window per key."""
    whole = Window.partitionBy(*keys)
    prev = F.lag(seq).over(whole.orderBy(F.col(seq).asc(), *[_sort_col(t) for t in tie]))
    versions = events.withColumn("_prev", prev).where(F.col("_prev").isNull() | (F.col("_prev") != F.col(seq)))
    end = F.when(F.col(seq).isNotNull(), F.lead(seq).over(whole.orderBy(F.col(seq).asc())))
    return versions.withColumn(END, end).withColumn(START, F.col(seq)).select(*events.columns, START, END)


def scd2(events: DataFrame, keys: list[str], seq: str, tie: list[Term] | None = None,
         split: Column | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """SCD type 2 history over all events (batch); ``seq`` is never NULL.

    Equal (keys, seq) rows collapse to one version chosen by ``tie``: inside
    each window the rows are ordered by (seq, tie) and the
    first row of every seq value is kept; the same partitioning and order
    then serve ``lead``, so versions and their ends cost one shuffle."""
    if not _has_hot(events, keys, hot_rows):
        return _by_key(events, keys, seq, tie or [])
    bucket = split if split is not None else F.to_date(F.col(seq))
    w = Window.partitionBy(*keys, "_bkt").orderBy(F.col(seq).asc(), *[_sort_col(t) for t in (tie or [])])
    bucketed = events.withColumn("_bkt", bucket)
    if _has_hot(bucketed, [*keys, "_bkt"], hot_rows):
        hist = carried_next(keep_one(events, [*keys, seq], tie or []), keys, seq, END)
        return hist.withColumn(START, F.col(seq)).select(*events.columns, START, END)
    b = bucketed.withColumn("_prev", F.lag(seq).over(w))
    versions = b.where(F.col("_prev").isNull() | (F.col("_prev") != F.col(seq))).drop("_prev")
    hist = _bucket_ends(versions, keys, seq, END, firsts_from=bucketed.select(*keys, seq, "_bkt"))
    return hist.withColumn(START, F.col(seq)).select(*events.columns, START, END)


def current(hist: DataFrame) -> DataFrame:
    """Open versions only."""
    return hist.where(F.col(END).isNull())


def scd1(events: DataFrame, keys: list[str], seq: str, cols: list[str] | None = None,
         tie: list[Term] | None = None) -> DataFrame:
    """Last row per key by sequence (ties by ``tie``); only ``cols``
    are kept (all by default)."""
    out = keep_one(events, keys, [desc(seq), *(tie or [])])
    return out.select(*(cols or events.columns))
