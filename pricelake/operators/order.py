"""Orderings that an aggregate can pick a winner with.

``keep_one`` is ``min(struct(order..., row...))`` (or ``max``) per key -- a
partial aggregate: every map task reduces its share of a key to one row
before the shuffle, so a key holding a third of all rows costs one row per
task in the exchange instead of a third of the data in one window task.

Each ordering term becomes a struct field compared in the aggregate's
direction: numbers and timestamps are negated when their direction differs
from the aggregate's, and the aggregate's direction is chosen so that
string terms never need reversing.  A boolean "is NULL" flag precedes each
term so that NULL loses in both directions (NULLS LAST).  The row itself
follows the order terms, so complete ties still resolve deterministically.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Term:
    col: str
    descending: bool


def desc(col: str) -> Term:
    return Term(col, True)


def asc(col: str) -> Term:
    return Term(col, False)


_NEGATABLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
              T.DecimalType, T.TimestampType, T.TimestampNTZType, T.DateType, T.BooleanType)


def _negated(c: Column, dtype) -> Column:
    if isinstance(dtype, T.TimestampNTZType):
        return -F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    if isinstance(dtype, T.TimestampType):
        return -F.unix_micros(c)
    if isinstance(dtype, T.DateType):
        return -F.unix_date(c)
    if isinstance(dtype, T.BooleanType):
        return ~c
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return -c.cast("double")
    if isinstance(dtype, T.DecimalType):
        return -c
    return -c.cast("long")


def _reversed_string(c: Column) -> Column:
    """Byte-order reversal of a string (slow path, only for mixed string
    directions): complement every UTF-8 byte and close with 'z'."""
    hexed = F.lower(F.hex(F.encode(c, "UTF-8")))
    return F.concat(F.translate(hexed, "0123456789abcdef", "fedcba9876543210"), F.lit("z"))


def _winner_direction(df: DataFrame, terms: list[Term]) -> bool:
    """True -> take the max; chosen so that string terms keep their order."""
    strings = {t.descending for t in terms if not isinstance(df.schema[t.col].dataType, _NEGATABLE)}
    if len(strings) == 1:
        return strings.pop()
    return terms[0].descending if terms else True


def _fields(df: DataFrame, terms: list[Term], use_max: bool) -> list[Column]:
    out = []
    for i, t in enumerate(terms):
        c = F.col(t.col)
        dtype = df.schema[t.col].dataType
        # NULL loses: under max a NULL flag must be smaller, under min larger.
        out.append((c.isNotNull() if use_max else c.isNull()).alias(f"_n{i}"))
        if t.descending == use_max:
            v = c
        elif isinstance(dtype, _NEGATABLE):
            v = _negated(c, dtype)
        else:
            v = _reversed_string(c)
        out.append(v.alias(f"_o{i}"))
    return out


def order_key(df: DataFrame, terms: list[Term]) -> tuple[Column, bool]:
    """(struct comparing like the ORDER BY, True if the winner is its max)."""
    use_max = _winner_direction(df, terms)
    return F.struct(*_fields(df, terms, use_max)), use_max


def first_by(df: DataFrame, value: Column, terms: list[Term]) -> Column:
    """Aggregate: ``value`` of the first row by ``terms`` (NULLS LAST)."""
    key, use_max = order_key(df, terms)
    return (F.max_by if use_max else F.min_by)(value, key)


def keep_one(df: DataFrame, keys: list[str], order: list[Term]) -> DataFrame:
    """One row per key, the first by ``order``.  Partial aggregation, no window.

    Key columns come from the grouping, not from the row, so that rows already
    partitioned by them stay so (floats excepted: grouping makes -0.0 a 0.0)."""
    cols = df.columns
    use_max = _winner_direction(df, order)
    kept = [k for k in keys if not isinstance(df.schema[k].dataType, (T.FloatType, T.DoubleType))]
    row = [c for c in cols if c not in kept]
    rest = [F.struct(*[F.col(c) for c in row]).alias("_row")] if row else []
    packed = F.struct(*_fields(df, order, use_max), *rest) if order or rest else F.struct(F.lit(True).alias("_n"))
    agg = F.max(packed) if use_max else F.min(packed)
    return (df.groupBy(*keys).agg(agg.alias("_w"))
            .select(*[F.col(c) if c in kept else F.col("_w._row." + c).alias(c) for c in cols]))
