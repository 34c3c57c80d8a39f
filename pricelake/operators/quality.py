"""Row-quality gate (expect-or-drop) and its per-rule report.

A rule is ``(name, SQL condition)``.  A row passes when every condition is
TRUE; NULL counts as a failure.  ``write_gated`` writes the rows that pass and
counts failures per rule in the same pass, by an ``Observation`` on the rows
before the gate; ``quality_report`` counts them for a table that is not written
(one aggregate pass, partial aggregation, one row out).
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _ok(cond: str):
    return F.coalesce(F.expr(cond), F.lit(False))


def passes(rules: list[tuple[str, str]]) -> Column:
    """TRUE for rows that pass every rule, else FALSE."""
    return reduce(lambda a, b: a & b, [_ok(c) for _, c in rules], F.lit(True))


def quality_gate(df: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    return df.where(passes(rules)) if rules else df


def _counts(rules: list[tuple[str, str]], n: Column | None = None) -> list[Column]:
    aggs = [F.count(F.lit(1)).alias("_total") if n is None else F.coalesce(F.sum(n), F.lit(0)).alias("_total")]
    each = F.lit(1) if n is None else n
    return aggs + [F.coalesce(F.sum(F.when(_ok(c), 0).otherwise(each)), F.lit(0)).cast("long").alias(f"_r{i}")
                   for i, (_, c) in enumerate(rules)]


REPORT = "rule string, failed long, total long"


def write_gated(df: DataFrame, rules: list[tuple[str, str]], path: str) -> tuple[DataFrame, DataFrame]:
    """Write the rows that pass; returns them read back, and the report
    (rule, failed, total) of the rows written and dropped.  The gate and the
    counts run inside the tasks that write, so no row is read twice."""
    spark, seen = df.sparkSession, Observation()
    quality_gate(df.observe(seen, *_counts(rules)), rules).write.mode("overwrite").parquet(path)
    got = seen.get
    report = [(name, int(got[f"_r{i}"]), int(got["_total"])) for i, (name, _) in enumerate(rules)]
    return spark.read.schema(df.schema).parquet(path), spark.createDataFrame(report, REPORT)


def joined_report(rows: DataFrame, other: DataFrame, keys: list[str], rules: list[tuple[str, str]]) -> DataFrame:
    """``quality_report`` of the left join of ``rows`` and ``other`` on ``keys``.
    Rows are joined as one row for each key and outcome of the rules on ``rows``
    alone, with its number."""
    def named(cond, cols):
        return [c for c in cols if re.search(rf"\b{re.escape(c)}\b", cond, re.IGNORECASE)]

    theirs = [c for c in other.columns if c not in rows.columns]
    alone = [(f"_ok{i}", F.expr(c)) for i, (_, c) in enumerate(rules) if not named(c, theirs)]
    # columns of ``rows`` that a rule reads together with the other side's
    more = sorted({x for _, c in rules if named(c, theirs) for x in named(c, rows.columns)} - set(keys))
    known = {n for n, _ in alone}
    groups = (rows.select(*keys, *more, *[F.coalesce(c, F.lit(False)).alias(n) for n, c in alone])
              .groupBy(*keys, *more, *[n for n, _ in alone]).agg(F.count(F.lit(1)).alias("_rows")))
    joined = groups.join(other, keys, "left")
    return _stacked(joined.agg(*_counts([(n, f"_ok{i}" if f"_ok{i}" in known else c) for i, (n, c) in enumerate(rules)],
                                        F.col("_rows"))), rules)


def quality_report(df: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """One row per rule: (rule, failed, total), total = rows checked."""
    return _stacked(df.agg(*_counts(rules)), rules)


def _stacked(one: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    stack = F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(f"_r{i}").alias("failed"))
        for i, (name, _) in enumerate(rules)]))
    return one.select(stack.alias("_s"), F.col("_total").cast("long").alias("total")).select(
        "_s.rule", "_s.failed", "total")
