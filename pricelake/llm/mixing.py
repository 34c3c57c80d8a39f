"""Mixing sources to target weights by entropy balancing (operator 6).

Targets.  Sources in code-point order (null last) weigh 3, 1, 2, repeating,
and share ``factor`` times all words in proportion; a target stops at ``cap``
times its source's words and the excess is shared again by weight among the
others (water filling: one scalar level, found by a few aggregates over one
row a source).

Rates.  Each document gets a rate r in (0, cap), the expected number of its
copies.  Of all rates whose words meet the source's target, the ones closest
in (Fermi-Dirac) relative entropy to the even rate are exponential tilts of
the odds, ``r / (cap - r) = exp(theta_s * words / scale_s)``, with one dual
variable a source.  The dual is convex; safeguarded Newton steps for all
sources run together, each step one distributed aggregate over the histogram
(source, words) -> documents, never over the documents again.

Copies.  Inside a source the histogram cells go from long to short documents
with the rounding error, in words, carried on; what is left at the end is
under the smallest document.  A cell's copies are dealt to its documents by
salted ranks (64 salts a cell or more), so a cell with a third of all rows is
no single window group.  Sums are decimal, so reruns agree bit for bit.

A source's fold reads one row for each distinct document size, which the
longest document bounds, not the number of documents.

Edge cases: null or wordless texts have size 0 and take 0; a table of such
texts has targets 0; an empty table gives an empty result; repeated rows are
separate documents; null sources form one source; null doc_ids are kept.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake.llm.common import materialize, n_words
from pricelake.operators.keys import dense_ids
from pricelake.operators.order import Term

# Weights by source order, share of all words, copies at most.
WEIGHTS = (3, 1, 2)
FACTOR = 1.5
CAP = 2.0
NEWTON_STEPS = 60
MIN_SALTS = 64
ROWS_PER_SALT = 1_000_000


def source_targets(cells: DataFrame, weights=WEIGHTS, factor: float = FACTOR, cap: float = CAP) -> DataFrame:
    """(sid, source, source_size, scale, target) from (source, size, n)."""
    words = F.sum(F.col("n") * F.col("size"))
    per = cells.groupBy("source").agg(
        words.alias("source_size"),
        F.sum(F.col("n").cast("decimal(20,0)") * F.col("size") * F.col("size")).cast("double").alias("sq"))
    ranked = dense_ids(per, [Term("source", False)], "sid")
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("sid") - 1, F.lit(len(weights))) + 1).cast("int"))
    sources = materialize(ranked.select("sid", "source", "source_size", pick.cast("long").alias("weight"),
                                        F.when(F.col("source_size") > 0, F.col("sq") / F.col("source_size"))
                                        .otherwise(1.0).alias("scale")))
    level = _water_level(sources, factor, cap)
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), F.col("source_size") * F.lit(cap)))


def _water_level(sources: DataFrame, factor: float, cap: float) -> float:
    """The words for each unit of weight once no target is above its cap."""
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        full = F.col("source_size") * F.lit(cap) < F.col("weight") * F.lit(level)
        fixed, weight = sources.agg(F.sum(F.when(full, F.col("source_size"))),
                                    F.sum(F.when(~full, F.col("weight")))).first()
        if not weight:
            return level
        raised = (factor * total - cap * (fixed or 0)) / weight
        if raised <= level:
            return level
        level = raised


def _rate(theta: Column, size: Column, scale: Column, cap: float) -> Column:
    z = F.least(F.greatest(theta * size / scale, F.lit(-700.0)), F.lit(700.0))
    return F.lit(cap) / (F.lit(1.0) + F.exp(-z))


def balance(cells: DataFrame, sources: DataFrame, cap: float = CAP, steps: int = NEWTON_STEPS) -> DataFrame:
    """``sources`` with the dual variable ``theta``.  A source at its cap is
    not iterated (every rate is ``cap``)."""
    share = F.col("target") / F.col("source_size")
    open_ = (F.col("source_size") > 0) & (F.col("target") < F.col("source_size") * F.lit(cap))
    state = materialize(sources.select(
        "*", F.when(open_, F.log(share / (F.lit(cap) - share))).otherwise(0.0).alias("theta"),
        F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"), (~open_).alias("done")))
    exact = "decimal(38,8)"
    for _ in range(steps):
        if not state.filter(~F.col("done")).limit(1).count():
            break
        r = _rate(F.col("theta"), F.col("size"), F.col("scale"), cap)
        words = F.col("n") * F.col("size")
        slope = words * F.col("size") / F.col("scale") * r * (F.lit(1.0) - r / F.lit(cap))
        sums = (cells.join(state.filter(~F.col("done")).select("sid", "theta", "scale"), "sid")
                .groupBy("sid").agg(F.sum((words * r).cast(exact)).cast("double").alias("got"),
                                    F.sum(slope.cast(exact)).cast("double").alias("slope")))
        state = materialize(_newton_step(state.join(sums, "sid", "left"), sources.columns))
    return state


def _newton_step(at: DataFrame, keep: list[str]) -> DataFrame:
    gap = F.col("got") - F.col("target")
    near = F.abs(gap) <= F.lit(1e-7) * F.col("target") + F.lit(0.01)
    low = F.when(gap < 0, F.col("theta")).otherwise(F.col("low"))
    high = F.when(gap > 0, F.col("theta")).otherwise(F.col("high"))
    at = at.withColumn("near", F.col("done") | near).withColumn("low", low).withColumn("high", high)
    reach = F.lit(4.0) + F.abs("theta")  # a step without a bracket goes no further
    step = F.when(F.col("slope") > 0, -gap / F.col("slope")).otherwise(-F.signum(gap) * reach)
    tried = F.col("theta") + F.least(F.greatest(step, -reach), reach)
    middle = (F.col("low") + F.col("high")) / 2
    inside = (tried > F.coalesce("low", F.lit(float("-inf")))) & (tried < F.coalesce("high", F.lit(float("inf"))))
    return at.select(*keep, F.when(F.col("near"), F.col("theta")).when(inside, tried)
                     .otherwise(F.coalesce(middle, tried)).alias("theta"), "low", "high", F.col("near").alias("done"))


def _round_source(pdf: pd.DataFrame, cap: float) -> pd.DataFrame:
    """Copies for each cell of one source, longest documents first; the error
    in words is carried to the next cell."""
    pdf = pdf.sort_values("size", ascending=False)
    carry, copies = 0.0, []
    for size, n, rate in zip(pdf["size"].tolist(), pdf["n"].tolist(), pdf["rate"].tolist()):
        if size == 0:
            copies.append(n)
            continue
        want = n * rate * size + carry
        k = min(int(cap * n), max(0, int(want / size + 0.5)))
        carry = want - k * size
        copies.append(k)
    return pd.DataFrame({"sid": pdf["sid"], "size": pdf["size"], "n": pdf["n"], "copies": copies})


def mix(docs: DataFrame, weights=WEIGHTS, factor: float = FACTOR, cap: float = CAP) -> DataFrame:
    """One row for each document: doc_id, th (hash of its text), source, size,
    source_size, target, copies, taken."""
    sized = materialize(docs.select("doc_id", "source", n_words().alias("size"), F.xxhash64("text").alias("th"),
                                    F.monotonically_increasing_id().alias("rid")))
    salts = max(MIN_SALTS, -(-sized.count() // ROWS_PER_SALT))
    salt = F.pmod(F.xxhash64("doc_id", "size"), F.lit(salts)).alias("salt")
    cells = materialize(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    sources = materialize(source_targets(cells, weights, factor, cap))

    def by_sid(rows: DataFrame) -> DataFrame:
        named = sources.select("sid", F.col("source").alias("_s"))
        return rows.join(named, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")

    cells = materialize(by_sid(cells).drop("source"))
    state = balance(cells, sources, cap)
    full = F.col("target") >= F.col("source_size") * F.lit(cap)
    rate = F.when(full, F.lit(cap)).otherwise(_rate(F.col("theta"), F.col("size"), F.col("scale"), cap)).alias("rate")
    rated = cells.join(state, "sid").select("sid", "size", "n", rate)
    dealt = rated.groupBy("sid").applyInPandas(lambda pdf: _round_source(pdf, cap),
                                               "sid long, size long, n long, copies long")
    rows = by_sid(sized).select("doc_id", "th", "rid", "sid", "size", salt)
    cell = Window.partitionBy("sid", "size").orderBy("salt")
    upto = F.sum("m").over(cell.rowsBetween(Window.unboundedPreceding, 0))
    parts = (rows.groupBy("sid", "size", "salt").agg(F.count(F.lit(1)).alias("m"))
             .withColumn("upto", upto).join(dealt, ["sid", "size"])
             .withColumns({c: F.col(c).cast("decimal(19,0)") for c in ("upto", "n", "copies")})
             .select("sid", "size", "salt", "m",
                     F.expr("(copies * upto) div n - (copies * (upto - m)) div n").alias("k")))
    rank = F.row_number().over(Window.partitionBy("sid", "size", "salt").orderBy(F.xxhash64("doc_id"), "doc_id", "th", "rid"))
    per_doc = (rows.withColumn("rank", rank).join(parts, ["sid", "size", "salt"])
               .withColumn("copies", F.expr("k div m") + F.when(F.col("rank") <= F.expr("k % m"), 1).otherwise(0)))
    return (per_doc.join(state.select("sid", "source", "source_size", "target"), "sid")
            .select("doc_id", "th", "source", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


def mixed(docs: DataFrame, weights=WEIGHTS, factor: float = FACTOR, cap: float = CAP) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, unchanged.
    (Rows repeated under one doc_id and source are taken as one with the sum
    of their copies.)"""
    key = lambda th: F.xxhash64("doc_id", "source", th).alias("_key")
    taken = mix(docs, weights, factor, cap).groupBy(key("th")).agg(F.sum("copies").alias("_n")).filter("_n > 0")
    rows = docs.withColumn("_key", key(F.xxhash64("text"))).join(taken.hint("merge"), "_key")
    return (rows.dropDuplicates(["_key"]).withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
            .select(*docs.columns))
