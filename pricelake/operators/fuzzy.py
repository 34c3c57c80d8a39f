"""Blocked fuzzy best-match (token-sort ratio) as a distributed join.

Score (F6) = normalised indel similarity of the token-sorted strings, x100:
``100 * (1 - (la + lb - 2*LCS) / (la + lb))``.  A candidate counts when the
score is at least the threshold (80 by default).

Instead of comparing every query row with every candidate row of its block
(quadratic in the block, and again per duplicate row), the job:

1. reduces both sides to distinct names per block (partial aggregation),
   token-sorting each name once;
2. joins on (block, length band, salt) with the candidate side expanded to the
   bands of ``BAND`` lengths it can reach: score >= 80 forces 2/3*la <= lb <=
   3/2*la, so pairs far outside that window are never met, and the join condition
   drops those at a band's edge.  The pairs of each (block, band)
   are counted first, from the two sides' group sizes; a group with more than
   ``PAIRS_PER_TASK`` is cut into tiles of queries x candidates, so a hot block
   becomes many tasks; at most ``MAX_TILES``, so that the names moved grow in
   line with the names given;
3. drops, inside the join condition, the pairs whose characters cannot give
   the score: the LCS is at most the number of characters the two names have
   in common, counted with multiplicity.  Each name carries these counts as a
   bitmap (the i-th occurrence of a character class is one bit), so the bound
   is a ``bit_count`` of two ANDs in generated code, some nanoseconds a pair;
4. drops pairs whose Levenshtein distance already rules them out
   (indel distance >= Levenshtein, so ``5*lev > la+lb`` means score < 80),
   using the native bounded ``levenshtein(a, b, k)``;
5. computes the exact LCS of the survivors, bit-parallel over all pairs of an
   Arrow batch at once (one vector step for each character);
6. keeps the best candidate per query name with ``max_by`` (score desc,
   candidate name asc, id asc), a partial aggregate.

An index of segments (split a name so that one part must stay intact) does not
prune here: a score of 80 lets two names of 30 characters differ by 12 edits,
so the parts are 2 characters long and nearly every pair shares one nearby.
"""

from __future__ import annotations

import sys
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.functions.text import token_sort
from pricelake.operators.order import asc, desc, first_by

PAIRS_PER_TASK = 10_000_000  # of one (block, length band) before it is cut into tiles
MAX_TILES = 36  # of one (block, length band)
BAND = 8  # query lengths of one band

# The scorer is shipped to the Python workers with the task (by value), so
# executors need no copy of this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence (bit-parallel, any length)."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & masks.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - bin(v).count("1")


WORD = 64


def lcs_lengths(a: list[str], b: list[str]) -> np.ndarray:
    """LCS lengths of pairs: the bit-parallel recurrence on vectors of 64-bit
    words, one step for each character of the longest ``b``.  Pairs whose
    ``a`` has more than 64 characters go one by one."""
    out = np.zeros(len(a), dtype=np.int32)
    long_ = np.array([len(x) > WORD for x in a], dtype=bool)
    for i in np.flatnonzero(long_):
        out[i] = lcs_length(a[i], b[i])
    rows = [i for i in np.flatnonzero(~long_) if a[i] and b[i]]
    if not rows:
        return out
    # characters as small numbers; 0 is padding and equals nothing
    code = {c: i + 1 for i, c in enumerate(sorted(set("".join(a[i] + b[i] for i in rows))))}
    n, steps = len(rows), max(len(b[i]) for i in rows)
    masks = np.zeros((n, len(code) + 1), dtype=np.uint64)
    other = np.zeros((steps, n), dtype=np.int64)
    for r, i in enumerate(rows):
        other[:len(b[i]), r] = [code[c] for c in b[i]]
    first = np.zeros((n, max(len(a[i]) for i in rows)), dtype=np.int64)
    for r, i in enumerate(rows):
        first[r, :len(a[i])] = [code[c] for c in a[i]]
    at = np.arange(n)
    for j in range(first.shape[1]):
        masks[at, first[:, j]] |= np.uint64(1) << np.uint64(j)
    masks[:, 0] = 0
    v = np.full(n, 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    for ch in other:
        u = v & masks[at, ch]
        v = (v + u) | (v - u)
    # bits beyond the length of a stay set: no character of b meets them
    out[rows] = WORD - np.bitwise_count(v)
    return out


@F.pandas_udf(T.IntegerType())
def lcs_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(lcs_lengths(a.tolist(), b.tolist()), dtype="int32")


# Character classes with the occurrences that get a bit; all other characters
# are one class.  Occurrences beyond these are counted together.
CLASSES = [("abcdefghijklmnopqrstuvwxyz", 4), ("0123456789", 2)]
OTHER_BITS = 4


def _bag(text: str, prefix: str) -> dict[str, Column]:
    """Two bitmaps and an overflow count of the characters of a name."""
    counts = [(F.length(text) - F.length(F.translate(text, c, "")), bits) for chars, bits in CLASSES for c in chars]
    listed = "".join(chars for chars, _ in CLASSES)
    counts.append((F.length(F.translate(text, listed, "")), OTHER_BITS))
    words, used = [[], []], [0, 0]
    for count, bits in counts:
        w = 0 if used[0] + bits <= WORD else 1
        ones = F.call_function("shiftleft", F.lit(1).cast("long"), F.least(count, F.lit(bits))) - F.lit(1)
        words[w].append(F.shiftleft(ones, used[w]))
        used[w] += bits
    over = sum((F.greatest(count - F.lit(bits), F.lit(0)) for count, bits in counts), F.lit(0))
    return {f"{prefix}0": reduce(Column.bitwiseOR, words[0]), f"{prefix}1": reduce(Column.bitwiseOR, words[1]),
            f"{prefix}2": over}


def common_characters(q: str = "_q", c: str = "_c") -> Column:
    """Upper bound of the LCS: characters in common, with multiplicity."""
    return (F.bit_count(F.col(f"{q}0").bitwiseAND(F.col(f"{c}0"))) + F.bit_count(F.col(f"{q}1").bitwiseAND(F.col(f"{c}1")))
            + F.least(f"{q}2", f"{c}2"))


def _salted(q: DataFrame, c: DataFrame, group: list[str], pairs_per_task: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_salt``: a group with more pairs than ``pairs_per_task`` is
    cut into tiles, queries dealt over rows and candidates over columns, so that a
    pair meets in one tile.  Tiles are about square, as a name is repeated along
    its row or column, and at most ``MAX_TILES`` of a group: names are repeated a
    bounded number of times, however large the group."""
    n = q.groupBy(*group).agg(F.count(F.lit(1)).alias("_nq")).join(c.groupBy(*group).agg(F.count(F.lit(1)).alias("_nc")), group)
    tiles = F.least(F.lit(MAX_TILES), F.ceil(F.col("_nq") * F.col("_nc") / F.lit(pairs_per_task)))
    # no more rows than queries, no more columns than candidates
    n = n.withColumn("_tiles", tiles).where("_tiles > 1").withColumn(
        "_rows", F.greatest(F.lit(1), F.least("_nq", "_tiles", F.round(F.sqrt(F.col("_tiles") * F.col("_nq") / F.col("_nc"))))).cast("int"))
    hot = n.select(*group, "_rows", F.least("_nc", F.ceil(F.col("_tiles") / F.col("_rows"))).cast("int").alias("_cols"))
    rows, cols = F.coalesce("_rows", F.lit(1)), F.coalesce("_cols", F.lit(1))
    row = F.pmod(F.xxhash64("_qs"), rows).cast("int")
    q = (q.join(hot, group, "left").withColumn("_at", F.explode(F.sequence(F.lit(0), cols - F.lit(1))))
         .withColumn("_salt", row * cols + F.col("_at")).drop("_at", "_rows", "_cols"))
    col = F.pmod(F.xxhash64("_cs"), cols).cast("int")
    c = (c.join(hot, group, "left").withColumn("_at", F.explode(F.sequence(F.lit(0), rows - F.lit(1))))
         .withColumn("_salt", F.col("_at") * cols + col).drop("_at", "_rows", "_cols"))
    return q, c


def candidate_pairs(queries: DataFrame, candidates: DataFrame, block: list[str],
                    name: str = "canonical_name", cand_id: str = "canonical_product_id",
                    threshold: int = 80, common: bool = False, pairs_per_task: int = PAIRS_PER_TASK) -> DataFrame:
    """Distinct (query name, candidate name) pairs of a block that can still
    reach ``threshold``: inside the length window and within the Levenshtein
    bound; with ``common`` also within the bound of common characters.
    ``queries``: block cols + ``name``; ``candidates``: block cols + ``name`` +
    ``cand_id``."""
    q = (queries.select(*block, name)
         .where(F.col(name).isNotNull() & (F.trim(F.col(name)) != ""))
         .distinct()
         .withColumn("_qs", token_sort(name))
         .withColumn("_len", F.length("_qs")))
    c = (candidates.where(F.col(name).isNotNull())
         .groupBy(*block, name).agg(F.min(cand_id).alias(cand_id))
         .withColumnRenamed(name, "cand_name")
         .withColumn("_cs", token_sort("cand_name"))
         .withColumn("_cl", F.length("_cs")))
    if common:
        q, c = q.withColumns(_bag("_qs", "_q")), c.withColumns(_bag("_cs", "_c"))
    # score >= t needs 200*min(la,lb) >= t*(la+lb): the reachable query lengths
    lo = F.expr(f"CAST(ceil(_cl * {threshold} / (200 - {threshold})) AS INT)")
    hi = F.expr(f"CAST(floor(_cl * (200 - {threshold}) / {threshold}) AS INT)")
    band = lambda length: F.floor(length / BAND).cast("int")
    q = q.withColumn("_band", band(F.col("_len")))
    c = c.withColumns({"_lo": F.greatest(lo, F.lit(1)), "_hi": F.greatest(hi, F.lit(1))})
    c = c.withColumn("_band", F.explode(F.sequence(band(F.col("_lo")), band(F.col("_hi")))))
    q, c = _salted(q, c, [*block, "_band"], pairs_per_task)
    on = [*block, "_band", "_salt"]
    c = c.select(*[F.col(x).alias(f"_r_{x}") if x in on else F.col(x) for x in c.columns])
    lsum = F.col("_len") + F.col("_cl")
    # max indel distance allowed: lsum * (100 - t) / 100; Levenshtein <= indel.
    k = F.floor(lsum * (100 - threshold) / 100).cast("int")
    cond = reduce(Column.__and__, [F.col(x) == F.col(f"_r_{x}") for x in on]) & F.col("_len").between(F.col("_lo"), F.col("_hi"))
    if common:
        cond = cond & (common_characters() * 200 >= lsum * threshold)
    return (q.join(c, cond).drop("_band", "_salt", "_lo", "_hi", *[f"_r_{x}" for x in on])
            .where(F.call_function("levenshtein", F.col("_qs"), F.col("_cs"), k) >= 0))


def pair_scores(queries: DataFrame, candidates: DataFrame, block: list[str],
                name: str = "canonical_name", cand_id: str = "canonical_product_id",
                threshold: int = 80) -> DataFrame:
    """All (query name, candidate name) pairs of a block with score >= threshold.

    Output: block, ``name``, ``cand_name``, ``cand_id``, ``match_score``."""
    pairs = candidate_pairs(queries, candidates, block, name, cand_id, threshold, common=True)
    lsum = F.col("_len") + F.col("_cl")
    pairs = pairs.withColumn("_lcs", lcs_udf("_qs", "_cs"))
    pairs = pairs.where(F.col("_lcs") * 200 >= lsum * threshold)
    score = F.lit(100.0) * (F.lit(1.0) - (lsum - 2 * F.col("_lcs")).cast("double") / lsum.cast("double"))
    return pairs.select(*block, name, "cand_name", cand_id, score.alias("match_score"))


def best_match(queries: DataFrame, candidates: DataFrame, block: list[str],
               name: str = "canonical_name", cand_id: str = "canonical_product_id",
               threshold: int = 80) -> DataFrame:
    """Best candidate per (block, name): block, name, cand_id, match_score."""
    scored = pair_scores(queries, candidates, block, name, cand_id, threshold)
    best = first_by(scored, F.struct(cand_id, "match_score"), [desc("match_score"), asc("cand_name"), asc(cand_id)])
    return (scored.groupBy(*block, name)
            .agg(best.alias("_b"))
            .select(*block, name, F.col("_b." + cand_id).alias(cand_id),
                    F.col("_b.match_score").alias("match_score")))
