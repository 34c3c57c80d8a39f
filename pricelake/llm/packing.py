"""Best-fit packing of documents into sequences (operator 1).

A document's ids (an end id appended) are cut into pieces of at most
``capacity`` tokens.  Pieces of one length are interchangeable, so the packing
is planned on the histogram of lengths: at most ``capacity`` rows whatever the
number of documents, the only thing that reaches the driver.

Best-two-fit on the histogram: open a sequence with the longest length left,
fill it greedily with the longest that fits, then, while it leaves a gap, take
its smallest piece out and look for the two unpacked lengths that fit the
expanded gap most tightly; keep the pair if it fills more.  The finished
pattern is repeated as often as the counts allow, which uses up (almost) all
of at least one length, so the plan has a number of patterns in the order of
``capacity``.

Ranks inside a length (salted, so that a length with a third of all pieces is
no single window group) map each piece to its pattern, sequence and offset by
a binary search in the plan.

Edge cases: a null or empty text is one piece holding the end id; repeated
rows are separate documents; null doc_ids are kept; an empty table gives an
empty result; texts of any length are tokenized whole.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelake.llm.common import map_in_pandas, materialize
from pricelake.llm.tokens import chunk_ids, kept_as

CAPACITY = 4096
END_ID = 1
MIN_SALTS = 64
ROWS_PER_SALT = 1_000_000


def cut(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = chunk_ids(path)
        for pdf in batches:
            rows = []
            for at, ids in enumerate(ids_of.texts(pdf["text"].tolist())):
                ids += end
                for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[start:start + 4 * capacity]
                    rows.append((at, piece, start // 4, len(own) // 4, zlib.crc32(own)))
            at, *cols = zip(*rows) if rows else [()] * 5
            yield pd.DataFrame({"doc_id": pdf["doc_id"].take(list(at)).to_numpy(),
                                **dict(zip(("piece", "start", "length", "ids_crc32"), cols))})
    return map_in_pandas(docs.select("doc_id", "text"), pieces,
                         "doc_id long, piece int, start long, length long, ids_crc32 long", keep=kept_as(path))


class Plan:
    """Runs of equal patterns: for a length, ranks [first, first + take) go to
    ``per`` places a sequence from sequence ``seq``, offset ``at``."""

    def __init__(self, counts: dict[int, int], capacity: int):
        left = np.zeros(capacity + 1, dtype=np.int64)
        for length, n in counts.items():
            left[length] = n
        used = np.zeros(capacity + 1, dtype=np.int64)  # ranks given out, by length
        runs: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0
        longest = capacity
        while longest:
            if not left[longest]:
                longest -= 1
                continue
            pattern = _pattern(left, longest, capacity)
            times = min(int(left[x]) // k for x, k in pattern.items())
            at = 0
            for x, k in pattern.items():
                runs.append((x, int(used[x]), k, self.sequences, at))
                used[x] += k * times
                left[x] -= k * times
                at += x * k
            self.sequences += times
        runs.sort()
        self.runs = np.array(runs, dtype=np.int64).reshape(-1, 5)
        self.starts = self.runs[:, 0] * (1 << 48) + self.runs[:, 1]

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        run = self.runs[np.searchsorted(self.starts, length * (1 << 48) + rank, side="right") - 1]
        within = rank - run[:, 1]
        return run[:, 3] + within // run[:, 2], run[:, 4] + within % run[:, 2] * length


def _pattern(left: np.ndarray, longest: int, capacity: int) -> dict[int, int]:
    """One sequence from the lengths left: greedy fill, then best-two-fit."""
    left = left.copy()
    left[0] = 0
    present = np.flatnonzero(left).tolist()
    pattern: dict[int, int] = {}

    def put(x: int, k: int) -> None:
        left[x] -= k
        pattern[x] = pattern.get(x, 0) + k
        if not pattern[x]:
            del pattern[x]

    put(longest, 1)
    gap = capacity - longest
    while gap:
        i = bisect_right(present, gap) - 1
        while i >= 0 and not left[present[i]]:
            i -= 1
        if i < 0:
            break
        x = present[i]
        k = min(int(left[x]), gap // x)
        put(x, k)
        gap -= k * x
    while gap and sum(pattern.values()) > 1:
        smallest = min(pattern)
        pair = _best_pair(left, gap + smallest)
        if pair is None or sum(pair) <= smallest:
            break
        put(smallest, -1)
        for x in pair:
            put(x, 1)
        gap += smallest - sum(pair)
    return pattern


def _best_pair(left: np.ndarray, room: int) -> tuple[int, int] | None:
    """The two unpacked lengths with the largest sum of at most ``room``."""
    upto = min(room, len(left) - 1)
    have = left[:upto + 1] > 0
    floor_ = np.maximum.accumulate(np.where(have, np.arange(upto + 1), 0))  # longest present length <= i
    a = np.flatnonzero(have)
    if not len(a):
        return None
    b = floor_[np.minimum(np.minimum(a, room - a), upto)]
    twice = (b == a) & (left[a] < 2)
    b = np.where(twice, floor_[np.maximum(a - 1, 0)], b)
    total = np.where(b > 0, a + b, 0)
    best = int(total.argmax())
    return (int(a[best]), int(b[best])) if total[best] else None


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset."""
    pieces = materialize(cut(docs, path, capacity, end_id))
    lengths = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # <= capacity rows
    plan = Plan({r["length"]: r["n"] for r in lengths}, capacity)
    salts = max(MIN_SALTS, -(-sum(r["n"] for r in lengths) // ROWS_PER_SALT))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    before = F.sum("m").over(Window.partitionBy("length").orderBy("salt")
                             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("m"))
               .select("length", "salt", F.coalesce(before, F.lit(0)).alias("before")))
    in_salt = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece"))
    ranked = (salted.withColumn("rn", in_salt).join(offsets, ["length", "salt"])
              .withColumn("rank", F.col("before") + F.col("rn") - 1).drop("salt", "rn", "before"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seq, at = plan.place(pdf["length"].to_numpy(), pdf["rank"].to_numpy())
            yield pdf.drop(columns="rank").assign(sequence_id=seq, offset=at)
    return map_in_pandas(ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank"), place,
                         "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
