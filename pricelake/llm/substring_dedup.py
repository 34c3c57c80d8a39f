"""Repeated word passages by seed and extend (operator 12).

A window is ``LENGTH`` consecutive words of one document.  A word is removed
when a window that covers it has a word sequence that also starts in a document
with a smaller doc_id.  Windows are judged on the input.

1. *Winnowed seeds.*  Of every window the ``SEED``-word gram with the smallest
   hash (leftmost of ties) is its anchor, so equal windows have the same anchor
   at the same place.  Consecutive windows share anchors: each anchor place
   owns one run of windows, and each window belongs to one run.  Some 7 of 100
   words start a run.
2. *Join on anchors.*  Runs are grouped by the hash of their anchor with partial
   aggregates: an anchor in one document only is no seed.  A seed's *zone* is
   the text of its run, from its first window's first word to its last window's
   last.  Runs with equal zones extend to the whole zone, so all of them but
   those of the smallest doc_id are done without another look.
3. *Extension.*  Where the zones of one anchor differ, a match reaches some
   words to the left of the anchor and some to the right.  For each zone its
   smallest document is read again, and every (left, right) reach of ``LENGTH``
   words around the anchor -- the windows of the run -- meets the smallest
   document with the same stretch.  This extends a seed against all its partners
   at once, in proportion to the seeds; pairs of documents never form, however
   many share a passage.
4. *Maximal repeats.*  Overlapping stretches of a document merge to maximal
   spans of at least ``LENGTH`` words, which are cut out.

Words are compared by two 64-bit hashes, stretches by 128 bits.  Every
aggregate is a minimum and a maximum, so a hot anchor or zone is one row for
each map task; the joins back have one row for each key on one side, which
Spark's adaptive skew join splits.

Edge cases: null and empty texts have no words; a text under ``LENGTH`` words
has no window; null doc_ids are neither smaller nor larger than others (nothing
is removed from or because of them); rows that share a doc_id remove nothing
from each other; repeated rows come back as often as given; a text of any
length is read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import map_in_pandas, materialize, text_or_empty

LENGTH = 50
SEED = 25
BASE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)  # odd, for the rolling hashes
KNOWN_WORDS = 300_000  # words whose hashes a task remembers
FLUSH = 1_000_000  # rows a task collects before it puts them out


class WordHashes:
    """Two 64-bit hashes of every word of a text; a bounded memory of words
    saves work only."""

    def __init__(self):
        self.known: dict[bytes, int] = {}
        self.table = np.empty((KNOWN_WORDS, 2), dtype=np.uint64)

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode().split()
        out = np.empty((len(words), 2), dtype=np.uint64)
        for at in range(0, len(words), KNOWN_WORDS):
            part = words[at:at + KNOWN_WORDS]
            new = [w for w in set(part) if w not in self.known]
            if len(self.known) + len(new) > KNOWN_WORDS:
                self.known, new = {}, set(part)
            for w in new:
                n = len(self.known)
                self.known[w] = n
                h = xxhash.xxh3_128_intdigest(w)
                self.table[n] = h & 0xFFFFFFFFFFFFFFFF, h >> 64
            out[at:at + len(part)] = self.table[np.fromiter(map(self.known.__getitem__, part), np.int64, len(part))]
        return out


class Stretches:
    """Hashes of any stretch of a word sequence: sum of word[i] * base**(n - i)
    times base**(end - n), modulo 2**64 in two lanes, from prefix sums."""

    INVERSE = np.array([pow(int(b), -1, 1 << 64) for b in BASE], dtype=np.uint64)
    up = down = np.ones((1, 2), dtype=np.uint64)  # powers of the bases and of their inverses, as far as needed yet

    def __init__(self, words: np.ndarray):
        n = len(words)
        if n >= len(self.up):
            shape = (2 * n, 2)
            Stretches.up, Stretches.down = (
                np.concatenate([np.ones((1, 2), np.uint64), np.multiply.accumulate(np.broadcast_to(b, shape), axis=0)])
                for b in (BASE, self.INVERSE))
        self.prefix = np.zeros((n + 1, 2), dtype=np.uint64)
        np.cumsum(words * self.up[n:0:-1], axis=0, out=self.prefix[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.prefix[end] - self.prefix[start]) * self.down[len(self.prefix) - 1 - end]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits (public finalizer constants), so that order by it is random."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` grams the place of its smallest (leftmost of
    ties), by doubling."""
    value, place, reach = grams, np.arange(len(grams)), 1
    while reach < width:
        step = min(reach, width - reach)
        m = len(value) - step
        later = value[step:] < value[:m]
        value, place = np.where(later, value[step:], value[:m]), np.where(later, place[step:], place[:m])
        reach += step
    return place


def runs(stretches: Stretches, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor hash, anchor place) of each run."""
    at = np.arange(n - SEED + 1)
    grams = mixed(stretches(at, at + SEED)[:, 0])
    place = anchors(grams, LENGTH - SEED + 1)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return first, np.diff(np.append(first, len(place))), grams[place[first]], place[first]


def _signed(h: np.ndarray) -> np.ndarray:
    return h.astype(np.uint64).view(np.int64)


def _put(parts: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame({c: np.concatenate([p[i] for p in parts]) for i, c in enumerate(names)})


RUN_COLS = ["anchor", "zone1", "zone2", "doc_id", "th", "first", "windows"]


def _find_runs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    parts, held = [], 0
    for pdf in frames:
        for doc_id, th, text in zip(pdf["doc_id"], pdf["th"], pdf["text"]):
            words = hashes(text)
            if len(words) < LENGTH:
                continue
            s = Stretches(words)
            first, windows, anchor, place = runs(s, len(words))
            zone = s(first, first + windows + LENGTH - 1)
            # the anchor's offset and the run's length are part of the zone
            shape = mixed(((place - first) * (1 << 20) + windows).astype(np.uint64))
            k = len(first)
            parts.append((_signed(anchor), _signed(zone[:, 0] ^ shape), _signed(zone[:, 1] + shape),
                          np.full(k, doc_id, dtype=np.int64), np.full(k, th, dtype=np.int64),
                          first.astype(np.int32), windows.astype(np.int32)))
            held += k
            if held >= FLUSH:
                yield _put(parts, RUN_COLS)
                parts, held = [], 0
    if parts:
        yield _put(parts, RUN_COLS)


WINDOW_COLS = ["w1", "w2", "doc_id", "th", "first"]


def _find_windows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    parts, held = [], 0
    for pdf in frames:
        for doc_id, th, text, seeds in zip(pdf["doc_id"], pdf["th"], pdf["text"], pdf["seeds"]):
            s = Stretches(hashes(text))
            spans = np.array([(r["first"], r["windows"]) for r in seeds], dtype=np.int64).reshape(-1, 2)
            at = np.repeat(spans[:, 0] - np.append(0, np.cumsum(spans[:, 1])[:-1]), spans[:, 1]) + np.arange(spans[:, 1].sum())
            h = s(at, at + LENGTH)
            k = len(at)
            parts.append((_signed(h[:, 0]), _signed(h[:, 1]), np.full(k, doc_id, dtype=np.int64),
                          np.full(k, th, dtype=np.int64), at.astype(np.int32)))
            held += k
            if held >= FLUSH:
                yield _put(parts, WINDOW_COLS)
                parts, held = [], 0
    if parts:
        yield _put(parts, WINDOW_COLS)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(start, end) spans united to maximal ones."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def _cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        rows = []
        for doc_id, text, found in zip(pdf["doc_id"], pdf["text"], pdf["found"]):
            words = text.encode().split()
            spans = merged([(r["first"], r["last"]) for r in found]) if found is not None else []
            kept, at = [], 0
            for a, b in spans:
                kept += words[at:a]
                at = b
            kept += words[at:]
            body = b" ".join(kept)
            rows.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(body).hexdigest(), len(spans),
                         body.decode()))
        yield pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept_sha256", "n_spans", "kept_text"])


def found_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, th, first, last): stretches of words that a document with a
    smaller doc_id has too; ``th`` is the hash of the text they are in."""
    texts = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("th"), "text")
    schema = "anchor long, zone1 long, zone2 long, doc_id long, th long, first int, windows int"
    found = materialize(texts.mapInPandas(_find_runs, schema))
    # one row for each zone: its smallest document; then what the anchor has in all
    zones = materialize(found.groupBy("anchor", "zone1", "zone2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")))
    zone = F.struct("zone1", "zone2")
    seeds = (zones.groupBy("anchor")
             .agg(F.min("low").alias("lowest"), F.max("high").alias("highest"),
                  (F.min(zone) != F.max(zone)).alias("several"))
             .filter("lowest < highest"))
    matched = materialize(zones.join(seeds.select("anchor", "several"), "anchor").filter("several OR low < high"))
    seen = found.join(matched, ["anchor", "zone1", "zone2"])
    whole = (seen.filter("doc_id > low")
             .select("doc_id", "th", "first", (F.col("first") + F.col("windows") + F.lit(LENGTH - 1)).alias("last")))
    # zones that differ around one anchor: every reach of their smallest document
    open_seeds = (seen.filter("several AND doc_id = low").groupBy("doc_id", "th")
                  .agg(F.collect_set(F.struct("first", "windows")).alias("seeds")))
    again = texts.join(open_seeds, ["doc_id", "th"]).dropDuplicates(["doc_id", "th"])
    windows = materialize(again.select("doc_id", "th", "text", "seeds")
                          .mapInPandas(_find_windows, "w1 long, w2 long, doc_id long, th long, first int"))
    shared = (windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
              .filter("low < high").select("w1", "w2", "low"))
    reach = (windows.join(shared, ["w1", "w2"]).filter("doc_id > low")
             .select("doc_id", "th", "first", (F.col("first") + F.lit(LENGTH)).alias("last")))
    return whole.unionByName(reach)


def repeats(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, n_words, n_removed, kept_sha256,
    n_spans (maximal removed spans) and kept_text."""
    per_doc = (found_spans(docs).groupBy(F.col("doc_id").alias("_id"), F.col("th").alias("_th"))
               .agg(F.collect_set(F.struct("first", "last")).alias("found")))
    texts = docs.select("doc_id", text_or_empty().alias("text"), F.xxhash64("text").alias("th"))
    joined = texts.join(per_doc, (F.col("doc_id") == F.col("_id")) & (F.col("th") == F.col("_th")), "left")
    return map_in_pandas(joined.select("doc_id", "text", "found"), _cut,
                         "doc_id long, n_words long, n_removed long, kept_sha256 string, n_spans long, kept_text string")
