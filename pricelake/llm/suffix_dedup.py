"""Repeated byte strings by a distributed suffix merge sort (operator 7).

A byte is removed when a ``LENGTH``-byte string that covers it also starts
anywhere else in the table (same document included, overlaps count).

1. *Anchors.*  Of every LENGTH-byte string the ``GRAM`` bytes with the smallest
   hash are its anchor (leftmost of ties), so equal strings have the same
   anchor at the same place.  Consecutive strings share anchors: about one
   suffix in 185 has to be sorted.  An anchor whose gram occurs once in the
   table anchors no repeated string and is dropped (a count by gram hash with
   partial aggregates).
2. *Runs.*  Each task sorts the suffixes that begin at its anchors (as far as
   a string can reach, LENGTH bytes) and front-codes the sorted run: the
   length of the prefix shared with the suffix before, then the rest.  Equal
   surroundings in one task are one entry.  Runs are cut at splitters, sampled
   quantiles of the suffixes' first 8 bytes, and exchanged.
3. *Merge.*  A range's runs are merged by a **loser tree** that keeps for each
   run's head the prefix it shares with the last suffix put out: of two heads
   the one that shares more is smaller, and only ties compare bytes, from the
   known prefix on.  The merge yields the suffix order and its LCP array.
4. *Repeats.*  Anchors with the same gram are neighbours in the order.  Two of
   them that share ``r`` bytes to the right and ``l`` to the left are inside a
   repeat of ``l + r`` bytes; from LENGTH on, both copies are marked.  Groups
   of more than ``SMALL`` anchors find, for every place of the anchor in its
   string, equal (left class, right class) pairs from the two LCP arrays.
5. A gram with more than ``HOT`` occurrences (a line in a third of all
   documents) would make one merge group: its strings are grouped by their
   128-bit hash instead, after collapsing equal strings in each task, which
   spreads by string and not by gram.

Marks return to the documents as byte intervals.

Edge cases: null and empty texts and texts under LENGTH bytes remove nothing
unless covered (they cannot be); repeated rows are each other's copies, so
both lose everything that is LENGTH bytes or more; null doc_ids are kept; a
text of any length is read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import map_in_pandas, materialize, shuffle_partitions, text_or_empty

LENGTH = 400
GRAM = 32
SMALL = 12
HOT = 4096
FLUSH = 16_000_000  # bytes of suffixes a task keeps before it writes its runs


# ---------------------------------------------------------------- anchors
def gram_hashes(data: bytes) -> np.ndarray:
    """64-bit hash of the GRAM bytes at every place (GRAM is 4 x 8)."""
    n = len(data) - GRAM + 1
    raw = np.frombuffer(data, dtype=np.uint8)
    words = np.zeros(n + 24, dtype=np.uint64)
    for shift in range(8):
        own = raw[shift:shift + (len(raw) - shift) // 8 * 8].view("<u8")
        words[shift::8][:len(own)] = own[:len(words[shift::8])]
    with np.errstate(over="ignore"):
        h = words[:n] * np.uint64(0x9E3779B97F4A7C15)
        for k in (8, 16, 24):
            h ^= h >> np.uint64(29)
            h += words[k:n + k]
            h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(29))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by block prefixes and suffixes."""
    n = len(x) - width + 1
    pad = np.full(-len(x) % width, np.uint64(2**64 - 1))
    blocks = np.concatenate([x, pad]).reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1:width - 1 + n])


def anchors(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, first string, last string, gram hash) of every anchor."""
    if len(data) < length:
        e = np.zeros(0, dtype=np.int64)
        return e, e, e, e
    h = gram_hashes(data)
    keys = (h >> np.uint64(32) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
    place = (_sliding_min(keys, length - GRAM + 1) & np.uint64(2**32 - 1)).astype(np.int64)
    starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    return place[starts], starts, np.r_[starts[1:], len(place)] - 1, h[place[starts]].view(np.int64)


def _anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            cols: list[list[np.ndarray]] = [[np.zeros(0, dtype=np.int64)] for _ in range(6)]
            for rid, text in zip(pdf["rid"].tolist(), pdf["text"].tolist()):
                data = text.encode()
                place, first, last, gram = anchors(data, length)
                if len(place):
                    raw = np.frombuffer(data, dtype=np.uint8)
                    lead = np.zeros(len(place), dtype=np.uint64)
                    for k in range(8):  # the suffix's first 8 bytes, in order; halved to fit a long
                        lead = (lead << np.uint64(8)) | raw[place + k]
                    for col, x in zip(cols, (np.full(len(place), rid), place, first, last, gram,
                                             (lead >> np.uint64(1)).astype(np.int64))):
                        col.append(x)
            yield pd.DataFrame(dict(zip(("rid", "place", "first", "last", "gram", "lead"),
                                        (np.concatenate(c) for c in cols))))
    return docs.select("rid", "text").mapInPandas(
        run, "rid long, place long, first long, last long, gram long, lead long")


# ---------------------------------------------------------------- runs
def lcp(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    top = min(len(a), len(b))
    if a[known:top] == b[known:top]:
        return top
    low, high = known, top  # a[:low] agrees, a[:high] does not
    step = 16
    while low + step < high and a[low:low + step] == b[low:low + step]:
        low += step
        step *= 2
    high = min(high, low + step)
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


_NUMBERS = np.dtype([("lcp", "<u2"), ("rest", "<u2"), ("left", "<u2"), ("rid", "<i8"), ("place", "<i8")])


def front_code(entries: list[tuple[bytes, bytes, int, int]]) -> bytes:
    """A sorted run of (suffix, left text reversed, rid, place), front-coded."""
    numbers = np.zeros(len(entries), dtype=_NUMBERS)
    texts, before = [], b""
    for k, (suffix, left, rid, place) in enumerate(entries):
        same = lcp(before, suffix)
        numbers[k] = (same, len(suffix) - same, len(left), rid, place)
        texts += [suffix[same:], left]
        before = suffix
    return zlib.compress(b"".join([len(entries).to_bytes(4, "little"),
                                   *(numbers[c].tobytes() for c in _NUMBERS.names), *texts]), 1)


class Run:
    """Reads a front-coded run entry by entry."""

    def __init__(self, blob: bytes):
        data = zlib.decompress(blob)
        n, at = int.from_bytes(data[:4], "little"), 4
        cols = []
        for c in _NUMBERS.names:
            size = n * _NUMBERS[c].itemsize
            cols.append(np.frombuffer(data[at:at + size], dtype=_NUMBERS[c]).tolist())
            at += size
        self._numbers, self._data, self._at = zip(*cols), data, at
        self.suffix, self.lcp, self.entry = b"", 0, None
        self.next()

    def next(self) -> None:
        """The next entry; ``lcp`` is what it shares with the one before."""
        numbers = next(self._numbers, None)
        if numbers is None:
            self.entry = None
            self._data = b""
            return
        self.lcp, rest, left, rid, place = numbers
        cut = self._at + rest
        self.suffix = self.suffix[:self.lcp] + self._data[self._at:cut]
        self._at = cut + left
        self.entry = (self.suffix, self._data[cut:self._at], rid, place)


def merge(runs: list[Run]) -> Iterator[tuple[int, tuple[bytes, bytes, int, int]]]:
    """(common prefix with the one before, entry) of all runs in order.

    A loser tree over the runs.  ``known[i]`` is what run i's head shares with
    the last suffix put out (its path's winner for the losers on it)."""
    k = 1
    while k < len(runs):
        k *= 2
    heads = runs + [None] * (k - len(runs))
    known = [0] * k

    def beats(i: int, j: int) -> bool:
        """Whether head i is smaller; keeps the loser's prefix with the winner."""
        a, b = heads[i], heads[j]
        if b is None or b.entry is None:
            return True
        if a is None or a.entry is None:
            return False
        if known[i] != known[j]:  # more in common with the last one: smaller
            return known[i] > known[j]
        same = lcp(a.suffix, b.suffix, known[i])
        first = a.suffix[same:same + 1] <= b.suffix[same:same + 1]
        known[j if first else i] = same
        return first

    losers = [0] * k
    winners = [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        i, j = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (i, j) if beats(i, j) else (j, i)
    top = winners[1] if k > 1 else 0
    while heads and heads[top] is not None and heads[top].entry is not None:
        yield known[top], heads[top].entry
        heads[top].next()
        known[top] = heads[top].lcp
        node = (top + k) // 2
        while node:
            if not beats(top, losers[node]):
                top, losers[node] = losers[node], top
            node //= 2


# ---------------------------------------------------------------- repeats
Mark = tuple[int, int, int]  # rid, first byte, end


def repeats(group: list[tuple[bytes, bytes, int, int]], right: list[int], length: int) -> Iterator[Mark]:
    """Marks of the anchors of one gram, in suffix order; ``right[k]`` is the
    prefix that suffix k shares with suffix k - 1."""
    n = len(group)
    if n > SMALL:
        yield from _repeats_by_class(group, right, length)
        return
    for i in range(n):
        r = length
        for j in range(i + 1, n):
            r = min(r, right[j])
            shared = lcp(group[i][1], group[j][1])
            if shared + r >= length:
                for _, _, rid, place in (group[i], group[j]):
                    yield rid, place - shared, place + r


def _repeats_by_class(group, right, length: int) -> Iterator[Mark]:
    """For every offset o of the anchor in its string: the members with equal
    o bytes to the left and equal length - o bytes to the right.  A class is
    the first member of its stretch in the order of that side."""
    n = len(group)
    most = max(len(g[1]) for g in group)
    offsets = np.arange(most + 1)
    by_left = sorted(range(n), key=lambda k: group[k][1])
    left = [0] + [lcp(group[a][1], group[b][1]) for a, b in zip(by_left, by_left[1:])]
    at = np.arange(n)[:, None]
    new_right = np.asarray(right)[:, None] < (length - offsets)[None, :]
    new_left = np.asarray(left)[:, None] < offsets[None, :]
    new_right[0] = new_left[0] = True
    right_class = np.maximum.accumulate(np.where(new_right, at, 0), axis=0)
    left_sorted = np.maximum.accumulate(np.where(new_left, at, 0), axis=0)
    left_class = np.empty_like(left_sorted)
    left_class[by_left] = left_sorted
    sizes_l = np.array([len(g[1]) for g in group])[:, None]
    sizes_r = np.array([len(g[0]) for g in group])[:, None]
    valid = (offsets[None, :] <= sizes_l) & (length - offsets[None, :] <= sizes_r)
    code = right_class.astype(np.int64) * n + left_class
    rows, cols = np.nonzero(valid)
    _, inverse, count = np.unique(np.stack([cols, code[rows, cols]]), axis=1, return_inverse=True, return_counts=True)
    again = count[inverse.ravel()] > 1
    flags = np.zeros((n, most + 2), dtype=np.int8)
    flags[rows[again], cols[again]] = 1
    edges = np.diff(np.concatenate([np.zeros((n, 1), dtype=np.int8), flags], axis=1), axis=1)
    starts, ends = np.nonzero(edges == 1), np.nonzero(edges == -1)
    for k, low, high in zip(starts[0].tolist(), starts[1].tolist(), ends[1].tolist()):
        _, _, rid, place = group[k]
        yield rid, place - (high - 1), place - low + length


def merged_repeats(runs: list[Run], length: int) -> Iterator[Mark]:
    """Marks of all gram groups of a merge."""
    group: list = []
    right: list[int] = []
    for shared, entry in merge(runs):
        if group and shared < GRAM:
            if len(group) > 1:
                yield from repeats(group, right, length)
            group, right = [], []
        group.append(entry)
        right.append(shared)
    if len(group) > 1:
        yield from repeats(group, right, length)


# ---------------------------------------------------------------- job
# no nulls in the number columns: pandas would make them floats
_ROW = "kind int, part int, run binary, rid long, first long, end long, string binary"
_COLS = ["kind", "part", "run", "rid", "first", "end", "string"]
RUN, MARK, STRING = 0, 1, 2


class _Task:
    """Collects a task's suffixes and hot strings; gives rows when asked."""

    def __init__(self, splitters: np.ndarray, length: int):
        self.splitters, self.length = splitters, length
        self._clear()

    def _clear(self) -> None:
        self.entries: dict[tuple[bytes, bytes], list[tuple[int, int]]] = defaultdict(list)
        self.strings: list[bytes] = []
        self.places: list[tuple[int, int]] = []
        self.size = 0

    def add(self, data: bytes, rid: int, place: int, first: int, last: int) -> None:
        """One anchor: its suffix and, reversed, the text to its left."""
        key = data[place:last + self.length], data[first:place][::-1]
        self.entries[key].append((rid, place))
        self.size += len(key[0]) + len(key[1]) + 100

    def add_hot(self, data: bytes, rid: int, first: int, last: int) -> None:
        """The hashes of all strings of a hot anchor."""
        for p in range(first, last + 1):
            self.strings.append(xxhash.xxh3_128_digest(data[p:p + self.length]))
            self.places.append((rid, p))
        self.size += 150 * (last + 1 - first)

    def rows(self) -> list[tuple]:
        """Marks of what the task holds twice, the sorted runs by range, and
        each hot string once."""
        out: list[tuple] = []
        parts: dict[int, list] = defaultdict(list)
        keys = sorted(self.entries)
        leads = np.array([int.from_bytes(k[0][:8], "big") >> 1 for k in keys], dtype=np.int64)
        for (suffix, left), part in zip(keys, np.searchsorted(self.splitters, leads, side="right").tolist()):
            met = self.entries[suffix, left]
            if len(met) > 1:
                out += [(MARK, -1, None, rid, place - len(left), place + len(suffix), None) for rid, place in met]
            parts[part].append((suffix, left, *met[0]))
        out += [(RUN, part, front_code(entries), 0, 0, 0, None) for part, entries in parts.items()]
        out += self._string_rows()
        self._clear()
        return out

    def _string_rows(self) -> list[tuple]:
        if not self.strings:
            return []
        keys = np.frombuffer(b"".join(self.strings), dtype="V16")
        _, first, inverse, count = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        twice = count[inverse.ravel()] > 1
        out = [(STRING, -1, None, *self.places[i], self.places[i][1] + self.length, self.strings[i])
               for i in first.tolist()]
        places = np.array(self.places, dtype=np.int64)[twice]
        if len(places):  # strings at neighbouring places are one mark
            places = places[np.lexsort((places[:, 1], places[:, 0]))]
            new = np.r_[True, (np.diff(places[:, 0]) != 0) | (np.diff(places[:, 1]) > 1)]
            last = places[np.r_[new[1:], True]]
            out += [(MARK, -1, None, rid, p, q + self.length, None)
                    for (rid, p), q in zip(places[new].tolist(), last[:, 1].tolist())]
        return out


def _exchange_rows(docs: DataFrame, wanted: DataFrame, splitters: np.ndarray, length: int) -> DataFrame:
    """Runs, marks found inside a task, and hot strings, of the documents that
    have wanted anchors."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = _Task(splitters, length)
        for pdf in batches:
            for rid, text, found in zip(pdf["rid"].tolist(), pdf["text"].tolist(), pdf["found"]):
                data = text.encode()
                for a in found:
                    if a["hot"]:
                        task.add_hot(data, rid, a["first"], a["last"])
                    else:
                        task.add(data, rid, a["place"], a["first"], a["last"])
                if task.size > FLUSH:
                    yield pd.DataFrame(task.rows(), columns=_COLS)
        yield pd.DataFrame(task.rows(), columns=_COLS)
    # a shuffle join at every size: the texts move once, in proportion to the input
    met = docs.hint("merge").join(wanted, "rid")
    return met.select("rid", "text", "found").mapInPandas(run, _ROW)


def _merge_ranges(pdf: pd.DataFrame, length: int) -> pd.DataFrame:
    marks = sorted(set(merged_repeats([Run(b) for b in pdf["run"]], length)))
    return pd.DataFrame(marks, columns=["rid", "first", "end"])


def _string_marks(strings: DataFrame) -> DataFrame:
    """Places of the hot strings that occur more than once."""
    twice = strings.groupBy("string").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("string")
    return strings.join(twice, "string").select("rid", "first", "end")


def _union(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of overlapping or touching intervals."""
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(end[order])
    new = np.r_[True, first[1:] > end[:-1]]
    return first[new], end[np.r_[new[1:], True]]


def _cut_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for text, first, end in zip(pdf["text"].tolist(), pdf["first"], pdf["end"]):
            data = text.encode()
            if first is None or not len(first):
                rows.append((len(data), 0, 0, hashlib.sha256(data).hexdigest()))
                continue
            low, high = _union(np.asarray(first), np.asarray(end))
            kept = hashlib.sha256()
            at = 0
            for a, b in zip(low.tolist(), high.tolist()):
                kept.update(data[at:a])
                at = b
            kept.update(data[at:])
            rows.append((len(data), int((high - low).sum()), len(low), kept.hexdigest()))
        out = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])
        out.insert(0, "doc_id", pdf["doc_id"].to_numpy())
        yield out


def spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(rid, first, end): byte intervals of repeats in ``docs`` (rid, text);
    rows with the same rid must have the same text."""
    spark = docs.sparkSession
    found = materialize(_anchor_rows(docs.filter(F.octet_length("text") >= length), length))
    # written first, so that the join below reads two plain shuffles and Spark can split a hot gram
    often = materialize(found.groupBy("gram").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"))
    repeated = (found.join(often, "gram")
                .select("rid", "place", "first", "last", "lead", (F.col("m") > HOT).alias("hot")))
    repeated = materialize(repeated)
    parts = shuffle_partitions(spark)
    quantiles = [k / parts for k in range(1, parts)]
    picked = repeated.filter("not hot").agg(F.percentile_approx("lead", quantiles, 10_000)).first()[0] if quantiles else None
    splitters = np.unique(np.array(picked or [], dtype=np.int64))
    wanted = repeated.groupBy("rid").agg(F.collect_set(F.struct("place", "first", "last", "hot")).alias("found"))
    long_ = docs.filter(F.octet_length("text") >= length)
    rows = materialize(_exchange_rows(long_, wanted, splitters, length))
    merged = (rows.filter(F.col("kind") == RUN).select("part", "run").groupBy("part")
              .applyInPandas(lambda pdf: _merge_ranges(pdf, length), "rid long, first long, end long"))
    return (rows.filter(F.col("kind") == MARK).select("rid", "first", "end").unionByName(merged)
            .unionByName(_string_marks(rows.filter(F.col("kind") == STRING))))


def suffix_dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    # rows with equal doc_id and text may share a key: their marks are the same
    named = docs.select("doc_id", text_or_empty().alias("text")).withColumn("rid", F.xxhash64("doc_id", "text"))
    marks = (spans(named.select("rid", "text"), length).groupBy("rid")
             .agg(F.collect_list("first").alias("first"), F.collect_list("end").alias("end")))
    return map_in_pandas(named.hint("merge").join(marks, "rid", "left").select("doc_id", "text", "first", "end"),
                         _cut_rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
