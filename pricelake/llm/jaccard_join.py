"""N-gram Jaccard join and its components (operator 2).

A document's set is its distinct 5-word shingles (ASCII lower case; fewer
words: the whole sequence is one).  Documents link when
``100 * |A & B| >= 75 * |A | B|``; every document gets its component's smallest
doc_id.  Equal sets are one **class**; all work is on classes.

Token-group matrix.

1. *Groups.*  Classes that share one of ``SIGNATURES`` min-hashes are compared
   with their leader; confirmed links give a first set of components.  Linked or
   not, the classes that share a min-hash are one family, cut into groups of
   about ``GROUP``: a thousand copies around one text that are not 0.75-similar
   to each other are a few groups.
2. *Matrix.*  Sets are ordered rarest shingle first (counts of all documents
   in a fixed-size table).  Two sets of the wanted overlap share a shingle
   among their first ``n - ceil(0.75 n) + 1``, whatever the order.  Shingles
   that only one component holds there are dropped first.  The matrix has a
   row for each other shingle with the groups that hold it, and groups meet
   groups: two that share a shingle are a candidate, if their sizes and the
   shingle's places allow the overlap.  Groups of one shingle are salted, so
   one that very many hold is not the work of one task.
3. *Bound and open.*  The classes of one group of a candidate ask the other.
   A class carries a bit set of its shingles' buckets, four buckets a shingle,
   and a group their union: a bucket that a group's union lacks is a shingle
   that no member shares with the query.  Groups whose union leaves too little
   overlap are passed by; in the others the query is bounded by all members'
   bit sets at once, before any set is read again (a group's queries are
   salted).  For the rest the overlap of the query set with the token union of
   the members asked for is the last bound; only groups that reach the query's
   needed overlap are opened, and the members of components not yet joined there
   are compared (more links between joined components change nothing).

Every link between different components is found, so the components are
exact.  No group is cut: shingles shared by very many documents come last in
the order, and groups of one component are never candidates of each other.

Shingles are 64-bit hashes and classes 64-bit hashes of the whole set.

Edge cases: null, empty and wordless texts have an empty set (n_shingles 0)
and link with nothing; repeated rows are one class; null doc_ids join in but
are never a component's id unless it has no other; an empty table gives an
empty result; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import fresh, map_in_pandas, materialize, shuffle_partitions
from pricelake.llm.components import components

WORDS = 5
NUM, DEN = 75, 100  # similarity as a fraction
SIGNATURES = 6
GROUP = 128
SLOT_BITS = 20
SLOT_BLOCK = 4096
ENTRIES_PER_PARTITION = 2_000_000
FILTER_BITS = 23
BLOCK_BITS = 18
SALT_ROWS = 512

_MULT = np.uint64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------- sets
def _mix(h: np.ndarray) -> np.ndarray:
    """64-bit finalizer (the public MurmurHash3 constants)."""
    with np.errstate(over="ignore"):
        for mult in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            h = (h ^ (h >> np.uint64(33))) * np.uint64(mult)
        return h ^ (h >> np.uint64(33))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    span = min(WORDS, len(w))
    with np.errstate(over="ignore"):
        h = np.full(len(w) - span + 1, span, dtype=np.uint64)
        for k in range(span):
            h = h * _MULT + w[k:len(w) - span + 1 + k]
    return np.unique(_mix(h))


def class_id(s: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64))


def _signatures(s: np.ndarray) -> list[int]:
    return [int(_mix(s ^ _mix(np.uint64([k + 1]))).min().astype(np.int64)) for k in range(SIGNATURES)]


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if DEN * len(small) < NUM * len(large):
        return False
    both = int(_overlap(small, large))
    return DEN * both >= NUM * (len(a) + len(b) - both)


def _overlap(small: np.ndarray, large: np.ndarray) -> int:
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    return int((large[at] == small).sum())


def bucket_bits(s: np.ndarray) -> bytes:
    """Bit set of the buckets of a set's shingles, at least 4 buckets each.
    A set of twice the buckets folds to the smaller size by or-ing halves."""
    m = 64
    while m < 4 * len(s):
        m *= 2
    flags = np.zeros(m, dtype=np.uint8)
    flags[(s & np.uint64(m - 1)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").tobytes()


def may_link(n_a: int, bits_a: bytes, n_b: int, bits_b: bytes) -> bool:
    """Whether the bit sets leave room for the wanted similarity."""
    if DEN * min(n_a, n_b) < NUM * max(n_a, n_b):
        return False
    a, b = np.frombuffer(bits_a, dtype=np.uint64), np.frombuffer(bits_b, dtype=np.uint64)
    while len(a) > len(b):
        a = a[:len(a) // 2] | a[len(a) // 2:]
    while len(b) > len(a):
        b = b[:len(b) // 2] | b[len(b) // 2:]
    both = min(n_a - int(np.bitwise_count(a & ~b).sum()), n_b - int(np.bitwise_count(b & ~a).sum()))
    return (NUM + DEN) * both >= NUM * (n_a + n_b)


def _read(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One pass: (doc_id, th, cid, n, sigs, bits) for each document, and the counts
    of all documents' shingles by slot (block, counts)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(1 << SLOT_BITS, dtype=np.uint32)
        for pdf in batches:
            rows, seen = [], []
            for text in pdf["text"].tolist():
                s = shingles(text)
                seen.append(s)
                rows.append((class_id(s), len(s), _signatures(s), bucket_bits(s)) if len(s) else (0, 0, None, None))
            if seen:
                slots = (np.concatenate(seen) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
                counts += np.bincount(slots, minlength=1 << SLOT_BITS).astype(np.uint32)
            # no nulls in cid: pandas would make it a float
            yield pd.DataFrame(rows, columns=["cid", "n", "sigs", "bits"]).assign(
                doc_id=pdf["doc_id"].to_numpy(), th=pdf["th"].to_numpy(), block=-1, counts=None)
        blocks = counts.reshape(-1, SLOT_BLOCK)
        yield pd.DataFrame([{"cid": 0, "n": 0, "sigs": None, "bits": None, "doc_id": None, "th": 0, "block": i,
                             "counts": b.tobytes()} for i, b in enumerate(blocks) if b.any()],
                           columns=["cid", "n", "sigs", "bits", "doc_id", "th", "block", "counts"])
    both = materialize(map_in_pandas(docs.select("doc_id", "text", F.xxhash64("text").alias("th")), run,
                                     "cid long, n long, sigs array<long>, bits binary, doc_id long, th long, block int, counts binary"))
    rows = both.filter("block < 0").withColumn("cid", F.when(F.col("n") > 0, F.col("cid")))
    return rows.drop("block", "counts"), both.filter("block >= 0").select("block", "counts")


def _slot_counts(parts: DataFrame) -> np.ndarray:
    """The summed table: 2**SLOT_BITS counters, whatever the input."""
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, dtype=np.uint32).astype(np.uint64) for c in pdf["counts"])
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "counts": [total.tobytes()]})
    out = np.zeros(1 << SLOT_BITS, dtype=np.uint64)
    for r in parts.groupBy("block").applyInPandas(add, "block int, counts binary").collect():
        out[r["block"] * SLOT_BLOCK:(r["block"] + 1) * SLOT_BLOCK] = np.frombuffer(bytes(r["counts"]), dtype=np.uint64)
    return np.minimum(out, 2**32 - 1).astype(np.uint32)


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cid, shingles) of the classes in ``wanted`` (cid, th), read again from
    the texts.  A fixed-size bit table of the wanted texts' hashes keeps most
    others out of the shuffle; the join on cid is exact."""
    words = (wanted.select(F.pmod("th", F.lit(1 << FILTER_BITS)).alias("bit"))
             .groupBy(F.expr("bit div 64").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits")).collect())
    table = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    for r in words:
        table[r["word"]] = r["bits"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        given: set[int] = set()  # texts of this task already sent
        for pdf in batches:
            th = pdf["th"].to_numpy(dtype=np.int64)
            bit = th & ((1 << FILTER_BITS) - 1)
            hit = (table[bit >> 6].astype(np.uint64) >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1
            rows = []
            for i in np.flatnonzero(hit).tolist():
                if (h := int(th[i])) not in given:
                    given.add(h)
                    s = shingles(pdf["text"].iat[i])
                    rows.append((class_id(s), s.tobytes()))
            yield pd.DataFrame(rows, columns=["cid", "shingles"])
    read = (docs.filter(F.col("text").isNotNull()).select("text", F.xxhash64("text").alias("th"))
            .mapInPandas(fresh(run), "cid long, shingles binary"))
    return read.join(wanted.select("cid").distinct(), "cid", "left_semi").dropDuplicates(["cid"])


# ---------------------------------------------------------------- groups
def _signature_groups(classes: DataFrame) -> DataFrame:
    """(cid, n, k, sig, m): the min-hash groups of at least two classes."""
    keys = classes.select("cid", "n", F.posexplode("sigs").alias("k", "sig"))
    sizes = keys.groupBy("k", "sig").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    return materialize(keys.join(sizes, ["k", "sig"]))


def _leader_pairs(shared: DataFrame) -> DataFrame:
    """(a, b): a class and the leader of a min-hash group it is in, where the
    sizes allow a link.  The leader is the member with the largest groups: the
    middle of a family shares its min-hashes with most of it."""
    known = shared.groupBy("cid").agg(F.sum("m").alias("weight"))
    leaders = (shared.join(known, "cid").groupBy("k", "sig").agg(F.max(F.struct("weight", "cid", "n")).alias("lead"))
               .select("k", "sig", F.col("lead.cid").alias("b"), F.col("lead.n").alias("n_b")))
    fits = F.least("n", "n_b") * DEN >= F.greatest("n", "n_b") * NUM
    return (shared.join(leaders, ["k", "sig"]).filter((F.col("cid") != F.col("b")) & fits)
            .select(F.col("cid").alias("a"), "b").distinct())


def _possible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose bit sets leave room for a link."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ok = [may_link(*x) for x in zip(pdf["n_a"], pdf["bits_a"], pdf["n_b"], pdf["bits_b"])]
            yield pdf.loc[ok, ["a", "b"]]
    both = pairs
    for c in ("a", "b"):
        both = both.join(classes.select(F.col("cid").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}")), c)
    return both.select("a", "b", "n_a", "bits_a", "n_b", "bits_b").mapInPandas(run, "a long, b long")


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ok = [similar(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64))
                  for x, y in zip(pdf["x"], pdf["y"])]
            yield pdf.loc[ok, ["a", "b"]]
    both = (pairs.join(sets.select(F.col("cid").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("cid").alias("b"), F.col("shingles").alias("y")), "b"))
    return both.select("a", "b", "x", "y").mapInPandas(run, "a long, b long")


def _grouped(classes: DataFrame, shared: DataFrame, edges: DataFrame) -> DataFrame:
    """(cid, th, n, comp, gid): first components, and groups of about GROUP
    similar classes, linked or not: those that chose one min-hash (of each
    class's the one that most classes have)."""
    roots = components(edges).select(F.col("v").alias("cid"), F.col("root").alias("comp"))
    chosen = (shared.groupBy("cid").agg(F.max(F.struct("m", "k", "sig")).alias("best"))
              .select("cid", F.xxhash64("best.k", "best.sig").alias("key")))
    sizes = chosen.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit(GROUP)).alias("blocks"))
    placed = chosen.join(sizes, "key").select("cid", F.xxhash64("key", F.pmod(F.xxhash64("cid"), "blocks")).alias("gid"))
    return (classes.select("cid", "th", "n").join(roots, "cid", "left").join(placed, "cid", "left")
            .select("cid", "th", "n", F.coalesce("comp", "cid").alias("comp"), F.coalesce("gid", "cid").alias("gid")))


# ---------------------------------------------------------------- matrix
def _prefixes(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """(cid, n, tokens): each class's first shingles, rarest first.  A class
    comes once from each task that holds it."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        given: set[int] = set()
        for pdf in batches:
            rows = []
            for text in pdf["text"].tolist():
                s = shingles(text)
                if not len(s) or (cid := class_id(s)) in given:
                    continue
                given.add(cid)
                n = len(s)
                keep = n - -(-NUM * n // DEN) + 1
                often = counts[(s >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
                rows.append((cid, n, s[np.lexsort((s, often))[:keep]].tobytes()))
            yield pd.DataFrame(rows, columns=["cid", "n", "tokens"])
    return docs.select("text").mapInPandas(fresh(run), "cid long, n int, tokens binary")


def _per_token(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of a batch of prefixes, and the row of each."""
    per = (pdf["tokens"].str.len() // 8).to_numpy()
    return np.frombuffer(b"".join(pdf["tokens"]), dtype="<u8"), np.repeat(np.arange(len(pdf)), per)


def _spread(tokens: np.ndarray, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """(token, least comp, greatest comp, entries), a row for each token."""
    order = np.argsort(tokens, kind="stable")
    tokens = tokens[order]
    at = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
    return (tokens[at], np.minimum.reduceat(low[order], at), np.maximum.reduceat(high[order], at),
            np.add.reduceat(n[order], at))


def _shared_tokens(prefixes: DataFrame, parts: int) -> DataFrame:
    """(token, entries): the tokens that two components hold.  A batch sends a
    token once, with the least and the greatest component there, so a family
    of near copies in one component costs a row a batch and no pairs."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            tokens, row = _per_token(pdf)
            comp = pdf["comp"].to_numpy()[row]
            tokens, low, high, n = _spread(tokens, comp, comp, np.ones(len(tokens), dtype=np.int64))
            part = (tokens % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.diff(part[order])) + 1
            # column by column, mostly zeros after the first two: compresses well
            yield pd.DataFrame([(int(part[g[0]]), b"".join(x.tobytes() for x in (tokens[g], low[g], low[g] ^ high[g], n[g])))
                                for g in np.split(order, cuts)], columns=["part", "tokens"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        blobs = [np.frombuffer(b, dtype=np.int64).reshape(4, -1) for b in pdf["tokens"]]
        tokens, low, apart, n = np.concatenate(blobs, axis=1)
        tokens, low, high, n = _spread(tokens, low, low ^ apart, n)
        return pd.DataFrame({"token": tokens, "entries": n})[low != high]
    return (prefixes.select("comp", "tokens").mapInPandas(fresh(run), "part int, tokens binary")
            .groupBy("part").applyInPandas(add, "token long, entries long"))


def _bit_table(tokens: DataFrame, bits: int) -> np.ndarray:
    """Bit set of the last ``bits`` bits of the tokens, 8 to a byte."""
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        flags = np.zeros(1 << BLOCK_BITS, dtype=np.uint8)
        flags[pdf["bit"].to_numpy() & ((1 << BLOCK_BITS) - 1)] = 1
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "flags": [np.packbits(flags, bitorder="little").tobytes()]})
    bit = F.pmod("token", F.lit(1 << bits))
    rows = (tokens.select(bit.alias("bit")).distinct().withColumn("block", F.shiftright("bit", BLOCK_BITS))
            .groupBy("block").applyInPandas(pack, "block long, flags binary").collect())
    table = np.zeros((1 << (bits - BLOCK_BITS), 1 << (BLOCK_BITS - 3)), dtype=np.uint8)
    for r in rows:
        table[r["block"]] = np.frombuffer(bytes(r["flags"]), dtype=np.uint8)
    return table.ravel()


def _entries(prefixes: DataFrame, shared: DataFrame) -> DataFrame:
    """(token, salt, salts, cid, comp, gid, n, place): the matrix entries of the
    shared tokens.  A fixed-size bit table keeps most others out of the
    shuffle; the join is exact.  Salts of a token hold about ``SALT_ROWS``
    classes each."""
    bits = min(FILTER_BITS + 5, max(FILTER_BITS, (8 * shared.count()).bit_length()))
    table = _bit_table(shared, bits)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            tokens, row = _per_token(pdf)
            place = np.arange(len(tokens)) - np.searchsorted(row, np.arange(len(pdf)))[row]
            bit = (tokens & np.uint64((1 << bits) - 1)).astype(np.int64)
            hit = np.flatnonzero((table[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)
            yield pd.DataFrame({"token": tokens[hit].view(np.int64), "place": place[hit],
                                **{c: pdf[c].to_numpy()[row[hit]] for c in ("cid", "comp", "gid", "n")}})
    salts = F.ceil(F.col("entries") / F.lit(SALT_ROWS)).cast("int")
    return (prefixes.mapInPandas(fresh(run), "token long, place int, cid long, comp long, gid long, n int")
            .join(shared, "token").withColumn("salts", salts)
            .select("token", F.pmod(F.xxhash64("cid"), "salts").cast("int").alias("salt"), "salts", "cid", "comp", "gid",
                    "n", "place"))


def _candidates(entries: DataFrame) -> DataFrame:
    """(g, h): pairs of groups (a group with itself too) that hold classes of
    different components with a common shingle, where sizes and places allow
    the overlap.  A token's entries are first reduced to its groups, so a large
    family is a few rows for each token, and groups meet groups."""
    held = materialize(entries.groupBy("token", "gid").agg(
        F.first("salts").alias("salts"), F.min("n").alias("least"), F.max("n").alias("most"),
        F.max(F.col("n") - F.col("place")).alias("room"), F.min("comp").alias("low"), F.max("comp").alias("high")))
    mine = held.withColumn("salt", F.pmod(F.xxhash64("gid"), "salts").cast("int")).drop("salts")
    other = held.select("token", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("gid").alias("h"),
                        *[F.col(c).alias(f"{c}_h") for c in ("least", "most", "room", "low", "high")])
    need = F.ceil((F.col("least") + F.col("least_h")) * NUM / F.lit(NUM + DEN))  # of the smallest two
    fits = ((F.col("gid") <= F.col("h")) & (F.least("low", "low_h") != F.greatest("high", "high_h"))
            & (F.col("most") * DEN >= F.col("least_h") * NUM) & (F.col("most_h") * DEN >= F.col("least") * NUM)
            & (F.least("room", "room_h") >= need))
    return mine.join(other, ["token", "salt"]).filter(fits).select(F.col("gid").alias("g"), "h").distinct()


def _asking(pairs: DataFrame, grouped: DataFrame) -> DataFrame:
    """(q, n_q, comp_q, gid, own): the classes of one group of each pair ask the
    other, if its sizes fit; in their own group they ask the smaller classes."""
    sizes = grouped.groupBy("gid").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    queries = grouped.select(F.col("cid").alias("q"), F.col("n").alias("n_q"), F.col("comp").alias("comp_q"), F.col("gid").alias("g"))
    fits = (F.col("n_q") * DEN >= F.col("least") * NUM) & (F.col("most") * DEN >= F.col("n_q") * NUM)
    return (pairs.join(sizes.withColumnRenamed("gid", "h"), "h").join(queries, "g").filter(fits)
            .select("q", "n_q", "comp_q", F.col("h").alias("gid"), (F.col("g") == F.col("h")).alias("own")))


def _folded(bits: np.ndarray, length: int) -> np.ndarray:
    """Bit sets (rows of words) folded to ``length`` words by or-ing halves."""
    while bits.shape[-1] > length:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


class GroupBits:
    """The bit sets of a group's members, by length, and their union."""

    def __init__(self, sizes: list[int], blobs: list[bytes]):
        by_length: dict[int, list[int]] = {}
        for i, blob in enumerate(blobs):
            by_length.setdefault(len(blob) // 8, []).append(i)
        self.sizes = np.array(sizes, dtype=np.int64)
        self.tables = {m: (np.array(at), np.frombuffer(b"".join(blobs[i] for i in at), dtype=np.uint64).reshape(len(at), m))
                       for m, at in by_length.items()}
        shortest = min(self.tables)
        self.union = np.bitwise_or.reduce([np.bitwise_or.reduce(_folded(t, shortest)) for _, t in self.tables.values()])

    def may_link(self, n: int, blob: bytes) -> np.ndarray:
        """The members that a set may link with: bound by the union, then by
        all members at once."""
        own = np.frombuffer(blob, dtype=np.uint64)
        length = min(len(own), len(self.union))
        least = max(int(self.sizes.min()), -(-NUM * n // DEN))
        outside = int(np.bitwise_count(_folded(own, length) & ~_folded(self.union, length)).sum())
        found = np.zeros(0, dtype=np.int64)
        if (NUM + DEN) * (n - outside) < NUM * (n + least):
            return found
        for m, (at, table) in self.tables.items():
            sizes = self.sizes[at]
            fits = (DEN * np.minimum(n, sizes) >= NUM * np.maximum(n, sizes)).nonzero()[0]
            if not len(fits):
                continue
            length = min(len(own), m)
            mine, theirs = _folded(own, length), _folded(table[fits], length)
            both = np.minimum(n - np.bitwise_count(mine & ~theirs).sum(axis=1, dtype=np.int64),
                              sizes[fits] - np.bitwise_count(theirs & ~mine).sum(axis=1, dtype=np.int64))
            found = np.append(found, at[fits[(NUM + DEN) * both >= NUM * (n + sizes[fits])]])
        return found


def _bound(queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
    """The queries (q, comp_q, gid) of a group with the members of other
    components that they may link with (hits); the first of them also has all
    members that any of them asks for (opened)."""
    none = pd.DataFrame({"q": [], "comp_q": [], "gid": [], "hits": pd.Series([], dtype=object),
                         "opened": pd.Series([], dtype=object)})
    if queries.empty or members.empty:
        return none
    members = members.sort_values(["n", "cid"], ignore_index=True)
    comp, cid = members["comp"].to_numpy(), members["cid"].to_numpy()
    place = {c: i for i, c in enumerate(cid.tolist())}
    group = GroupBits(members["n"].tolist(), members["bits"].tolist())
    hits = []
    for q, n, c, own, bits in zip(*(queries[x].tolist() for x in ("q", "n_q", "comp_q", "own", "bits_q"))):
        at = group.may_link(n, bits)
        at = at[comp[at] != c]
        hits.append(cid[at[at < place[q]] if own else at].tolist())
    some = [len(h) > 0 for h in hits]
    if not any(some):
        return none
    hits = [h for h in hits if h]
    opened = [sorted(set().union(*hits))] + [[] for _ in hits[1:]]
    return queries.loc[some, ["q", "comp_q", "gid"]].assign(hits=pd.Series(hits, dtype=object).to_numpy(),
                                                            opened=pd.Series(opened, dtype=object).to_numpy())


def _open(queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
    """Links (a, b) between a query's component and a member's, as many as
    join what the group joins.  Bound by the token union of the members asked
    for, then they are compared, those of joined components no more."""
    if queries.empty or members.empty:
        return pd.DataFrame({"a": [], "b": []})
    held = {c: (b, np.frombuffer(s, dtype=np.uint64)) for c, b, s in zip(members["cid"], members["comp"], members["held"])}
    union = np.unique(np.concatenate([s for _, s in held.values()]))
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = parent[x]
        return x

    links = []
    for a, blob, hits in zip(queries["comp_q"].tolist(), queries["asked"], queries["hits"]):
        s = np.frombuffer(blob, dtype=np.uint64)
        if DEN * _overlap(s, union) < NUM * len(s):
            continue
        for b, x in (held[h] for h in hits):
            if root(a) != root(b) and similar(s, x):
                links.append((a, b))
                parent[root(a)] = root(b)
    return pd.DataFrame(links, columns=["a", "b"])


def _salted(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The queries with a salt, about ``SALT_ROWS`` of a group to each, and the
    (gid, salt) there are: a group asked by very many classes is no single task."""
    salts = materialize(pairs.groupBy("gid").agg(F.ceil(F.count(F.lit(1)) / F.lit(SALT_ROWS)).cast("int").alias("salts")))
    salted = (pairs.join(salts, "gid").withColumn("salt", F.pmod(F.xxhash64("q"), "salts").cast("int")).drop("salts"))
    return salted, salts.select("gid", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))


def _links(docs: DataFrame, pairs: DataFrame, classes: DataFrame, grouped: DataFrame) -> DataFrame:
    """(a, b): the components that a pair of groups (g, h) links."""
    asking, salts = _salted(materialize(_asking(pairs, grouped)))
    held = grouped.join(salts, "gid").join(classes.select("cid", "bits"), "cid").select("gid", "salt", "cid", "n", "comp", "bits")
    asking = (asking.join(classes.select(F.col("cid").alias("q"), F.col("bits").alias("bits_q")), "q")
              .select("gid", "salt", "q", "n_q", "comp_q", "own", "bits_q"))
    left = materialize(asking.groupBy("gid", "salt").cogroup(held.groupBy("gid", "salt"))
                       .applyInPandas(_bound, "q long, comp_q long, gid long, hits array<long>, opened array<long>"))
    hit = materialize(left.select("gid", F.explode("opened").alias("cid")).distinct())
    wanted = left.select(F.col("q").alias("cid")).union(hit.select("cid")).distinct()
    sets = materialize(sets_of(docs, grouped.join(wanted, "cid", "left_semi").select("cid", "th")))
    left, salts = _salted(left.drop("opened"))
    queries = (left.join(sets.select(F.col("cid").alias("q"), F.col("shingles").alias("asked")), "q")
               .select("gid", "salt", "q", "comp_q", "hits", "asked"))
    members = (hit.join(salts, "gid").join(grouped.select("cid", "comp"), "cid")
               .join(sets.select("cid", F.col("shingles").alias("held")), "cid").select("gid", "salt", "cid", "comp", "held"))
    return materialize(queries.groupBy("gid", "salt").cogroup(members.groupBy("gid", "salt"))
                       .applyInPandas(_open, "a long, b long").distinct())


def jaccard_links(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, th (hash of its text), n_shingles,
    class_id, root (null for an empty set); documents with one root are one
    component."""
    spark = docs.sparkSession
    rows, slots = _read(docs)
    classes = materialize(rows.filter("n > 0").groupBy("cid").agg(
        F.min("th").alias("th"), F.max("n").alias("n"), F.first("sigs").alias("sigs"), F.first("bits").alias("bits")))
    # groups
    shared = _signature_groups(classes)
    pairs = materialize(_possible(_leader_pairs(shared), classes))
    ends = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    sets = materialize(sets_of(docs, classes.join(ends, "cid", "left_semi").select("cid", "th")))
    edges = materialize(_linked(pairs, sets))
    grouped = materialize(_grouped(classes, shared, edges))
    # matrix
    entries = classes.agg(F.sum(F.col("n") - F.ceil(F.col("n") * F.lit(NUM / DEN)) + 1)).first()[0] or 0
    parts = max(shuffle_partitions(spark), entries // ENTRIES_PER_PARTITION)
    prefixes = materialize(_prefixes(docs, _slot_counts(slots)).dropDuplicates(["cid"])
                           .join(grouped.select("cid", "comp", "gid"), "cid"))
    tokens = materialize(_shared_tokens(prefixes, parts))
    candidates = materialize(_candidates(_entries(prefixes, tokens)))
    # bound and open; the links join first components, few enough to contract before the last step
    roots = components(_links(docs, candidates, classes, grouped))
    roots = (grouped.join(roots.withColumnRenamed("v", "comp"), "comp", "left")
             .select(F.col("cid").alias("v"), F.coalesce("root", "comp").alias("root")))
    # documents
    return materialize(rows.join(roots.withColumnRenamed("v", "cid"), "cid", "left")
                       .select("doc_id", "th", F.col("n").alias("n_shingles"), F.col("cid").alias("class_id"),
                               F.coalesce("root", "cid").alias("root")))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id, class_id."""
    placed = jaccard_links(docs)
    smallest = placed.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("low"))
    return (placed.join(smallest, "root", "left")
            .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("low")).otherwise(F.col("doc_id"))
                    .alias("component_id"), "class_id"))


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component (the smallest
    doc_id, null last; repeated rows of it together), unchanged.  Documents
    with an empty set stay."""
    placed = jaccard_links(docs).select("doc_id", "th", "root")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")).alias("first")
    kept = (placed.filter("root IS NOT NULL").groupBy("root").agg(first).select("first.doc_id", "first.th")
            .union(placed.filter("root IS NULL").select("doc_id", "th")).distinct())
    kept = kept.select(F.xxhash64("doc_id", "th").alias("_key"))
    keyed = docs.withColumn("_key", F.xxhash64("doc_id", F.xxhash64("text")))
    return keyed.join(kept.hint("merge"), "_key", "left_semi").select(*docs.columns)
