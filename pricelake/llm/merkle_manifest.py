"""A Merkle manifest of a table with resumable SHA-256 nodes (operator 11).

Each document is a leaf: the hash of its fields, each ``-`` if null, else its
UTF-8 byte count, ``:`` and its value.  Per source, leaves ascend by doc_id, and
while several nodes remain, every ``FAN`` consecutive ones become the hash of
their digests (hex text, joined).  The last node is the source's subroot; the
subroots, ordered by source (null first, by UTF-8 bytes), likewise give the root.

*Midstates.*  A digest in hex fills one 64-byte block of SHA-256, so the state
before a child slot is the eight words after that many blocks.  Every parent
keeps a copy of its state before each child slot, beside its children.  Folding
a replaced child resumes the state at its slot with the replacement and the
siblings to its right only; what is left of it is never read again.

In Spark: leaves are ranked within their source by a range partitioning and
offsets (no window over a source), 16 neighbours are one row from then on, and
each level is a ``groupBy`` of at most 16 small rows a parent.  The loop runs
once a level (the logarithm of the largest source).  Downwards, every parent's
path to the root is joined level by level from the small end; the documents are
folded 16 at a time beside their own path, without another exchange of leaves.
The hashing of states is vectorised over many parents at once.

Edge cases: a null source is a source of its own; rows without doc_id come
first in their source; rows that share a doc_id are leaves side by side in the
order of their leaf digests; null, empty and very long texts hash as given; a
lone leaf is its source's subroot, a lone subroot the root; a document without
any sibling has the proof of the empty text; an empty table gives an empty
result; extra columns are not part of a leaf.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake.llm.common import materialize, shuffle_partitions

FAN = 16
HEX = 64  # characters of a digest in hex: one SHA-256 block
SLICE = 256  # runs of leaves that are folded at once
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]

# SHA-256 (FIPS 180-4): its constants are the fractional parts of roots of primes.


def _primes(n: int) -> list[int]:
    found: list[int] = []
    at = 2
    while len(found) < n:
        if all(at % p for p in found):
            found.append(at)
        at += 1
    return found


def _root_bits(p: int, k: int) -> int:
    """The first 32 bits of the fractional part of the k-th root of p."""
    low, high = 0, p << 32
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if mid ** k <= p << 32 * k else (low, mid - 1)
    return low & 0xFFFFFFFF


ROUND = np.array([_root_bits(p, 3) for p in _primes(64)], dtype=np.uint32)
START = np.array([_root_bits(p, 2) for p in _primes(8)], dtype=np.uint32)


def _turn(x: np.ndarray, r: int) -> np.ndarray:
    return (x >> np.uint32(r)) | (x << np.uint32(32 - r))


def absorb(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The states (8, n) after one block (16, n) each; 32-bit words."""
    w = list(block)
    for i in range(16, 64):
        a, b = w[i - 15], w[i - 2]
        w.append(w[i - 16] + w[i - 7] + (_turn(a, 7) ^ _turn(a, 18) ^ (a >> np.uint32(3)))
                 + (_turn(b, 17) ^ _turn(b, 19) ^ (b >> np.uint32(10))))
    a, b, c, d, e, f, g, h = state
    for i in range(64):
        t = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + ROUND[i] + w[i]
        u = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = t + u, a, b, c, d + t, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h])


def finish(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Digests (n, HEX) as hex characters of states that took ``blocks`` whole blocks."""
    pad = np.zeros((16, state.shape[1]), dtype=np.uint32)
    pad[0], pad[15] = 0x80000000, blocks * (HEX * 8)  # at most FAN blocks: the length fits one word
    raw = np.ascontiguousarray(absorb(state, pad).T.astype(">u4")).view(np.uint8)
    return np.frombuffer(b"0123456789abcdef", dtype=np.uint8)[np.stack([raw >> 4, raw & 15], axis=2)].reshape(-1, HEX)


def words(digests: np.ndarray) -> np.ndarray:
    """Blocks (16, n) of digests (n, HEX)."""
    return np.ascontiguousarray(np.ascontiguousarray(digests).view(">u4").T.astype(np.uint32))


def digests_of(message: pd.Series, slots: int = FAN) -> tuple[np.ndarray, np.ndarray]:
    """(children (n, slots, HEX) as characters, number of children (n)) of joined digests."""
    text = message.str.ljust(slots * HEX, "0")
    children = np.frombuffer("".join(text).encode(), dtype=np.uint8).reshape(len(message), slots, HEX)
    return children, (message.str.len() // HEX).to_numpy(dtype=np.int64)


def hash_children(children: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(states before each slot (n, FAN, 8), digests (n, HEX)) of parents."""
    n = len(count)
    states = np.zeros((n, FAN, 8), dtype=np.uint32)
    state = np.repeat(START[:, None], n, axis=1)
    for slot in range(FAN):
        has = np.flatnonzero(count > slot)
        states[has, slot] = state[:, has].T
        if len(has):
            state[:, has] = absorb(state[:, has], words(children[has, slot]))
    return states, finish(state, count)


def resume(states: np.ndarray, digests: np.ndarray, children: np.ndarray, slot: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The parents' digests (n, HEX) when the child at ``slot`` becomes
    ``digests``: its state (n, 8), the new child, its right siblings (of
    ``children`` (n, FAN, HEX)), the end."""
    state = absorb(np.ascontiguousarray(states.T), words(digests))
    for at in range(1, FAN):
        more = np.flatnonzero(slot + at < count)
        if not len(more):
            break
        state[:, more] = absorb(state[:, more], words(children[more, slot[more] + at]))
    return finish(state, count)


def _parents(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds states and digest; a group that is its whole level keeps its one digest."""
    for pdf in frames:
        children, count = digests_of(pdf["message"])
        states, digest = hash_children(children, count)
        alone = (pdf["n"] == 1).to_numpy()
        kept = [s[:c].tobytes() for s, c in zip(states, count)]
        hexes = [m if one else d.tobytes().decode() for m, one, d in zip(pdf["message"], alone, digest)]
        yield pdf.assign(states=[None if one else s for one, s in zip(alone, kept)], digest=hexes)


def _field(c: str) -> Column:
    text = F.col(c).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(text: Column | None = None) -> Column:
    """The leaf of a document, optionally with another text of the same byte count."""
    parts = [_field(c) for c in FIELDS]
    if text is not None:
        parts[-1] = F.coalesce(F.concat(F.octet_length("text").cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def ranked(nodes: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``nodes`` with ``idx`` (place in its group by ``order``, nulls first) and
    ``n`` (nodes of the group)."""
    spark = nodes.sparkSession
    cols = [F.col(c).asc_nulls_first() for c in [group, *order]]
    put = materialize(nodes.repartitionByRange(shuffle_partitions(spark), *cols).sortWithinPartitions(*cols)
                      .withColumns({"_pid": F.spark_partition_id(), "_pos": F.monotonically_increasing_id()}))
    # one row for each (group, partition) that holds it
    held = put.groupBy(group, "_pid").agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_held"))
    before = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select(group, "_pid", "_first", F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_before"),
                          F.sum("_held").over(Window.partitionBy(group)).alias("n"))
    return (put.join(offsets, [group, "_pid"]).withColumn("idx", F.col("_pos") - F.col("_first") + F.col("_before"))
            .drop("_pid", "_pos", "_first", "_before"))


def grouped(nodes: DataFrame, group: str, digest: str, *more: Column) -> DataFrame:
    """Runs of FAN neighbours: (group, idx, n of this level, message, ...)."""
    run = nodes.groupBy(group, F.floor(F.col("idx") / FAN).alias("run")).agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("idx", digest, *more))).alias("nodes"))
    return run.select(group, F.col("run").alias("idx"), "n", F.array_join(f"nodes.{digest}", "").alias("message"), "nodes")


def level_up(runs: DataFrame) -> DataFrame:
    """``runs`` with their states and digests, stored."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in runs.schema.fields)
    return materialize(runs.mapInPandas(_parents, f"{schema}, states binary, digest string"))


def tree(first: DataFrame, group: str) -> list[DataFrame]:
    """The levels of parents above ``first`` (itself the lowest of them)."""
    levels = [level_up(first)]
    top = levels[0].agg(F.max("n")).first()[0] or 1
    while top > FAN:
        below = levels[-1].filter(F.col("n") > FAN).select(group, "idx", F.ceil(F.col("n") / FAN).alias("n"), "digest")
        levels.append(level_up(grouped(below, group, "digest").drop("nodes")))
        top = -(-top // FAN)
    return levels


STEP = "struct<slot:int,state:binary,message:string>"


def paths(levels: list[DataFrame], group: str, above: DataFrame) -> DataFrame:
    """The steps from each node of the lowest level to the root: (group, idx,
    path, ...).  ``above`` has the path of each group's last node and more
    columns to pass down: (group, path, ...)."""
    more = [c for c in above.columns if c not in (group, "path")]
    out = None
    for i in reversed(range(len(levels))):
        # the last node of a group continues above it, others pass through their parent
        done = levels[i].filter(F.col("n") <= FAN).select(group, "idx").join(above, group).select(group, "idx", "path", *more)
        if i + 1 < len(levels):
            slot = F.pmod(F.col("_idx"), F.lit(FAN)).cast("int")
            step = F.struct(slot.alias("slot"), F.substring("states", slot * 32 + 1, F.lit(32)).alias("state"), "message").cast(STEP)
            parent = levels[i + 1].join(out, [group, "idx"]).select(group, "idx", "states", "message", "path", *more)
            nodes = (levels[i].filter(F.col("n") > FAN)
                     .select(group, F.col("idx").alias("_idx"), F.floor(F.col("idx") / FAN).alias("idx")))
            through = nodes.join(parent, [group, "idx"]).select(group, F.col("_idx").alias("idx"),
                                                               F.concat(F.array(step), "path").alias("path"), *more)
            done = done.unionByName(through)
        out = done
    return out


def _up(digests: np.ndarray, owner: np.ndarray, slots: pd.Series, states: pd.Series, messages: pd.Series) -> np.ndarray:
    """Folds ``digests`` (m, HEX), each of run ``owner``, along the runs' paths."""
    depth = slots.str.len().to_numpy(dtype=np.int64)
    for at in range(depth.max(initial=0)):
        rows = np.flatnonzero(depth[owner] > at)
        has = np.flatnonzero(depth > at)
        children, count = digests_of(pd.Series([messages.iloc[r][at] for r in has], dtype=object))
        state = np.frombuffer(b"".join(states.iloc[r][at] for r in has), dtype=np.uint32).reshape(-1, 8)
        slot = np.array([slots.iloc[r][at] for r in has], dtype=np.int64)
        mine = np.searchsorted(has, owner[rows])
        digests[rows] = resume(state[mine], digests[rows], children[mine], slot[mine], count[mine])
    return digests


def _fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per run of leaves: the root folded from each (replaced) leaf, and the
    digest of each leaf's siblings."""
    for pdf in frames:
        for start in range(0, len(pdf), SLICE):
            part = pdf.iloc[start:start + SLICE].reset_index(drop=True)
            children, count = digests_of(part["message"])
            replaced, _ = digests_of(part["replaced"])
            owner, slot = np.nonzero(np.arange(FAN) < count[:, None])
            leaf = replaced[owner, slot].copy()
            own = part["states"].notna().to_numpy()[owner]  # a lone leaf has no parent in its source
            state = np.zeros((len(part), FAN, 8), dtype=np.uint32)
            for r, s in enumerate(part["states"]):
                if s is not None:
                    state[r, :count[r]] = np.frombuffer(s, dtype=np.uint32).reshape(-1, 8)
            at = np.flatnonzero(own)
            leaf[at] = resume(state[owner[at], slot[at]], leaf[at], children[owner[at]], slot[at], count[owner[at]])
            # leaves of one run that give the same parent share the way up
            same = np.column_stack([owner.astype(">i8").view(np.uint8).reshape(-1, 8), leaf])
            kept, back = np.unique(np.ascontiguousarray(same).view(f"V{same.shape[1]}").ravel(), return_index=True, return_inverse=True)[1:]
            roots = _up(leaf[kept], owner[kept], part["slots"], part["path_states"], part["path_messages"])[back.ravel()]
            bounds = np.concatenate([[0], np.cumsum(count)])
            proofs = []
            for m, slots, messages, c in zip(part["message"], part["slots"], part["path_messages"], count):
                above = "".join(t[:s * HEX] + t[(s + 1) * HEX:] for s, t in zip(slots, messages)).encode()
                proofs.append("".join(hashlib.sha256((m[:j * HEX] + m[(j + 1) * HEX:]).encode() + above).hexdigest() for j in range(c)))
            roots = [roots[a:b].tobytes().decode() for a, b in zip(bounds, bounds[1:])]
            yield part[["skey", "ids", "message", "subroot", "root"]].assign(proofs=proofs, folded=roots)


def manifest(docs: DataFrame, tampered: Column | None = None, tampered_text: Column | None = None) -> DataFrame:
    """One row for each document: doc_id, source, leaf, subroot, root,
    proof_sha256, folded_root and verified.  Where ``tampered`` holds, the text is
    replaced by ``tampered_text`` (of the same byte count) after the tree was
    built, and the root is folded from that leaf and the tree's siblings."""
    leaf, swapped = leaf_digest(), F.lit(None)
    if tampered is not None:
        swapped = F.when(tampered & F.col("text").isNotNull(), leaf_digest(tampered_text))
    skey = F.coalesce(F.concat(F.lit("1"), "source"), F.lit("0"))  # null first
    leaves = materialize(docs.select(skey.alias("skey"), "doc_id", leaf.alias("leaf"), swapped.cast("string").alias("swapped")))
    placed = ranked(leaves, "skey", ["doc_id", "leaf"])
    member = [F.col("doc_id"), F.coalesce("swapped", "leaf").alias("replaced")]
    runs = grouped(placed, "skey", "leaf", *member)
    runs = runs.select("skey", "idx", "n", "message", F.array_join("nodes.replaced", "").alias("replaced"),
                       F.transform("nodes.doc_id", lambda x: x.cast("string")).alias("ids"))
    levels = tree(runs, "skey")

    # the subroots: the one node of each source's last level; then their tree
    subroots = levels[0].filter(F.col("n") <= FAN).select("skey", F.col("digest").alias("subroot"))
    for level in levels[1:]:
        subroots = subroots.unionByName(level.filter(F.col("n") <= FAN).select("skey", F.col("digest").alias("subroot")))
    sources = materialize(ranked(subroots.withColumn("g", F.lit(0)), "g", ["skey"]))
    tops = tree(grouped(sources, "g", "subroot").drop("nodes"), "g")
    root = tops[-1].select("g", F.array().cast(f"array<{STEP}>").alias("path"), F.col("digest").alias("root"))
    up = paths(tops, "g", F.broadcast(root)).withColumnRenamed("idx", "run")  # one row
    slot = F.pmod("idx", F.lit(FAN)).cast("int")
    step = F.struct(slot.alias("slot"), F.substring("states", slot * 32 + 1, F.lit(32)).alias("state"), "message").cast(STEP)
    met = (sources.withColumn("run", F.floor(F.col("idx") / FAN)).join(up, ["g", "run"])
           .join(tops[0].select("g", F.col("idx").alias("run"), "states", "message"), ["g", "run"]))
    above = materialize(met.select("skey", "subroot", "root", F.when(F.col("n") > 1, F.concat(F.array(step), "path"))
                                   .otherwise(F.col("path")).alias("path")))

    rows = levels[0].join(paths(levels, "skey", above), ["skey", "idx"]).select(
        "skey", "message", "replaced", "ids", "states", "subroot", "root", F.col("path.slot").alias("slots"),
        F.col("path.state").alias("path_states"), F.col("path.message").alias("path_messages"))
    folded = rows.mapInPandas(_fold, "skey string, ids array<string>, message string, subroot string, root string, "
                                     "proofs string, folded string")
    at = F.col("pos") * HEX + 1

    def cut(c: str) -> Column:
        return F.substring(F.col(c), at, F.lit(HEX))

    each = folded.select("*", F.posexplode("ids").alias("pos", "id"))
    source = F.when(F.col("skey") != "0", F.expr("substring(skey, 2)"))
    return each.select(F.col("id").cast("long").alias("doc_id"), source.alias("source"), cut("message").alias("leaf"), "subroot",
                       "root", cut("proofs").alias("proof_sha256"), cut("folded").alias("folded_root"),
                       (cut("folded") == F.col("root")).alias("verified"))


def audited(docs: DataFrame, every: int = 5) -> DataFrame:
    """The manifest with the texts lower-cased (A-Z) where ``every`` divides the
    CRC-32 of the decimal doc_id."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0, F.lit(False))
    return manifest(docs, hit, F.translate("text", string.ascii_uppercase, string.ascii_lowercase))
