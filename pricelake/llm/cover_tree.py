"""Exact top-k inner products by a dual-tree cover-tree search (operator 3).

Queries and data are indexed in one tree, built from the top in Spark, level by
level.  A node has a centre (one of its vectors) and a covering radius r, the
largest distance of its vectors from the centre.  A node of more than
``BLOCK_ROWS`` rows is split: its own centre is the first child's centre
(nesting), further ones are the farthest vectors of a sample from those chosen
(separation), until all are within r / 2 (covering) or ``FANOUT`` are chosen;
each vector joins the nearest.  Where ``FANOUT`` centres don't cover within
r / 2, as in many dimensions, the child's measured radius is larger, and only
speed depends on it.  The farthest vector of all is always in the sample, so every
split makes progress, and the number of levels grows with the rows.  Nodes of at
most ``BLOCK_ROWS`` rows are cut into **leaves** inside one task.

Search.  For a query node (centre p, radius s) and a data node (centre c,
radius r) no inner product exceeds ``p.c + s|c| + r|p| + rs``.  Each query first
searches its own node, which gives every query leaf, and every node above it,
its worst k-th score so far.  Pairs of a query node and a data node go down the
tree together from (root, root); a pair whose bound is below the query node's
worst k-th score is pruned, with all pairs below it.  Query leaves meet the data
leaves of the pairs that are left, best bound first, until the rest is pruned.

Hot vectors.  Equal vectors give equal scores and ties go to the smaller vec_id,
so of the rows of one vector only those with the k + 1 smallest ids can be an
answer, and of equal rows with one id at most k: the others are dropped as data
(never as queries) before the tree.  Queries of one node, and query leaves sent to
one node, are worked on in bounded parts.

Bounds carry a margin above rounding; scores are exact integers of any size, put
out as the nearest 64-bit integer where they are beyond its range (and ranked
among themselves there by their nearest doubles).  Vectors of unequal length are
compared as if padded with zeros.

Edge cases: null vectors, null or non-finite components (or such that overflow
when scaled) and null vec_ids take no part; empty vectors score 0; ties go to the
smaller vec_id; rows that share the query's own vec_id are not candidates, other
repeated rows count each; an id repeated with one vector is one query, with several
vectors its k best over all of them are given; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake.llm.common import materialize

SCALE = 256
FANOUT = 64          # most children of a node
SAMPLE = 2_048       # vectors of a node that its children's centres are chosen from
BLOCK_ROWS = 4_096   # a node of more rows is split
LEAF_ROWS = 48
ASSIGN_ROWS = 32_768  # rows of a node that one group assigns to its children
SENT_LEAVES = 128    # query leaves that one group takes to a data node

LEAF = "node string, is_query boolean, centre binary, radius double, worst double, ids binary, vectors binary"
FOUND = "query_id long, vec_id long, score long, high double"
ANSWER = "query_id long, rank int, vec_id long, score long"


def _vectors(column: pd.Series, dim: int) -> np.ndarray:
    packed = b"".join(column)
    return np.frombuffer(packed, dtype="<f8").reshape(-1, dim) if packed else np.zeros((0, dim))


def integer_vectors(table: DataFrame, scale: int = SCALE) -> tuple[DataFrame, int]:
    """(vec_id, v) with v the scaled, floored vector as whole 64-bit floats, all
    of one length, and that length."""
    scaled = F.transform("embedding", lambda e: e.cast("double") * scale)
    fine = F.forall(scaled, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = table.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(fine)
    dim = max(1, rows.agg(F.max(F.size("embedding"))).first()[0] or 1)

    def pad(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = np.zeros((len(pdf), dim), dtype="<f8")
            for row, v in zip(out, pdf["x"]):
                row[:len(v)] = np.floor(v)
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "v": [(r + 0.0).tobytes() for r in out]})  # no -0.0
    ints = rows.select("vec_id", scaled.alias("x")).mapInPandas(pad, "vec_id long, v binary")
    return materialize(ints), dim


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1)[None, :] - 2 * x @ centres.T).argmin(axis=1)


def _leaves(x: np.ndarray, size: int) -> np.ndarray:
    """Leaf of each row: a farthest-point cover with about ``size`` rows a set."""
    wanted = max(1, len(x) // size)
    centres = [0]
    far = ((x - x[0])**2).sum(1)
    while len(centres) < wanted and far.max() > 0:
        centres.append(int(far.argmax()))
        far = np.minimum(far, ((x - x[centres[-1]])**2).sum(1))
    return _nearest(x, x[centres])


def _scores(q: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Exact integer inner products; Python integers where 64 bits may not hold them."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(d).max(initial=0)) * q.shape[1]
    if top < 2**53:
        return (q @ d.T).astype(np.int64)
    whole = np.int64 if top < 2**62 and max(np.abs(q).max(), np.abs(d).max()) < 2**62 else object
    return _whole(q, whole) @ _whole(d, whole).T


def _whole(x: np.ndarray, kind) -> np.ndarray:
    if kind is not object:
        return x.astype(kind)
    return np.array([int(e) for e in x.ravel()], dtype=object).reshape(x.shape)


class _Best:
    """The k best (score, smaller id first) of each query row."""

    def __init__(self, query_ids: np.ndarray, k: int):
        self.ids, self.k = query_ids, k
        self.rows: list[list[tuple[int, int]]] = [[] for _ in query_ids]

    def offer(self, at: np.ndarray, data_ids: np.ndarray, scores: np.ndarray) -> None:
        """Scores of the query rows ``at`` against the given data rows."""
        for row, own in zip(at.tolist(), scores):
            ok = np.flatnonzero(data_ids != self.ids[row])
            if len(ok) > self.k:  # everything at least as high as the k-th
                kth = np.partition(own[ok], len(ok) - self.k)[len(ok) - self.k]
                ok = ok[own[ok] >= kth]
            pairs = self.rows[row] + [(-int(own[i]), int(data_ids[i])) for i in ok]
            self.rows[row] = sorted(pairs)[:self.k]

    def worst(self, at: np.ndarray) -> float:
        """The lowest k-th score of these rows, -inf while one has fewer."""
        return min((float(-self.rows[i][-1][0]) if len(self.rows[i]) == self.k else -np.inf for i in at), default=-np.inf)


def _bound(p, s, c, r) -> np.ndarray:
    """Largest possible inner product for query nodes (rows) and data nodes."""
    p, c = np.atleast_2d(p), np.atleast_2d(c)
    len_p, len_c = np.sqrt((p**2).sum(1)), np.sqrt((c**2).sum(1))
    b = p @ c.T + s[:, None] * len_c[None, :] + r[None, :] * len_p[:, None] + s[:, None] * r[None, :]
    return b + 1e-9 * (len_p[:, None] + s[:, None]) * (len_c[None, :] + r[None, :]) + 1e-6


def _nodes(x: np.ndarray, leaf: np.ndarray):
    """(rows, centre, radius) of each leaf."""
    for k in range(int(leaf.max(initial=-1)) + 1):
        at = np.flatnonzero(leaf == k)
        if len(at):
            centre = x[at].mean(axis=0)
            yield at, centre, float(np.sqrt(((x[at] - centre)**2).sum(1).max())) * (1 + 1e-9)


def _parent(node: str = "node") -> Column:
    """"/3/12" is a child of "/3", and that of the root ""."""
    return F.regexp_replace(node, "/[0-9]+$", "")


def indexed_rows(vectors: DataFrame, k: int, every: int) -> DataFrame:
    """(vec_id, v, copies, is_query): the rows that can be an answer, and the queries."""
    once = materialize(vectors.groupBy("vec_id", "v").agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("copies")))
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    data = once.withColumn("_r", rank).filter(F.col("_r") <= k + 1).drop("_r").withColumn("is_query", F.lit(False))
    return data.unionByName(once.filter(F.col("vec_id") % every == 0).withColumn("is_query", F.lit(True)))


def _distances(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - centre)**2).sum(1))


def build_levels(rows: DataFrame, dim: int) -> tuple[list[DataFrame], DataFrame]:
    """The nodes of each level (node, centre, radius, n, n_vectors, far_v, open), the
    root's first, and all rows with their last node."""
    root = bytes(rows.agg(F.min_by("v", F.struct(F.xxhash64("v"), "v"))).first()[0])

    def from_root(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(node="", far=_distances(_vectors(pdf["v"], dim), np.frombuffer(root, dtype="<f8")))
    columns = "vec_id long, v binary, copies int, is_query boolean, node string, far double"
    names = ["vec_id", "v", "copies", "is_query", "node", "far"]

    def children(key, nodes: pd.DataFrame, sample: pd.DataFrame) -> pd.DataFrame:
        """Centres of a node's children: its own, then always the farthest vector."""
        if nodes.empty:
            return pd.DataFrame({"node": [], "child": [], "centre": []})
        x = _vectors([nodes["centre"].iloc[0], nodes["far_v"].iloc[0], *sorted(sample["v"])], dim)
        chosen, far = [0], _distances(x, x[0])
        while len(chosen) < FANOUT and far.max() > nodes["radius"].iloc[0] / 2:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, _distances(x, x[chosen[-1]]))
        return pd.DataFrame({"node": key[0], "child": [f"{key[0]}/{i}" for i in range(len(chosen))],
                             "centre": [x[i].tobytes() for i in chosen]})

    def assign(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Each row to the nearest centre of its node's children."""
        if left.empty:
            return left.reindex(columns=names)
        right = right.sort_values("child")
        x, centres = _vectors(left["v"], dim), _vectors(right["centre"], dim)
        to = _nearest(x - centres[0], centres - centres[0])
        return left.assign(node=right["child"].to_numpy()[to], far=_distances(x, centres[to]))[names]

    now = materialize(rows.mapInPandas(from_root, columns))
    centre = rows.sparkSession.createDataFrame([("", bytearray(root))], "node string, centre binary")
    levels, done = [], []
    while True:
        found = now.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("v").alias("n_vectors"),
                                        F.max("far").alias("radius"), F.max_by("v", F.struct("far", "v")).alias("far_v"))
        nodes = materialize(found.join(centre, "node").withColumn(
            "open", (F.col("n") > BLOCK_ROWS) & (F.col("radius") > 0)))
        levels.append(nodes)
        split = nodes.filter("open")
        if split.isEmpty():
            return levels, materialize(reduce_union([*done, now]))
        done.append(now.join(nodes.filter("not open").select("node"), "node", "left_semi").select(*names))
        opened = now.join(split.select("node", "n", "n_vectors"), "node")
        share = F.lit(float(SAMPLE)) / F.col("n_vectors")
        sample = opened.filter(F.pmod(F.xxhash64("v"), F.lit(1 << 30)) < share * (1 << 30)).select("node", "v").distinct()
        centres = materialize(split.groupBy("node").cogroup(sample.groupBy("node"))
                              .applyInPandas(children, "node string, child string, centre binary"))
        parts = F.ceil(F.col("n") / ASSIGN_ROWS).cast("int")
        dealt = opened.withColumn("part", F.pmod(F.xxhash64("vec_id", "v"), parts).cast("int")).drop("n", "n_vectors")
        spread = centres.join(split.select("node", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part")), "node")
        now = materialize(dealt.groupBy("node", "part").cogroup(spread.groupBy("node", "part"))
                          .applyInPandas(assign, columns))
        centre = centres.select(F.col("child").alias("node"), "centre")


def reduce_union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def build_leaves(rows: DataFrame, dim: int, k: int) -> DataFrame:
    """The leaves of all last nodes; a query leaf has the worst k-th score that
    its own node's rows give (-inf while they are fewer)."""
    def leaves(key, queries: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        out = []
        data = data.sort_values(["vec_id", "v"])
        ids, v, copies = data["vec_id"].to_numpy(), _vectors(data["v"], dim), data["copies"].to_numpy()
        if len(ids) and key[1] == 0:
            for at, c, r in _nodes(v, _leaves(v, LEAF_ROWS)):
                rep = np.repeat(at, copies[at])
                out.append((key[0], False, c.tobytes(), r, None, ids[rep].astype("<i8").tobytes(), v[rep].tobytes()))
        if len(queries):
            queries = queries.sort_values(["vec_id", "v"])
            q_ids, q = queries["vec_id"].to_numpy(), _vectors(queries["v"], dim)
            best = _Best(q_ids, k)
            rep = np.repeat(np.arange(len(ids)), copies)
            for at in np.array_split(np.arange(len(q)), -(-len(q) // 128)):
                best.offer(at, ids[rep], _scores(q[at], v[rep]))
            for at, c, r in _nodes(q, _leaves(q, LEAF_ROWS)):
                for few in np.array_split(at, -(-len(at) // 512)):
                    out.append((key[0], True, c.tobytes(), r, best.worst(few), q_ids[few].astype("<i8").tobytes(),
                                q[few].tobytes()))
        return pd.DataFrame(out, columns=["node", "is_query", "centre", "radius", "worst", "ids", "vectors"])
    queries, data = rows.filter("is_query"), rows.filter("not is_query")
    parts = queries.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("parts"))
    dealt = queries.join(parts, "node").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
    spread = (data.join(parts, "node", "left")
              .withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))))
    cols = ["vec_id", "v", "copies", "node", "part"]
    return materialize(dealt.select(*cols).groupBy("node", "part").cogroup(spread.select(*cols).toDF(*cols).groupBy("node", "part"))
                       .applyInPandas(leaves, LEAF))


def _frontiers(levels: list[DataFrame], leaves: DataFrame) -> list[DataFrame]:
    """For each level: its nodes and the last nodes above it, with the worst k-th
    score of the queries below (null: none) and whether data are below."""
    ends = leaves.groupBy("node").agg(F.min(F.when(F.col("is_query"), F.col("worst"))).alias("worst"),
                                       F.max(~F.col("is_query")).alias("has_data"))
    own = [nodes.select("node", "centre", "radius", "open") for nodes in levels]
    known, below = [], None
    for nodes in reversed(own):
        here = nodes.filter("not open").select("node").join(ends, "node", "left")
        if below is not None:
            up = below.groupBy(_parent().alias("node")).agg(F.min("worst").alias("worst"), F.max("has_data").alias("has_data"))
            here = here.unionByName(up)
        below = here
        known.insert(0, materialize(nodes.join(here, "node", "left")))
    out, kept = [], []
    for nodes in known:
        out.append(reduce_union([nodes, *kept]))
        kept.append(nodes.filter("not open"))
    return out


def node_pairs(levels: list[DataFrame], leaves: DataFrame, dim: int) -> list[DataFrame]:
    """(q, d) pairs of query node and data node that are not pruned, level by level."""
    def prune(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                keep = _pair_bounds(pdf, dim) >= pdf["worst"].to_numpy(dtype=float)
                yield pdf.loc[keep, ["q", "d"]]
    pairs = leaves.sparkSession.createDataFrame([("", "")], "q string, d string")
    out = []
    for level, nodes in enumerate(_frontiers(levels, leaves)):
        # a node of this level belongs to its parent, a last node above it to itself
        depth = F.size(F.split("node", "/")) - 1
        above = F.when((depth == level) & (F.lit(level) > 0), _parent()).otherwise(F.col("node"))
        q = nodes.filter("worst is not null").select(above.alias("q"), F.col("node").alias("_q"), F.col("centre").alias("p"),
                                                     F.col("radius").alias("s"), "worst")
        d = nodes.filter("has_data").select(above.alias("d"), F.col("node").alias("_d"), F.col("centre").alias("c"),
                                            F.col("radius").alias("r"))
        met = pairs.join(q, "q").join(d, "d").select(F.col("_q").alias("q"), F.col("_d").alias("d"), "p", "s", "worst", "c", "r")
        pairs = materialize(met.mapInPandas(prune, "q string, d string"))
        out.append(pairs)
    return out


def _pair_bounds(pdf: pd.DataFrame, dim: int) -> np.ndarray:
    """``_bound`` of the pair in each row: query node (p, s), data node (c, r)."""
    p, c = _vectors(pdf["p"], dim), _vectors(pdf["c"], dim)
    s, r = (pdf[x].to_numpy(dtype=float) * (1 + 1e-9) for x in ("s", "r"))
    len_p, len_c = np.sqrt((p**2).sum(1)), np.sqrt((c**2).sum(1))
    return (p * c).sum(1) + s * len_c + r * len_p + s * r + 1e-9 * (len_p + s) * (len_c + r) + 1e-6


def top_k(table: DataFrame, k: int = 5, every: int = 50, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of every vector whose id
    is divisible by ``every``."""
    vectors, dim = integer_vectors(table, scale)
    if vectors.isEmpty():
        return table.sparkSession.createDataFrame([], ANSWER)
    levels, rows = build_levels(materialize(indexed_rows(vectors, k, every)), dim)
    leaves = build_leaves(rows, dim, k)
    pairs = node_pairs(levels, leaves, dim)[-1]
    data, queries = leaves.filter(~F.col("is_query")), leaves.filter("is_query")
    nodes = reduce_union([n.select("node", "centre", "radius") for n in (x.filter("not open") for x in levels)])

    def narrow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Query leaves against the data nodes that their own node could not prune."""
        for pdf in batches:
            if len(pdf):
                bound = _pair_bounds(pdf.rename(columns={"centre": "p", "radius": "s"}), dim)
                yield pdf[bound >= pdf["worst"].to_numpy(dtype=float)].drop(columns=["c", "r"])
    sent = (pairs.join(queries.withColumnRenamed("node", "q"), "q")
            .join(nodes.select(F.col("node").alias("d"), F.col("centre").alias("c"), F.col("radius").alias("r")), "d")
            .select("d", "centre", "radius", "worst", "ids", "vectors", "c", "r")
            .mapInPandas(narrow, "d string, centre binary, radius double, worst double, ids binary, vectors binary"))
    sent = materialize(sent)
    parts = sent.groupBy("d").agg(F.ceil(F.count(F.lit(1)) / SENT_LEAVES).cast("int").alias("parts"))
    dealt = sent.join(parts, "d").withColumn("part", F.pmod(F.xxhash64("ids", "vectors"), F.col("parts")).cast("int")).drop("parts")
    spread = data.withColumnRenamed("node", "d").join(
        parts.select("d", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")), "d")
    spread = spread.toDF(*spread.columns)

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": [], "high": []})
        d_ids = [np.frombuffer(b, dtype="<i8") for b in right["ids"]]
        d_vec = [np.frombuffer(b, dtype="<f8").reshape(-1, dim) for b in right["vectors"]]
        p, c = _vectors(left["centre"], dim), _vectors(right["centre"], dim)
        bound = _bound(p, left["radius"].to_numpy(), c, right["radius"].to_numpy())
        out = []
        for g, (ids, vec, floor_) in enumerate(zip(left["ids"], left["vectors"], left["worst"].astype(float))):
            q_ids, q = np.frombuffer(ids, dtype="<i8"), np.frombuffer(vec, dtype="<f8").reshape(-1, dim)
            best, all_q = _Best(q_ids, k), np.arange(len(q_ids))
            order = np.argsort(-bound[g])
            for start in range(0, len(order), 16):  # best leaves first, until the rest is pruned
                near = [j for j in order[start:start + 16] if bound[g, j] >= max(floor_, best.worst(all_q))]
                if not near:
                    break
                best.offer(all_q, np.concatenate([d_ids[j] for j in near]),
                           _scores(q, np.concatenate([d_vec[j] for j in near])))
            out += [(i, vec_id, min(max(-s, -2**63), 2**63 - 1), float(-s))
                    for i, row in zip(q_ids.tolist(), best.rows) for s, vec_id in row]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score", "high"])
    found = dealt.groupBy("d", "part").cogroup(spread.groupBy("d", "part")).applyInPandas(search, FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("high").desc(), "vec_id"))
    return (found.withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
