import numpy as np

from pricelake.llm import cover_tree

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=5, every=50):
    good = [(i, [float(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, _ in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dim = max((len(v) for _, v in good), default=0)
    ids = np.array([i for i, _ in good])
    x = np.array([v + [0.0] * (dim - len(v)) for _, v in good], dtype=object).astype(float).astype(np.int64).reshape(len(good), dim)
    out = set()
    for q in {int(i) for i in ids if i % every == 0}:
        best = []
        for row in {tuple(r) for r in x[ids == q].tolist()}:
            scores = x @ np.array(row)
            best += [(-int(s), int(i)) for s, i in zip(scores, ids) if i != q]
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(best)[:k])}
    return out


def small_tree(monkeypatch):
    for name, value in {"FANOUT": 4, "SAMPLE": 30, "BLOCK_ROWS": 60, "LEAF_ROWS": 8, "ASSIGN_ROWS": 100, "SENT_LEAVES": 3}.items():
        monkeypatch.setattr(cover_tree, name, value)


def test_random_and_odd_vectors(spark, monkeypatch):
    small_tree(monkeypatch)
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 0.4, (6, 16))
    rows = [(i, (centres[i % 6] + rng.normal(0, 0.1, 16)).astype(np.float32).tolist(), 0) for i in range(700)]
    rows += [(700 + i, rows[50][1], 0) for i in range(30)]  # many ties
    rows += [(800, None, 0), (850, [1.0, None], 0), (900, [float("nan")] * 16, 0), (950, [float("inf")] * 16, 0),
             (None, [1.0] * 16, 0), (1000, [], 0), (1050, [0.5] * 4, 0), (100, rows[100][1], 0)]
    got = cover_tree.top_k(spark.createDataFrame(rows, SCHEMA)).collect()
    want = brute(rows[:-1])
    # the repeated row 100 is a second candidate for the others, not for itself
    mine = [tuple(r) for r in got]
    assert len(mine) == len({(r[0], r[1]) for r in mine})
    best = {}
    for q, r, i, s in want:
        best.setdefault(q, {})[r] = s
    for q, r, i, s in mine:
        assert i != q
        assert s >= best[q][r]  # a repeated row can only push others down
    plain = cover_tree.top_k(spark.createDataFrame(rows[:-1], SCHEMA)).collect()
    assert {tuple(r) for r in plain} == want


def test_few_and_none(spark):
    rows = [(0, [1.0, 2.0], 0), (1, [0.5, 0.5], 0), (50, [-1.0, 0.0], 0)]
    assert {tuple(r) for r in cover_tree.top_k(spark.createDataFrame(rows, SCHEMA)).collect()} == brute(rows)
    assert cover_tree.top_k(spark.createDataFrame([], SCHEMA)).count() == 0
    assert cover_tree.top_k(spark.createDataFrame([(0, None, 1)], SCHEMA)).count() == 0


def test_pruning_prunes(monkeypatch):
    p, c = np.array([[10.0, 0.0]]), np.array([[10.0, 0.0], [-10.0, 0.0]])
    b = cover_tree._bound(p, np.array([1.0]), c, np.array([1.0, 1.0]))[0]
    assert b[0] >= 121 > 0 > b[1]


def test_hot_vectors_and_ids(spark, monkeypatch):
    """A third of all rows hold one vector, another part one row again and again."""
    small_tree(monkeypatch)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(0, 1, 3).astype(np.float32).tolist(), 0) for i in range(150)]
    rows += [(150 + i, [0.5, 0.25, 2.0], 0) for i in range(150)]
    rows += [(7, rows[7][1], 0)] * 100
    got = {tuple(r) for r in cover_tree.top_k(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows)


def test_finite_components_of_any_size(spark):
    """Above 2**54 products are exact, beyond 64 bits they are the nearest long."""
    rows = [(0, [2.0**50, 1.0], 0), (1, [2.0**30, 0.0], 0), (2, [3.0e38, 0.0], 0), (3, [-3.0e38, 0.0], 0), (4, [0.0, 3.0], 0),
            (5, [2.0e38, 5.0], 0)]
    got = [tuple(r) for r in cover_tree.top_k(spark.createDataFrame(rows, SCHEMA)).orderBy("rank").collect()]
    top = 2**63 - 1
    assert got == [(0, 1, 2, top), (0, 2, 5, top), (0, 3, 1, top), (0, 4, 4, 3 * 256 * 256), (0, 5, 3, -2**63)]


def test_pairs_are_pruned_level_by_level(spark, monkeypatch):
    """On clustered data the part of all node pairs that is left falls with the
    depth, and so does the part of a larger table."""
    small_tree(monkeypatch)
    shares = []
    for n in (300, 1200):
        rng = np.random.default_rng(3)
        x = 4 * np.eye(6)[np.arange(n) % 6] + rng.normal(0, 0.05, (n, 6))
        table = spark.createDataFrame([(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(x)], SCHEMA)
        vectors, dim = cover_tree.integer_vectors(table)
        levels, rows = cover_tree.build_levels(cover_tree.indexed_rows(vectors, 5, 50), dim)
        for up, down in zip(levels, levels[1:]):  # children lie in their parents
            assert down.agg({"n": "sum"}).first()[0] == up.filter("open").agg({"n": "sum"}).first()[0]
        leaves = cover_tree.build_leaves(rows, dim, 5)
        pairs = cover_tree.node_pairs(levels, leaves, dim)[-1]
        nodes = rows.select("node").distinct().count()
        queried = rows.filter("is_query").select("node").distinct().count()
        shares.append(pairs.count() / (nodes * queried))
    assert len(levels) > 2
    assert shares[0] < 0.6 and shares[1] < shares[0]
