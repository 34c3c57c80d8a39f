"""Composite operators against brute force on small fixtures."""

import datetime as dt
import random

from pyspark.sql import functions as F

from pricelake.operators.cdc import END, START, carried_next, scd1, scd2
from pricelake.operators.fuzzy import best_match, lcs_length
from pricelake.operators.keys import assign_keys, dense_ids, ranged_keys
from pricelake.operators.order import asc, desc, keep_one
from pricelake.operators.quality import quality_gate, quality_report


def test_keep_one_orders_and_nulls(spark):
    rows = [("k1", 1, "b", 5.0), ("k1", 1, "a", 5.0), ("k1", None, "a", 9.0), ("k1", 0, "z", 1.0),
            ("k2", None, "q", None), ("k2", None, "p", 2.0)]
    df = spark.createDataFrame(rows, "k string, n int, s string, v double")
    # n desc (NULL last), s asc
    got = {r.k: (r.n, r.s) for r in keep_one(df, ["k"], [desc("n"), asc("s")]).collect()}
    assert got == {"k1": (1, "a"), "k2": (None, "p")}
    # mixed string directions take the byte-reversal path
    got = {r.k: (r.s, r.v) for r in keep_one(df, ["k"], [desc("s"), asc("v")]).collect()}
    assert got == {"k1": ("z", 1.0), "k2": ("q", None)}
    got = {r.k: r.s for r in keep_one(df, ["k"], [asc("s"), desc("v")]).collect()}
    assert got == {"k1": "a", "k2": "p"}


def test_dense_ids_equal_row_number(spark):
    random.seed(7)
    rows = [(f"h{random.randrange(500):03d}", i) for i in range(2000)]
    df = spark.createDataFrame(rows, "h string, t int")
    got = sorted((r.h, r.t, r.rid) for r in dense_ids(df, [asc("h"), asc("t")], "rid", start=10).collect())
    want = [(h, t, i + 11) for i, (h, t) in enumerate(sorted(rows))]
    assert got == want


def test_assign_keys_keeps_existing(spark):
    existing = spark.createDataFrame([("b", 1), ("d", 7)], "k string, id long")
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "k string")
    got = sorted(tuple(r) for r in assign_keys(df, ["k"], "id", [asc("k")], existing=existing).collect())
    assert got == [("a", 8), ("b", 1), ("c", 9), ("d", 7)]


def _scd2_brute(events):
    """Python SCD2: latest tie winner per (key, seq), end = next seq."""
    by_key = {}
    for key, seq, tie, payload in events:
        cur = by_key.setdefault(key, {})
        if seq not in cur or tie < cur[seq][0]:
            cur[seq] = (tie, payload)
    out = set()
    for key, versions in by_key.items():
        seqs = sorted(versions)
        for i, s in enumerate(seqs):
            out.add((key, s, versions[s][1], seqs[i + 1] if i + 1 < len(seqs) else None))
    return out


def test_scd2_late_and_tied_events(spark):
    random.seed(3)
    base = dt.datetime(2025, 11, 1)
    events = []
    for i in range(600):
        key = f"sku{random.randrange(12)}"
        seq = base + dt.timedelta(hours=random.randrange(24 * 20))
        events.append((key, seq, f"h{random.randrange(10 ** 6):06d}", f"p{i}"))
    events += [(k, s, "h000000", "tie-winner") for k, s, _, _ in events[:5]]  # exact-tie cases
    random.shuffle(events)  # arrival order must not matter
    df = spark.createDataFrame(events, "k string, seq timestamp_ntz, raw_hash string, payload string")
    hist = scd2(df, ["k"], "seq", tie=[asc("raw_hash")])
    got = {(r.k, r[START], r.payload, r[END]) for r in hist.collect()}
    assert got == _scd2_brute(events)


def test_scd1_latest_by_sequence(spark):
    df = spark.createDataFrame([("a", 1, "x", "h2"), ("a", 3, "y", "h9"), ("a", 3, "z", "h1"), ("b", 2, "w", "h0")],
                               "k string, seq int, v string, raw_hash string")
    got = sorted(tuple(r) for r in scd1(df, ["k"], "seq", ["k", "v"], tie=[asc("raw_hash")]).collect())
    assert got == [("a", "z"), ("b", "w")]


def test_quality_gate_and_report(spark):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (None, 3.0)], "id int, p double")
    rules = [("id_present", "id IS NOT NULL"), ("price_ok", "p >= 0")]
    assert [r.id for r in quality_gate(df, rules).collect()] == [1]
    rep = {r.rule: (r.failed, r.total) for r in quality_report(df, rules).collect()}
    assert rep == {"id_present": (1, 3), "price_ok": (1, 3)}


def _ratio(a, b):
    a, b = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    n = len(a) + len(b)
    return 100.0 * (1.0 - (n - 2 * lcs_length(a, b)) / n) if n else 100.0


def test_best_match_equals_brute_force(spark):
    random.seed(11)
    words = ["milk", "full", "cream", "lite", "2l", "1l", "choc", "chip", "cookies", "200g", "new", "tim", "tam"]

    def name():
        return " ".join(random.sample(words, random.randint(1, 5)))

    cands = [(b, f"{name()}", i) for i, b in enumerate(random.choices([1, 2], k=60))]
    queries = [(b, name()) for b in random.choices([1, 2, 3], k=80)]
    qdf = spark.createDataFrame(queries, "blk int, canonical_name string")
    cdf = spark.createDataFrame(cands, "blk int, canonical_name string, canonical_product_id long")
    got = {(r.blk, r.canonical_name): (r.canonical_product_id, r.match_score)
           for r in best_match(qdf, cdf, ["blk"]).collect()}
    want = {}
    for blk, q in set(queries):
        best = None
        for cb, cn, cid in cands:
            if cb != blk:
                continue
            s = _ratio(q, cn)
            if s >= 80 and (best is None or (-s, cn, cid) < (-best[0], best[1], best[2])):
                best = (s, cn, cid)
        if best is not None:
            want[(blk, q)] = (min(c for b, n, c in cands if b == blk and n == best[1]), best[0])
    assert got == want


def test_gated_write_counts_in_the_same_pass(spark, tmp_path):
    from pricelake.operators.quality import quality_gate, quality_report, write_gated
    df = spark.createDataFrame([(1, "a"), (None, "b"), (-1, None), (5, "c")], "x int, s string").repartition(3)
    rules = [("positive", "x > 0"), ("named", "s IS NOT NULL")]
    out, report = write_gated(df, rules, f"file://{tmp_path}/t")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, quality_gate(df, rules).collect())) == [(1, "a"), (5, "c")]
    want = {("positive", 2, 4), ("named", 1, 4)}
    assert {tuple(r) for r in report.collect()} == want == {tuple(r) for r in quality_report(df, rules).collect()}
    none, empty = write_gated(df.where("false"), rules, f"file://{tmp_path}/e")
    assert none.count() == 0 and {tuple(r) for r in empty.collect()} == {("positive", 0, 0), ("named", 0, 0)}


def test_scd2_one_key_with_a_third_of_one_day(spark):
    """The carry scan: the hot key's day is many tasks, the history is the same."""
    random.seed(11)
    day = dt.datetime(2024, 3, 1)

    def at():
        return day + dt.timedelta(seconds=random.randrange(86_400))
    events = [("hot", at(), f"t{i % 7}", f"p{i}") for i in range(1000)]
    events += [(f"k{random.randrange(40)}", at() + dt.timedelta(days=random.randrange(3)), f"t{i % 5}", f"q{i}")
               for i in range(2000)]
    events += [("hot", day + dt.timedelta(days=2), "t", "later"), ("one", day, "t", "only")]
    events += [("copy", day, f"t{i:04d}", f"c{i}") for i in range(300)]  # one version, many rows
    events = list({(k, s, t): (k, s, t, p) for k, s, t, p in events}.values())
    df = spark.createDataFrame(events, "k string, seq timestamp, tie string, payload string").repartition(6)
    for hot_rows in (100, 1_000_000):
        hist = scd2(df, ["k"], "seq", [asc("tie")], hot_rows=hot_rows)
        assert {(r.k, r.seq, r.payload, r[END]) for r in hist.collect()} == _scd2_brute(events)
        assert hist.columns == [*df.columns, START, END]


def test_carried_next_null_keys_and_splits(spark):
    rows = [(None, i) for i in range(50)] + [("hot", i) for i in range(500)] + [("z", 1)]
    df = spark.createDataFrame(rows, "k string, seq int")
    got = {tuple(r) for r in carried_next(df, ["k"], "seq", "nxt", partitions=16).collect()}
    assert got == {(k, i, i + 1 if (k, i + 1) in set(rows) else None) for k, i in rows}
    sizes = [r["count"] for r in ranged_keys(df, [asc("k"), asc("seq")], 16).groupBy("_pid").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 100  # the hot key is spread
    assert carried_next(df.limit(0), ["k"], "seq", "nxt").count() == 0
