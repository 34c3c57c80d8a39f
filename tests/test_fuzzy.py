"""The fuzzy join finds every pair over the cut-off, also in a hot block."""

import random

from pyspark.sql import functions as F

from pricelake.operators.fuzzy import (MAX_TILES, _bag, _salted, candidate_pairs, common_characters, lcs_length, lcs_lengths,
                                       pair_scores)


def _names(seed, n):
    rng = random.Random(seed)
    words = ["milk", "full cream", "2l", "été", "choc-chip", "a", "zzzzzzzzzzzz", "500g", "organic", "日本", "x1"]
    out = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 6))) for _ in range(n)]
    return out + ["".join(rng.choice("abc 1é") for _ in range(rng.choice([1, 63, 64, 65, 130]))) for _ in range(20)] + ["", " "]


def _sorted(s):
    return " ".join(sorted(s.split()))


def test_vector_lcs_equals_the_plain_one():
    a, b = _names(1, 300), _names(2, 300)
    assert lcs_lengths(a, b).tolist() == [lcs_length(x, y) for x, y in zip(a, b)]
    assert lcs_lengths([], []).tolist() == []
    for x, y in [("abcbdab", "bdcaba"), ("a" * 64, "a" * 200), ("ab" * 32, "ba" * 40)]:
        table = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, p in enumerate(x):
            for j, q in enumerate(y):
                table[i + 1][j + 1] = table[i][j] + 1 if p == q else max(table[i][j + 1], table[i + 1][j])
        assert lcs_lengths([x], [y])[0] == table[-1][-1]


def test_common_characters_bound_the_lcs(spark):
    rows = list(zip(_names(3, 200), _names(4, 200)))
    df = spark.createDataFrame(rows, "a string, b string").withColumns({**_bag("a", "_q"), **_bag("b", "_c")})
    for r in df.withColumn("bound", common_characters()).collect():
        exact = sum(min(r.a.count(c), r.b.count(c)) for c in set(r.a))
        assert r.bound >= exact >= lcs_length(r.a, r.b)


def test_pairs_equal_all_pairs_and_salts_change_nothing(spark):
    qs = [(i % 2, n) for i, n in enumerate(_names(5, 80))]
    cs = [(i % 2, n, i) for i, n in enumerate(_names(6, 80))]
    q, c = spark.createDataFrame(qs, "blk int, name string"), spark.createDataFrame(cs, "blk int, name string, cid long")
    got = {(r.blk, r.name, r.cand_name): r.match_score for r in pair_scores(q, c, ["blk"], "name", "cid").collect()}
    want = {}
    for blk, n in {x for x in qs if x[1].strip()}:
        for blk2, m, _ in cs:
            a, b = _sorted(n), _sorted(m)
            if blk == blk2 and a and b and 200 * lcs_length(a, b) >= 80 * (len(a) + len(b)):
                want[blk, n, m] = 100.0 * (1.0 - (len(a) + len(b) - 2 * lcs_length(a, b)) / (len(a) + len(b)))
    assert got == want
    cols = ["blk", "name", "cand_name"]
    plain = {tuple(r) for r in candidate_pairs(q, c, ["blk"], "name", "cid").select(*cols).collect()}
    salted = candidate_pairs(q, c, ["blk"], "name", "cid", pairs_per_task=3).select(*cols).collect()
    assert {tuple(r) for r in salted} == plain and len(salted) == len(plain)
    assert set(got) <= plain


def test_a_hot_block_gives_no_table_of_all_pairs(spark):
    """4,000 unrelated names of one length in one block: 4 million pairs are
    bounded inside the join; few leave it."""
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [("".join(rng.choice(letters) for _ in range(24)), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "name string, cid long").withColumn("blk", F.lit(1))
    q, c = df.where("cid % 2 = 0").select("blk", "name"), df.where("cid % 2 = 1")
    pairs = candidate_pairs(q, c, ["blk"], "name", "cid", common=True, pairs_per_task=500_000)
    assert pairs.count() < 4000
    assert pairs.select("_qs").join(df.selectExpr("name AS _qs"), "_qs").count() == pairs.count()


def test_names_moved_do_not_grow_with_the_pairs(spark):
    """tiles repeat a name a bounded number of times, and each pair meets once."""
    names = spark.range(1000).select(F.lit(1).alias("blk"), F.col("id").cast("string").alias("_qs"))
    q, c = _salted(names, names.withColumnRenamed("_qs", "_cs"), ["blk"], 500)  # 2,000 tasks' pairs
    assert q.count() + c.count() <= 2 * 1000 * (MAX_TILES ** 0.5 + 1)
    assert q.select("_salt").distinct().count() == MAX_TILES
    met = q.join(c, ["blk", "_salt"])
    assert met.count() == 1000 * 1000 and met.select("_qs", "_cs").distinct().count() == 1000 * 1000
    few = names.limit(1)
    q, c = _salted(names, few.withColumnRenamed("_qs", "_cs"), ["blk"], 1)
    assert q.count() == 1000 and c.count() == MAX_TILES
