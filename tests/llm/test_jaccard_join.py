import random
import re
from collections import defaultdict

import numpy as np
import pytest

from pricelake.llm import jaccard_join as jj
from pricelake.llm.components import components
from tests.llm.helpers import frame, given_docs, odd_docs


def shingle_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def brute(rows):
    sets = [shingle_set(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for j in holders[x]:
                if j < i:
                    common[j] += 1
        for j, k in common.items():
            if 100 * k >= 75 * (len(s) + len(sets[j]) - k):
                parent[find(parent, i)] = find(parent, j)
    low = defaultdict(list)
    for i in range(len(rows)):
        low[find(parent, i)].append(rows[i][0])
    out = []
    for i, (doc_id, *_) in enumerate(rows):
        ids = [x for x in low[find(parent, i)] if x is not None]
        out.append((doc_id, len(sets[i]), (min(ids) if ids else None) if sets[i] else doc_id))
    return sorted(map(str, out))


def families(seed, n=12, size=14):
    """Families of copies with more and less change, and shared passages."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(400)]
    line = [rng.choice(words) for _ in range(25)]
    rows, doc_id = [], 0
    for _ in range(n):
        base = [rng.choice(words) for _ in range(rng.randint(3, 160))]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 14))):
                own[rng.randrange(len(own))] = rng.choice(words)
            if rng.random() < 0.4:
                own += line
            if rng.random() < 0.2:
                own = own[:rng.randint(1, len(own))]
            text = " ".join(own)
            rows.append((doc_id, text.title() if rng.random() < 0.2 else text, "en", "s", 1))
            doc_id += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rows", [odd_docs(), given_docs(), families(1), families(2, 30, 6), []],
                         ids=["odd", "given", "families", "small", "empty"])
def test_components_against_brute_force(spark, rows):
    got = jj.jaccard_components(frame(spark, rows)).collect()
    assert sorted(str(tuple(r)[:3]) for r in got) == brute(rows)


def test_matrix_alone_finds_every_link(spark, monkeypatch):
    """Without the leader step all links must come from the matrix."""
    monkeypatch.setattr(jj, "_leader_pairs", lambda classes: classes.select(
        classes["cid"].alias("a"), classes["cid"].alias("b")).limit(0))
    rows = families(3, 8, 8)
    got = jj.jaccard_components(frame(spark, rows)).collect()
    assert sorted(str(tuple(r)[:3]) for r in got) == brute(rows)


def test_representatives(spark):
    rows = families(4, 6, 6) + [(1000, None, "en", "s", 1), (1001, " ", None, None, None)]
    kept = {r["doc_id"] for r in jj.representatives(frame(spark, rows)).collect()}
    want = set()
    for r in brute(rows):
        want.add(int(r.strip("()").split(",")[2]))
    assert kept == want


def test_components_of_a_chain_and_a_star(spark):
    rng = random.Random(1)
    chain = list(range(200))
    rng.shuffle(chain)
    edges = list(zip(chain, chain[1:])) + [(1000, x) for x in range(1001, 1100)] + [(5000, 5001)]
    got = {r["v"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[x] for x in range(200)}) == 1 and len({got[x] for x in range(1000, 1100)}) == 1
    assert len(set(got.values())) == 3


PREFIX = "cid long, n int, tokens binary, comp long, gid long"


def prefix(cid, tokens, comp, gid, n=40):
    return (cid, n, np.array(tokens, dtype="<u8").tobytes(), comp, gid)


def test_a_family_in_one_component_forms_no_pairs(spark):
    """Tokens of one component only never reach the join, whatever their number."""
    rows = [prefix(i, [7, 2**63 + 5, 1000 + i], 1, i % 3) for i in range(4000)]
    rows += [prefix(5000, [9, 11], 5000, 5000), prefix(5001, [9, 12], 5001, 5001), prefix(5002, [7, 13], 5002, 5002)]
    prefixes = spark.createDataFrame(rows, PREFIX).repartition(5)
    shared = jj._shared_tokens(prefixes, 4)
    assert sorted(map(tuple, shared.collect())) == [(7, 4001), (9, 2)]
    entries = jj._entries(prefixes, shared).cache()
    per_salt = entries.groupBy("token", "salt").count().collect()
    assert sum(r["count"] for r in per_salt) == 4003 and max(r["count"] for r in per_salt) < 2 * jj.SALT_ROWS
    # the odd class's group meets the family's three, the family's do not meet each other
    got = sorted((r["g"], r["h"]) for r in jj._candidates(entries).collect())
    assert got == [(0, 5002), (1, 5002), (2, 5002), (5000, 5001)]


def test_hot_passage_of_many_components(spark, monkeypatch):
    """Many salts for a token and for a group's queries: all links are found."""
    monkeypatch.setattr(jj, "SALT_ROWS", 2)
    monkeypatch.setattr(jj, "_leader_pairs", lambda classes: classes.select(
        classes["cid"].alias("a"), classes["cid"].alias("b")).limit(0))
    rows = families(5, 4, 24)
    got = jj.jaccard_components(frame(spark, rows)).collect()
    assert sorted(str(tuple(r)[:3]) for r in got) == brute(rows)


def test_group_bounds_equal_the_bounds_of_its_members():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    make = lambda k, keep: np.unique(np.concatenate([base[:keep], rng.integers(0, 2**63, k, dtype=np.uint64)]))
    for _ in range(60):
        members = [make(int(rng.integers(0, 60)), int(rng.integers(20, 400))) for _ in range(int(rng.integers(1, 12)))]
        group = jj.GroupBits([len(m) for m in members], [jj.bucket_bits(m) for m in members])
        q = make(int(rng.integers(0, 60)), int(rng.integers(20, 400)))
        want = {i for i, m in enumerate(members) if jj.may_link(len(q), jj.bucket_bits(q), len(m), jj.bucket_bits(m))}
        got = set(group.may_link(len(q), jj.bucket_bits(q)).tolist())
        assert got <= want and got >= {i for i, m in enumerate(members) if jj.similar(q, m)}


def test_a_family_that_hardly_links(spark, monkeypatch):
    """Copies around one text, most pairs under 0.75: a few groups, all links found."""
    monkeypatch.setattr(jj, "GROUP", 16)
    rng = random.Random(11)
    base = [f"w{i}" for i in range(90)]
    rows = []
    for i in range(160):
        t = list(base)
        for _ in range(rng.randrange(1, 6)):
            t[rng.randrange(90)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(t), "en", "s", 1))
    got = jj.jaccard_components(frame(spark, rows)).collect()
    assert sorted(str(tuple(r)[:3]) for r in got) == brute(rows)
