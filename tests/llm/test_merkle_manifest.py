import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from pricelake.llm import merkle_manifest as mm
from tests.llm.helpers import frame, given_docs, odd_docs


def h(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def field(v):
    b = None if v is None else str(v).encode()
    return b"-" if b is None else str(len(b)).encode() + b":" + b


def leaf(doc_id, text, lang, source, n_chars):
    return h(b"".join(field(v) for v in (doc_id, source, lang, n_chars, text)))


def lower(t):
    return None if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def climb(nodes):
    """(root, siblings of each node up to the root)."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = range(i // 16 * 16, min(len(nodes), i // 16 * 16 + 16))
            proofs[k] += [(nodes[j], j < i) for j in run if j != i] + [None]
        nodes = [h("".join(nodes[i:i + 16])) for i in range(0, len(nodes), 16)]
        at = [i // 16 for i in at]
    return nodes[0], proofs


def fold(digest, proof):
    left, right = [], []
    for step in proof:
        if step is None:
            digest, left, right = h("".join([*left, digest, *right])), [], []
        else:
            (left if step[1] else right).append(step[0])
    return digest


def brute(rows):
    sources = defaultdict(list)
    for r in rows:
        sources[r[3]].append(r)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        mine = sorted(sources[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees.append((mine, *climb([leaf(*r) for r in mine])))
    root, top = climb([t[1] for t in trees])
    out = []
    for s, (mine, subroot, proofs), upper in zip(order, trees, top):
        for r, proof in zip(mine, proofs):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            folded = fold(leaf(r[0], lower(r[1]) if hit else r[1], *r[2:]), proof + upper)
            out.append((r[0], s, leaf(*r), subroot, root, h("".join(x[0] for x in proof + upper if x)), folded, folded == root))
    return out


def check(spark, rows):
    got = [tuple(r) for r in mm.audited(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)
    return got


def deep():
    """Three levels in one source, many small sources, lone leaves."""
    rng = random.Random(5)
    sources = ["big"] * 600 + [f"s{i}" for i in range(40)] + ["é", "Z", "", None, None] * 7
    return [(rng.randrange(10_000), rng.choice(["Aa bB", "x", None, "Äö €"]) , "en", s, i) for i, s in enumerate(sources)]


@pytest.mark.parametrize("rows", [odd_docs(), given_docs(), deep()], ids=["odd", "given", "deep"])
def test_against_brute_force(spark, rows):
    got = check(spark, rows)
    assert {r[-1] for r in got} <= {True, False} and len(got) == len(rows)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257])
def test_level_bounds(spark, n):
    check(spark, [(i, f"Text {i}", "en", "s", 1) for i in range(n)])


def test_one_document_without_siblings(spark):
    got = check(spark, [(7, "T", None, None, None)])
    assert got[0][5] == h("") and got[0][2] == got[0][4]


def test_empty_table(spark):
    assert mm.audited(frame(spark, [])).count() == 0


def test_states_are_those_of_sha256():
    rng = np.random.default_rng(1)
    assert mm.START[0] == 0x6A09E667 and mm.ROUND[63] == 0xC67178F2
    import pandas as pd
    messages = pd.Series(["".join(h(str(rng.random())) for _ in range(k)) for k in (1, 2, 15, 16, 7)])
    children, count = mm.digests_of(messages)
    states, digest = mm.hash_children(children, count)
    assert [d.tobytes().decode() for d in digest] == [h(m) for m in messages]
    new = np.frombuffer(h("new").encode(), np.uint8)[None].repeat(5, 0)
    slot = np.array([0, 1, 3, 15, 6])
    again = mm.resume(states[np.arange(5), slot], new, children, slot, count)
    want = [h(m[:s * 64] + h("new") + m[(s + 1) * 64:]) for m, s in zip(messages, slot)]
    assert [d.tobytes().decode() for d in again] == want
