import hashlib
import random
from collections import Counter

import pytest

from pricelake.llm import suffix_dedup as sd
from tests.llm.helpers import frame, given_docs, odd_docs


def brute(rows, length):
    datas = [(t or "").encode() for _, t, *_ in rows]
    n = Counter(d[i:i + length] for d in datas for i in range(len(d) - length + 1))
    out = []
    for (doc_id, *_), d in zip(rows, datas):
        cover = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if n[d[i:i + length]] > 1:
                cover[i:i + length] = b"\1" * length
        kept = bytes(b for b, c in zip(d, cover) if not c)
        spans = sum(1 for i, c in enumerate(cover) if c and (i == 0 or not cover[i - 1]))
        out.append((doc_id, len(d), sum(cover), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(map(str, out))


def passages(n=60, seed=11):
    """Documents with shared passages, overlaps and inner repeats."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7)))
    text = lambda k: " ".join(word() for _ in range(k))
    shared = [text(rng.randint(60, 200)) for _ in range(5)]
    rows = []
    for i in range(n):
        parts = [text(rng.randint(0, 150))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, 40)
            parts += [s[a:len(s) - rng.randint(0, 40)], text(rng.randint(0, 60))]
        rows.append((i, " ".join(parts), "en", "s", 1))
    rows.append((n, shared[0] + shared[0], "en", "s", 1))
    rows.append((n + 1, "ab" * 700, "en", "s", 1))
    rows.append((n + 2, "z" * 399, "en", "s", 1))
    rows.append((n + 3, "z" * 401, "en", "s", 1))
    return rows


@pytest.mark.parametrize("hot,small", [(4096, 12), (4096, 2), (3, 12), (0, 12)], ids=["pairs", "classes", "mixed", "hashed"])
def test_against_brute_force(spark, monkeypatch, hot, small):
    monkeypatch.setattr(sd, "HOT", hot)
    monkeypatch.setattr(sd, "SMALL", small)
    rows = passages()
    got = sd.suffix_dedup(frame(spark, rows)).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows, 400)


@pytest.mark.parametrize("rows", [odd_docs(), given_docs(), []], ids=["odd", "given", "empty"])
def test_tables(spark, rows):
    got = sd.suffix_dedup(frame(spark, rows)).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows, 400)


def test_merge_is_a_sort_with_its_lcp_array():
    rng = random.Random(2)
    for n_runs in (1, 2, 3, 5, 8):
        runs, entries = [], []
        for _ in range(n_runs):
            own = sorted((bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))), b"L", rng.randint(0, 9), k)
                         for k in range(rng.randint(1, 40)))
            own.sort(key=lambda e: e[0])
            entries += own
            runs.append(sd.Run(sd.front_code(own)))
        merged = list(sd.merge(runs))
        assert [e[0] for _, e in merged] == sorted(e[0] for e in entries)
        before = b""
        for k, (shared, e) in enumerate(merged):
            if k:
                assert shared == sd.lcp(before, e[0])
            before = e[0]


def test_anchor_windows_cover_every_string():
    data = ("x" * 50 + "".join(chr(97 + i * i % 26) for i in range(3000))).encode()
    place, first, last, gram = sd.anchors(data)
    assert first[0] == 0 and last[-1] == len(data) - 400 and (first[1:] == last[:-1] + 1).all()
    assert ((place >= last) & (place <= first + 400 - sd.GRAM)).all()
