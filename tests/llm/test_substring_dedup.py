import hashlib
import random
import re

import numpy as np
import pytest

from pricelake.llm import substring_dedup
from tests.llm.helpers import frame, given_docs, odd_docs

N = substring_dedup.LENGTH


def brute(rows):
    first = {}
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, *_ in rows]
    for (doc_id, *_), w in zip(rows, split):
        for s in range(len(w) - N + 1):
            key = tuple(w[s:s + N])
            if doc_id is not None:
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for (doc_id, *_), w in zip(rows, split):
        gone = set()
        for s in range(len(w) - N + 1):
            if doc_id is not None and first.get(tuple(w[s:s + N]), doc_id) < doc_id:
                gone.update(range(s, s + N))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        spans = sum(1 for i in gone if i - 1 not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), spans, kept))
    return out


def check(spark, rows):
    got = [tuple(r) for r in substring_dedup.repeats(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)
    return got


def shared_passages():
    """Passages of 40 to 130 words, cut at random, between random words; some
    without own words, some periodic, some in one document twice."""
    rng = random.Random(12)
    word = lambda: rng.choice("abcdefghijklmnop") + str(rng.randrange(60))
    passages = [[word() for _ in range(n)] for n in (49, 50, 51, 75, 130)] + [["la"] * 90, ["x", "y"] * 60]
    rows = []
    for i in range(150):
        text = []
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            a = rng.randrange(max(1, len(p) - 55))
            text += p[a:rng.randrange(a + 40, len(p) + 45)] + [word() for _ in range(rng.choice((0, 1, 30)))]
        rows.append((rng.randrange(120), rng.choice((" ", "\n", " \t")).join(text), "en", "s", 1))
    return rows


@pytest.mark.parametrize("rows", [odd_docs(), given_docs(), shared_passages()], ids=["odd", "given", "shared"])
def test_against_brute_force(spark, rows):
    got = check(spark, rows)
    assert len(got) == len(rows)


def test_copies_repeated_rows_and_null_ids(spark):
    w = [f"w{i}" for i in range(120)]
    t = " ".join(w)
    rows = [(5, t, "en", "s", 1), (5, t, "en", "s", 1), (3, " ".join(w[10:70]), "en", "s", 1), (None, t, "en", "s", 1),
            (None, t, "en", "s", 1), (9, "\t" + t.replace(" ", "\n") + " ", "en", "s", 1), (7, " ".join(w[:49]), "en", "s", 1)]
    got = {(r[0], r[1], r[2]) for r in check(spark, rows)}
    assert got == {(5, 120, 60), (3, 60, 0), (None, 120, 0), (9, 120, 120), (7, 49, 0)}


def test_one_passage_in_every_document(spark):
    """A line of 30 words between own words is no window; with 55 it is cut everywhere but once."""
    line = [f"l{i}" for i in range(55)]
    rows = [(i, " ".join([f"a{i}_{j}" for j in range(40)] + line[:30 if i % 2 else 55] + [f"b{i}_{j}" for j in range(40)]),
             "en", "s", 1) for i in range(300)]
    got = check(spark, rows)
    assert sum(r[2] for r in got) == 149 * 55


def test_empty_table(spark):
    assert substring_dedup.repeats(frame(spark, [])).count() == 0


def test_every_window_has_one_run_and_equal_windows_one_anchor():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 2**64 - 1, (400, 2), dtype=np.uint64)
    words[200:290] = words[20:110]
    s = substring_dedup.Stretches(words)
    first, windows, anchor, place = substring_dedup.runs(s, len(words))
    assert first[0] == 0 and (first[1:] == first[:-1] + windows[:-1]).all() and windows.sum() == 351
    owner = np.repeat(place, windows)
    assert (owner[200:241] - owner[20:61] == 180).all()
    assert ((owner >= np.arange(351)) & (owner <= np.arange(351) + N - substring_dedup.SEED)).all()
