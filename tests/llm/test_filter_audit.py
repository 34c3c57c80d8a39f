import random
import re
from collections import defaultdict
from itertools import permutations

import pytest

from pricelake.llm import filter_audit
from pricelake.llm.common import scratch
from tests.llm.helpers import frame, given_docs, odd_docs


def masks(rows):
    low = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            low[text or ""] = min(low.get(text or "", doc_id), doc_id)
    for doc_id, text, lang, *_ in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": doc_id is not None and doc_id > low[t]}
        yield doc_id, lang or "", {f for f, x in fails.items() if x}


def brute(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    parts = defaultdict(list)
    for doc_id, part, failed in masks(rows):
        parts[part].append((doc_id, failed))
    out = []
    for part, docs in parts.items():
        table = []
        for order in permutations("ABCDE"):
            left = docs
            for i, f in enumerate(order):
                gone = [d for d in left if f in d[1]]
                redundant = sum(f in d[1] for d in docs) - len(gone)
                left = [d for d in left if f not in d[1]]
                table.append([part, "".join(order), i + 1, len(left), len(gone), redundant,
                              sum(d[1] == {f} for d in docs), sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone)])
        shapley = defaultdict(int)
        for r in table:
            shapley[r[1][r[2] - 1]] += r[4]
        out += [(*r, shapley[r[1][r[2] - 1]]) for r in table]
    return out


def store(spark, rows, files):
    """The rows as a Parquet table, ``files`` files that are read in the order given."""
    path = scratch(spark) + "/documents.parquet"
    for i in range(files):
        frame(spark, rows[i::files]).coalesce(1).write.mode("append").parquet(path)
    return path


def check(spark, rows, labels, files, batches):
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "1 AS n", "'x' AS part")
    got = filter_audit.audit(spark, store(spark, rows, files), known, batches)
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute(rows, labels))


@pytest.mark.parametrize("files,batches", [(1, 1), (4, 4), (5, 2)])
def test_smaller_ids_that_arrive_later(spark, files, batches):
    """Copies in any order over the files; the smallest id often comes last."""
    rng = random.Random(files)
    texts = ["alpha " * 250, "one TWO # three", "", None, " ".join(f"w{i}" for i in range(220)), "AB cd"]
    rows = [(rng.randrange(60) if rng.random() < 0.9 else None, rng.choice(texts), rng.choice(["en", "", None, "fr"]), "s", 1)
            for _ in range(120)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 60, 2)] + [(4, 1, 1), (None, 1, 1)]
    check(spark, rows, labels, files, batches)


def test_odd_and_given_documents(spark):
    rows = odd_docs() + [(d + 100, t, lang, s, n) for d, t, lang, s, n in reversed(given_docs())]
    check(spark, rows, [(d, d % 2, (d // 2) % 2) for d in range(0, 300, 3)], 3, 3)


def test_empty_table(spark):
    check(spark, [], [], 1, 1)


def test_retractions_are_counted():
    """The state of a text gives back what it counted before."""
    low, held, out = filter_audit.retract(None, [], [(7, "en", 1, True, False, 2)])
    assert out == [("en", 1, True, False, 2)]
    low, held, out = filter_audit.retract(low, held, [(9, "fr", 1, False, False, 1), (7, "en", 1, True, False, 1), (None, "en", 1, False, False, 4)])
    assert out == [("fr", 17, False, False, 1), ("en", 1, True, False, 1), ("en", 1, False, False, 4)]
    assert (low, held) == (7, [["en", 1, True, False, 3]])
    low, held, out = filter_audit.retract(low, held, [(3, "de", 1, False, True, 1)])
    assert out == [("en", 1, True, False, -3), ("en", 17, True, False, 3), ("de", 1, False, True, 1)]
    assert (low, held) == (3, [["de", 1, False, True, 1]])
