import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelake.llm import exact_dedup, fuse_filter
from tests.llm.helpers import frame, given_docs, odd_docs


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


@pytest.mark.parametrize("rows", [odd_docs(), given_docs()], ids=["odd", "given"])
def test_against_brute_force(spark, rows):
    docs = frame(spark, rows)
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[norm(text)].append(doc_id)
    for incoming in (exact_dedup.later_half(docs), F.lit(True), F.lit(False)):
        got = exact_dedup.exact_dedup(docs, incoming).collect()
        key = lambda r: str(r)
        want = []
        for t, ids in groups.items():
            sha = hashlib.sha256(t.encode()).hexdigest()
            keep = min((i for i in ids if i is not None), default=None)
            want += [(i, keep, len(ids), sha) for i in ids]
        assert sorted(((r[0], r[1], r[2], r[4]) for r in got), key=key) == sorted(want, key=key)
        kept = [r for r in got if r["kept"]]
        assert len(kept) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)


def test_empty_table(spark):
    docs = frame(spark, [])
    assert exact_dedup.exact_dedup(docs, exact_dedup.later_half(docs)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 50_000])
def test_fuse_filter(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 2**63, n, dtype=np.uint64)
    blob = fuse_filter.build(keys)
    assert fuse_filter.contains(blob, keys).all()
    other = rng.integers(2**63, 2**64 - 1, 20_000, dtype=np.uint64)
    assert fuse_filter.contains(blob, other).mean() < 0.01
    assert len(blob) < 16 + 2.3 * n + 64
