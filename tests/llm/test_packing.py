import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pricelake.llm import packing
from tests.llm.helpers import DOCS, frame, given_docs, odd_docs

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("rows", [odd_docs(), given_docs()], ids=["odd", "given"])
def test_pack_against_the_library(spark, rows):
    got = packing.pack(frame(spark, rows), PATH).collect()
    lib = Tokenizer.from_file(PATH)
    want = []
    for doc_id, text, *_ in rows:
        ids = np.array([*lib.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        want += [(doc_id, k, s, len(ids[s:s + 4096]), zlib.crc32(ids[s:s + 4096].tobytes()))
                 for k, s in enumerate(range(0, len(ids), 4096))]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) <= _first_fit_decreasing([r["length"] for r in got])


def _first_fit_decreasing(lengths, capacity=4096):
    bins = []
    for x in sorted(lengths, reverse=True):
        i = next((i for i, b in enumerate(bins) if b + x <= capacity), None)
        if i is None:
            bins.append(x)
        else:
            bins[i] += x
    return len(bins)


def test_two_fit_replaces_the_smallest():
    # greedy: 60 + 30 leaves 10; 30 out, 21 + 19 fill the gap of 40 exactly
    plan = packing.Plan({60: 1, 30: 1, 21: 1, 19: 1}, 100)
    at = {x: int(plan.place(np.array([x]), np.array([0]))[0][0]) for x in (60, 30, 21, 19)}
    assert at[60] == at[21] == at[19] != at[30]


def test_two_fit_replaces_one_of_equal_lengths():
    # greedy: 1500 + 1500 leaves 1096; one 1500 out, 1300 + 1296 fill the gap exactly
    plan = packing.Plan({1500: 2, 1300: 1, 1296: 1}, 4096)
    seq = plan.place(np.array([1500, 1500, 1300, 1296]), np.array([0, 1, 0, 0]))[0].tolist()
    assert plan.sequences == 2 and seq[2] == seq[3] and seq[:2].count(seq[2]) == 1


def test_plan_size_does_not_follow_the_counts():
    counts = {x: 10**6 + x for x in range(1, 4097, 7)}
    plan = packing.Plan(counts, 4096)
    assert len(plan.runs) < 20_000
    total = sum(x * n for x, n in counts.items())
    assert plan.sequences <= total / 4096 * 1.02 + 1


def test_empty_table(spark):
    assert packing.pack(frame(spark, []), PATH).count() == 0
    assert spark.createDataFrame([], DOCS).count() == 0


def test_chunk_ids_of_random_texts(monkeypatch):
    import random

    from pricelake.llm import tokens
    monkeypatch.setattr(tokens, "MAX_CHUNKS", 300)  # forgets often
    rng = random.Random(6)
    parts = ["'s", "'re", "'", "''", "don't", "we", "WE", "12", "½", "²", "ª", "ÀÉ", "é", "é", "ß", "日本", "😀", ".", ",", "!?",
             "...", "<|endoftext|>", "<|", "|>", "<", "-", "_", "\x1c", "\x85", "\xa0", "\xad", " ", "İ", "Σ", "​", "a1b2"]
    gaps = ["", "", " ", "  ", "\n", "\t", "\r\n", "\xa0"]
    texts = ["".join(rng.choice(parts) + rng.choice(gaps) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    lib = Tokenizer.from_file(PATH)
    ids = tokens.ChunkIds(PATH)
    for text, got in zip(texts, ids.texts(texts, 50), strict=True):
        want = np.array(lib.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert got == want, text
