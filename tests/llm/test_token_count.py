import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pricelake.llm import token_count
from tests.llm.helpers import frame, given_docs, odd_docs

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_random_texts(library):
    rng = random.Random(3)
    parts = ["'s", "'re", "'ve", "'ll", "'t", "'m", "'d", "'", "''", "'r", "'l", "'v", "'S", " ", "  ", "\n", "\t", "\r\n",
             " ", "　", "don", "we", "12", "x9", "½", "…", "!", "!!'", "日本", "é", "é", "ß", "😀", "the",
             " the", "ing", "Übung", "<|endoftext|>", "\x1c", "\x00", "​", "re", "ll", "s", "Ⅷ", "ª"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += ["".join(rng.choice(parts) for _ in range(3000)) for _ in range(5)]
    texts += ["a" * 5000, " " * 3000, "'" * 777, "\n \n" * 400, "ab" * 20_000]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    got = token_count.counts(PATH).texts(texts)
    bad = [(t[:200], w, g) for t, w, g in zip(texts, want, got) if w != g]
    assert not bad, bad[:3]


def test_chunk_ends_at_every_place(library):
    rng = random.Random(5)
    parts = ["'s", "'re", "'ll", "'", " ", "  ", "\n", "we", "1", "!", "the"]
    texts = ["x" * k + "".join(rng.choice(parts) for _ in range(60)) for k in range(200, 270)]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert token_count.counts(PATH).texts(texts) == want


def test_states_are_dropped_when_many(library, monkeypatch):
    monkeypatch.setattr(token_count, "MAX_STATES", 50)
    monkeypatch.setattr(token_count, "MAX_PIECES", 20)
    texts = [t for _, t, *_ in given_docs(30)]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert token_count.Counts(PATH).texts(texts) == want


@pytest.mark.parametrize("rows", [odd_docs(), given_docs(), []], ids=["odd", "given", "empty"])
def test_query_against_the_library(spark, library, rows):
    got = token_count.count_tokens(frame(spark, rows), PATH).collect()
    want = []
    for doc_id, text, *_ in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((doc_id, len((text or "").encode()), n, n > 512))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
