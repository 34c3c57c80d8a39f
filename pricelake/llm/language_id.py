"""Language identification by compression (operator 9).

For each language a raw-content zstandard dictionary is filled with excerpts
of labelled documents.  A text is encoded whole with every dictionary, in
consecutive pieces of ``PIECE`` bytes, and takes the language whose dictionary
gives the smallest sum of frames; ties go to the language with more labelled
documents, then to code-point order.  Each piece meets the dictionary anew: in
one long frame it would leave the window, and its lead would not grow with the
text.  ``score`` is the margin, (second - best) / second, 1.0 if only one
language is known; it does not fall with the length of the text.  A caller
that filters rejects texts whose margin is narrow.

Learning: labelled documents that are not held out (crc32 of the doc_id as
text, mod 4, is 2).  ``SAMPLE_DOCS`` documents a language at most, chosen by
the hash of their id, give ``EXCERPT_CHARS`` characters each to its
dictionary; that bounded sample (a parameter) is all that is collected.
Predictions read only the text, all of it, letters in lower case.

Edge cases: null text or text without a letter gives ``und`` and score 0; no
labelled rows give ``und`` for all; null doc_id is not held out and not
learned from; empty table gives an empty result; repeated rows get equal
answers.  The number of languages must be small (one dictionary each).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import release_memory

SAMPLE_DOCS = 120
EXCERPT_CHARS = 800
PIECE = 1 << 14
# Lazy matching down to 4 bytes: words are short, and speed stays near level 6.
SEARCH = dict(window_log=18, chain_log=17, hash_log=17, search_log=4, min_match=4, target_length=16,
              strategy=zstandard.STRATEGY_LAZY, write_content_size=0, write_checksum=0, write_dict_id=0)
UNKNOWN = "und"
# The pipeline rejects texts whose best dictionary wins by less than this.
NARROW = 0.001

_NOT_LETTERS = re.compile(r"[\W\d_]+")
_LETTER = regex.compile(r"\p{L}")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def _letters(text: str) -> bytes:
    return _NOT_LETTERS.sub(" ", text.lower()).encode("utf-8", "replace")


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, excerpt: int = EXCERPT_CHARS) -> list[tuple[str, bytes]]:
    """(language, dictionary content), the most frequent language first."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    # twice the wanted number is expected to pass; the surplus goes after the collect
    space = 1 << 40
    limit = F.element_at(F.create_map(*[F.lit(x) for lang, n in counts.items()
                                        for x in (lang, min(space, 2 * sample_docs * space // n))]), F.col("lang"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(space))
    rows = (known.withColumn("place", place).filter((F.col("place") < limit) & F.col("text").isNotNull())
            .select("lang", "place", "doc_id", F.substring("text", 1, excerpt).alias("text")).collect())
    content = {}
    for lang in sorted(counts, key=lambda x: (-counts[x], x)):
        own = sorted((r["place"], r["doc_id"], r["text"]) for r in rows if r["lang"] == lang)[:sample_docs]
        content[lang] = b" ".join(_letters(text) for _, _, text in own)
    return [(lang, c) for lang, c in content.items() if c.strip()]


class Classifier:
    def __init__(self, content: list[tuple[str, bytes]]):
        self.langs = [lang for lang, _ in content]
        self.compressors = []
        for _, raw in content:
            d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            search = zstandard.ZstdCompressionParameters(**SEARCH)
            d.precompute_compress(compression_params=search)
            self.compressors.append(zstandard.ZstdCompressor(compression_params=search, dict_data=d))

    def classify(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.langs or not _LETTER.search(text):
            return UNKNOWN, 0.0
        data = memoryview(_letters(text))
        pieces = [data[at:at + PIECE] for at in range(0, len(data), PIECE)]
        sizes = [sum(len(c.compress(p)) for p in pieces) for c in self.compressors]
        best = min(sizes)
        at = sizes.index(best)
        if len(sizes) == 1:
            return self.langs[0], 1.0
        second = min(s for i, s in enumerate(sizes) if i != at)
        return self.langs[at], (second - best) / second


def language(content: list[tuple[str, bytes]], text: str = "text") -> Column:
    """struct(lang, score) of a text column."""
    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        release_memory()
        classify = Classifier(content).classify
        for texts in batches:
            yield pd.DataFrame([classify(t) for t in texts], columns=["lang", "score"])
    return predict(F.col(text))


def accepted(docs: DataFrame, narrow: float = NARROW) -> DataFrame:
    """The rows of ``docs`` whose language is told apart by at least ``narrow``;
    learned from the labelled rows of ``docs`` itself."""
    return docs.filter(language(learn(docs.select("doc_id", "text", "lang")))["score"] >= narrow)


def predictions(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document."""
    pred = language(learn(docs.select("doc_id", "text", "lang"))).alias("pred")
    return docs.select("doc_id", held_out().alias("held_out"), pred).select(
        "doc_id", "held_out", F.col("pred.lang").alias("lang_pred"), "pred.score")
