"""Small tables for the llm tests."""

import random

import duckdb

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def given_docs(limit=None):
    q = f"SELECT doc_id, text, lang, source, n_chars FROM '{SF}/documents.parquet' ORDER BY doc_id"
    return duckdb.sql(q + (f" LIMIT {limit}" if limit else "")).fetchall()


def odd_docs():
    """Nulls, empty and white-space texts, ties, repeated rows, long texts."""
    rng = random.Random(7)
    words = ["alpha", "Beta", "gamma,", "x", "été", "ß", "日本語", "don't", "42", "😀"]
    long_ = " ".join(rng.choice(words) for _ in range(30_000))
    texts = [None, "", " \t\n", "one", "one", "ONE two", "a  b\tc", "a b c", "a\nb\rc", "<|endoftext|> x", long_,
             long_ + " tail", "x" * 9000, " nbsp wide", "é combining", "12345", "a b c d e f g h"]
    rows = [(i, t, ["en", None, "fr"][i % 3], [None, "s1", "s2", "s1"][i % 4], 1) for i, t in enumerate(texts)]
    return rows + [(3, "one", "en", "s1", 1), (None, "one", "en", "s2", 1), (None, None, None, None, None)]


def frame(spark, rows, schema=DOCS):
    """The rows as ``documents``, with an extra column under a clashing name."""
    df = spark.createDataFrame(rows, schema)
    return df.selectExpr("*", "1 AS size", "'z' AS norm", "2 AS length", "3 AS n")
