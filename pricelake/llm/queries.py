"""The registered queries of the llm operators, and their SQL."""

from __future__ import annotations

import string

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm import (cover_tree, exact_dedup, filter_audit, html_text, jaccard_join, language_id, merkle_manifest,
                           mixing, packing, secret_crf, substring_dedup, suffix_dedup, token_count)
from pricelake.llm.common import table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return token_count.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return exact_dedup.exact_dedup(docs, exact_dedup.later_half(docs))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents", "doc_id", "text"))
    return cut.withColumn("n_kept", F.col("n_bytes") - F.col("n_removed"))  # n_bytes is the input's


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return html_text.extract(pages, html_text.fit(html_text.sample(pages)))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predictions(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return secret_crf.scan(docs, secret_crf.fit(docs))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text")
    return merkle_manifest.audited(docs).drop("source")


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeats(table(spark, sf_dir, "documents", "doc_id", "text")).drop("kept_text")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_ngram_jaccard_join, op3_exact_top_k, op4_token_counts, op5_exact_dedup, op6_mixing,
    op7_suffix_array_dedup, op8_html_extraction, op9_language_id, op10_secret_scans, op11_merkle_manifest,
    op12_substring_dedup, op13_filter_audit)}



def _merkle_sql(levels: int = 5, source_levels: int = 4) -> str:
    """The Merkle tree level by level, for sources of up to 16**levels rows and
    16**source_levels sources."""
    def field(c: str) -> str:
        return f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"

    lower = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    out = ["""bits AS (
  SELECT DISTINCT CAST(doc_id AS VARCHAR) AS id, 0 AS k, 4294967295 AS c FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT id, k + 1, xor(x >> 1, 3988292384 * (x & 1)) FROM (
    SELECT id, k, CASE WHEN k % 8 = 0 THEN xor(c, CAST(ascii(substr(id, k // 8 + 1, 1)) AS BIGINT)) ELSE c END AS x
    FROM bits WHERE k < 8 * length(id)))""",
           "crc AS (SELECT id, xor(c, 4294967295) AS crc FROM bits WHERE k = 8 * length(id))",
           f"""d AS (
  SELECT doc_id, coalesce('1' || source, '0') AS g, {leaf('text')} AS leaf,
         CASE WHEN crc % 5 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS f
  FROM documents LEFT JOIN crc ON CAST(doc_id AS VARCHAR) = id)""",
           """a0 AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n,
         leaf AS digest FROM d)"""]

    def climb(p: str, depth: int) -> None:
        for k in range(depth):
            out.append(f"""{p}{k + 1} AS (
  SELECT g, idx // 16 AS idx, (any_value(n) + 15) // 16 AS n, list(digest ORDER BY idx) AS kids,
         CASE WHEN any_value(n) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY idx)) END AS digest
  FROM {p}{k} GROUP BY g, idx // 16)""")

    def descend(p: str, rows: str, depth: int) -> str:
        for k in range(depth):
            slot = f"CAST((r.idx // {16 ** k}) % 16 AS INTEGER)"
            size = f"(r.n + {16 ** k - 1}) // {16 ** k}"
            out.append(f"""{rows}{k + 1} AS (
  SELECT r.* REPLACE (
    CASE WHEN {size} = 1 THEN r.f ELSE sha256(array_to_string(
      list_concat(list_concat(kids[1:{slot}], [r.f]), kids[{slot} + 2:]), '')) END AS f,
    CASE WHEN {size} = 1 THEN r.proof ELSE r.proof || array_to_string(
      list_concat(kids[1:{slot}], kids[{slot} + 2:]), '') END AS proof)
  FROM {rows}{k} r JOIN {p}{k + 1} t ON r.g = t.g AND r.idx // {16 ** (k + 1)} = t.idx)""")
        return f"{rows}{depth}"

    climb("a", levels)
    out.append(f"""s0 AS (
  SELECT 0 AS g, g AS source, row_number() OVER (ORDER BY g) - 1 AS idx, count(*) OVER () AS n, digest FROM a{levels})""")
    climb("s", source_levels)
    out.append("x0 AS (SELECT *, '' AS proof FROM a0)")
    last = descend("a", "x", levels)
    out.append(f"""y0 AS (
  SELECT x.doc_id, x.leaf, s.digest AS subroot, x.f, x.proof, s.g, s.idx, s.n FROM {last} x JOIN s0 s ON x.g = s.source)""")
    last = descend("s", "y", source_levels)
    return (f"WITH RECURSIVE {', '.join(out)} SELECT doc_id, leaf, subroot, (SELECT digest FROM s{source_levels}) AS root, "
            f"sha256(proof) AS proof_sha256, f AS folded_root, f = (SELECT digest FROM s{source_levels}) AS verified FROM {last}")


ORACLE_SQL = {
    "op11_merkle_manifest": _merkle_sql(),
    "op3_exact_top_k": """
WITH t AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.v, d.v) AS BIGINT) AS score
  FROM t q JOIN t d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op5_exact_dedup": r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
""",
    "op12_substring_dedup": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT rid, doc_id, s, md5(array_to_string(w[s:s + 49], ' ')) AS h
  FROM (SELECT *, unnest(range(1, len(w) - 48)) AS s FROM d WHERE len(w) >= 50)),
firsts AS (SELECT h, min(doc_id) AS low FROM win GROUP BY h),
gone AS (
  SELECT DISTINCT rid, unnest(range(s, s + 50)) AS i FROM win JOIN firsts USING (h) WHERE doc_id > low),
words AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
marked AS (
  SELECT words.rid, words.i, word, gone.i IS NOT NULL AS cut,
         gone.i IS NOT NULL AND NOT coalesce(lag(gone.i IS NOT NULL) OVER (PARTITION BY words.rid ORDER BY words.i), false) AS opens
  FROM words LEFT JOIN gone ON words.rid = gone.rid AND words.i = gone.i),
per AS (
  SELECT rid, count(*) AS n_words, count(*) FILTER (cut) AS n_removed, count(*) FILTER (opens) AS n_spans,
         string_agg(word, ' ' ORDER BY i) FILTER (NOT cut) AS kept
  FROM marked GROUP BY rid)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256, coalesce(n_spans, 0) AS n_spans
FROM d LEFT JOIN per USING (rid)
""",
    "op13_filter_audit": r"""
WITH l AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS low FROM documents),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > low THEN 'E' ELSE '' END AS failed
  FROM t LEFT JOIN l USING (doc_id)),
c AS (SELECT part, good, toxic, failed, count(*) AS n FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS letter, filter_order[1:step - 1] AS earlier
  FROM (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders)),
j AS (
  SELECT *, contains(failed, letter) AS fails, length(translate(failed, earlier, '')) < length(failed) AS gone FROM c, steps),
r AS (
  SELECT part, filter_order, step, letter, sum(n) FILTER (NOT fails AND NOT gone) AS kept,
         sum(n) FILTER (fails AND NOT gone) AS removed, sum(n) FILTER (fails AND gone) AS redundant,
         sum(n) FILTER (failed = letter) AS unique_fails, sum(n) FILTER (fails AND NOT gone AND good) AS good_lost,
         sum(n) FILTER (fails AND NOT gone AND toxic) AS toxic_lost
  FROM j GROUP BY ALL)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, letter), 0) AS BIGINT) AS shapley
FROM r
""",
}
