"""Registered queries: one per operator of the inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
derived feeds of that folder.  Column names match the oracle SQL in
``pricelake.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake import STORE_A, STORE_B
from pricelake.functions.text import parse_pack
from pricelake.operators.fuzzy import candidate_pairs, pair_scores
from pricelake.operators.keymap import KeyMap
from pricelake.operators.keys import assign_keys, dense_ids
from pricelake.operators.latest import keep_latest
from pricelake.operators.order import asc
from pricelake.operators.quality import joined_report, quality_gate
from pricelake.plans import gold, silver
from pricelake.plans.params import CATEGORY_MAP_A, CATEGORY_MAP_B, PRICE_RULES, map_column
from pricelake.plans.pipeline import tables
from pricelake.session import scratch
from pricelake.sources.feeds import exclude_sources

Query = Callable[[SparkSession, str], DataFrame]

# Files left out by the exclude_sources query (two landing days of each feed).
EXCLUDED_FILES = ["landing/a/1996-03-15.csv", " landing/a/1998-07-01.csv ", "",
                  "landing/b/1996-03-15.csv"]


def q_row_hash(spark, d):
    t = tables(spark, d)
    a = t.bronze_a.select(F.lit(STORE_A).alias("store_id"), F.col("id").alias("store_sku"), "raw_hash")
    b = t.bronze_b.select(F.lit(STORE_B).alias("store_id"), F.col("Stockcode").alias("store_sku"), "raw_hash")
    return a.unionByName(b)


def q_exclude_sources(spark, d):
    t = tables(spark, d)
    a = t.bronze_a.select("source_file", F.col("id").alias("store_sku"), "raw_hash")
    b = t.bronze_b.select("source_file", F.col("Stockcode").alias("store_sku"), "raw_hash")
    return exclude_sources(a.unionByName(b), EXCLUDED_FILES)


def q_normalize_names(spark, d):
    t = tables(spark, d)
    texts = (t.bronze_a.select(F.col("description").alias("text"))
             .unionByName(t.bronze_b.select(F.col("Description").alias("text"))).distinct())
    from pricelake.functions.text import normalize_name
    return texts.select("text", normalize_name(F.coalesce(F.col("text"), F.lit(""))).alias("canonical_name"))


def q_parse_pack(spark, d):
    names = q_normalize_names(spark, d).select("canonical_name").distinct()
    size, uom = parse_pack("canonical_name")
    return names.select("canonical_name", size.alias("unit_size"), uom.alias("unit_uom"))


def q_parse_unit_price(spark, d):
    return tables(spark, d).bronze_b.select("CupPrice", "unit_price", "unit_size", "unit_uom").distinct()


def q_category_map(spark, d):
    t = tables(spark, d)
    a = t.bronze_a.select(F.lit(STORE_A).alias("store_id"), F.col("cat").alias("source_category"))
    b = t.bronze_b.select(F.lit(STORE_B).alias("store_id"), F.col("Category").alias("source_category"))
    both = a.unionByName(b).distinct()
    return both.select("store_id", "source_category",
                       F.when(F.col("store_id") == STORE_A, map_column(CATEGORY_MAP_A, "source_category"))
                       .otherwise(map_column(CATEGORY_MAP_B, "source_category")).alias("category_name"))


def q_signature(spark, d):
    return tables(spark, d).canonical_a.select("store_sku", "brand_id", "canonical_name", "unit_size",
                                               "unit_uom", "canonical_signature")


def q_promo_details(spark, d):
    return silver.prices_a(tables(spark, d).bronze_a).select("store_sku", "raw_hash", "promo_details",
                                                             "is_on_special", "regular_price")


def _price_rows(t):
    return silver.prices_a(t.bronze_a).unionByName(silver.prices_b(t.bronze_b))


def _bridged_price_rows(t):
    """Price rows with their bridge id, NULL where the SKU has none."""
    return _price_rows(t).join(_bridge_ids(t), ["store_id", "store_sku"], "left")


def _bridge_ids(t):
    return t.store_product.select("store_id", "store_sku", "store_product_id")


def q_quality_gate(spark, d):
    return quality_gate(_bridged_price_rows(tables(spark, d)), PRICE_RULES).select(
        "store_id", "store_sku", "store_product_id", "raw_hash")


def q_quality_report(spark, d):
    t = tables(spark, d)
    parts = [t.quality["stage_a"].withColumn("gate", F.lit("stage_a")),
             t.quality["stage_b"].withColumn("gate", F.lit("stage_b")),
             joined_report(_price_rows(t), _bridge_ids(t), ["store_id", "store_sku"], PRICE_RULES)
             .withColumn("gate", F.lit("price"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("gate", "rule", "failed", "total")


def q_stage_a(spark, d):
    return tables(spark, d).stage_a


def q_stage_b(spark, d):
    return tables(spark, d).stage_b


def q_keep_latest(spark, d):
    return keep_latest(tables(spark, d).stage_a, silver.KEYS, silver.LATEST_A)


def q_scd2_a(spark, d):
    return tables(spark, d).hist_a


def q_scd2_b(spark, d):
    return tables(spark, d).hist_b


def q_scd2_current(spark, d):
    t = tables(spark, d)
    return t.cur_a.unionByName(t.cur_b, allowMissingColumns=True)


def q_dense_ids(spark, d):
    rows = tables(spark, d).bronze_a.select("raw_hash")
    return dense_ids(rows, [asc("raw_hash")], "row_id")


def q_incremental_keys(spark, d):
    """Brand keys of A first, then B's new keys numbered after them."""
    t = tables(spark, d)

    def keys(cur):
        return (cur.where(F.col("brand_name").isNotNull())
                .select(F.lower(F.trim("brand_name")).alias("brand_key")).where(F.col("brand_key") != "").distinct())

    existing = dense_ids(keys(t.cur_a), [asc("brand_key")], "brand_id")
    allk = keys(t.cur_a).unionByName(keys(t.cur_b)).distinct()
    return assign_keys(allk, ["brand_key"], "brand_id", [asc("brand_key")], existing=existing)


# Three refreshes of the price feed: all rows up to a batch time, then all.
REFRESHES = ["1994-01-01 00:00:00", "1996-01-01 00:00:00", None]


def q_persistent_keys(spark, d):
    """Ids of (store, SKU, scrape time) over three refreshes of a growing feed:
    what an earlier refresh numbered keeps its id."""
    key = ["store_id", "store_sku", "scrape_timestamp"]
    rows = silver._priced(_price_rows(tables(spark, d))).select(*key, "batch_ts")
    ids = KeyMap(spark, scratch(spark, "keymap"), [rows.schema[c] for c in key], "key_id")
    for until in REFRESHES:
        seen = rows.where(F.col("batch_ts") < F.lit(until).cast("timestamp_ntz")) if until else rows
        out = ids.assign(seen.select(*key).distinct(), [asc(c) for c in key])
    return out


def q_dim_lookup(spark, d):
    t = tables(spark, d)
    return silver.dim_lookup(t.cur_a, t.dim_brand, t.dim_category).select("store_sku", "brand_name", "brand_id",
                                                                        "category_name", "category_id")


def q_dim_brand(spark, d):
    return tables(spark, d).dim_brand


def q_dim_category(spark, d):
    return tables(spark, d).dim_category


def q_canonical_a(spark, d):
    return tables(spark, d).canonical_a.select(*silver.CANONICAL_COLS)


def _blocked_b(t, cols=silver.HIST_B_COLS):
    b = silver.dim_lookup(silver.versions_b(t.stage_b, cols), t.dim_brand, t.dim_category)
    return silver.block_filter(b, t.canonical_a)


# What a name pair is made from.
_MATCHED = ["brand_name", "category_name", "canonical_name"]


def q_fuzzy_block_filter(spark, d):
    return _blocked_b(tables(spark, d)).select("store_sku", "raw_hash", "brand_id", "category_id", "canonical_name")


def q_fuzzy_candidates(spark, d):
    """Distinct name pairs of a block that survive the Levenshtein bound."""
    t = tables(spark, d)
    pairs = candidate_pairs(_blocked_b(t, _MATCHED), t.canonical_a, ["brand_id", "category_id"])
    return pairs.select("brand_id", "category_id", "canonical_name", "cand_name")


def q_fuzzy_score(spark, d):
    t = tables(spark, d)
    return pair_scores(_blocked_b(t, _MATCHED), t.canonical_a, ["brand_id", "category_id"])


def q_fuzzy_match(spark, d):
    return tables(spark, d).match_b


def q_matched_b(spark, d):
    return silver.matched_b(tables(spark, d).match_b)


def q_matches_b(spark, d):
    return silver.matches_b(tables(spark, d).match_b)


def q_unmatched_b(spark, d):
    return silver.unmatched_b(tables(spark, d).match_b).drop("store_sku", "ingestion_ts")


def q_canonical(spark, d):
    return tables(spark, d).canonical


def q_store_product(spark, d):
    return tables(spark, d).store_product


def q_price_stage(spark, d):
    return tables(spark, d).price_stage


def q_price_observation(spark, d):
    return tables(spark, d).price_observation


def q_multi_store_products(spark, d):
    t = tables(spark, d)
    return gold.multi_store_products(t.canonical, t.store_product)


def _joined(t):
    return gold.current_prices(t.canonical, t.store_product, t.price_facts, t.versions_a, t.cur_b)


def q_pivot_prices(spark, d):
    return gold.pivot_prices(_joined(tables(spark, d)))


def q_discount_ratio(spark, d):
    o = tables(spark, d).price_observation
    return o.select("observation_id", "store_id", gold.discount(F.col("promo_price"), F.col("regular_price"))
                    .alias("discount"))


def q_gold_price_comparison(spark, d):
    return tables(spark, d).gold_price_comparison


def q_gold_price_trend(spark, d):
    return tables(spark, d).gold_price_trend


def q_gold_trend_a(spark, d):
    t = tables(spark, d)
    return gold.trend_a(t.bronze_a, t.cur_a, t.store_product, t.price_facts)


def q_gold_trend_b(spark, d):
    t = tables(spark, d)
    return gold.trend_b(t.bronze_b, t.cur_b, t.store_product, t.price_facts)


def q_gold_promo_share(spark, d):
    return gold.promo_share(tables(spark, d).gold_price_trend)


def q_gold_basket(spark, d):
    return gold.basket(tables(spark, d).gold_price_comparison)


QUERIES: dict[str, Query] = {
    "row_hash": q_row_hash,
    "exclude_sources": q_exclude_sources,
    "normalize_names": q_normalize_names,
    "parse_pack": q_parse_pack,
    "parse_unit_price": q_parse_unit_price,
    "category_map": q_category_map,
    "signature": q_signature,
    "promo_details": q_promo_details,
    "quality_gate": q_quality_gate,
    "quality_report": q_quality_report,
    "stage_a": q_stage_a,
    "stage_b": q_stage_b,
    "keep_latest": q_keep_latest,
    "scd2_a": q_scd2_a,
    "scd2_b": q_scd2_b,
    "scd2_current": q_scd2_current,
    "dense_ids": q_dense_ids,
    "incremental_keys": q_incremental_keys,
    "persistent_keys": q_persistent_keys,
    "dim_lookup": q_dim_lookup,
    "dim_brand": q_dim_brand,
    "dim_category": q_dim_category,
    "canonical_a": q_canonical_a,
    "fuzzy_block_filter": q_fuzzy_block_filter,
    "fuzzy_candidates": q_fuzzy_candidates,
    "fuzzy_score": q_fuzzy_score,
    "fuzzy_match": q_fuzzy_match,
    "matched_b": q_matched_b,
    "matches_b": q_matches_b,
    "unmatched_b": q_unmatched_b,
    "canonical": q_canonical,
    "store_product": q_store_product,
    "price_stage": q_price_stage,
    "price_observation": q_price_observation,
    "multi_store_products": q_multi_store_products,
    "pivot_prices": q_pivot_prices,
    "discount_ratio": q_discount_ratio,
    "gold_price_comparison": q_gold_price_comparison,
    "gold_price_trend": q_gold_price_trend,
    "gold_trend_a": q_gold_trend_a,
    "gold_trend_b": q_gold_trend_b,
    "gold_promo_share": q_gold_promo_share,
    "gold_basket": q_gold_basket,
}


def _stream_queries() -> dict[str, Query]:
    from pricelake.streaming.jobs import STREAM_QUERIES
    return dict(STREAM_QUERIES)


QUERIES.update(_stream_queries())
