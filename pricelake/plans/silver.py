"""Silver layer: staged rows, SCD2 history, dimensions, canonical products,
cross-store matching, the store bridge and the price fact.

Each function takes DataFrames and returns a DataFrame; ``plans.pipeline``
wires them together.  Dimension lookups are plain equi-joins: AQE turns
them into broadcast joins at run time when the measured dimension is
small, and keeps a shuffle join when it is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake import STORE_A, STORE_B
from pricelake.functions.text import normalize_name, parse_pack, signature
from pricelake.operators.cdc import END, HOT_ROWS, START, scd1, scd2
from pricelake.operators.fuzzy import best_match
from pricelake.operators.joins import SKU, broadcast_if_small, by_sku
from pricelake.operators.keymap import KeyMap
from pricelake.operators.keys import assign_keys, dense_ids, pinned_by, prefix_sums
from pricelake.operators.latest import keep_latest, keep_one_of_few
from pricelake.operators.order import asc, desc, keep_one
from pricelake.operators.quality import quality_gate
from pricelake.plans.params import (CATEGORY_MAP_A, CATEGORY_MAP_B, FALLBACK_ID_START,
                                    MATCH_SCORE_THRESHOLD, PRICE_RULES, STAGE_A_RULES,
                                    STAGE_B_RULES, map_column)

# ---------------------------------------------------------------------------
# Column lists of the silver tables.
# ---------------------------------------------------------------------------
STAGE_A_COLS = ["store_id", "store_sku", "store_product_name", "description", "canonical_name",
                "brand_name", "category_name", "unit_size", "unit_uom", "raw_hash", "ingestion_ts",
                "scrape_timestamp"]
STAGE_B_COLS = ["store_sku", "store_id", "store_product_name", "brand_name", "category_name",
                "canonical_name", "unit_size", "unit_uom", "raw_hash", "ingestion_ts"]
HIST_B_COLS = ["store_id", "store_sku", "store_product_name", "description", "canonical_name",
               "brand_name", "category_name", "unit_size", "unit_uom", "raw_hash", "ingestion_ts"]
CANONICAL_COLS = ["canonical_product_id", "canonical_name", "brand_id", "brand_name", "category_id",
                  "category_name", "unit_size", "unit_uom", "canonical_signature", "ingestion_ts"]
MATCH_COLS = ["store_id", "brand_id", "store_sku", "category_id", "unit_size", "unit_uom",
              "canonical_product_id", "canonical_name", "match_status", "match_score",
              "category_name", "brand_name", "ingestion_ts"]
BRIDGE_COLS = ["store_id", "store_sku", "canonical_product_id", "match_score", "match_status",
               "canonical_name"]
STORE_PRODUCT_COLS = ["store_product_id", "store_id", "store_sku", "canonical_product_id",
                      "match_score", "match_status", "canonical_name"]
PRICE_COLS = ["store_product_id", "canonical_product_id", "store_id", "scrape_timestamp",
              "regular_price", "promo_price", "promo_details", "unit_price", "unit_measure",
              "raw_hash", "in_stock", "is_on_special", "is_half_price", "batch_ts"]
# ---------------------------------------------------------------------------
KEYS = ["store_id", "store_sku"]
# Latest version wins; ties by raw_hash ascending.
LATEST_A = [desc("ingestion_ts"), desc("scrape_timestamp"), asc("raw_hash")]
LATEST_B = [desc("ingestion_ts"), asc("raw_hash")]


def parse_timestamp(col: str, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """P5: typed timestamps pass through; text is parsed (bad text -> NULL)."""
    return F.coalesce(F.try_to_timestamp(F.col(col).cast("string"), F.lit(fmt)).cast("timestamp_ntz"),
                      F.col(col).try_cast("timestamp_ntz"))


def _with_pack(df: DataFrame) -> DataFrame:
    size, uom = parse_pack("canonical_name")
    return df.withColumns({"unit_size": size, "unit_uom": uom})


def stage_a(raw: DataFrame, rules=STAGE_A_RULES, category_map=CATEGORY_MAP_A) -> DataFrame:
    """M1: raw feed A -> staged rows (P2, P5, P4, P1, P3, F1, F2, gate)."""
    ts = raw.schema["scrape_timestamp"].dataType
    scrape = F.col("scrape_timestamp") if isinstance(ts, (T.TimestampNTZType,)) else parse_timestamp("scrape_timestamp")
    df = raw.select(
        F.lit(STORE_A).cast("int").alias("store_id"),
        F.col("id").alias("store_sku"),
        F.coalesce("name", "description").alias("store_product_name"),
        "description",
        normalize_name(F.coalesce(F.col("description"), F.lit(""))).alias("canonical_name"),
        F.col("brand").alias("brand_name"),
        map_column(category_map, "cat").alias("category_name"),
        "raw_hash", "ingestion_ts", scrape.alias("scrape_timestamp"))
    return quality_gate(_with_pack(df).select(*STAGE_A_COLS), rules)


def stage_b(raw: DataFrame, rules=STAGE_B_RULES, category_map=CATEGORY_MAP_B) -> DataFrame:
    """M2: raw feed B -> staged rows."""
    df = raw.select(
        F.col("Stockcode").alias("store_sku"),
        F.lit(STORE_B).cast("int").alias("store_id"),
        F.col("Name").alias("store_product_name"),
        F.col("Brand").alias("brand_name"),
        map_column(category_map, "Category").alias("category_name"),
        normalize_name(F.coalesce(F.col("Description"), F.lit(""))).alias("canonical_name"),
        "raw_hash", "ingestion_ts")
    return quality_gate(_with_pack(df).select(*STAGE_B_COLS), rules)


def history_a(staged: DataFrame) -> DataFrame:
    """C1 on stage A: versions per (store_id, store_sku) by ingestion_ts."""
    return scd2(staged, KEYS, "ingestion_ts", tie=[desc("scrape_timestamp"), asc("raw_hash")])


def history_b(staged: DataFrame) -> DataFrame:
    """C1 on stage B; the target also carries an (always NULL) description."""
    return scd2(_with_desc(staged), KEYS, "ingestion_ts", tie=[asc("raw_hash")])


def current_a(staged: DataFrame) -> DataFrame:
    """The open versions of ``history_a``, which are the last of each key,
    without its other versions."""
    return _open(staged, KEYS, [desc("ingestion_ts"), desc("scrape_timestamp"), asc("raw_hash")])


def _with_desc(staged: DataFrame) -> DataFrame:
    return staged.withColumn("description", F.lit(None).cast("string")).select(*HIST_B_COLS)


def current_b(staged: DataFrame) -> DataFrame:
    """The open versions of ``history_b``."""
    return _open(_with_desc(staged), KEYS, [desc("ingestion_ts"), asc("raw_hash")])


def _open(staged: DataFrame, keys: list[str], order) -> DataFrame:
    seq = staged.schema["ingestion_ts"].dataType
    kept = _kept(staged, lambda timed: keep_latest(timed, keys, order))
    return kept.withColumns({START: F.col("ingestion_ts"), END: F.lit(None).cast(seq)})


def _kept(staged: DataFrame, keep) -> DataFrame:
    """``keep`` of the rows with a sequence value; the others are open versions of their own."""
    timed = F.col("ingestion_ts").isNotNull()
    return keep(staged.where(timed)).unionByName(staged.where(~timed))


def _versions(staged: DataFrame, order) -> DataFrame:
    return _kept(staged, lambda timed: keep_one_of_few(timed, [*KEYS, "ingestion_ts"], order))


def versions_a(staged: DataFrame) -> DataFrame:
    """The versions of ``history_a`` without their ends: what the gold tables read."""
    return _versions(staged, [desc("scrape_timestamp"), asc("raw_hash")])


def versions_b(staged: DataFrame, cols: list[str] = HIST_B_COLS) -> DataFrame:
    """The versions of ``history_b`` without their ends: what the matcher reads."""
    need = [c for c in HIST_B_COLS if c in cols or c in (*KEYS, "ingestion_ts", "raw_hash")]
    return _versions(_with_desc(staged).select(*need), [asc("raw_hash")])


def _names(cur: DataFrame, col: str, trim: bool) -> DataFrame:
    c = F.trim(F.col(col)) if trim else F.col(col)
    return cur.where(F.col(col).isNotNull()).select(c.alias(col), "ingestion_ts").where(F.col(col) != "")


def dim_brand(cur_a: DataFrame, cur_b: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """M3: one row per lower-cased brand; the latest spelling wins (ties by
    name); ids in brand_key order.  Per-side then cross-side de-dup gives
    the same survivor as one keep-one over both sides, so it is one
    aggregate.  Brands in ``known`` (an earlier dim_brand) keep their id."""
    names = _names(cur_a, "brand_name", True).unionByName(_names(cur_b, "brand_name", True))
    names = names.withColumn("brand_key", F.lower("brand_name"))
    one = keep_one(names, ["brand_key"], [desc("ingestion_ts"), asc("brand_name")])
    ids = assign_keys(one, ["brand_key"], "brand_id", [asc("brand_key")], known)
    return ids.select("brand_id", "brand_name", "brand_key", "ingestion_ts")


def dim_category(cur_a: DataFrame, cur_b: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """M4: one row per category name, ids in name order (ids in ``known`` stay)."""
    names = _names(cur_a, "category_name", False).unionByName(_names(cur_b, "category_name", False))
    one = keep_one(names, ["category_name"], [desc("ingestion_ts")])
    ids = assign_keys(one, ["category_name"], "category_id", [asc("category_name")], known)
    return ids.select("category_id", "category_name", "ingestion_ts")


def dim_lookup(df: DataFrame, brands: DataFrame, categories: DataFrame, lookup: str = "name") -> DataFrame:
    """Attach brand_id / category_id by exact name (left joins).

    ``lookup="key"`` (D7) matches brands on the trimmed, lower-cased key, so
    variant spellings of one brand share its id."""
    if lookup == "key":
        keyed = df.withColumn("_bk", F.lower(F.trim(F.col("brand_name"))))
        names = broadcast_if_small(brands.select(F.col("brand_key").alias("_bk"), "brand_id"))
        out = keyed.join(names, "_bk", "left").drop("_bk")
    else:
        out = df.join(broadcast_if_small(brands.select("brand_name", "brand_id")), "brand_name", "left")
    return out.join(broadcast_if_small(categories.select("category_name", "category_id")), "category_name", "left")


# What identifies a row over runs, by table (K1): a canonical product is known
# by the store and the SKU (or signature) that it was made from.
NATURAL_KEYS = {
    "canonical": ("canonical_product_id", "store_id int, product_key string"),
    "store_product": ("store_product_id", "store_id int, store_sku string, canonical_product_id long"),
    "price_observation": ("observation_id", "store_product_id long, scrape_timestamp timestamp_ntz")}


def key_map(spark, folder: str, table: str) -> KeyMap:
    """The ids of ``table`` kept below ``folder``."""
    id_col, ddl = NATURAL_KEYS[table]
    return KeyMap(spark, f"{folder}/{table}", T.StructType.fromDDL(ddl).fields, id_col)


def canonical_a(cur_a: DataFrame, brands: DataFrame, categories: DataFrame, grain: str = "sku",
                lookup: str = "name", ids: KeyMap | None = None) -> DataFrame:
    """M5: one canonical row per current A SKU, ids in (signature, sku) order.

    SCD2 leaves exactly one open version per (store_id, store_sku) and the
    store is constant, so the reference's two per-SKU de-dups are no-ops here.
    ``grain="signature"`` (D3) keeps one row per signature (smallest SKU).
    With ``ids``, products of earlier runs keep their id."""
    s = dim_lookup(cur_a, brands, categories, lookup).withColumn("canonical_signature", signature())
    if grain == "signature":
        s = keep_one(s, ["canonical_signature"], [asc("store_sku")])
    order = [asc("canonical_signature"), asc("store_sku")]
    if ids is not None:
        key = F.col("canonical_signature" if grain == "signature" else "store_sku")
        out = ids.assign(s.withColumn("product_key", key), order)
    else:
        out = dense_ids(s, order, "canonical_product_id")
    return out.select(*CANONICAL_COLS, "store_sku")


def block_filter(b_rows: DataFrame, canon_a: DataFrame) -> DataFrame:
    """B rows whose (brand_id, category_id) block has A candidates."""
    blocks = broadcast_if_small(canon_a.select("brand_id", "category_id").distinct())
    return b_rows.join(blocks, ["brand_id", "category_id"], "left_semi")


def match_b(hist_b: DataFrame, brands: DataFrame, categories: DataFrame, canon_a: DataFrame,
            threshold: int = MATCH_SCORE_THRESHOLD, keep_unblocked: bool = False,
            lookup: str = "name") -> DataFrame:
    """M6: latest blocked version of every B SKU with its best A match.

    All SCD2 versions take part (D9); the latest blocked version per SKU is
    kept, then its name is matched -- the score depends only on (block, name),
    so this equals matching every version and keeping the latest."""
    b = dim_lookup(hist_b, brands, categories, lookup).withColumn("store_id", F.lit(STORE_B).cast("int"))
    if not keep_unblocked:  # D8: by default B rows without A candidates vanish
        b = block_filter(b, canon_a)
    b = keep_latest(b, KEYS, LATEST_B)
    best = best_match(b, canon_a, ["brand_id", "category_id"], threshold=threshold)
    out = b.join(best, ["brand_id", "category_id", "canonical_name"], "left")
    return out.select(
        *[c for c in MATCH_COLS if c not in ("match_status", "match_score")],
        F.lit("matched").alias("match_status"),
        F.coalesce(F.col("match_score"), F.lit(0.0)).alias("match_score")).select(*MATCH_COLS)


def matched_b(matches: DataFrame, threshold: int = MATCH_SCORE_THRESHOLD) -> DataFrame:
    """M7: rows usable for the bridge."""
    return matches.where(F.col("canonical_product_id").isNotNull()
                         & (F.col("match_score") >= threshold)).select(*BRIDGE_COLS)


def matches_b(matches: DataFrame) -> DataFrame:
    """M8: published matches (id present)."""
    return matches.where(F.col("canonical_product_id").isNotNull()).select(*BRIDGE_COLS)


def unmatched_b(matches: DataFrame) -> DataFrame:
    """M9: unmatched B rows with their signature.  The rows passed the block
    filter, so their brand_id / category_id are the dimension ids already."""
    return (matches.where(F.col("canonical_product_id").isNull())
            .withColumn("canonical_signature", signature())
            .where(F.col("brand_id").isNotNull() & F.col("category_id").isNotNull())
            .select("canonical_name", "brand_id", "brand_name", "category_id", "category_name",
                    "unit_size", "unit_uom", "canonical_signature", "store_sku", "ingestion_ts"))


def canonical(canon_a: DataFrame, matches: DataFrame, ids: KeyMap | None = None) -> DataFrame:
    """Canonical A plus unmatched B, numbered after A's largest id
    (or FALLBACK_ID_START when A has none).  With ``ids``, products of earlier
    runs keep their id and new ones come after the largest of all."""
    b = unmatched_b(matches)
    order = [asc("canonical_signature"), asc("store_sku")]
    if ids is not None:
        keyed = b.withColumns({"store_id": F.lit(STORE_B).cast("int"), "product_key": F.col("store_sku")})
        b = ids.assign(keyed, order, FALLBACK_ID_START)
    else:
        top = canon_a.agg(F.max("canonical_product_id")).scalar()
        start = F.coalesce(F.nullif(top, F.lit(0)), F.lit(FALLBACK_ID_START))
        b = dense_ids(b, order, "canonical_product_id", start)
    return canon_a.select(*CANONICAL_COLS).unionByName(b.select(*CANONICAL_COLS))


def store_product(cur_a: DataFrame, canon: DataFrame, matches: DataFrame, ids: KeyMap | None = None) -> DataFrame:
    """Bridge.  A SKUs join canonical rows by name (every canonical row
    of that name), B SKUs come from their match; ids in (store, sku, id)
    order.  Blank names say nothing about the product and are not bridged to
    each other (the matcher skips them too); such SKUs keep a NULL id."""
    named = canon.select("canonical_product_id", "canonical_name").where(F.trim("canonical_name") != "")
    a = (cur_a.select("store_id", "store_sku", "canonical_name").join(named, "canonical_name", "left")
         .withColumn("match_score", F.lit(100.0))
         .withColumn("match_status", F.lit("bootstrap"))
         .select(*BRIDGE_COLS))
    both = a.unionByName(matched_b(matches))
    order = [asc("store_id"), asc("store_sku"), asc("canonical_product_id")]
    out = dense_ids(both, order, "store_product_id") if ids is None else ids.assign(both, order)
    return out.select(*STORE_PRODUCT_COLS)


def _promo_a() -> tuple[Column, Column]:
    """Promo flag and details of feed A."""
    mask = (F.col("promotionType").isNotNull() | F.col("specialType").isNotNull()
            | F.col("offerDescription").isNotNull())
    details = F.concat_ws("|", F.coalesce("promotionType", F.lit("")), F.coalesce("specialType", F.lit("")),
                          F.coalesce("offerDescription", F.lit("")))
    return (F.when(mask, details).otherwise(F.lit("")),
            F.when(mask, F.lit(True)).otherwise(F.lit(None).cast("boolean")))


def prices_a(raw_a: DataFrame) -> DataFrame:
    """P8 + P9: feed A in the common price layout."""
    details, special = _promo_a()
    return raw_a.select(
        F.col("id").alias("store_sku"), "unit_price", "unit_measure",
        F.when(F.col("price_was") == 0, F.col("price_now")).otherwise(F.col("price_was")).alias("regular_price"),
        F.col("price_now").alias("promo_price"), details.alias("promo_details"), "raw_hash",
        "scrape_timestamp", F.lit(None).cast("boolean").alias("in_stock"), special.alias("is_on_special"),
        "batch_ts", F.lit(None).cast("boolean").alias("is_half_price"), F.lit(STORE_A).cast("int").alias("store_id"))


def prices_b(raw_b: DataFrame) -> DataFrame:
    """P10: feed B in the common price layout."""
    return raw_b.select(
        F.col("Stockcode").alias("store_sku"), "unit_price", F.col("unit_uom").alias("unit_measure"),
        F.col("WasPrice").alias("regular_price"), F.col("Price").alias("promo_price"),
        F.lit("").alias("promo_details"), "raw_hash", "scrape_timestamp",
        F.col("InStock").cast("boolean").alias("in_stock"), F.col("IsOnSpecial").cast("boolean").alias("is_on_special"),
        "batch_ts", F.col("IsHalfPrice").cast("boolean").alias("is_half_price"),
        F.lit(STORE_B).cast("int").alias("store_id"))


def _priced(staged: DataFrame) -> DataFrame:
    """P12 row filters that do not depend on the bridge."""
    return staged.where(F.col("regular_price").isNotNull() & F.col("scrape_timestamp").isNotNull()
                        & F.col("store_sku").isNotNull())


def _bridge(rows: DataFrame, sp: DataFrame) -> DataFrame:
    """Attach store_product / canonical ids (inner: unbridged rows drop)."""
    bridge = sp.select("store_product_id", "store_id", "store_sku", "canonical_product_id")
    return rows.join(bridge, ["store_id", "store_sku"], "inner").select(*PRICE_COLS)


def enrich_prices(staged: DataFrame, sp: DataFrame) -> DataFrame:
    """J4 + P12: attach store_product / canonical ids; rows without a bridge,
    a regular price or a scrape time are dropped."""
    return _bridge(_priced(staged), sp)


# Row rules of the price gate; the bridge rule holds by the inner join.
_ROW_PRICE_RULES = [r for r in PRICE_RULES if r[0] != "has_store_product_match"]


def _one_place(rows: DataFrame, hot_rows: int) -> tuple[DataFrame, bool]:
    """``rows`` with each SKU in one partition (of both stores, as the gold joins
    on the SKU alone cross over), so that what is keyed by the SKU
    and more columns needs no further shuffle; unchanged (and False) if a SKU
    has more than ``hot_rows``."""
    counts = rows.groupBy(SKU).agg(F.count(F.lit(1)).alias("_n"))
    if not counts.where(F.col("_n") > hot_rows).isEmpty():
        return rows, False
    return by_sku(rows), True


def _deduped(raw_a: DataFrame, raw_b: DataFrame, rules, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, bool]:
    """De-dup + row gate before the bridge.  store_product_id determines
    (store_id, store_sku) and every row of a SKU gets the same set of bridge
    ids, so de-duplicating per (store_id, store_sku, ...) and fanning out
    afterwards equals de-duplicating the fanned-out rows per
    (store_product_id, ...) -- on fewer rows.  Also whether the rows of each SKU
    are in one partition."""
    staged, placed = _one_place(_priced(prices_a(raw_a).unionByName(prices_b(raw_b))), hot_rows)
    one = keep_one(staged, ["store_id", "store_sku", "scrape_timestamp", "batch_ts"], [asc("raw_hash")])
    return quality_gate(one, [r for r in rules if r[0] != "has_store_product_match"]), placed


def price_stage(raw_a: DataFrame, raw_b: DataFrame, sp: DataFrame, rules=PRICE_RULES) -> DataFrame:
    """Normalised, enriched, de-duplicated and gated price rows.

    De-dup is on (store_product_id, scrape_timestamp, batch_ts) so a later
    correction (newer batch_ts) still reaches the upsert (D16)."""
    rows, placed = _deduped(raw_a, raw_b, rules)
    return _bridge(rows, by_sku(sp) if placed else sp)


def price_observation_from(raw_a: DataFrame, raw_b: DataFrame, sp: DataFrame, rules=PRICE_RULES,
                           ids: KeyMap | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """M13, see ``observations``."""
    return observations(raw_a, raw_b, sp, rules, ids, hot_rows).select("observation_id", *PRICE_COLS)


def observations(raw_a: DataFrame, raw_b: DataFrame, sp: DataFrame, rules=PRICE_RULES,
                 ids: KeyMap | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """SCD1 per (store_product_id, scrape_timestamp), sequence batch_ts,
    with a surrogate observation_id in key order.  The upsert also runs
    per SKU before the bridge fan-out (same argument as ``_deduped``).

    The numbers are found before the fan-out too: a store product has the rows
    of its SKU, so its observations follow on the row counts of the store
    products before it, in the order of the SKU's scrape times.  The rows are
    shuffled once, by SKU: de-dup, upsert and the place of a row in its SKU need
    no other order, and they are pinned in buckets of the SKU.  The numbered bridge
    is too, so whoever reads the observations joins the two without a shuffle, and
    they need not be written again; they then carry ``store_sku``, beside which the
    gold tables join.  If a SKU has more than ``hot_rows`` rows, only the keys of
    the unbridged rows are ranged and pinned instead.  With ``ids``, observations
    of earlier runs keep their id."""
    sku, key = ["store_id", "store_sku"], ["store_id", "store_sku", "scrape_timestamp"]
    rows, placed = _deduped(raw_a, raw_b, rules, hot_rows)
    last = scd1(rows, key, "batch_ts", tie=[asc("raw_hash")])
    if ids is None and placed:
        place = F.row_number().over(Window.partitionBy(*sku).orderBy("scrape_timestamp"))
        last = pinned_by(last.withColumn("_place", place), [SKU])
        per_sku = last.groupBy(*sku).agg(F.count(F.lit(1)).alias("_rows"))
        bridge = by_sku(sp.select("store_product_id", *sku, "canonical_product_id")).join(per_sku, sku)
        bridge = prefix_sums(bridge, [asc("store_product_id")], "_rows", "_before")
        bridge = pinned_by(by_sku(bridge.drop("_rows")), [SKU])
        return (last.join(bridge, sku).withColumn("observation_id", F.col("_before") + F.col("_place"))
                .select("observation_id", *PRICE_COLS, SKU))
    if ids is not None:
        out = ids.assign(_bridge(last, by_sku(sp) if placed else sp), [asc("store_product_id"), asc("scrape_timestamp")])
        return out.select("observation_id", *PRICE_COLS)
    places = dense_ids(last.select(*key), [asc(c) for c in key], "_place")
    per_sku = places.groupBy(*sku).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    bridge = sp.select("store_product_id", *sku, "canonical_product_id").join(per_sku, sku)
    bridge = prefix_sums(bridge, [asc("store_product_id")], "_rows", "_before")
    number = F.col("_before") + F.col("_place") - F.col("_first") + F.lit(1)
    return (last.join(places, key).join(bridge, sku).withColumn("observation_id", number)
            .select("observation_id", *PRICE_COLS))


def price_observation(stage: DataFrame) -> DataFrame:
    """M13 over an already bridged price stage (e.g. a stream's output)."""
    last = scd1(stage, ["store_product_id", "scrape_timestamp"], "batch_ts", PRICE_COLS, tie=[asc("raw_hash")])
    out = dense_ids(last, [asc("store_product_id"), asc("scrape_timestamp")], "observation_id")
    return out.select("observation_id", *PRICE_COLS)
