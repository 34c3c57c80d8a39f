"""Gold queries: price comparison, weekly trend, per-store trend detail,
promo share and basket comparison.

Written as DataFrame plans with the same results as the view definitions
they replace, minus their fan-outs:

* the "current price" branch of store A joins the stage on (sku, raw_hash)
  and the store B branch on sku only; both are semi joins here, which give
  the same distinct rows without multiplying them by stage versions (J7/J8);
* the store pivot is computed once per canonical product and joined to the
  product's names, instead of grouping the names x prices product;
* in the weekly trend, store B's branch pairs every observation of a SKU
  with every week the SKU was scraped (D12).  Only maxima are read from it,
  so observations are reduced per store product first and then paired with
  the distinct weeks -- same result, no observations x raw rows product;
* observations that lie by SKU (``silver.observations``) are not moved: the
  bridge, stage versions and raw rows come to them (``operators.joins``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake import STORE_A, STORE_B
from pricelake.operators.joins import SKU, beside, by_sku, join_facts, moved
from pricelake.plans.params import BASKET_RULES, basket_filter, basket_label

CID = "canonical_product_id"


def multi_store_products(canon: DataFrame, sp: DataFrame, obs: DataFrame | None = None) -> DataFrame:
    """A1: canonical products bridged in more than one store
    (``min <> max`` is "more than one distinct" without a distinct aggregate)."""
    j = canon.select(CID, "canonical_name").join(moved(sp.select(CID, "store_id"), obs), CID)
    return (j.groupBy(CID, "canonical_name")
            .agg(F.min("store_id").alias("_lo"), F.max("store_id").alias("_hi"))
            .where(F.col("_lo") != F.col("_hi")).select(CID, "canonical_name"))


def _bridged(canon: DataFrame, sp: DataFrame, obs: DataFrame) -> DataFrame:
    """The bridge of products in both stores, to be joined to ``obs``."""
    similar = multi_store_products(canon, sp, obs)
    return similar.join(moved(sp.select(CID, "store_id", "store_sku", "store_product_id"), obs), CID)


def _observed(obs: DataFrame, *cols: str) -> DataFrame:
    """``cols`` of the observations, with their SKU if they lie by it."""
    return obs.select(*cols, *[c for c in obs.columns if c == SKU])


def current_prices(canon: DataFrame, sp: DataFrame, obs: DataFrame, hist_a: DataFrame,
                   in_b: DataFrame) -> DataFrame:
    """The ``joined`` rows of the comparison: A rows whose observation hash is
    a stage-A version of the SKU, plus every bridged row whose SKU is in
    stage B (with or without observations); ``in_b``: these SKUs, once or more."""
    base = _bridged(canon, sp, obs)
    o = _observed(obs, "store_product_id", "promo_price", "regular_price", "is_on_special", "raw_hash")
    a = (join_facts(base, o, "store_product_id")
         .join(beside(hist_a.select("store_sku", "raw_hash"), o), ["store_sku", "raw_hash"], "left_semi")
         .withColumn("is_on_special", F.coalesce("is_on_special", F.lit(False))))
    b = join_facts(base.join(in_b.select("store_sku"), "store_sku", "left_semi"), o, "store_product_id",
                   keep_unmatched=True)
    cols = [CID, "canonical_name", "store_id", "store_sku", "store_product_id", "promo_price",
            "regular_price", "is_on_special"]
    # rows may repeat: everything that reads them takes maxima or distinct keys
    return a.select(*cols).unionByName(b.select(*cols))


def discount(promo: Column, regular: Column) -> Column:
    """``1 - promo / regular``; a zero or NULL divisor gives NULL."""
    return F.lit(1.0) - F.try_divide(promo, regular)


def _a_regular(promo: Column, regular: Column) -> Column:
    """Store A's regular price falls back to the promo price when it is 0."""
    return F.when(regular == 0, promo).otherwise(regular)


_PIVOT_COLS = ["a_sku", "b_sku", "a_promo_price", "b_promo_price", "a_regular_price", "b_regular_price",
               "a_is_on_special", "b_is_on_special"]


def pivot_prices(joined: DataFrame, by: tuple[str, ...] = (CID,)) -> DataFrame:
    """A2: per canonical product, SKU / promo / regular / special by store."""
    a = F.col("store_id") == STORE_A
    b = F.col("store_id") == STORE_B
    return joined.groupBy(*by).agg(
        F.max(F.when(a, F.col("store_sku"))).alias("a_sku"),
        F.max(F.when(b, F.col("store_sku"))).alias("b_sku"),
        F.max(F.when(a, F.col("promo_price"))).alias("a_promo_price"),
        F.max(F.when(b, F.col("promo_price"))).alias("b_promo_price"),
        F.max(F.when(a, _a_regular(F.col("promo_price"), F.col("regular_price")))).alias("a_regular_price"),
        F.max(F.when(b, F.col("regular_price"))).alias("b_regular_price"),
        F.max(F.when(a, F.col("is_on_special"))).alias("a_is_on_special"),
        F.max(F.when(b, F.col("is_on_special"))).alias("b_is_on_special"))


def product_names(pairs: DataFrame, hist_a: DataFrame) -> DataFrame:
    """Names of a canonical product: the store-A stage rows (any version) of
    its SKUs; rows without a product name are dropped (J12)."""
    names = hist_a.select("store_sku", "store_product_name", "brand_name", "category_name").distinct()
    return (pairs.select(CID, "store_sku").distinct().join(names, "store_sku")
            .where(F.col("store_product_name").isNotNull())
            .select(CID, "store_product_name", "brand_name", "category_name").distinct())


COMPARISON_COLS = [CID, "canonical_name", "store_product_name", "brand_name", "category_name",
                   "a_sku", "b_sku", "a_promo_price", "b_promo_price", "a_regular_price",
                   "b_regular_price", "a_is_on_special", "b_is_on_special"]


def price_comparison(canon: DataFrame, sp: DataFrame, obs: DataFrame, hist_a: DataFrame,
                     in_b: DataFrame) -> DataFrame:
    """G1: current prices of products sold by both stores, one row per
    product name variant."""
    joined = current_prices(canon, sp, obs, hist_a, in_b)
    # one pass over ``joined``: maxima per (product, SKU); the product pivot
    # (max of maxima) and the product's SKUs for its names both read it
    per_sku = pivot_prices(joined, (CID, "canonical_name", "store_sku"))
    piv = per_sku.groupBy(CID, "canonical_name").agg(*[F.max(c).alias(c) for c in _PIVOT_COLS])
    return product_names(per_sku, hist_a).join(piv, CID).select(*COMPARISON_COLS)


TREND_COLS = [CID, "canonical_name", "store_product_name", "brand_name", "category_name", "scrape_date",
              "week_num", "a_sku", "b_sku", "a_promo_price", "b_promo_price", "a_regular_price",
              "b_regular_price", "a_promo", "b_promo", "a_is_on_special", "b_is_on_special"]


def _contributions(df: DataFrame) -> DataFrame:
    """Per-row values the weekly pivot takes the maximum of."""
    a = F.col("store_id") == STORE_A
    b = F.col("store_id") == STORE_B
    promo = F.coalesce(F.col("promo_price"), F.lit(0.0))
    reg = F.coalesce(F.col("regular_price"), F.lit(0.0))
    a_reg = F.when(F.col("regular_price") == 0, promo).otherwise(reg)
    flag = F.coalesce(F.col("is_on_special"), F.lit(False))
    return df.withColumns({
        "a_sku": F.when(a, F.col("store_sku")), "b_sku": F.when(b, F.col("store_sku")),
        "a_promo_price": F.when(a, promo), "b_promo_price": F.when(b, promo),
        "a_regular_price": F.when(a, a_reg), "b_regular_price": F.when(b, reg),
        "a_promo": F.when(a, discount(promo, a_reg)), "b_promo": F.when(b, discount(promo, reg)),
        "a_is_on_special": F.when(a, flag), "b_is_on_special": F.when(b, flag)})


_PIVOT = ["a_sku", "b_sku", "a_promo_price", "b_promo_price", "a_regular_price", "b_regular_price",
          "a_promo", "b_promo", "a_is_on_special", "b_is_on_special"]


def price_trend(canon: DataFrame, sp: DataFrame, obs: DataFrame, raw_a: DataFrame, raw_b: DataFrame,
                hist_a: DataFrame, calendar: DataFrame, b_match: str = "sku") -> DataFrame:
    """Weekly prices of products sold by both stores.  Weeks come from
    the calendar table; rows whose scrape day has no week are dropped.
    ``b_match="hash"`` (D12) ties store B's observations to their own raw
    row as store A's are, instead of to every raw row of the SKU."""
    base = _bridged(canon, sp, obs)
    cal = F.broadcast(calendar.select("scrape_date", "week_num", "week_start"))
    o = _observed(obs, "store_product_id", "promo_price", "regular_price", "is_on_special", "raw_hash")
    # A branch: observation -> the raw A row it came from (sku + hash) -> its week.
    raw_a_days = (raw_a.where(F.col("id").isNotNull())
                  .select(F.col("id").alias("store_sku"), "raw_hash",
                          F.col("scrape_timestamp").cast("date").alias("scrape_date")))
    # as the join below has it: one shuffle
    raw_a_days = (by_sku(raw_a_days) if SKU in o.columns else raw_a_days.repartition("store_sku", "raw_hash")).distinct()
    a_rows = (join_facts(base, o, "store_product_id").join(raw_a_days, ["store_sku", "raw_hash"])
              .join(cal, "scrape_date"))
    a_rows = _contributions(a_rows).select(CID, "week_num", "week_start", *_PIVOT)
    # B branch: every observation of the store product (or none) x every week
    # its SKU was scraped in feed B.  Reduce observations per product first.
    per_sp = _contributions(join_facts(base, o, "store_product_id", keep_unmatched=True)).groupBy(
        CID, "store_sku", "store_product_id").agg(*[F.max(c).alias(c) for c in _PIVOT])
    if b_match == "hash":
        raw_b_hash = beside(raw_b.select(F.col("Stockcode").alias("store_sku"), "raw_hash",
                                         F.col("scrape_timestamp").cast("date").alias("scrape_date")), o).distinct()
        b_rows = (join_facts(base, o, "store_product_id").join(raw_b_hash, ["store_sku", "raw_hash"])
                  .join(cal, "scrape_date"))
        b_rows = _contributions(b_rows).select(CID, "week_num", "week_start", *_PIVOT)
    else:
        raw_b_days = (raw_b.select(F.col("Stockcode").alias("store_sku"),
                                   F.col("scrape_timestamp").cast("date").alias("scrape_date"))
                      .distinct().join(cal, "scrape_date").select("store_sku", "week_num", "week_start"))
        b_rows = per_sp.join(raw_b_days, "store_sku").select(CID, "week_num", "week_start", *_PIVOT)
    weekly = a_rows.unionByName(b_rows).groupBy(CID, "week_num", "week_start").agg(
        *[F.max(c).alias(c) for c in _PIVOT])
    weekly = weekly.select(
        CID, "week_num", F.col("week_start").cast("string").alias("scrape_date"),
        F.coalesce("a_sku", F.lit("0")).alias("a_sku"), F.coalesce("b_sku", F.lit("0")).alias("b_sku"),
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in
          ["a_promo_price", "b_promo_price", "a_regular_price", "b_regular_price", "a_promo", "b_promo"]],
        "a_is_on_special", "b_is_on_special")
    names = product_names(base, hist_a)
    cname = base.select(CID, "canonical_name").distinct()
    return names.join(cname, CID).join(weekly, CID).select(*TREND_COLS)


TREND_DETAIL_COLS = ["store_product_id", CID, "store_id", "category_name", "brand_name", "canonical_name",
                     "name", "regular_price", "promo_price", "promo_details", "is_on_special", "unit_price",
                     "unit_measure", "scrape_date", "raw_hash"]


def _trend_detail(raw: DataFrame, sku_col: str, name_col: str, cur: DataFrame, sp: DataFrame,
                  obs: DataFrame, store_id: int) -> DataFrame:
    bridge = sp.where(F.col("store_id") == store_id).select("store_product_id", CID, "store_id",
                                                            "store_sku", "canonical_name")
    o = _observed(obs, "store_product_id", "regular_price", "promo_price", "promo_details", "is_on_special",
                  "unit_price", "unit_measure", "scrape_timestamp", "raw_hash")
    r = beside(raw.select(F.col(sku_col).alias("store_sku"), F.col(name_col).alias("name"), "raw_hash"), o)
    s = cur.select("store_sku", "raw_hash", "category_name", "brand_name").distinct().drop("raw_hash")
    return (join_facts(bridge, o, "store_product_id").join(r, ["store_sku", "raw_hash"])
            .join(s, "store_sku", "left")
            .withColumn("scrape_date", F.col("scrape_timestamp").cast("date")))


def trend_a(raw_a: DataFrame, cur_a: DataFrame, sp: DataFrame, obs: DataFrame) -> DataFrame:
    """Every raw A row with its bridge and observation (flag NULL -> false)."""
    d = _trend_detail(raw_a, "id", "name", cur_a, sp, obs, STORE_A)
    return d.withColumn("is_on_special", F.coalesce("is_on_special", F.lit(False))).select(*TREND_DETAIL_COLS)


def trend_b(raw_b: DataFrame, cur_b: DataFrame, sp: DataFrame, obs: DataFrame) -> DataFrame:
    """Every raw B row with its bridge and observation (promo NULL -> 0)."""
    d = _trend_detail(raw_b, "Stockcode", "Name", cur_b, sp, obs, STORE_B)
    return d.withColumn("promo_price", F.coalesce("promo_price", F.lit(0.0))).select(*TREND_DETAIL_COLS)


def promo_share(trend: DataFrame, exclude_filler: bool = False) -> DataFrame:
    """Share of SKUs on special per (week, category), per store, in percent.
    The '0' filler SKU counts in the denominator unless ``exclude_filler`` (D6).

    "distinct special SKUs / distinct SKUs" is computed as: per (group, SKU)
    whether the SKU is ever on special, then per group the number of SKUs and
    of special ones -- two plain aggregates, no distinct-aggregate expansion."""
    g = ["week_num", "scrape_date", "category_name"]

    sides = F.array(*[F.struct(F.lit(p).alias("side"), F.col(f"{p}_sku").alias("sku"),
                               F.coalesce(F.col(f"{p}_is_on_special"), F.lit(False)).alias("flag")) for p in "ab"])
    per_sku = (trend.select(*g, F.explode(sides).alias("s")).groupBy(*g, "s.side", "s.sku")
               .agg(F.max((F.col("s.sku") != "0") & F.col("s.flag")).alias("special")))

    def share(p: str) -> Column:
        mine = F.col("side") == p
        counted = mine & (F.col("sku") != "0") if exclude_filler else mine
        return (F.round(F.try_divide(F.count_if(mine & F.col("special")), F.count_if(counted)), 2) * 100
                ).alias(f"{p}_promo_proportion")
    return per_sku.groupBy(*g).agg(share("b"), share("a"))


def exact_avg(c: Column) -> Column:
    """Mean of prices, added as decimals so that the order of rows cannot
    change its last digits."""
    return F.sum(c.cast("decimal(28,10)")).cast("double") / F.count(c).cast("double")


def basket(comparison: DataFrame, rules=BASKET_RULES) -> DataFrame:
    """Labelled product groups with mean prices, mean discount and the
    cheaper store (ties and NULL go to B)."""
    rows = comparison.where(basket_filter(rules)).select(
        basket_label(rules).alias("category"),
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in
          ["b_regular_price", "b_promo_price", "a_regular_price", "a_promo_price"]])
    rows = rows.withColumns({
        "b_promo": discount(F.col("b_promo_price"), F.col("b_regular_price")),
        "a_promo": discount(F.col("a_promo_price"), F.col("a_regular_price"))})
    out = rows.groupBy("category").agg(
        exact_avg(F.col("b_regular_price")).alias("avg_b_regular_price"),
        exact_avg(F.col("b_promo_price")).alias("avg_b_promo_price"),
        F.round(F.avg("b_promo") * 100, 2).alias("avg_b_promo"),
        exact_avg(F.col("a_regular_price")).alias("avg_a_regular_price"),
        exact_avg(F.col("a_promo_price")).alias("avg_a_promo_price"),
        F.round(F.avg("a_promo") * 100, 2).alias("avg_a_promo"))
    return out.withColumn("cheaper_retailer", F.when(F.col("avg_b_regular_price") > F.col("avg_a_regular_price"),
                                                     F.lit("A")).otherwise(F.lit("B")))
