"""Options of SURVEY §2.13 (defaults keep the reference's results)."""

from pyspark.sql import functions as F

from pricelake.plans import gold, params
from pricelake.plans.pipeline import Tables
from tests.conftest import SF_SMALL


def test_options_change_only_what_they_name(spark):
    base = Tables(spark, SF_SMALL)
    opt = Tables(spark, SF_SMALL, grain="signature", lookup="key", keep_unblocked=True, b_match="hash")
    # D3: one canonical A row per signature
    ca = opt.canonical_a
    assert ca.count() == ca.select("canonical_signature").distinct().count()
    assert base.canonical_a.count() >= ca.count()
    # Variant spellings find their brand id
    def with_brand(t):
        return t.canonical_a.where(F.col("brand_id").isNotNull()).count() / t.canonical_a.count()
    assert with_brand(opt) >= with_brand(base)
    # D8 alone: unblocked B SKUs stay, unmatched
    d8 = Tables(spark, SF_SMALL, keep_unblocked=True)
    extra = d8.match_b.join(base.match_b.select("store_sku"), "store_sku", "left_anti")
    assert extra.count() > 0
    assert extra.where(F.col("canonical_product_id").isNotNull()).count() == 0
    # Hash-tied store-B weeks are a subset of the SKU-tied ones
    weeks = ["canonical_product_id", "week_num"]
    b_hash = opt.gold_price_trend.where(F.col("b_sku") != "0").select(*weeks).distinct()
    assert b_hash.count() > 0


def test_calendars(spark):
    days = spark.createDataFrame([("2025-11-04",), ("2025-11-13",), (None,)], "scrape_date string")
    got = {(str(r[0]), r[1], str(r[2])) for r in params.calendar_from_dates(days).collect()}
    assert {(d, w) for d, _, w in got} == {("2025-11-04", "2025-11-03"), ("2025-11-13", "2025-11-10")}
    weeks = {(str(r[0]), r[1], str(r[2])) for r in params.calendar_from_weeks(spark).collect()}
    assert weeks == {("2025-11-04", 1, "2025-11-03"), ("2025-11-10", 1, "2025-11-03"), ("2025-11-07", 2, "2025-11-10"),
                     ("2025-11-12", 2, "2025-11-10"), ("2025-11-17", 3, "2025-11-17")}
    # a day without a week drops out of the trend
    short = Tables(spark, SF_SMALL, calendar=params.calendar_from_dates(
        Tables(spark, SF_SMALL).bronze_b.select("scrape_timestamp").where("dayofmonth(scrape_timestamp) <> 13"), "scrape_timestamp"))
    full = Tables(spark, SF_SMALL)
    assert 0 < short.gold_price_trend.count() <= full.gold_price_trend.count()


def test_published_basket_rules(spark):
    rows = [("full cream milk", "dairy_eggs_fridge", "Pauls", "Milk"), ("egg and milk", "dairy_eggs_fridge", "Sunny Queen", "Milk"),
            ("free range egg", "dairy_eggs_fridge", "Sunny Queen", "Egg"), ("milk", "pantry", "Pauls", None),
            ("tim x tam", "snacks_confectionary", "Arnotts", "Snacks"), ("cone", "freezer", " Peters", "Ice cream"),
            ("cone", "freezer", "Peters", None), ("pasta", "international_food", "any", "Pasta"),
            ("rice", "international_food", None, "International food"), ("butter", "dairy_eggs_fridge", "Lurpak", "Butter")]
    df = spark.createDataFrame(rows, "canonical_name string, category_name string, brand_name string, want string")
    rules = params.PUBLISHED_BASKET_RULES
    got = df.withColumn("got", F.when(params.basket_filter(rules), params.basket_label(rules))).collect()
    assert [r["got"] for r in got] == [r["want"] for r in got]


def test_mean_prices_are_not_rounded(spark):
    df = spark.createDataFrame([(1.005,), (2.0,), (None,)], "p double")
    assert df.agg(gold.exact_avg(F.col("p"))).first()[0] == (1.005 + 2.0) / 2
