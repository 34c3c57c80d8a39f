"""The weekly trend moves the raw days of feed A once."""

import datetime as dt
import re

from pricelake.plans import gold

TS = dt.datetime(2025, 11, 4)


def test_raw_days_are_shuffled_once(spark):
    """the distinct and the join with the observations share one shuffle; repeated raw rows change nothing."""
    canon = spark.createDataFrame([(1, "milk")], "canonical_product_id long, canonical_name string")
    sp = spark.createDataFrame([(10, 1000, "a1", 1), (11, 1001, "b1", 1)],
                               "store_product_id long, store_id int, store_sku string, canonical_product_id long")
    obs = spark.createDataFrame([(10, 2.0, 4.0, True, "h1"), (11, 3.0, 3.0, None, "h2")],
                                "store_product_id long, promo_price double, regular_price double, is_on_special boolean, raw_hash string")
    raw_a = spark.createDataFrame([("a1", "h1", TS)] * 3 + [(None, "h3", TS)], "id string, raw_hash string, scrape_timestamp timestamp_ntz")
    raw_b = spark.createDataFrame([("b1", "h2", TS)] * 2, "Stockcode string, raw_hash string, scrape_timestamp timestamp_ntz")
    hist_a = spark.createDataFrame([("a1", "Milk", "B", "dairy")],
                                   "store_sku string, store_product_name string, brand_name string, category_name string")
    cal = spark.createDataFrame([(TS.date(), 1, TS.date())], "scrape_date date, week_num int, week_start date")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = gold.price_trend(canon, sp, obs, raw_a, raw_b, hist_a, cal)
        plan = out._jdf.queryExecution().executedPlan().toString()
        rows = out.select("week_num", "a_sku", "b_sku", "a_promo_price", "b_promo_price", "a_promo").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert [tuple(r) for r in rows] == [(1, "a1", "b1", 2.0, 3.0, 0.5)]
    assert not re.search(r"hashpartitioning\(store_sku#\d+, raw_hash#\d+, scrape_date#", plan)
    assert re.search(r"hashpartitioning\(store_sku#\d+, raw_hash#\d+, \d+\)", plan)
