"""The gold tables join beside the SKU: observations are moved once, when they are made."""

import datetime as dt
import re

import pytest

from pricelake.plans import gold, silver

DAY = dt.datetime(2025, 11, 4)
RAW_A = ("id string, name string, unit_price double, unit_measure string, price_now double, price_was double, promotionType string, "
         "specialType string, offerDescription string, raw_hash string, scrape_timestamp timestamp_ntz, batch_ts timestamp_ntz")
RAW_B = ("Stockcode string, Name string, unit_price double, unit_uom string, Price double, WasPrice double, InStock boolean, "
         "IsOnSpecial boolean, IsHalfPrice boolean, raw_hash string, scrape_timestamp timestamp_ntz, batch_ts timestamp_ntz")


def at(days):
    return DAY + dt.timedelta(days=days)


@pytest.fixture(scope="module")
def made(spark):
    """Two products of both stores, one of A alone; 'x' is a SKU of both stores, 'a3' has no
    observation, and rows come twice, without a SKU or with a price that the gate drops."""
    a = [(s, f"n{s}", 1.0, "ea", 2.0 + d, 4.0 * (d % 2), None, "S" if d else None, None, f"h{s}{d}", at(d), at(d))
         for s in ("a1", "x", "a2") for d in range(3)]
    a += [a[0], (None, "none", 1.0, "ea", 1.0, 1.0, None, None, None, "h", at(0), at(0)),
          ("a3", "n3", 1.0, "ea", 1.0, None, None, None, None, "h3", at(0), at(0))]
    b = [(s, f"m{s}", 1.0, "ea", 3.0 + d, 5.0, True, None if d else True, False, f"g{s}{d}", at(d), at(d))
         for s in ("b1", "x") for d in range(2)]
    raw_a, raw_b = spark.createDataFrame(a, RAW_A), spark.createDataFrame([*b, b[0]], RAW_B)
    sp = spark.createDataFrame(
        [(1, 1000, "a1", 1, "milk"), (2, 1000, "a1", 2, "milk"), (3, 1000, "a2", 3, "egg"), (4, 1000, "a3", 1, "milk"),
         (5, 1000, "x", 2, "milk"), (6, 1001, "b1", 1, "milk"), (7, 1001, "x", 2, "milk"), (8, 1001, None, 1, "milk")],
        "store_product_id long, store_id int, store_sku string, canonical_product_id long, canonical_name string")
    canon = sp.selectExpr("canonical_product_id", "canonical_name").distinct()
    hist = spark.createDataFrame([(s, h, f"n{s}", "B", "dairy") for s, h in (("a1", "ha10"), ("a1", "ha12"), ("x", "hx1"), ("x", "gx0"), (None, "h"))],
                                 "store_sku string, raw_hash string, store_product_name string, brand_name string, category_name string")
    in_b = spark.createDataFrame([("b1",), ("x",), ("x",), ("a3",), (None,)], "store_sku string")
    cal = spark.createDataFrame([(at(d).date(), 1 + d // 2, DAY.date()) for d in range(3)], "scrape_date date, week_num int, week_start date")
    cur = spark.createDataFrame([("a1", "ha12", "dairy", "B"), ("x", "hx2", "dairy", None), ("b1", "gb11", "dairy", "C")],
                                "store_sku string, raw_hash string, category_name string, brand_name string")
    facts = silver.observations(raw_a, raw_b, sp)
    assert "store_sku" in facts.columns
    return {
        "pivot_prices": lambda o: gold.pivot_prices(gold.current_prices(canon, sp, o, hist, in_b)),
        "price_comparison": lambda o: gold.price_comparison(canon, sp, o, hist, in_b),
        "price_trend": lambda o: gold.price_trend(canon, sp, o, raw_a, raw_b, hist, cal),
        "price_trend_hash": lambda o: gold.price_trend(canon, sp, o, raw_a, raw_b, hist, cal, b_match="hash"),
        "trend_a": lambda o: gold.trend_a(raw_a, cur, sp, o), "trend_b": lambda o: gold.trend_b(raw_b, cur, sp, o)}, facts


@pytest.mark.parametrize("name", ["pivot_prices", "price_comparison", "price_trend", "price_trend_hash", "trend_a", "trend_b"])
def test_observations_stay_in_their_buckets(spark, made, name):
    """The same rows as from observations without their SKU, and no shuffle above the buckets."""
    builders, facts = made
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = builders[name](facts)
        plan = out._jdf.queryExecution().executedPlan().toString()
        rows = sorted(map(repr, out.collect()))
        plain = sorted(map(repr, builders[name](facts.drop("store_sku")).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert rows and rows == plain
    assert "Bucketed: true" in plan and "Bucketed: false" not in plan
    assert not re.search(r"hashpartitioning\((store_product_id#\d+|store_id#\d+|store_sku#\d+, raw_hash#\d+, \d+\))", plan)


def test_price_stage_moves_the_bridge_not_the_rows(spark):
    a = [("a1", "n", 1.0, "ea", 2.0, 3.0, None, None, None, "h1", at(0), at(0)), ("a2", "n", 1.0, "ea", 2.0, 3.0, None, None, None, "h2", at(0), at(0))]
    sp = spark.createDataFrame([(1, 1000, "a1", 1), (2, 1000, "a1", 2), (3, 1001, "a2", 3)],
                               "store_product_id long, store_id int, store_sku string, canonical_product_id long")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = silver.price_stage(spark.createDataFrame(a, RAW_A), spark.createDataFrame([], RAW_B), sp)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert sorted((r["store_product_id"], r["raw_hash"]) for r in out.collect()) == [(1, "h1"), (2, "h1")]
    assert len(re.findall(r"Exchange hashpartitioning\(store_sku#\d+, \d+\)", plan)) == 2 and plan.count("Exchange") == 2
