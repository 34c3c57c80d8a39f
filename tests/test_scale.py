"""Steps whose bytes or tasks must not grow faster than their input."""

import datetime as dt

from pyspark.sql import functions as F

from pricelake.operators.cdc import END
from pricelake.operators.fuzzy import pair_scores
from pricelake.operators.order import asc, keep_one
from pricelake.operators.quality import joined_report, quality_report
from pricelake.plans import silver
from pricelake.plans.pipeline import Tables
from pricelake.session import size_for
from pricelake.streaming.jobs import _files
from tests.conftest import SF_SMALL


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_keep_one_needs_no_second_shuffle(spark):
    df = spark.createDataFrame([(1, "a", 3, "x"), (1, "a", 2, "y"), (1, None, 1, "z")], "k int, s string, v int, w string")
    one = keep_one(keep_one(df.repartition(5, "k"), ["k", "s", "v"], [asc("w")]), ["k", "s"], [asc("v")])
    assert one._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert rows_of(one) == rows_of(spark.createDataFrame([(1, "a", 2, "y"), (1, None, 1, "z")], df.schema))


def test_observations_of_a_hot_sku_equal_those_by_sku(spark):
    t = Tables(spark, SF_SMALL)
    sp = spark.createDataFrame([(i + 1, *r, i % 7) for i, r in enumerate(sorted(
        tuple(x) for x in silver._priced(silver.prices_a(t.bronze_a)).select("store_id", "store_sku").distinct().collect()))],
        "store_product_id long, store_id int, store_sku string, canonical_product_id long")
    by_sku = silver.price_observation_from(t.bronze_a, t.bronze_b, sp)
    hot = silver.price_observation_from(t.bronze_a, t.bronze_b, sp, hot_rows=1)
    assert by_sku.count() and rows_of(by_sku) == rows_of(hot)


def test_open_versions_equal_the_history(spark):
    at = [None, dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 1, 5), dt.datetime(2025, 1, 2)]
    rows = [(f"k{i % 3}", 1001, f"n{i}", "b", "c", "x", None, None, f"h{i * 7 % 11}", at[i % 4]) for i in range(24)]
    staged = spark.createDataFrame(rows, "store_sku string, store_id int, store_product_name string, brand_name string, "
                                   "category_name string, canonical_name string, unit_size double, unit_uom string, "
                                   "raw_hash string, ingestion_ts timestamp_ntz")
    assert rows_of(silver.current_b(staged)) == rows_of(silver.history_b(staged).where(F.col(END).isNull()))


def test_report_of_a_join_counts_its_rows(spark):
    rows = spark.createDataFrame([(1, "a", 1.0), (1, "a", -1.0), (1, "b", None), (1, None, 2.0)], "store int, sku string, p double")
    other = spark.createDataFrame([(1, "a", 7), (1, "a", 8), (1, "c", 9)], "store int, sku string, sp int")
    rules = [("p", "p >= 0"), ("sp", "sp IS NOT NULL"), ("store", "store IN (1)"), ("two", "p >= 0 AND sp > 7")]
    got = joined_report(rows, other, ["store", "sku"], rules)
    want = quality_report(rows.join(other, ["store", "sku"], "left"), rules)
    assert rows_of(got) == rows_of(want) and got.schema == want.schema
    none = rows.where("false")
    assert rows_of(joined_report(none, other, ["store", "sku"], rules)) == rows_of(
        quality_report(none.join(other, ["store", "sku"], "left"), rules))


def test_bands_find_every_length(spark):
    q = spark.createDataFrame([(1, "a" * n) for n in range(1, 40)], "b int, canonical_name string")
    c = spark.createDataFrame([(1, "a" * n, n) for n in range(1, 40)], "b int, canonical_name string, canonical_product_id long")
    got = {(len(r[0]), r[1]) for r in pair_scores(q, c, ["b"]).select("canonical_name", "canonical_product_id").collect()}
    assert got == {(x, y) for x in range(1, 40) for y in range(1, 40) if 200 * min(x, y) >= 80 * (x + y)}


def test_files_and_tasks_grow_with_the_rows(spark):
    assert _files(spark, spark.range(1000), per_file=10) == 100
    assert _files(spark, spark.range(5), per_file=10) == spark.sparkContext.defaultParallelism
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")}
    try:
        size_for(spark, 1000)
        assert spark.conf.get("spark.sql.shuffle.partitions") == old["spark.sql.shuffle.partitions"]
        size_for(spark, 20_000_000)
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 100
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
