"""De-duplication that moves few rows, and tasks of even size."""

import datetime as dt

from pyspark.sql import functions as F

from pricelake.operators.cdc import END, START, scd2
from pricelake.operators.latest import among, keep_latest, keep_one_of_few
from pricelake.operators.order import asc, desc, keep_one
from pricelake.plans import silver
from pricelake.session import size_for
from pricelake.streaming.files import land

DAY = dt.datetime(2025, 1, 1)


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def events(spark, n=3000):
    rows = [(None if i % 97 == 0 else f"k{i % 41}", None if i % 13 == 0 else DAY + dt.timedelta(hours=i * 7919 % 50),
             f"h{i * 31 % 503}") for i in range(n)]
    return spark.createDataFrame(rows, "k string, t timestamp_ntz, h string")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_few_rows_give_the_same_winners(spark):
    df, order = events(spark), [desc("t"), asc("h")]
    assert rows_of(keep_latest(df, ["k"], order)) == rows_of(keep_one(df, ["k"], order))
    assert rows_of(keep_one_of_few(df, ["k", "t"], [asc("h")])) == rows_of(keep_one(df, ["k", "t"], [asc("h")]))
    once = df.dropDuplicates(["k", "t"])
    assert rows_of(keep_one_of_few(once, ["k", "t"], [asc("h")])) == rows_of(once)
    assert keep_latest(df.where("false"), ["k"], order).count() == 0


def test_found_keys_are_never_missed_and_others_rarely_pass(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("k"))
    found = df.where("cast(k as int) % 20 = 0")
    seen = df.where(among(found, ["k"], found.count()))
    assert found.join(seen, "k", "left_anti").count() == 0
    assert seen.count() - 1000 < 19000 / 8


def test_the_filter_is_below_what_is_costly(spark, tmp_path):
    events(spark).write.parquet(f"{tmp_path}/e")
    df = spark.read.parquet(f"{tmp_path}/e").withColumn("h", F.sha2("h", 256))
    text = plan_of(keep_latest(df, ["k"], [desc("t"), asc("h")]))
    assert text.index("sha2(") < text.index("xxhash64(") < text.index("FileScan")


def test_versions_equal_the_history(spark):
    rows = [(1000, f"k{i % 3}", "n", "d", "x", "b", "c", None, None, f"h{i * 7 % 11}", DAY + dt.timedelta(hours=i % 5),
             DAY + dt.timedelta(hours=i % 4)) for i in range(60)]
    staged = spark.createDataFrame(rows, "store_id int, store_sku string, store_product_name string, description string, "
                                   "canonical_name string, brand_name string, category_name string, unit_size double, "
                                   "unit_uom string, raw_hash string, ingestion_ts timestamp_ntz, scrape_timestamp timestamp_ntz")
    assert rows_of(silver.versions_a(staged)) == rows_of(silver.history_a(staged).drop(START, END))


def test_history_shuffles_its_rows_once(spark):
    df = events(spark).where("t IS NOT NULL AND k IS NOT NULL")
    by_key = scd2(df, ["k"], "t", [asc("h")])
    assert plan_of(by_key).count("Exchange") == 1
    assert rows_of(by_key) == rows_of(scd2(df, ["k"], "t", [asc("h")], hot_rows=20)) == rows_of(
        scd2(df, ["k"], "t", [asc("h")], hot_rows=1))


def test_a_busy_day_is_not_one_file(spark, tmp_path):
    df = spark.range(8000).select("id", F.when(F.col("id") % 4 > 0, F.lit("1996-01-01")).otherwise(
        F.date_add(F.lit("1996-01-01"), F.col("id").cast("int") % 365).cast("string")).alias("day"))
    land(df, f"{tmp_path}/l", 16, "day", fmt="parquet")
    sizes = [r["count"] for r in spark.read.parquet(f"{tmp_path}/l").groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 8000 and max(sizes) < 8000 / 3


def test_splits_shrink_also_where_tasks_suffice(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        size_for(spark, 36_000_000)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(16 * 1024 * 1024)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
