"""Streaming twins equal their batch queries."""

import os

import pytest
from pyspark.sql import types as T

import __spark_entry__ as E
from pricelake.plans.pipeline import Tables
from pricelake.sources import feeds
from pricelake.streaming import files
from tests.conftest import SF_SMALL
from tools.oracle_check import digest


@pytest.mark.parametrize("stream_key,batch_key", [("stream_scd2", "scd2_a"), ("stream_scd2_b", "scd2_b"), ("stream_scd1", None)])
def test_stream_equals_batch(spark, stream_key, batch_key):
    q = E.queries()
    s = q[stream_key](spark, SF_SMALL)
    if stream_key == "stream_scd1":
        b = q["price_observation"](spark, SF_SMALL).drop("observation_id")
    else:
        b = q[batch_key](spark, SF_SMALL)
    srows, brows = [tuple(r) for r in s.collect()], [tuple(r) for r in b.select(*s.columns).collect()]
    assert len(srows) == len(brows)
    assert digest(s.columns, srows)[0] == digest(s.columns, brows)[0]


def test_dedup_of_the_price_stream(spark):
    keys = ["store_id", "store_sku", "scrape_timestamp", "batch_ts"]
    from pricelake.plans import silver
    from pricelake.plans.pipeline import tables
    t = tables(spark, SF_SMALL)
    rows = silver._priced(silver.prices_a(t.bronze_a).unionByName(silver.prices_b(t.bronze_b)))
    got = [tuple(r) for r in E.queries()["stream_dedup"](spark, SF_SMALL).select(*keys).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {tuple(r) for r in rows.select(*keys).collect()}


def test_late_rows_are_kept_aside(spark, tmp_path):
    """A row weeks behind the watermark is not in the output but in the side
    table; late repetitions of a known key are in neither twice."""
    import datetime as dt

    from pricelake.streaming.jobs import dedup_within
    day = lambda n: dt.datetime(2025, 1, 1) + dt.timedelta(days=n)
    files_ = [[("a", day(0), "x"), ("b", day(1), "x")], [("c", day(90), "x"), ("c", day(90), "y")], [("d", day(91), "x")],
              [("late", day(2), "x"), ("late", day(3), "y"), (None, day(2), "n"), ("e", day(92), "x"), ("d", day(91), "x")]]
    schema = T.StructType.fromDDL("k string, t timestamp_ntz, v string")
    for rows in files_:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    out, late = dedup_within(spark, f"file://{tmp_path}/in", schema, ["k"], "t", "10 days", f"file://{tmp_path}", max_files=1)
    assert sorted(r[0] for r in out.collect()) == ["a", "b", "c", "d", "e"]
    assert {tuple(r) for r in late.collect()} == {("late", day(2), "x"), ("late", day(3), "y"), (None, day(2), "n")}
    assert late.count() == 3


def _csv(folder, name, header, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.csv", "w") as f:
        f.write("\n".join([",".join(header), *(",".join(r) for r in rows)]) + "\n")


def test_landing_folders_to_bronze_and_on(spark, tmp_path):
    """Nested folders, exclusion list, appended columns; a column in the middle fails."""
    known = T.StructType([f for f in files.ntz_schema(feeds.FEED_A_DDL).fields if f.name not in ("isVerified", "storename")])
    cols = [f.name for f in known.fields]
    row = lambda i: [{"id": str(i), "cat": "pantry", "price_now": "1.5"}.get(c, "") for c in cols]
    root = f"file://{tmp_path}"
    _csv(f"{tmp_path}/in/2025/11/04", "a", cols, [row(1), row(2)])
    _csv(f"{tmp_path}/in/2025/11/05", "b", cols, [row(3)])
    _csv(f"{tmp_path}/in/2025/11/06", "bad", cols, [row(9)])
    spark.conf.set("pipeline.excluded_paths", f"file://{tmp_path}/in/2025/11/06/bad.csv, ")
    try:
        files.write_bronze(files.read_feed_a(spark, f"{root}/in", known), f"{root}/bronze", f"{root}/ckpt")
    finally:
        spark.conf.unset("pipeline.excluded_paths")
    _csv(f"{tmp_path}/in/2025/11/07", "c", [*cols, "extra"], [[*row(4), "x"]])
    wide = files.evolve_schema(spark, known, f"{root}/in")
    assert wide.fieldNames() == [*cols, "extra"]
    files.write_bronze(files.read_feed_a(spark, f"{root}/in", wide), f"{root}/bronze", f"{root}/ckpt")
    got = {(r["id"], r["price_now"], r["extra"]) for r in spark.read.option("mergeSchema", True).parquet(f"{root}/bronze").collect()}
    assert got == {("1", 1.5, None), ("2", 1.5, None), ("3", 1.5, None), ("4", 1.5, "x")}
    _csv(f"{tmp_path}/in/2025/11/08", "d", ["cat", "middle", *cols[1:], "extra"], [["pantry", "m", *row(5)[1:], "x"]])
    with pytest.raises(Exception):
        files.write_bronze(files.read_feed_a(spark, f"{root}/in", wide), f"{root}/bronze", f"{root}/ckpt")


def test_columns_are_found_by_name(spark, tmp_path):
    """A new column in the middle, columns in another order, absent columns, a
    path with a blank; a header that comes later fails the stream."""
    known = T.StructType.fromDDL("id string, price double, at timestamp_ntz, ok boolean")
    folder, root = f"{tmp_path}/in/2025 x+y", f"file://{tmp_path}"
    _csv(folder, "a", ["id", "price", "at", "ok"], [["1", "1.5", "2025-01-01 10:00:00", "true"], ["2", "bad", "", ""]])
    _csv(folder, "b", ["id", "price", "at", "ok"], [["3", "2", "2025-01-01 10:00:00.5", "false"]])
    _csv(folder, "c", ["id", "extra", "price", "at", "ok"], [["4", "mid", "3.5", "2025-01-02 00:00:00", "true"]])
    _csv(f"{tmp_path}/in/n", "d", ["price", "id"], [["9", "5"]])
    wide = files.evolve_schema(spark, known, f"{root}/in")
    assert wide.fieldNames() == ["id", "price", "at", "ok", "extra"]

    def run():
        stream = files.read_csv_by_name(spark, f"{root}/in", wide).drop("_file")
        files.write_bronze(stream, f"{root}/bronze", f"{root}/ckpt")
    run()
    got = {r["id"]: (r["price"], str(r["at"]), r["ok"], r["extra"]) for r in spark.read.parquet(f"{root}/bronze").collect()}
    assert got == {"1": (1.5, "2025-01-01 10:00:00", True, None), "2": (None, "None", None, None),
                   "3": (2.0, "2025-01-01 10:00:00.500000", False, None), "4": (3.5, "2025-01-02 00:00:00", True, "mid"),
                   "5": (9.0, "None", None, None)}
    _csv(folder, "e", ["id", "price", "at", "ok"], [["6", "1", "", ""]])
    run()  # the same checkpoint reads new files only
    assert spark.read.parquet(f"{root}/bronze").count() == 6
    stream = files.read_csv_by_name(spark, f"{root}/in", wide).drop("_file")
    _csv(folder, "late", ["ok", "price", "id"], [["true", "1", "7"]])
    with pytest.raises(Exception, match="unknown header"):
        files.write_bronze(stream, f"{root}/bronze", f"{root}/ckpt")


def test_tables_over_given_bronze_keep_their_ids(spark, tmp_path):
    base = Tables(spark, SF_SMALL, materialize=True)
    paths = []
    for name, df in (("a", base.bronze_a), ("b", base.bronze_b)):
        paths.append(f"file://{tmp_path}/{name}")
        df.write.parquet(paths[-1])
    one = Tables(spark, bronze=tuple(paths), keys=f"file://{tmp_path}/keys", materialize=True)
    first = {r["brand_key"]: r["brand_id"] for r in one.dim_brand.collect()}
    assert first == {r["brand_key"]: r["brand_id"] for r in base.dim_brand.collect()}
    assert one.gold_price_comparison.count() == base.gold_price_comparison.count()
    # a second run with a new brand early in the alphabet
    new = spark.read.parquet(paths[0]).limit(1).selectExpr(
        "* except (id, brand, cat)", "'zzz' AS id", "'AAA new' AS brand", "'pantry' AS cat")
    new.write.mode("append").parquet(paths[0])
    two = Tables(spark, bronze=tuple(paths), keys=f"file://{tmp_path}/keys", materialize=True)
    second = {r["brand_key"]: r["brand_id"] for r in two.dim_brand.collect()}
    assert {k: second[k] for k in first} == first
    if "aaa new" in second:
        assert second["aaa new"] > max(first.values())
