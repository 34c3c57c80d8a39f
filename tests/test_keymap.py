"""Ids that survive every refresh, and numbering that pins keys only."""

import pytest
from pyspark.sql import functions as F

from pricelake.operators.keymap import KeyMap
from pricelake.operators.keys import dense_ids, prefix_sums
from pricelake.operators.order import asc, desc
from pricelake.plans.pipeline import Tables
from tests.conftest import SF_SMALL

SCHEMA = "a int, b string, v string"


def _map(spark, root, buckets=8):
    df = spark.createDataFrame([], SCHEMA)
    return KeyMap(spark, root, [df.schema["a"], df.schema["b"]], "id", buckets)


def _got(df):
    return {(r["a"], r["b"]): r["id"] for r in df.collect()}


def test_old_keys_keep_their_ids(spark, tmp_path):
    root = f"file://{tmp_path}/map"
    order = [asc("a"), asc("b")]
    rows = [(i % 7, f"k{i}", "x") for i in range(0, 40, 2)] + [(None, "n", "x"), (3, None, "x")]
    one = _got(_map(spark, root).assign(spark.createDataFrame(rows, SCHEMA), order))
    assert sorted(one.values()) == list(range(1, 23))
    more = rows[5:] + [(i % 7, f"k{i}", "y") for i in range(1, 40, 2)] + [(None, None, "y")]
    two = _got(_map(spark, root, buckets=99).assign(spark.createDataFrame(more, SCHEMA), order))
    assert all(two[k] == one[k] for k in two if k in one)
    assert sorted(v for k, v in two.items() if k not in one) == list(range(23, 44))
    again = _map(spark, root)
    assert again.buckets == 8
    assert _got(again.assign(spark.createDataFrame(more, SCHEMA), order)) == two
    assert len(again.versions.numbers()) == 2  # a run without new keys writes nothing
    again.compact()
    assert _got(again.read()) == {**one, **two}
    assert _got(again.assign(spark.createDataFrame(rows + [(9, "z", "z")], SCHEMA), order))[(9, "z")] == 44


def test_only_the_keys_buckets_are_read(spark, tmp_path):
    root = f"file://{tmp_path}/map"
    ids = _map(spark, root, buckets=64)
    ids.assign(spark.createDataFrame([(i, "k", "x") for i in range(500)], SCHEMA), [asc("a")])
    out = ids.assign(spark.createDataFrame([(1, "k", "x"), (2, "new", "x")], SCHEMA), [asc("a")])
    assert "PartitionFilters: [_b" in out._jdf.queryExecution().toString()
    assert len(ids.versions.newest()[1]["runs"]["run=000000000002"]) == 1
    assert out.count() == 2


def test_a_crashed_run_leaves_the_last_version(spark, tmp_path):
    root = f"file://{tmp_path}/map"
    ids = _map(spark, root)
    first = _got(ids.assign(spark.createDataFrame([(1, "a", "x")], SCHEMA), [asc("a")]))
    ids._write("run=000000000002", spark.createDataFrame([(5, "lost", 77)], "a int, b string, id long"))  # not published
    assert _got(ids.read()) == first
    assert _got(ids.assign(spark.createDataFrame([(2, "b", "x")], SCHEMA), [asc("a")])) == {(2, "b"): 2}
    with pytest.raises(RuntimeError):
        ids.versions.publish(2, {})


def test_second_refresh_of_the_pipeline_keeps_ids(spark, tmp_path):
    """Products, bridge rows and observations of a first, smaller feed keep
    their ids when the whole feed is loaded; a run without change adds none."""
    full = Tables(spark, SF_SMALL, materialize=True)
    cut = F.lit("1996-01-01").cast("timestamp_ntz")
    paths = [f"file://{tmp_path}/{n}" for n in ("a1", "b1", "a2", "b2")]
    for path, df in zip(paths, (full.bronze_a.where(F.col("batch_ts") < cut), full.bronze_b.where(F.col("batch_ts") < cut),
                                full.bronze_a, full.bronze_b)):
        df.write.parquet(path)
    keys = f"file://{tmp_path}/keys"
    runs = [Tables(spark, bronze=tuple(p), keys=keys, materialize=True) for p in (paths[:2], paths[2:], paths[2:])]
    natural = {"store_product": ["store_id", "store_sku", "canonical_product_id"],
               "price_observation": ["store_product_id", "scrape_timestamp"]}
    for table, key in natural.items():
        ids = [{tuple(r[c] for c in key): r[0] for r in getattr(t, table).select(getattr(t, table).columns[0], *key).collect()}
               for t in runs]
        assert ids[1] == ids[2] and len(set(ids[1].values())) == len(ids[1])
        common = ids[0].keys() & ids[1].keys()
        assert common and all(ids[0][k] == ids[1][k] for k in common)
        fresh = [v for k, v in ids[1].items() if k not in common]
        assert fresh and min(fresh) > max(ids[0].values())
    first = Tables(spark, bronze=tuple(paths[:2]), materialize=True)
    for table in ("canonical", "store_product", "price_observation"):  # a first run numbers like a run without keys
        assert getattr(first, table).exceptAll(getattr(runs[0], table)).count() == 0
    with pytest.raises(ValueError):
        Tables(spark, SF_SMALL, keys=keys)


def test_ids_in_order_without_wide_rows_in_the_range_exchange(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 3).cast("string").alias("g"),
                                  F.lit("w" * 50).alias("wide"))
    out = dense_ids(df, [desc("g"), asc("k")], "n", 10)
    want = {r.k: i + 11 for i, r in enumerate(sorted(df.collect(), key=lambda r: (-int(r.g), r.k)))}
    assert {r.k: r.n for r in out.collect()} == want and out.columns == ["k", "g", "wide", "n"]
    same = spark.createDataFrame([("x",), ("x",), (None,), ("a",)], "s string")
    assert sorted(r.n for r in dense_ids(same, [asc("s")], "n").collect()) == [1, 2, 3, 4]
    sums = prefix_sums(df.select("k", (F.col("k") % 5).alias("v")), [asc("k")], "v", "before", 7)
    assert all(r.before == sum(i % 5 for i in range(r.k)) for r in sums.collect())
