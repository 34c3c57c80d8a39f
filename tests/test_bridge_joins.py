"""The bridge is not sent whole to the driver."""

from pricelake.plans import gold


def test_the_bridge_is_never_broadcast(spark, tmp_path):
    """Spark takes tables with a row per product for small by their files; whatever
    their size, canonical products and the bridge are shuffled and sorted."""
    canon = spark.createDataFrame([(1, "milk"), (2, "egg"), (3, None), (None, "tea")], "canonical_product_id long, canonical_name string")
    sp = spark.createDataFrame([(10, 1000, "a1", 1), (11, 1001, "b1", 1), (12, 1000, "a2", 2), (13, 1000, "a3", 3), (14, 1001, None, 3),
                                (15, 1001, "b2", None)],
                               "store_product_id long, store_id int, store_sku string, canonical_product_id long")
    read = []
    for name, df in (("canon", canon), ("sp", sp)):
        df.write.parquet(f"file://{tmp_path}/{name}")
        read.append(spark.read.parquet(f"file://{tmp_path}/{name}"))
    out = gold._bridged(*read, spark.createDataFrame([], "store_product_id long, store_sku string"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, out.select("store_product_id", "canonical_product_id", "canonical_name").collect())) == [
        (10, 1, "milk"), (11, 1, "milk"), (13, 3, None), (14, 3, None)]
    assert plan.count("SortMergeJoin") == 2 and "Broadcast" not in plan
