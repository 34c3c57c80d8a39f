"""A SKU present at both stores crosses over in the SKU-only joins.

Hand-made driver tables (FIXTURES.md: "the SKU collision case is a hand-made
unit test"): store B's Stockcode is l_partkey + 1000000, so B's part 1 and
A's part 1000001 share the SKU '1000001'.  Spark and the oracle SQL must
agree on every query that touches the bridge and the gold views.
"""

import datetime as dt
import tempfile

import pandas as pd
import pytest

import __spark_entry__ as E
from tools.oracle_check import digest, duck

KEYS = ["fuzzy_match", "canonical", "store_product", "price_observation", "gold_price_comparison",
        "gold_price_trend", "gold_trend_a", "gold_trend_b", "gold_promo_share", "gold_basket"]


@pytest.fixture(scope="module")
def collision_dir():
    d = tempfile.mkdtemp(prefix="pricelake-collision-")
    part = pd.DataFrame({
        "p_partkey": pd.array([1, 1000001, 2, 1000002, 3], dtype="int64"),
        "p_name": ["red widget", "red widget", "blue gear", "blue gear", "hot ring"],
        "p_brand": ["Brand#1", "Brand#1", "Brand#4", "Brand#4", "Brand#7"],
        "p_type": ["STANDARD", "STANDARD", "PROMO", "PROMO", "SMALL"],
        "p_size": pd.array([12, 12, 8, 8, 5], dtype="int32"),
        "p_retailprice": [900.0, 900.0, 910.0, 910.0, 920.0]})
    rows = []
    days = [dt.datetime(1996, 3, 4), dt.datetime(1996, 3, 11), dt.datetime(1996, 3, 13), dt.datetime(1996, 3, 18)]
    order = 10
    for pk, supp in [(1000001, 2), (1000002, 4), (1, 1), (2, 3), (3, 5), (1000001, 12),
                     (1000001, 3), (1000002, 5)]:
        for i, day in enumerate(days):
            order += 1
            disc = [0.0, 0.05, 0.1, 0.09][i]
            rows.append((order, pk, supp, i + 1, 2.0 + i, (2.0 + i) * (900 + pk % 7), disc, 0.0,
                         "R" if i == 2 else "N", "O" if i % 2 else "F", day))
    li = pd.DataFrame(rows, columns=["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                     "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                                     "l_shipdate"])
    li = li.astype({"l_orderkey": "int64", "l_partkey": "int64", "l_suppkey": "int64", "l_linenumber": "int32"})
    part.to_parquet(f"{d}/part.parquet", index=False)
    li.to_parquet(f"{d}/lineitem.parquet", index=False, coerce_timestamps="us")
    return d


@pytest.mark.parametrize("key", KEYS)
def test_collision_matches_oracle(spark, collision_dir, key):
    sdf = E.queries()[key](spark, collision_dir)
    rows = [tuple(r) for r in sdf.collect()]
    res = duck(collision_dir).execute(E.oracle_sql()[key])
    dcols = [c[0] for c in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(rows) == len(drows), (rows, drows)
    assert digest(sdf.columns, rows)[0] == digest(dcols, drows)[0], (sorted(rows), sorted(drows))


def test_collision_is_exercised(spark, collision_dir):
    """The crossover really happens: an A SKU is also a B stage SKU."""
    sp = E.queries()["store_product"](spark, collision_dir)
    b = E.queries()["stage_b"](spark, collision_dir).select("store_sku").distinct()
    assert sp.where("store_id = 1000").join(b, "store_sku", "left_semi").count() > 0
    assert E.queries()["gold_price_comparison"](spark, collision_dir).count() > 0
