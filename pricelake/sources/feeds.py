"""Bronze feeds.

Two ways in:

* ``derived_feed_a/b`` build the raw feeds from the driver's TPC-H-like
  tables (``lineitem`` x ``part``), with SQL that runs unchanged in Spark
  and in the DuckDB oracle (see FIXTURES.md).  This is what every batch
  query and the bench read.
* ``sources.files`` reads the same feeds as incremental CSV streams.

``bronze_a/b`` add the load columns (``source_file``, ``raw_hash`` and, for
B, the parsed unit price) to either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.functions.text import parse_unit_price, row_hash

# ---------------------------------------------------------------------------
# Raw feed schemas (the source's schema hints).
# ---------------------------------------------------------------------------
FEED_A_DDL = ("cat STRING, id STRING, name STRING, brand STRING, description STRING, size STRING, "
              "availability BOOLEAN, availabilityType STRING, categoryGroup STRING, category STRING, "
              "subCategory STRING, className STRING, price_now DOUBLE, price_was DOUBLE, comparable STRING, "
              "offerDescription STRING, promotionType STRING, specialType STRING, unit_price DOUBLE, "
              "unit_measure STRING, offer STRING, scrape_timestamp TIMESTAMP, batch_ts TIMESTAMP, "
              "scrape_run_id INT, isVerified STRING, storename STRING")
FEED_B_DDL = ("Category STRING, Name STRING, DisplayName STRING, Brand STRING, Stockcode STRING, "
              "Barcode STRING, Price DOUBLE, WasPrice DOUBLE, SavingsAmount DOUBLE, Unit STRING, "
              "CupPrice STRING, InStock BOOLEAN, IsOnSpecial BOOLEAN, IsHalfPrice BOOLEAN, Image STRING, "
              "Description STRING, URL STRING, scrape_timestamp TIMESTAMP, batch_ts TIMESTAMP, "
              "scrape_run_id INT")
# Columns fingerprinted into raw_hash, in order.
HASH_COLS_A = ["cat", "id", "name", "brand", "description", "size", "availability", "availabilityType",
               "categoryGroup", "category", "subCategory", "className", "price_now", "price_was", "comparable",
               "offerDescription", "promotionType", "specialType", "unit_price", "unit_measure", "offer",
               "scrape_timestamp", "batch_ts", "scrape_run_id"]
HASH_COLS_B = ["Category", "Name", "DisplayName", "Brand", "Stockcode", "Barcode", "Price", "WasPrice",
               "SavingsAmount", "Unit", "CupPrice", "InStock", "IsOnSpecial", "IsHalfPrice", "Image", "Description",
               "URL", "scrape_timestamp", "batch_ts", "scrape_run_id"]
# Product text of a part: its name, a token of letters shared by two parts,
# and its size; every 20th pair of parts shares the whole text (FIXTURES.md).
_TOKEN = ("translate(substr(md5(CAST(CAST(floor(l_partkey / 2) AS BIGINT) AS STRING)), 1, 12), "
          "'0123456789abcdef', 'ghijkmnopqrstuvw')")
_SIZE = ("concat(CAST(p_size AS STRING), CASE p_size % 4 WHEN 0 THEN 'G' WHEN 1 THEN '.5ml' "
         "WHEN 2 THEN ' Pack' ELSE '' END)")
# Derived feeds over the driver tables; {lineitem} and {part} are table refs.
FEED_A_SQL = """
SELECT
  CASE p_type WHEN 'ECONOMY' THEN 'pantry' WHEN 'SMALL' THEN 'drinks'
    WHEN 'MEDIUM' THEN 'frozen' WHEN 'PROMO' THEN 'bakery'
    WHEN 'STANDARD' THEN 'dairy, eggs & fridge' ELSE 'gift cards' END AS cat,
  CASE WHEN l_orderkey % 997 = 0 THEN NULL ELSE CAST(l_partkey AS STRING) END AS id,
  CASE WHEN l_partkey % 83 = 0 THEN NULL ELSE p_name END AS name,
  CASE WHEN l_partkey % 101 = 0 THEN NULL
       WHEN p_brand = 'Brand#5' THEN 'Brand#55'
       WHEN l_suppkey % 10 = 0 THEN upper(p_brand) ELSE p_brand END AS brand,
  CASE WHEN l_partkey % 89 = 0 THEN NULL
       WHEN l_partkey % 40 < 2 THEN concat('Family ', {token})
       ELSE concat_ws(CASE WHEN l_partkey % 5 = 0 THEN '<BR/>' WHEN l_partkey % 7 = 0 THEN '®... ' ELSE ' ' END,
         p_name, {token}, {size}) END AS description,
  CASE WHEN l_orderkey % 501 = 0 THEN -1.0 ELSE 1.0 END
    * (floor(l_extendedprice / l_quantity * (1 - l_discount) * 100 + 0.5) / 100) AS price_now,
  CASE WHEN l_orderkey % 211 = 0 THEN NULL WHEN l_discount > 0
       THEN floor(l_extendedprice / l_quantity * 100 + 0.5) / 100 ELSE CAST(0 AS DOUBLE) END AS price_was,
  CASE WHEN l_discount >= 0.05 THEN 'SPECIAL' END AS promotionType,
  CASE WHEN l_returnflag = 'R' THEN 'CLEARANCE' END AS specialType,
  CASE WHEN l_discount >= 0.09 THEN 'Save' END AS offerDescription,
  CAST(l_quantity AS DOUBLE) AS unit_price, 'ea' AS unit_measure,
  CASE WHEN l_orderkey % 499 = 0 THEN NULL ELSE l_shipdate END AS scrape_timestamp,
  l_shipdate + l_linenumber * INTERVAL 1 HOUR AS batch_ts,
  l_shipdate + l_linenumber * INTERVAL 1 HOUR + INTERVAL 30 MINUTE AS ingestion_ts,
  CAST(l_orderkey AS STRING) AS offer
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
WHERE l_suppkey % 2 = 0
""".replace("{token}", _TOKEN).replace("{size}", _SIZE)
FEED_B_SQL = """
SELECT
  CASE p_type WHEN 'ECONOMY' THEN 'bargains' WHEN 'SMALL' THEN 'drinks'
    WHEN 'MEDIUM' THEN 'freezer' WHEN 'PROMO' THEN 'bakery'
    WHEN 'STANDARD' THEN 'dairy_eggs_fridge' ELSE 'beer_wine_spirits' END AS Category,
  p_name AS Name, p_brand AS Brand,
  CAST(l_partkey + 1000000 AS STRING) AS Stockcode,
  concat_ws(' ',
    CASE WHEN l_partkey % 7 = 0 THEN 'Limited Edition Gift Bundle Offer' WHEN l_partkey % 3 = 0 THEN 'New' END,
    CASE WHEN l_partkey % 40 < 2 THEN concat('FAMILY ', {token})
         ELSE concat_ws(' ', {size}, upper(p_name), {token}) END) AS Description,
  floor(l_extendedprice / l_quantity * (1 - l_discount) * 100 + 0.5) / 100 AS Price,
  floor(l_extendedprice / l_quantity * 100 + 0.5) / 100 AS WasPrice,
  CASE WHEN l_partkey % 13 = 0 THEN 'n/a'
       WHEN l_partkey % 4 = 1 THEN concat('$', CAST(CAST(l_quantity AS BIGINT) AS STRING), '.50 / EA')
       ELSE concat('$', CAST(CAST(l_quantity AS BIGINT) AS STRING), ' / 100G') END AS CupPrice,
  l_linestatus = 'O' AS InStock, l_discount > 0.05 AS IsOnSpecial, l_discount >= 0.1 AS IsHalfPrice,
  l_shipdate AS scrape_timestamp,
  l_shipdate + l_linenumber * INTERVAL 1 HOUR AS batch_ts,
  l_shipdate + l_linenumber * INTERVAL 1 HOUR + INTERVAL 30 MINUTE AS ingestion_ts,
  CAST(l_orderkey AS STRING) AS URL
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
WHERE l_suppkey % 2 = 1
""".replace("{token}", _TOKEN).replace("{size}", _SIZE)
# ---------------------------------------------------------------------------


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Spread an input over ``spark.pricelake.input.partitions`` tasks if that
    setting is given.  Meant for small inputs stored as one split (local
    runs); without it an input keeps its own splits and nothing is shuffled."""
    n = df.sparkSession.conf.get("spark.pricelake.input.partitions", None)
    return df.repartition(int(n)) if n else df


def _full_schema(df: DataFrame, ddl: str) -> DataFrame:
    """Give the feed every hinted column (absent ones as typed NULLs)."""
    fields = [f.strip().split(" ") for f in ddl.split(",")]
    have = set(df.columns)
    return df.select(*[F.col(n) if n in have else F.lit(None).cast(t).alias(n) for n, t in fields],
                     *[c for c in df.columns if c not in {n for n, _ in fields}])


def derived_feed_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw feed A (before load columns) derived from lineitem x part."""
    df = spark.sql(FEED_A_SQL, lineitem=spread(read_table(spark, sf_dir, "lineitem")),
                   part=read_table(spark, sf_dir, "part"))
    return _full_schema(df, FEED_A_DDL)


def derived_feed_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.sql(FEED_B_SQL, lineitem=spread(read_table(spark, sf_dir, "lineitem")),
                   part=read_table(spark, sf_dir, "part"))
    return _full_schema(df, FEED_B_DDL)


def source_file_of(store: str, batch_col: str = "batch_ts"):
    """Virtual landing file of a derived row: one file per store and batch day."""
    return F.concat(F.lit(f"landing/{store}/"), F.col(batch_col).cast("date").cast("string"), F.lit(".csv"))


def _present(df: DataFrame, cols: list[str]) -> list[str]:
    """Hash columns the rows carry; an absent column (older file layout)
    hashes like NULL, i.e. it is skipped."""
    return [c for c in cols if c in df.columns]


def bronze_a(raw: DataFrame, hash_cols: list[str] = HASH_COLS_A) -> DataFrame:
    """S5/S6 for feed A: ``source_file`` and ``raw_hash`` on the raw rows."""
    out = raw
    if "source_file" not in out.columns:
        out = out.withColumn("source_file", source_file_of("a"))
    return out.withColumn("raw_hash", row_hash(_present(out, hash_cols)))


def bronze_b(raw: DataFrame, hash_cols: list[str] = HASH_COLS_B) -> DataFrame:
    """S5/S6 + F3 for feed B: load columns and the parsed unit price."""
    out = raw
    if "source_file" not in out.columns:
        out = out.withColumn("source_file", source_file_of("b"))
    out = out.withColumn("raw_hash", row_hash(_present(out, hash_cols)))
    price, size, uom = parse_unit_price("CupPrice")
    return out.withColumns({"unit_price": price, "unit_size": size, "unit_uom": uom})


def exclude_sources(df: DataFrame, paths: list[str]) -> DataFrame:
    """Drop rows whose ``source_file`` is listed.  Blank entries are
    ignored; an empty list is no filter."""
    listed = [p.strip() for p in paths if p and p.strip()]
    if not listed:
        return df
    # local paths are listed as file:///x or file:/x; file metadata says file:/x
    listed += [p.replace("file:///", "file:/", 1) for p in listed if p.startswith("file:///")]
    return df.where(~F.col("source_file").isin(listed))


def excluded_paths_from_conf(spark: SparkSession | None, key: str = "pipeline.excluded_paths") -> list[str]:
    """Comma-separated exclusion list from a session setting."""
    if spark is None:
        return []
    raw = spark.conf.get(key, "") or ""
    return [p.strip() for p in raw.split(",") if p.strip()]
