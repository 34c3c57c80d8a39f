"""Wiring of the medallion tables for one input folder.

``Tables`` builds each table once, on first use, from the tables it depends
on.  With ``materialize=True`` every silver table is written as Parquet
under the session's checkpoint folder and read back (S12), which cuts the
lineage the way a materialised table does in production; otherwise only the
tables that several others read are (``SHARED``), the rest are lazy DataFrames
(the ids are still pinned by checkpoints inside ``dense_ids``).  Bronze, stage, versions and histories hold every raw row and are
read once or twice each: they stay lazy, as deriving them again moves no byte.
"""

from __future__ import annotations

import functools
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.operators.joins import SKU
from pricelake.operators.keymap import KeyMap
from pricelake.operators.quality import quality_report
from pricelake.plans import gold, silver
from pricelake.plans.params import STAGE_A_RULES, STAGE_B_RULES, calendar_from_dates
from pricelake.session import release, scratch, size_for
from pricelake.sources import feeds


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the complete tables (with a _SUCCESS file) in a folder."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    done = jvm.org.apache.hadoop.fs.Path
    return [st.getPath().getName() for st in fs.listStatus(root)
            if st.isDirectory() and fs.exists(done(st.getPath(), "_SUCCESS"))]


def _table(fn):
    name = fn.__name__

    @functools.wraps(fn)
    def wrapper(self):
        if name not in self._memo:
            # exclusive time: what this table costs beyond its inputs
            t0, outer, self._child = time.perf_counter(), self._child, 0.0
            df = fn(self)
            if name in (self.MATERIALIZED if self.materialize else self.SHARED):
                df = self._write(name, df)
            elapsed = time.perf_counter() - t0
            self.timings[name] = elapsed - self._child
            self._child = outer + elapsed
            self._memo[name] = df
        return self._memo[name]
    return property(wrapper)


class Tables:
    # Read by several others, each of which would derive a lazy table again.
    SHARED = {"cur_a", "cur_b", "dim_brand", "dim_category", "canonical_a", "match_b", "canonical", "store_product"}
    MATERIALIZED = SHARED | {"gold_price_comparison", "gold_price_trend"}  # and price_observation, see there

    def __init__(self, spark: SparkSession, sf_dir: str | None = None, materialize: bool = False,
                 bronze: tuple[str, str] | None = None, keys: str | None = None, calendar: DataFrame | None = None,
                 **options):
        """``sf_dir``: derive the feeds from the driver tables, or ``bronze``:
        the paths of given bronze tables of A and B.  ``keys``: folder with the
        ids of earlier runs, which stay (a run adds its new keys): the brand and
        category dimensions, and key maps of canonical products, store products
        and price observations; such a run has to be materialised.  ``calendar``: scrape days to weeks (default: all days).
        ``options``: ``grain`` (D3), ``lookup`` (D7), ``keep_unblocked``
        (D8), ``b_match`` (D12) -- defaults keep the reference's results."""
        self.bronze = bronze
        self.keys = keys.rstrip("/") if keys else None
        self._calendar = calendar
        self.options = {"grain": "sku", "lookup": "name", "keep_unblocked": False, "b_match": "sku", **options}
        if keys and not materialize:
            raise ValueError("ids are kept over runs by materialised tables only")
        self.spark = spark
        self.sf_dir = sf_dir
        self.materialize = materialize
        self._memo: dict[str, DataFrame] = {}
        self.timings: dict[str, float] = {}
        self._child = 0.0
        self._root = None

    def _write(self, name: str, df: DataFrame) -> DataFrame:
        path = self._folder(name)
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        release(self.spark)
        return self.spark.read.parquet(path)

    def _folder(self, name: str) -> str:
        if self._root is None:
            self._root = scratch(self.spark, "tables")
        return f"{self._root}/{name}"

    def _known(self, name: str) -> DataFrame | None:
        """The newest dimension of that name in the key folder."""
        runs = list_folders(self.spark, f"{self.keys}/{name}") if self.keys else []
        return self.spark.read.parquet(f"{self.keys}/{name}/{max(runs)}") if runs else None

    def _keep(self, name: str, df: DataFrame) -> DataFrame:
        """Store a dimension as the newest of its name: the next run's ids.
        The folder counts only once its write is complete."""
        if not self.keys:
            return df
        runs = list_folders(self.spark, f"{self.keys}/{name}")
        path = f"{self.keys}/{name}/{int(max(runs, default='0')) + 1:08d}"
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def _ids(self, name: str) -> KeyMap | None:
        return silver.key_map(self.spark, self.keys, name) if self.keys else None

    def _excluded(self, df: DataFrame) -> DataFrame:
        return feeds.exclude_sources(df, feeds.excluded_paths_from_conf(self.spark))

    # bronze ---------------------------------------------------------------
    def loaded_a(self, raw: DataFrame) -> DataFrame:
        return self._excluded(feeds.bronze_a(raw))

    def loaded_b(self, raw: DataFrame) -> DataFrame:
        return self._excluded(feeds.bronze_b(raw))

    @_table
    def bronze_a(self):
        if self.bronze:
            return self._excluded(self.spark.read.parquet(self.bronze[0]))
        return self.loaded_a(feeds.derived_feed_a(self.spark, self.sf_dir))

    @_table
    def bronze_b(self):
        if self.bronze:
            return self._excluded(self.spark.read.parquet(self.bronze[1]))
        return self.loaded_b(feeds.derived_feed_b(self.spark, self.sf_dir))

    # stage + history ------------------------------------------------------
    @_table
    def stage_a(self):
        return silver.stage_a(self.bronze_a)

    @_table
    def stage_b(self):
        return silver.stage_b(self.bronze_b)

    @_table
    def quality(self):
        """Reports (rule, failed, total) of the staged tables' gates, by table."""
        return {"stage_a": quality_report(silver.stage_a(self.bronze_a, rules=[]), STAGE_A_RULES),
                "stage_b": quality_report(silver.stage_b(self.bronze_b, rules=[]), STAGE_B_RULES)}

    @_table
    def hist_a(self):
        return silver.history_a(self.stage_a)

    @_table
    def versions_a(self):
        return silver.versions_a(self.stage_a)

    @_table
    def hist_b(self):
        return silver.history_b(self.stage_b)

    @_table
    def cur_a(self):
        return silver.current_a(self.stage_a)

    @_table
    def cur_b(self):
        return silver.current_b(self.stage_b)

    # dimensions / canonical ----------------------------------------------
    @_table
    def dim_brand(self):
        return self._keep("dim_brand", silver.dim_brand(self.cur_a, self.cur_b, self._known("dim_brand")))

    @_table
    def dim_category(self):
        return self._keep("dim_category", silver.dim_category(self.cur_a, self.cur_b, self._known("dim_category")))

    @_table
    def canonical_a(self):
        return silver.canonical_a(self.cur_a, self.dim_brand, self.dim_category,
                                  grain=self.options["grain"], lookup=self.options["lookup"], ids=self._ids("canonical"))

    @_table
    def match_b(self):
        return silver.match_b(silver.versions_b(self.stage_b), self.dim_brand, self.dim_category, self.canonical_a,
                              keep_unblocked=self.options["keep_unblocked"], lookup=self.options["lookup"])

    @_table
    def canonical(self):
        return silver.canonical(self.canonical_a, self.match_b, self._ids("canonical"))

    @_table
    def store_product(self):
        return silver.store_product(self.cur_a, self.canonical, self.match_b, self._ids("store_product"))

    # prices ---------------------------------------------------------------
    @_table
    def price_stage(self):
        return silver.price_stage(self.bronze_a, self.bronze_b, self.store_product)

    @_table
    def price_observation(self):
        return self._observed().select("observation_id", *silver.PRICE_COLS)

    def _observed(self):
        """Rows in SKU buckets are pinned already; others are written like any table."""
        rows = silver.observations(self.bronze_a, self.bronze_b, self.store_product, ids=self._ids("price_observation"))
        if self.materialize and SKU not in rows.columns:
            rows = self._write("price_observation", rows)
        release(self.spark)
        self._facts = rows
        return rows

    @property
    def price_facts(self):
        """The rows of ``price_observation``, with their SKU if they lie in its buckets."""
        return self.price_observation and self._facts

    # gold -----------------------------------------------------------------
    @_table
    def calendar(self):
        if self._calendar is not None:
            return self._calendar
        days = [b.select(F.col("scrape_timestamp").alias("scrape_date")) for b in (self.bronze_a, self.bronze_b)]
        return calendar_from_dates(days[0].unionByName(days[1]))

    @_table
    def gold_price_comparison(self):
        return gold.price_comparison(self.canonical, self.store_product, self.price_facts,
                                     self.versions_a, self.cur_b)

    @_table
    def gold_price_trend(self):
        return gold.price_trend(self.canonical, self.store_product, self.price_facts,
                                self.bronze_a, self.bronze_b, self.versions_a, self.calendar,
                                b_match=self.options["b_match"])


_CACHE: dict[tuple, Tables] = {}


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Shared tables per (session, folder): each silver table is written once
    and read by every query that needs it."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir)
    if key not in _CACHE:
        size_for(spark, feeds.read_table(spark, sf_dir, "lineitem").count())
        _CACHE[key] = Tables(spark, sf_dir, materialize=True)
    return _CACHE[key]
