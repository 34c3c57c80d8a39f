"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(cpus: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "pricelake") -> SparkSession:
    """Local session for tests and the bench.

    On a cluster the session comes from the launcher; these settings are the
    ones that matter there too (AQE with skew-join splitting and runtime
    broadcast conversion, UTC session zone, Arrow for pandas UDFs).
    """
    parts = shuffle_partitions or (2 * (os.cpu_count() or 4) if cpus == "*" else 2 * int(cpus))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
        .config("spark.pricelake.input.partitions", str(parts // 2))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    package_on_workers(spark)
    ensure_checkpoint_dir(spark)
    return spark


def package_on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did (a
    cluster's launcher ships it; a local session needs the path)."""
    env, root = spark.sparkContext.environment, os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only a local session with
    no such setting (tests) gets a fresh scratch folder of its own."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running pricelake on a cluster")
    local = tempfile.mkdtemp(prefix="pricelake-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


# Input rows of one reduce task, and bytes of one input split of a large input.
ROWS_PER_TASK = 200_000
SPLIT_BYTES = 16 * 1024 * 1024


def size_for(spark: SparkSession, rows: int) -> None:
    """Give the session tasks enough for ``rows`` input rows: the derived rows
    are many times wider than the stored ones, so a fixed number of tasks would
    sort ever larger shares and spill them.  Settings are only ever made finer."""
    wanted = -(-rows // ROWS_PER_TASK)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    splits = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    if wanted > spark.sparkContext.defaultParallelism and splits > SPLIT_BYTES:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(SPLIT_BYTES))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return ensure_checkpoint_dir(spark).rstrip("/") + f"/{name}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Drop the shuffle files and broadcasts of finished jobs now.  Spark does so once
    the driver has collected their plans, which in a long job may come after the
    disk is full."""
    gc.collect()
    spark._jvm.System.gc()


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
