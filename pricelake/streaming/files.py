"""Incremental file sources (S1-S5, S10) and additive schema evolution.

The landing folders are ordinary directories of CSV (or Parquet) files; a
file stream picks up new files only (its checkpoint remembers the rest).
All scratch folders live under the cluster's shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import csv
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.sources import feeds

# Files over which rows of one landing value (a day) are dealt.
PARTS_OF_ONE = 16


def land(df: DataFrame, path: str, files: int, by, fmt: str = "csv", mode: str = "overwrite",
         load: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Write ``df`` as ``files`` landing files, rows spread by the column
    expression ``by`` (e.g. the batch day), like a scraper dropping files.  One
    value of ``by`` is dealt over ``PARTS_OF_ONE`` files, so that a busy day is not
    one task's; a task writes one file.  ``load`` adds the load columns to the rows
    in their place, so that they are written but not moved."""
    part = F.pmod(F.xxhash64(*df.columns), F.lit(PARTS_OF_ONE))
    bucket = F.pmod(F.xxhash64(by, part), F.lit(files)).cast("int")
    out = df.withColumn("_f", bucket).repartitionById(files, "_f").drop("_f")
    out = load(out) if load else out
    w = out.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(path)
    else:
        w.option("compression", "zstd").parquet(path)


def ntz_schema(ddl: str) -> T.StructType:
    """Schema hints with TIMESTAMP read as TIMESTAMP_NTZ (wall-clock scrape
    times, no session-zone shift)."""
    schema = T.StructType.fromDDL(ddl)
    return T.StructType([T.StructField(f.name, T.TimestampNTZType() if isinstance(f.dataType, T.TimestampType)
                                       else f.dataType, True) for f in schema.fields])


def read_csv_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """New CSV files only, nested folders too, header row, typed
    schema.  A file whose header does not name the schema's columns in their
    order fails the query instead of shifting values."""
    reader = (spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
              .option("recursiveFileLookup", True)
              .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]"))
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).csv(path)


def read_feed_a(spark: SparkSession, path: str, schema: T.StructType | None = None,
                max_files: int | None = None, by_name: bool = False) -> DataFrame:
    """Feed A as a bronze stream from a landing folder: load columns,
    fingerprint, files of the session's exclusion list left out.  ``by_name``:
    files of any column order (S4)."""
    schema = schema or ntz_schema(feeds.FEED_A_DDL)
    if by_name:
        stream = loaded(read_csv_by_name(spark, path, schema, max_files).withColumnRenamed("_file", "source_file"))
    else:
        stream = with_ingest_metadata(read_csv_stream(spark, path, schema, max_files))
    return feeds.exclude_sources(feeds.bronze_a(stream), feeds.excluded_paths_from_conf(spark))


def read_feed_b(spark: SparkSession, path: str, schema: T.StructType | None = None,
                max_files: int | None = None) -> DataFrame:
    """The same for feed B, with its parsed unit price."""
    stream = with_ingest_metadata(read_csv_stream(spark, path, schema or ntz_schema(feeds.FEED_B_DDL), max_files))
    return feeds.exclude_sources(feeds.bronze_b(stream), feeds.excluded_paths_from_conf(spark))


def write_bronze(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append everything landed so far to a bronze Parquet table."""
    run_available(stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint), path)


def read_parquet_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None,
                        consume: bool = False) -> DataFrame:
    """A bronze table read as a stream.  ``consume``: files are deleted once the
    micro-batch that read them is committed."""
    reader = spark.readStream.schema(schema)
    reader = reader.option("cleanSource", "delete") if consume else reader
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(path)


def loaded(df: DataFrame) -> DataFrame:
    """``ingestion_ts`` = batch time."""
    return df.withColumn("ingestion_ts", F.current_timestamp().cast("timestamp_ntz"))


def with_ingest_metadata(df: DataFrame) -> DataFrame:
    """``source_file`` from the file metadata, ``ingestion_ts`` = batch time."""
    return loaded(df.withColumn("source_file", F.col("_metadata.file_path")))


def csv_layouts(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The CSV files below ``path`` by their header (through the Hadoop file
    system, first line only)."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    out: dict[tuple[str, ...], list[str]] = {}
    files = fs.listFiles(root, True)
    while files.hasNext():
        st = files.next()
        name = st.getPath().getName()
        if not st.isFile() or name.startswith((".", "_")) or not name.endswith(".csv"):
            continue
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(st.getPath()), "UTF-8"))
        try:
            line = reader.readLine()
        finally:
            reader.close()
        if line:
            out.setdefault(tuple(next(csv.reader([line]))), []).append(st.getPath().toUri().getPath())
    return out


def csv_headers(spark: SparkSession, path: str) -> list[list[str]]:
    """The distinct header lines of the CSV files below ``path``."""
    return [list(h) for h in csv_layouts(spark, path)]


def _cast(c: Column, dtype: T.DataType) -> Column:
    return c if isinstance(dtype, T.StringType) else c.try_cast(dtype)


def read_csv_by_name(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """New CSV files only, every column found by its *name* in the file's own
    header, wherever it stands: files of several layouts land side by side.
    Columns that a file lacks are NULL; columns that ``schema`` lacks are not
    read (``evolve_schema`` adds them); text that does not parse is NULL.

    The layouts (distinct headers, a handful) are found from the files' first
    lines.  The stream reads plain cells; a row's layout comes from its file: the
    commonest layout is the default, the files of others are a table joined to
    the stream by path.  A file that lands with a layout of its own while the
    stream runs fails the query at its header row instead of shifting values."""
    layouts = sorted(csv_layouts(spark, path).items(), key=lambda x: (-len(x[1]), x[0]))
    if not layouts:
        return read_csv_stream(spark, path, schema, max_files).withColumn("_file", F.col("_metadata.file_path"))
    width = max(len(header) for header, _ in layouts)
    cells = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    reader = spark.readStream.schema(cells).option("header", False).option("recursiveFileLookup", True)
    rows = (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).csv(path)
    rows = rows.withColumn("_file", F.col("_metadata.file_path"))
    # local paths come as file:/x or file:///x: compared without scheme and host
    where = F.regexp_replace(F.url_decode(F.regexp_replace("_file", r"\+", "%2B")), "^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "")
    rare = [(file, i) for i, (_, names) in enumerate(layouts) if i for file in names]
    if rare:
        rows = rows.join(spark.createDataFrame(rare, "_path string, _layout int"), where == F.col("_path"), "left").drop("_path")
    else:
        rows = rows.withColumn("_layout", F.lit(0))
    layout = F.coalesce("_layout", F.lit(0))
    line = F.array(*cells.fieldNames())
    headers = F.array(*[F.array(*[F.lit(c) for c in (*h, *[None] * (width - len(h)))]) for h, _ in layouts])
    own = F.element_at(headers, layout + 1)
    # a row that names every column all layouts share is a header
    shared = [c for c in layouts[0][0] if all(c in h for h, _ in layouts)]
    named = F.size(F.array_intersect(line, F.array(*[F.lit(c) for c in shared]))) == len(shared)
    strange = named & ~line.eqNullSafe(own)
    rows = rows.where(F.when(strange, F.raise_error(F.concat(F.lit("unknown header in "), "_file")).cast("boolean"))
                      .otherwise(~named))

    def column(field: T.StructField) -> Column:
        at = [next((i for i, c in enumerate(h) if c.lower() == field.name.lower()), None) for h, _ in layouts]
        value = F.lit(None).cast("string")
        for i in sorted({i for i in at if i is not None}):
            value = F.when(layout.isin([n for n, p in enumerate(at) if p == i]), F.col(f"c{i}")).otherwise(value)
        return _cast(value, field.dataType).alias(field.name)

    return rows.select(*[column(f) for f in schema.fields], "_file")


def evolve_schema(spark: SparkSession, known: T.StructType, path: str) -> T.StructType:
    """Columns named in the landed files' headers but missing from
    ``known`` are appended as STRING, in header order; old rows read them
    as NULL.  ``read_csv_by_name`` then finds them wherever they stand;
    ``read_csv_stream`` reads by position and fails on any layout but the
    schema's."""
    have = {f.name.lower() for f in known.fields}
    extra: list[str] = []
    for header in csv_headers(spark, path):
        for name in header:
            if name.lower() not in have and name not in extra:
                extra.append(name)
    return T.StructType(list(known.fields) + [T.StructField(n, T.StringType(), True) for n in extra])


def run_available(writer, path: str | None = None) -> int:
    """Run a stream over everything landed so far, then stop.  Returns the
    number of rows that came too late for a watermark and were dropped."""
    q = writer.trigger(availableNow=True).start(path) if path else writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"])
