"""Exact de-duplication against immutable snapshots (operator 5).

Texts are equal when identical after each run of white space became one
space; a null text counts as empty.  Of equal texts the row with the smallest
doc_id stays (null doc_ids last; of rows that also share the doc_id, one).

* A **snapshot** is the grouped digests (SHA-256) of rows already accepted
  plus one static binary fuse filter for each digest bucket, never changed
  after it was written.
* An incoming batch is first grouped **on its own** by digest: a partial
  aggregate, so a group that holds a third of all rows is one row for each
  map task before the shuffle.
* Its distinct digests meet the filter of their bucket (a co-group of digest
  rows and filters; filters are never broadcast).  Digests that the filter
  rules out are new.  The positives join the snapshot's exact buckets on the
  digest, and the normalised texts of the two representatives are compared
  byte by byte before the groups are merged.

Only representatives' texts of possible matches are compared; group rows are
about 50 bytes each.  The row-to-group join at the end has one row for each
group on one side, so Spark's adaptive skew join splits a hot group.

Edge cases: an empty table gives an empty result; empty and null texts form
one group; repeated rows (same doc_id and text) count in ``group_size`` and
one of them is kept; rows with null doc_id group like others and are kept
only if no row of the group has a doc_id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.llm import fuse_filter
from pricelake.llm.common import materialize, normalized, shuffle_partitions

# Filter buckets for each shuffle partition, and the keys of a bucket at most
# (on average): the bucket count grows with the snapshot.
BUCKETS_PER_PARTITION = 4
KEYS_PER_BUCKET = 200_000


def _digest() -> Column:
    return F.unhex(F.sha2(normalized(), 256))


def keyed(docs: DataFrame, incoming: Column) -> DataFrame:
    """(doc_id, rid, digest, incoming): one small row for each document."""
    return materialize(docs.select("doc_id", F.monotonically_increasing_id().alias("rid"),
                                   _digest().alias("digest"), F.coalesce(incoming, F.lit(True)).alias("incoming")))


def _groups(rows: DataFrame) -> DataFrame:
    """One row for each digest of a batch: its first row and its size."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid"))
    return rows.groupBy("digest", "incoming").agg(first.alias("first"), F.count(F.lit(1)).alias("n"))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int").alias("bucket")


def _key64(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(d)[:8] for d in digests), dtype="<u8")


def snapshot_filters(groups: DataFrame, buckets: int) -> DataFrame:
    """(bucket, filter) of a snapshot's groups."""
    def make(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "filter": [fuse_filter.build(_key64(pdf["digest"]))]})
    return groups.select(_bucket(buckets), "digest").groupBy("bucket").applyInPandas(make, "bucket int, filter binary")


def screen(groups: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """The groups whose digest the filter of its bucket does not rule out."""
    keyed_groups = groups.select(_bucket(buckets), "digest")

    def keep(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"digest": []})
        hit = fuse_filter.contains(bytes(right["filter"].iloc[0]), _key64(left["digest"]))
        return left.loc[hit, ["digest"]]
    maybe = keyed_groups.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(keep, "digest binary")
    return groups.join(maybe, "digest", "left_semi")


def _confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The digests whose two representatives have the same normalised bytes."""
    ids = pairs.select("digest", F.explode(F.array("a", "b")).alias("id")).select("digest", "id.doc_id")
    texts = docs.select(F.col("doc_id").alias("_id"), normalized().alias("norm"), _digest().alias("_digest"))
    # a shuffle join at every size: the texts move once, in proportion to the input
    met = ids.hint("merge").join(texts, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")))
    same = F.min("norm") == F.max("norm")
    return met.groupBy("digest").agg(same.alias("same")).filter("same").select("digest")


def exact_dedup(docs: DataFrame, incoming: Column) -> DataFrame:
    """One row for each document: doc_id, keep_id, group_size, kept,
    text_sha256.  ``incoming`` tells the rows of the new batch from those of
    the snapshot (null: incoming); the result does not depend on the split."""
    spark = docs.sparkSession
    rows = keyed(docs, incoming)
    groups = materialize(_groups(rows))
    old, new = groups.filter(~F.col("incoming")), groups.filter("incoming")
    buckets = max(BUCKETS_PER_PARTITION * shuffle_partitions(spark), old.count() // KEYS_PER_BUCKET)
    filters = snapshot_filters(old, buckets)
    positive = screen(new, filters, buckets)
    pairs = materialize(positive.select("digest", F.col("first").alias("b"), F.col("n").alias("n_b"))
                        .join(old.select("digest", F.col("first").alias("a"), F.col("n").alias("n_a")), "digest"))
    merged = (pairs.join(_confirmed(pairs, docs), "digest", "left_semi")
              .select("digest", F.least("a", "b").alias("both"), (F.col("n_a") + F.col("n_b")).alias("n_both")))
    final = (groups.join(merged, "digest", "left")
             .select("digest", "incoming", F.coalesce("both", "first").alias("first"),
                     F.coalesce("n_both", "n").alias("group_size")))
    return (rows.join(final, ["digest", "incoming"])
            .select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
                    (F.col("rid") == F.col("first.rid")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))


def deduplicated(docs: DataFrame, incoming: Column) -> DataFrame:
    """The rows of ``docs`` that stay, one for each distinct text, unchanged."""
    keep = (exact_dedup(docs, incoming).filter("kept")
            .select(F.col("doc_id").alias("_id"), F.unhex("text_sha256").alias("_keep")))
    texts = docs.withColumn("_digest", _digest())
    same = (F.col("_digest") == F.col("_keep")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    # at least one row meets each kept one; rows repeated under one doc_id meet it together
    return texts.join(keep, same).dropDuplicates(["_digest", "_id"]).select(*docs.columns)


def later_half(docs: DataFrame) -> Column:
    """Rows above the middle of the doc_id range: the incoming batch when a
    whole table is taken as one snapshot and one batch."""
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    return F.lit(True) if low is None else F.col("doc_id") > F.lit((low + high) // 2)
