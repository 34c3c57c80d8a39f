"""How quality filters interact, by incremental retraction streaming (operator 13).

Five filters judge whole texts (null: empty).  A document *fails*

* A: under 200 words; B: ``100 * distinct words < 50 * words``;
* C: ``100 * [A-Z] characters > 3 * code points``; D: any of ``#$%&*|``;
* E: a text identical to that of any smaller doc_id in the whole table.

The audit tells, for each part (lang) and each of the 120 orders in which the
filters can be applied, what every step keeps, removes and loses.

1. *Micro-batches.*  The files of the table are a stream that runs until all
   are read (available now), some files at a time.  Each document becomes its
   text key (SHA-256), its mask of failures A to D and its labels.
2. *Keyed text state.*  The state of a text is the smallest doc_id seen, with
   the rows under it.  A row with a larger id fails E.  When a smaller id
   arrives, the earlier rows' masks are **retracted** from the part counters
   (-n without E) and counted again with E.  Before the exchange each Arrow
   batch of rows is reduced to one candidate row for each text, so a text that
   a third of all rows share sends some rows for each batch of 10,000.  Texts
   are kept some 256 to a state entry, by their digest, since a call for each
   text costs milliseconds; the number of entries grows with the table.
3. *Part counters.*  Every micro-batch leaves one small table of signed counts
   by (part, mask, labels) in a folder of its own number, written anew if the
   batch is replayed.  Their sum is at most 128 rows for each part; the 600
   (order, step) rows of a part are sums over them.

State and progress live in the stream's checkpoint below the shared checkpoint
folder, so a lost executor costs the running micro-batch only.  The state store
is the session's choice (``spark.sql.streaming.stateStore.providerClass``); it
holds some 150 bytes for each distinct text.

Edge cases: a null lang is the part ``''`` (as an empty one); empty texts and
null texts are equal and fail A only (and E); rows with a null doc_id never fail
E and make no other row fail it; rows under one doc_id are never each other's
copies, each counts; of several labels of one doc_id any quality = 1 or toxic =
1 counts, missing and null labels count as neither; labels with null doc_ids
are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelake.llm.common import map_in_pandas, scratch
from pricelake.streaming.files import run_available

FILTERS = "ABCDE"
BIT = {f: 1 << i for i, f in enumerate(FILTERS)}
MIN_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT = 200, 50, 3
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
SYMBOLS = b"#$%&*|"
TEXTS_PER_ENTRY = 256  # of the state store, on average
BATCHES = 8  # micro-batches that a table is read in, at most
COUNTER = ["part", "mask", "good", "toxic"]


def mask_of(text: str) -> int:
    """Failures of the filters A to D."""
    body = text.encode()
    words = body.split()
    mask = BIT["A"] if len(words) < MIN_WORDS else 0
    if 100 * len(set(words)) < DISTINCT_PERCENT * len(words):
        mask |= BIT["B"]
    if 100 * (len(body) - len(body.translate(None, CAPITALS))) > CAPITALS_PERCENT * len(text):
        mask |= BIT["C"]
    return mask | (BIT["D"] if len(body.translate(None, SYMBOLS)) < len(body) else 0)


def _facts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "part": pdf["part"],
                            "key": [hashlib.sha256(t.encode()).digest() for t in pdf["text"]],
                            "mask": [mask_of(t) for t in pdf["text"]]})


def facts(docs: DataFrame) -> DataFrame:
    """(doc_id, part, key, mask) of each document, batch or stream."""
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    return map_in_pandas(rows, _facts, "doc_id long, part string, key binary, mask int")


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with good and toxic.  Rows without an id have no label; their
    join key is their text, so that they do not meet in one task."""
    def any_one(c: str) -> Column:
        return F.max(F.coalesce(F.col(c) == 1, F.lit(False)))

    known = (labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("string").alias("id"))
             .agg(any_one("quality").alias("good"), any_one("toxic").alias("toxic")))
    keyed = rows.withColumn("id", F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("-"), F.hex("key"))))
    return (keyed.join(known, "id", "left").drop("id")
            .withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")}))


def _combine(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per Arrow batch and text: the rows of its smallest doc_id (candidates),
    and counts of those that surely fail E or have no doc_id (doc_id null)."""
    for pdf in frames:
        ids = pd.to_numeric(pdf["doc_id"]).astype("Int64") if len(pdf) else pdf["doc_id"].astype("Int64")
        low = ids.groupby(pdf["key"]).transform("min")
        later = (ids > low).fillna(False).astype(bool)
        pdf = pdf.assign(mask=pdf["mask"] + later * BIT["E"], doc_id=pdf["doc_id"].where(~later & ids.notna(), None))
        yield (pdf.groupby(["key", "doc_id", *COUNTER], dropna=False, sort=False).size().rename("n").reset_index()
               .astype({"n": "int64"}))


DELTA = "part string, mask int, good boolean, toxic boolean, delta long"


def retract(low: int | None, held: list, rows: list[tuple]) -> tuple[int | None, list, list[tuple]]:
    """The state of one text after new rows (doc_id, part, mask, good, toxic, n),
    and their signed counts.  ``held``: the rows of the smallest doc_id ``low``."""
    out = []
    for doc_id, *counter, n in rows:
        if doc_id is None:
            out.append((*counter, n))
            continue
        if low is None or doc_id < low:
            for part, mask, good, toxic, k in held:  # earlier rows turn out to be copies
                out += [(part, mask, good, toxic, -k), (part, mask | BIT["E"], good, toxic, k)]
            low, held = doc_id, []
        part, mask, good, toxic = counter
        if doc_id > low:
            out.append((part, mask | BIT["E"], good, toxic, n))
            continue
        out.append((part, mask, good, toxic, n))
        same = next((h for h in held if h[:4] == counter), None)
        if same:
            same[4] += n
        else:
            held.append([*counter, n])
    return low, held, out


def _update(entry, frames, state):
    """Signed counts of the new rows of one state entry: {digest: [low, held]}."""
    texts = json.loads(state.get[0]) if state.exists else {}
    rows = defaultdict(list)
    for pdf in frames:
        ids = [None if i is None else int(i) for i in pdf["doc_id"]]
        for key, *row in zip(pdf["key"], ids, *(pdf[c].tolist() for c in (*COUNTER, "n"))):
            rows[key.hex()].append(tuple(row))
    total: Counter = Counter()
    for key, mine in rows.items():
        low, held, out = retract(*texts.get(key, (None, [])), mine)
        if low is not None:
            texts[key] = [low, held]
        for *counter, n in out:
            total[tuple(counter)] += n
    state.update((json.dumps(texts, separators=(",", ":")),))
    yield pd.DataFrame([(*c, n) for c, n in total.items() if n], columns=[*COUNTER, "delta"])


def deltas(stream: DataFrame, labels: DataFrame, entries: int) -> DataFrame:
    """The stream of signed counts by (part, mask, good, toxic), with the texts
    in ``entries`` entries of the state store."""
    rows = labelled(facts(stream), labels).select("key", F.col("doc_id").cast("string").alias("doc_id"), *COUNTER)
    reduced = rows.mapInPandas(_combine, "key binary, doc_id string, part string, mask int, good boolean, toxic boolean, n long")
    return (reduced.withColumn("entry", F.pmod(F.xxhash64("key"), F.lit(entries))).groupBy("entry")
            .applyInPandasWithState(_update, DELTA, "texts string", "append", "NoTimeout"))


def counters(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(part, mask, good, toxic, n): the part counters after all files of the
    Parquet table at ``path``, read as at most ``batches`` micro-batches."""
    table = spark.read.parquet(path)
    root = scratch(spark)
    files = path.rstrip("/")
    files = f"{files[:-1]}[{files[-1]}]"  # as a pattern, for a file stream takes one file by a pattern only
    stream = (spark.readStream.schema(table.schema).option("maxFilesPerTrigger", -(-len(table.inputFiles()) // batches) or 1)
              .parquet(files).select("doc_id", "text", "lang"))

    def count(batch: DataFrame, number: int) -> None:
        (batch.groupBy(*COUNTER).agg(F.sum("delta").alias("delta"))
         .write.mode("overwrite").parquet(f"{root}/counters/batch={number:08d}"))

    count(spark.createDataFrame([], DELTA), -1)  # a table without files has no micro-batch
    entries = max(1, table.count() // TEXTS_PER_ENTRY)
    run_available(deltas(stream, labels, entries).writeStream.foreachBatch(count).option("checkpointLocation", f"{root}/checkpoint"))
    return (spark.read.schema(DELTA).parquet(f"{root}/counters").groupBy(*COUNTER)
            .agg(F.sum("delta").alias("n")).filter("n <> 0"))


def steps() -> Column:
    """The 600 steps of all orders: what is applied, and what was before."""
    rows = [{"filter_order": "".join(order), "step": i + 1, "bit": BIT[f], "before": sum(BIT[g] for g in order[:i])}
            for order in permutations(FILTERS) for i, f in enumerate(order)]
    return F.explode(F.from_json(F.lit(json.dumps(rows)), "array<struct<filter_order:string,step:int,bit:int,before:int>>"))


def interactions(counts: DataFrame) -> DataFrame:
    """One row for each part, order and step from the part counters."""
    per = counts.select(*COUNTER, "n", steps().alias("s")).select(*COUNTER, "n", "s.*")
    mask, bit = F.col("mask"), F.col("bit")
    fails, gone = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(F.col("before")) != 0

    def total(where: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col("n"))), F.lit(0)).alias(name)

    out = per.groupBy("part", "filter_order", "step", "bit").agg(
        total(~fails & ~gone, "kept"), total(fails & ~gone, "removed"), total(fails & gone, "redundant"),
        total(mask == bit, "unique_fails"), total(fails & ~gone & F.col("good"), "good_lost"),
        total(fails & ~gone & F.col("toxic"), "toxic_lost"))
    return out.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "bit"))).drop("bit")


def audit(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The interaction table of the documents stored at ``path``."""
    return interactions(counters(spark, path, labels, batches))
