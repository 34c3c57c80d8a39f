import re
from collections import Counter

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.helpers import DOCS, SF, frame, given_docs, odd_docs
from tests.llm.test_jaccard_join import brute


def test_stages_on_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols = docs.columns
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), DOCS)
        assert docs.columns == cols
        ids[name] = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert all(r["text"] == texts[r["doc_id"]] for r in docs.collect())
    lang, exact, near, mix = (ids[n] for n, _ in corpus_pipeline.STAGES[:-1])
    assert len(lang) > 0.97 * len(texts)
    first = {}
    for i in sorted(lang):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", texts[i]), i)
    assert sorted(exact) == sorted(first.values())
    rows = [(i, texts[i], None, None, 0) for i in exact]
    assert sorted(near) == sorted({int(r.strip("()").split(",")[2]) for r in brute(rows)})
    assert set(mix) <= set(near) and max(Counter(mix).values()) <= 2
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", texts[i])) for i in near}
    assert abs(sum(size[i] for i in mix) - 1.5 * sum(size.values())) < 0.03 * sum(size.values())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter(mix)


def test_stages_on_odd_rows(spark):
    docs = frame(spark, odd_docs() + [(100 + r[0], *r[1:]) for r in given_docs(40)])
    cols = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == cols
        out.collect()
        assert stage(spark, frame(spark, []), SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0


def test_run_and_entry(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    names = entry.queries()
    assert "pipeline" in names and sum(n.startswith("op") for n in names) == 10
