import random
import zlib

from pricelake.llm import language_id
from tests.llm.helpers import frame, given_docs, odd_docs


def test_held_out_accuracy(spark):
    rows = given_docs()
    got = {r["doc_id"]: r for r in language_id.predictions(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    right = total = 0
    for doc_id, text, lang, *_ in rows:
        out = zlib.crc32(str(doc_id).encode()) % 4 == 2
        assert got[doc_id]["held_out"] == out and 0 <= got[doc_id]["score"] <= 1
        if out:
            total += 1
            right += got[doc_id]["lang_pred"] == lang
    assert total > 20 and right / total > 0.9


def test_labels_of_held_out_rows_are_not_read(spark):
    rows = given_docs()
    other = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, "moved", 0) for i, t, lang, *_ in rows]
    one = {tuple(r) for r in language_id.predictions(frame(spark, rows)).collect()}
    assert one == {tuple(r) for r in language_id.predictions(frame(spark, other)).collect()}


def test_odd_rows(spark):
    rows = odd_docs() + [(100 + i, t, lang, None, 0) for i, t, lang, *_ in given_docs(60)]
    got = language_id.predictions(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r["lang_pred"] for r in got}
    assert by_id[0] == by_id[1] == by_id[2] == by_id[15] == "und"
    assert {r["lang_pred"] for r in got} <= {"und", "en", "de", "fr", "es"}
    assert language_id.predictions(frame(spark, [])).count() == 0
    no_labels = language_id.predictions(frame(spark, [(1, "some text", None, None, 0)])).collect()
    assert [r["lang_pred"] for r in no_labels] == ["und"]


def test_long_clean_texts_keep_their_margin(spark):
    """The lead of the best dictionary must grow with the text."""
    rows = given_docs()
    classify = language_id.Classifier(language_id.learn(frame(spark, rows))).classify
    rng = random.Random(5)
    for lang in ("fr", "en"):
        words = [w for i, t, own, *_ in rows if own == lang and zlib.crc32(str(i).encode()) % 4 == 2 for w in t.split()]
        text = " ".join(rng.choices(words, k=5_000_000 // 4))[:5_000_000]
        short, long_ = classify(text[:10_000]), classify(text)
        assert len(text) == 5_000_000 and short[0] == long_[0] == lang
        assert long_[1] > 10 * language_id.NARROW and long_[1] > short[1] / 2
