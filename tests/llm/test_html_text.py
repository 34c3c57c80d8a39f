import html
import random

import duckdb
import pytest

from pricelake.llm import html_text as ht
from tests.llm.helpers import SF

SCHEMA = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def given():
    return duckdb.sql(f"SELECT page_id, url, html FROM '{SF}/pages.parquet' ORDER BY page_id").fetchall()


@pytest.fixture(scope="module")
def model(given):
    return ht.fit([h for _, _, h in given])


def article(source):
    """All text inside <article> of the given (regular) pages."""
    inner = source.split("<article>", 1)[1].split("</article>", 1)[0]
    out = []
    for part in inner.replace("<br>", " ").replace("</b>", "").replace("<b>", "").split("<"):
        text = part.split(">", 1)[-1]
        if text.strip():
            out.append(" ".join(html.unescape(text).split()))
    return " ".join(out)


def test_given_pages_give_their_article(given, model):
    got = model.texts([h for _, _, h in given])
    assert [g for g in got] == [article(h) for _, _, h in given]


def test_other_layouts(given, model):
    """Pages re-composed with unseen randomness: main text in, frame out."""
    rng = random.Random(99)
    texts = [t for _, _, h in given for _, t, _ in ht.Page(h).blocks if len(t) > 20]
    frame = [f"frametext{i} " + " ".join(rng.choice(texts).split()[:20]) for i in range(30)]
    right = kept = wanted = 0
    for _, _, h in given:
        inner = h.split("<article>", 1)[1].split("</article>", 1)[0]
        page, _ = ht.compose(inner, [html.escape(t) for t in frame], rng)
        text = model.texts([page])[0]
        want = article(h)
        words, have = want.split(), text.split()
        kept += len(set(words) & set(have))
        wanted += len(set(words))
        right += "frametext" not in text
    assert kept / wanted > 0.97
    assert right / len(given) > 0.85


@pytest.mark.parametrize("source", [None, "", " ", "plain text", "<", "<p", "<!-- open", "<script>x", "</p></div>",
                                    "<div class='a", "<p>a<p>b", "<article>" * 3000, "<a href=\"x>y", "&#xD800;&amp;&bogus;",
                                    "<p>" + "x " * 200_000, "<![CDATA[ x", "<style>p{}</style><title>t</title>"])
def test_broken_pages_never_fail(model, source):
    text = model.texts([source])[0]
    assert isinstance(text, str) and "<" not in text


def test_reading_rules():
    page = ht.Page("<body><p>a<b>b</b>  c<br>d\n<p>e &amp; f&nbsp;g<script>var x='<p>'</script></p><ul><li>x<li>y</ul>z</body>")
    assert [t for _, t, _ in page.blocks] == ["ab c d", "e & f g", "x", "y", "z"]


def test_decoding_is_consistent(given, model):
    rng = random.Random(1)
    for _, _, h in given[:20]:
        page = ht.Page(h)
        import numpy as np
        keep = ht.decode(page, np.array([rng.uniform(-2, 2) for _ in page.tag]))
        state = ["above"] * len(page.tag)
        for i in range(1, len(page.tag)):
            up = state[page.parent[i]]
            state[i] = ("inside" if keep[i] else "above") if up == "above" else ("inside" if keep[i] else "dropped")
            assert not (up == "dropped" and keep[i])


def test_query(spark, given, model):
    rows = given + [(None, None, None), (900, "u", ""), given[0]]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS text", "2 AS n_chars")
    got = ht.extract(df, ht.fit(ht.sample(df))).collect()
    assert len(got) == len(rows)
    texts = {r["page_id"]: r["text"] for r in got}
    assert texts[given[1][0]] == article(given[1][2]) and texts[900] == ""
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    empty = spark.createDataFrame([], SCHEMA)
    assert ht.extract(empty, ht.fit(ht.sample(empty))).count() == 0


def test_few_marked_pages_are_found(spark, given):
    """One page in a hundred marks its main text: the sample has only those."""
    rows = [(1000 + i, "u", f"<div class=content><p>plain page {i}</p></div>") for i in range(2000)] + given[:20]
    got = ht.sample(spark.createDataFrame(rows, SCHEMA), 10)
    assert len(got) == 10 and all("<article>" in h for h in got)


@pytest.mark.parametrize("enough", [True, False])
def test_pages_without_marks_keep_their_text(spark, given, enough):
    rows = [(i, u, h.replace("<article>", "<div class=content>").replace("</article>", "</div>")) for i, u, h in given]
    df = spark.createDataFrame(rows if enough else rows[:1], SCHEMA)
    got = {r["page_id"]: r["text"] for r in ht.extract(df, ht.fit(ht.sample(df))).collect()}
    kept = wanted = 0
    for page_id, _, h in given[:len(got)]:
        words = set(article(h).split())
        kept += len(words & set(got[page_id].split()))
        wanted += len(words)
    assert kept / wanted > 0.9


def test_no_text_is_dropped_unread():
    page = ht.Page("<body><noscript><p>a</p></noscript><object>b</object><select><option>c</select><template><p>d</p></template>"
                   "<p>e <svg><text>f</text></svg> <math><mi>g</mi></math></p><iframe>x</iframe></body>")
    assert " ".join(t for _, t, _ in page.blocks) == "a b c d e f g"
    for tag in ("noscript", "object", "svg", "math", "select", "template", "textarea", "iframe", "style", "title"):
        page = ht.Page(f"<body><p>before</p><{tag}><p>after</p></body>")
        assert [t for _, t, _ in page.blocks] == ["before", "after"], tag


def test_text_outside_all_blocks_is_labelled(given, model):
    plain = [" ".join(article(h).split()[:150]) for _, _, h in given[:40]]
    got = model.texts([html.escape(t).replace(" the ", " <i>the</i> ") for t in plain])
    assert sum(a == b for a, b in zip(got, plain)) >= 38
