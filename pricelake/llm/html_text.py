"""Main text of web pages (operator 8).

Each page becomes a tree of block elements (inline elements only add text).
Gradient-boosted trees score every node from its text and tag density, link
share, punctuation, depth, sibling statistics and the tokens of its tag, class,
id and role and of its ancestors.  **Hierarchical decoding** picks the best
consistent labelling of the whole tree: a node is above the main text, in it,
or dropped from it; children of a dropped node are dropped and nothing in the
main text has a node of the page's frame below it, so ancestors and
descendants never contradict each other.  The text of the nodes in the main
text, in page order, is the result.

Training.  Pages carry no labels, so a bounded sample (``SAMPLE_PAGES``, by
hash of the id) of those that mark their main text (``article``, ``main``) is
labelled by that mark-up and re-composed: its article under other wrappers,
among menus, headers, sidebars, notices, adverts, forms and reader comments
filled with text of the sample.  That teaches the features behind the tags
rather than one page layout.  Where no page marks its main text, the articles
to re-compose are runs of the long text blocks of a sample of all pages, or of
fixed words where there is no such block either.

Edge cases: null or empty html gives an empty text; unclosed or stray tags,
unclosed comments and scripts never fail; very long pages are read whole;
repeated rows get equal answers; null page_ids are kept; an empty table gives
an empty result.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.boosting import Boosted
from pricelake.llm.common import map_in_pandas

SAMPLE_PAGES = 160
VARIANTS = 4
TOKENS = 160

# ---------------------------------------------------------------------------
# HTML's element kinds.
# ---------------------------------------------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr".split())
# An opening tag closes an open element of its own group.
CLOSES = {t: frozenset({"p"}) for t in (
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul").split()}
CLOSES |= {"li": frozenset({"li", "p"}), "dt": frozenset({"dt", "dd", "p"}), "dd": frozenset({"dt", "dd", "p"}),
           "tr": frozenset({"tr", "td", "th", "p"}), "td": frozenset({"td", "th", "p"}),
           "th": frozenset({"td", "th", "p"}), "option": frozenset({"option"})}
SCOPES = frozenset("article aside body div dl fieldset footer form header html main nav ol section table ul".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)|</?\Z", re.S)  # the last: a tag cut off by the end
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_PART = re.compile(r"[a-z]+")


class Page:
    """Block tree of a page.  Node 0 is the document; text outside all block
    elements is a node of its own below it."""

    def __init__(self, source: str):
        self.tag, self.words, self.parent, self.kids = ["#"], [()], [-1], [[]]
        self.blocks: list[tuple[int, str, int]] = []  # owner, text, characters in links
        self._read(source)

    def _read(self, source: str) -> None:
        stack, links = [0], 0  # open block nodes; depth of open links
        open_inline: list[str] = []
        parts: list[str] = []
        linked = pos = 0

        def flush() -> None:
            nonlocal parts, linked
            if parts:
                text = " ".join(html.unescape("".join(parts)).split())
                if text:
                    owner = stack[-1] or self._add("#text", ("#text",), 0)
                    self.blocks.append((owner, text, min(linked, len(text))))
                parts, linked = [], 0

        while True:
            m = _TAG.search(source, pos)
            text = source[pos:m.start()] if m else source[pos:]
            if text:
                parts.append(text)
                if links:
                    linked += len(text)
            if m is None:
                break
            pos = m.end()
            tag = m[2].lower() if m[2] else ""
            if not tag:
                continue
            if tag in RAW:
                if not m[1] and not m[3].endswith("/"):
                    end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(source, pos)
                    if end or tag == "script":  # any other that is never closed hides nothing
                        pos = end.end() if end else len(source)
                    parts.append(" ")
                continue
            if tag in INLINE:
                if tag == "a":
                    links = max(0, links + (-1 if m[1] else 1))
                continue
            if tag == "br":
                parts.append(" ")
                continue
            flush()
            links = 0
            if m[1]:
                for k in range(len(stack) - 1, 0, -1):
                    name = self.tag[stack[k]]
                    if name == tag:
                        del stack[k:]
                        break
                    if name in SCOPES and tag not in SCOPES:
                        break
                continue
            closes = CLOSES.get(tag, ())
            for k in range(len(stack) - 1, 0, -1):
                name = self.tag[stack[k]]
                if name in closes:
                    del stack[k:]
                elif name in SCOPES:
                    break
            if tag in VOID:
                continue
            node = self._add(tag, _words(tag, m[3]), stack[-1])
            if not m[3].endswith("/"):
                stack.append(node)
        flush()

    def _add(self, tag: str, words: tuple[str, ...], parent: int) -> int:
        node = len(self.tag)
        self.tag.append(tag)
        self.words.append(words)
        self.parent.append(parent)
        self.kids.append([])
        self.kids[parent].append(node)
        return node

    def text(self, keep) -> str:
        return " ".join(t for owner, t, _ in self.blocks if keep[owner])


def _words(tag: str, attrs: str) -> tuple[str, ...]:
    """Tag and attribute tokens."""
    out = ["<" + tag]
    if "=" in attrs:
        for _, value in _ATTR.findall(attrs):
            out += [w for w in _PART.findall(value.lower()) if len(w) > 1]
    return tuple(dict.fromkeys(out))


class Vocabulary:
    """Tokens with a feature of their own (the commonest of the sample)."""

    def __init__(self, pages: list[Page], size: int = TOKENS):
        n: dict[str, int] = {}
        for p in pages:
            for w in {w for words in p.words for w in words}:
                n[w] = n.get(w, 0) + 1
        kept = sorted(n, key=lambda w: (-n[w], w))[:size]
        self.index = {w: i for i, w in enumerate(kept)}


def features(page: Page, vocabulary: Vocabulary) -> np.ndarray:
    """One row for each node: numbers, own tokens, ancestors' tokens."""
    n = len(page.tag)
    chars, links, marks, blocks, tags = (np.zeros(n) for _ in range(5))
    own = np.zeros(n)
    start = np.full(n, -1.0)
    seen = 0
    for owner, text, linked in page.blocks:
        own[owner] += len(text)
        links[owner] += linked
        marks[owner] += text.count(".") + text.count(",")
        blocks[owner] += 1
        if start[owner] < 0:
            start[owner] = seen
        seen += len(text)
    chars += own
    tags += 1
    depth = np.zeros(n)
    width = len(vocabulary.index)
    tokens = np.zeros((n, 2 * width), dtype=np.float32)
    for i in range(1, n):
        up = page.parent[i]
        depth[i] = depth[up] + 1
        for w in page.words[i]:
            if w in vocabulary.index:
                tokens[i, vocabulary.index[w]] = 1
        tokens[i, width:] = np.maximum(tokens[up, :width], tokens[up, width:])
    for i in range(n - 1, 0, -1):  # parents precede their children
        up = page.parent[i]
        for a in (chars, links, marks, blocks, tags):
            a[up] += a[i]
        if start[i] >= 0 and (start[up] < 0 or start[i] < start[up]):
            start[up] = start[i]
    total = max(1.0, chars[0])
    sibs, place, sib_chars, paras = (np.zeros(n) for _ in range(4))
    for i, kids in enumerate(page.kids):
        for k, c in enumerate(kids):
            sibs[c], place[c] = len(kids), k / len(kids)
            sib_chars[c] = (chars[i] - own[i] - chars[c]) / max(1, len(kids) - 1)
        paras[i] = sum(page.tag[c] == "p" for c in kids)
    return np.column_stack([
        depth, np.log1p(chars), np.log1p(own), chars / tags, links / np.maximum(chars, 1), marks / np.maximum(chars, 1),
        chars / np.maximum(blocks, 1), tags, sibs, place, np.log1p(sib_chars), chars / total,
        np.maximum(start, 0) / total, paras, chars / (sib_chars + chars + 1), tokens])


def decode(page: Page, odds: np.ndarray) -> np.ndarray:
    """Nodes in the main text: the best consistent labelling.

    ``above`` (frame of the page), ``inside`` and ``dropped``: below inside
    comes inside or dropped, below dropped only dropped, below above comes
    above or inside."""
    n = len(odds)
    above, inside, dropped = -odds.copy(), odds.copy(), -odds.copy()
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        above[up] += max(above[i], inside[i])
        inside[up] += max(inside[i], dropped[i])
        dropped[up] += dropped[i]
    keep = np.zeros(n, dtype=bool)
    frame = np.zeros(n, dtype=bool)
    frame[0] = True  # the document itself is the frame
    for i in range(1, n):
        up = page.parent[i]
        if frame[up]:
            keep[i] = inside[i] > above[i]
            frame[i] = not keep[i]
        else:
            keep[i] = keep[up] and inside[i] > dropped[i]
    return keep


# --------------------------------------------------------------- training
# ---------------------------------------------------------------------------
# Wrappers for re-composed training pages.
# ---------------------------------------------------------------------------
MAIN = ['<article>', '<main>', '<main><article>', '<div class="content">', '<div id="main-content">',
        '<section class="post">', '<div class="entry-content">', '<div class="article-body">', '<div class="story">',
        '<div role="main">', '<div id="wrapper"><article class="post">', '<div class="text">']
FRAME = {
    "menu": ['<nav>', '<div class="menu">', '<ul class="nav">', '<div id="navigation">', '<div class="breadcrumb">'],
    "header": ['<header>', '<div class="header">', '<div id="masthead">', '<div class="top-bar">'],
    "side": ['<aside>', '<div class="sidebar">', '<div id="side">', '<div class="related">', '<div class="widget">'],
    "notice": ['<div class="notice">', '<div class="cookie-banner">', '<div id="consent">', '<div class="alert">',
               '<div role="alert">', '<div class="popup">'],
    "advert": ['<div class="ad">', '<div class="advert">', '<div class="sponsored">', '<aside class="promo">',
               '<div class="ads banner">', '<div id="advertisement">'],
    "form": ['<form>', '<form class="newsletter">', '<form id="search">', '<div class="login"><form>',
             '<div class="subscribe"><form>'],
    "comment": ['<div class="comments">', '<section id="comments">', '<ul class="comment-list">',
                '<div class="discussion">', '<div id="disqus">', '<section class="comments reader">'],
    "share": ['<div class="share">', '<div class="social">', '<div class="tags">', '<div class="byline meta">'],
    "footer": ['<footer>', '<div class="footer">', '<div id="bottom">', '<div class="copyright">'],
}


def _close(opened: str) -> str:
    return "".join(f"</{t}>" for t in reversed(re.findall(r"<(\w+)", opened)))


def _frame(kind: str, texts: list[str], rng: random.Random) -> str:
    opened = rng.choice(FRAME[kind])
    pick = lambda low, high: " ".join(rng.choice(texts).split()[:rng.randint(low, high)])
    if kind in ("menu", "share"):
        body = "".join(f'<li><a href="/x">{pick(1, 3)}</a></li>' for _ in range(rng.randint(3, 9)))
        body = body if opened.startswith("<ul") else f"<ul>{body}</ul>"
    elif kind == "form":
        body = "".join(f"<label>{pick(1, 4)}</label><input name=q>" for _ in range(rng.randint(1, 4)))
        body = f"<p>{pick(3, 12)}</p>{body}<button>{pick(1, 2)}</button>"
    elif kind == "comment":
        body = "".join(f'<div class="comment"><p>{pick(4, 60)}</p></div>' for _ in range(rng.randint(1, 8)))
    elif kind == "side":
        body = f"<h3>{pick(1, 4)}</h3>" + "".join(f'<p><a href="/y">{pick(3, 12)}</a></p>' for _ in range(rng.randint(1, 6)))
    elif kind == "footer":
        body = f"&copy; {pick(2, 20)} &middot; {pick(3, 15)}"
    else:
        body = rng.choice(["{}", "<p>{}</p>", "<p>{}</p><p><a href='/z'>ok</a></p>"]).format(pick(3, 30))
    return opened + body + _close(opened)


def compose(article: str, texts: list[str], rng: random.Random) -> tuple[str, str]:
    """(html, opening mark of the main wrapper) of a re-composed page."""
    some = lambda *kinds: "".join(_frame(k, texts, rng) for k in kinds if rng.random() < 0.6)
    opened = rng.choice(MAIN)
    mark = f'data-main="{rng.randint(1, 10**9)}"'
    wrapped = opened[:-1] + f" {mark}>"
    if rng.random() < 0.5:  # something of the frame inside the article
        cut = [m.start() for m in re.finditer(r"<p>", article)]
        at = rng.choice(cut) if cut else len(article)
        article = article[:at] + _frame(rng.choice(["advert", "share", "notice", "side", "form"]), texts, rng) + article[at:]
    inner = wrapped + article + _close(opened)
    if rng.random() < 0.5:
        inner = '<div class="container">' + some("menu") + inner + some("side", "comment") + "</div>"
    page = ("<html><head><title>x</title></head><body>" + some("notice", "header", "menu", "advert") + inner
            + some("advert", "share", "side", "form", "comment", "notice", "footer") + "</body></html>")
    return page, mark


_ARTICLE = re.compile(r"<(article|main)\b[^>]*>(.*?)(?:</\1>|\Z)", re.S | re.I)
MARKED = r"(?i)<(article|main)\b[^>]*>"  # the same pages, for Spark
WORDS = ("the of and a to in is was he for it with as his on be at by had not are but from or have an they which one you "
         "were her all she there would their we him been has when who will more no if out so said what up its about into "
         "than them can only other new some could time these two may then do first any my now such like our over").split()


def _bare(article: str, texts: list[str], rng: random.Random) -> str:
    """A page whose main text is in no block element."""
    words = [f"<b>{w}</b>" if rng.random() < 0.02 else w
             for _, t, _ in Page(article).blocks for w in html.escape(t).split()]
    some = lambda: _frame(rng.choice(list(FRAME)), texts, rng) if rng.random() < 0.3 else ""
    return some() + " ".join(words[:rng.choice([30, 100, len(words)])]) + some()


def _labels(page: Page, mains: set[int]) -> np.ndarray:
    """1 for nodes in a main wrapper and not in a frame element inside it."""
    y = np.zeros(len(page.tag), dtype=bool)
    for i in range(1, len(page.tag)):
        frame = page.words[i] in _FRAMES or page.tag[i] in ("nav", "aside", "footer", "form", "header")
        y[i] = i in mains or (y[page.parent[i]] and not frame)
    return y


def _all_frames() -> frozenset:
    out = set()
    for group in FRAME.values():
        for opened in group:
            tag, attrs = re.match(r"<(\w+)([^>]*)>", opened).groups()
            out.add(_words(tag, attrs))
    return frozenset(out)


_FRAMES = _all_frames()


class Model:
    """Vocabulary and trees; scores and decodes pages."""

    def __init__(self, vocabulary: Vocabulary, trees: Boosted):
        self.vocabulary, self.trees = vocabulary, trees

    def texts(self, sources: list[str | None]) -> list[str]:
        pages = [Page(s or "") for s in sources]
        rows = [features(p, self.vocabulary) for p in pages]
        odds = self.trees.log_odds(np.concatenate(rows)) if rows else np.zeros(0)
        out, at = [], 0
        for p in pages:
            out.append(p.text(decode(p, odds[at:at + len(p.tag)])))
            at += len(p.tag)
        return out


def _made_articles(sources: list[str], rng: random.Random, count: int = SAMPLE_PAGES) -> list[str]:
    """Articles for pages that mark none: runs of their long text blocks."""
    blocks = [html.escape(t) for s in sources for _, t, linked in Page(s).blocks if len(t) > 80 and 2 * linked < len(t)]
    if len(blocks) < 20:
        blocks += [" ".join(rng.choices(WORDS, k=rng.randint(8, 18))).capitalize() + ". " for _ in range(200)]
    out = []
    for _ in range(count):
        paras = ["".join(f"<p>{' '.join(rng.choices(blocks, k=rng.randint(1, 3)))}</p>") for _ in range(rng.randint(1, 8))]
        out.append(f"<h1>{' '.join(rng.choice(blocks).split()[:rng.randint(2, 8)])}</h1>" + "".join(paras))
    return out


def fit(sources: list[str], variants: int = VARIANTS) -> Model:
    """Train on html pages that mark their main text; without any, on made articles."""
    found = [(s, m[2]) for s in sources if (m := _ARTICLE.search(s))]
    if not found:
        found = [(f"<html><body><article>{a}</article></body></html>", a)
                 for a in _made_articles(sources, random.Random(len(sources)))]
    texts = [t for s, _ in found for _, t, _ in Page(s).blocks if len(t) > 20] or ["text"]
    texts = [html.escape(t) for t in texts[:20_000]]
    pages, labels = [], []
    for s, article in found:
        page = Page(s)
        mains = {i for i, t in enumerate(page.tag) if t in ("article", "main")}
        pages.append(page)
        labels.append(_labels(page, mains))
        rng = random.Random(zlib.crc32(s.encode("utf-8", "replace")))
        for _ in range(variants):
            source, mark = compose(article, texts, rng)
            page = Page(source)
            place = source.index(mark)
            node = len(Page(source[:source.rindex("<", 0, place)]).tag)  # the wrapper's own number
            pages.append(page)
            labels.append(_labels(page, {node}))
        page = Page(_bare(article, texts, rng))
        pages.append(page)
        labels.append(_labels(page, {i for i, t in enumerate(page.tag) if t == "#text"}))
    vocabulary = Vocabulary(pages)
    x = np.concatenate([features(p, vocabulary) for p in pages])
    return Model(vocabulary, Boosted().fit(x, np.concatenate(labels).astype(float)))


def sample(pages: DataFrame, size: int = SAMPLE_PAGES) -> list[str]:
    """About ``size`` of the pages that mark their main text (of all, where
    none does) by the hash of their id: the training sample."""
    known = pages.filter(F.col("page_id").isNotNull() & F.col("html").isNotNull())
    marked = known.filter(F.col("html").rlike(MARKED))
    n = marked.count()
    if not n:
        marked, n = known, known.count()
    space = 1 << 40
    limit = min(space, 2 * size * space // max(n, 1))  # twice the wanted number is expected; the surplus goes
    place = F.pmod(F.xxhash64("page_id"), F.lit(space))
    rows = marked.select("page_id", "html", place.alias("place")).filter(F.col("place") < limit).collect()
    return [r["html"] for r in sorted(rows, key=lambda r: (r["place"], r["page_id"], r["html"]))][:size]


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """page_id, url, text, n_chars for every page."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = []
            for start in range(0, len(pdf), 200):
                own = pdf["html"].iloc[start:start + 200].tolist()
                texts += model.texts(own)
            yield pd.DataFrame({"page_id": pdf["page_id"].to_numpy(), "url": pdf["url"].to_numpy(), "text": texts,
                                "n_chars": [len(t) for t in texts]})
    return map_in_pandas(pages.select("page_id", "url", "html"), run,
                         "page_id long, url string, text string, n_chars long", ids=("page_id",))
