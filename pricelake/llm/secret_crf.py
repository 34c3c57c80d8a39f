"""Secret scans: fixed patterns plus a linear-chain CRF (operator 10).

Base spans come from three fixed patterns.  A conditional random field over
the tokens O (outside), B (secret begins), I (secret goes on) adds spans that
the patterns miss: values of the shape of a secret in the company of words
that go with secrets.

Features of a token: its shape, length and character mix and (hashed) word;
the same of its left and right neighbour; features of the file: size, share
of digits, number of assignments.  Weights are trained here by forward-
backward gradients (AdaGrad, fixed number of rounds, no randomness) on token
windows of a bounded sample of documents (``SAMPLE_DOCS``, by hash of the id)
whose labels are the base spans.  Documents with a base match are a stratum of
their own (``SECRET_DOCS``), so rare secrets are learned from as well.  Of the
sample's windows at most ``SECRET_WINDOWS`` hold a secret (``SECRETS_A_TEXT`` a
document) and ``PLAIN_WINDOWS`` none.  The base patterns show few shapes, so
secrets of other shapes, drawn from character classes, are put into
``MADE_WINDOWS`` plain windows beside names of many kinds or bare in prose, and
plain values (numbers, paths, identifiers) beside such names into
``DECOY_WINDOWS``.  Names are outside.

Decoding is exact Viterbi on whole texts.  A token whose best secret score is
below its outside score by more than any change of the transitions and of the
token after it can make good is outside on every best path, so such tokens cut a text into short
independent stretches; only the rest is decoded step by step.

Edge cases: null and empty texts have no span; an empty table gives an empty
result; without a text to train on the CRF adds nothing; repeated rows get
equal answers; very long texts are read whole, in linear time.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import map_in_pandas, materialize

# ---------------------------------------------------------------------------
# The base patterns and their least lengths, kinds in order.
# ---------------------------------------------------------------------------
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_MIN = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_MIN = 18
HEX = re.compile(r"[0-9a-f]{16,}")  # the runs of [0-9a-f]+ of 16 or more
# A text with a base match, for Spark (sampling only).
MATCHED = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12,}"""
           r"|AKIA[A-Z0-9]{14,}|[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "crf")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

TOKEN = re.compile(r"[^\W_]+(?:[+/_.\-][^\W_]+)*|[^\w\s]+|_+")
SAMPLE_DOCS = 6000
SECRET_DOCS = 600  # of the sample, documents with a base match
SECRET_WINDOWS = 400
PLAIN_WINDOWS = 500
SECRETS_A_TEXT = 3  # windows around secrets of one document
MADE_WINDOWS = 900
DECOY_WINDOWS = 300
WINDOW = 24
ROUNDS = 40
WORDS = 400
BUCKETS = 1 << 13
MAX_TOKENS = 300_000
MARKS = "\"'`,;"  # they end a value and are no part of it
O, B, I = 0, 1, 2
NEVER = -1e4

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """Base spans (start, end, kind) by start, then kind as listed."""
    spans: list[Span] = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_MIN]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(spans, key=_by_start)


def _by_start(s: Span):
    return s[0], KINDS.index(s[2]), s[1]


def value_spans(text: str) -> list[tuple[int, int]]:
    """The secret values themselves (group 2 of an assignment), for labels."""
    out = [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]
    out += [s[:2] for s in base_spans(text) if s[2] != "assign"]
    return out


# --------------------------------------------------------------- features
def _bucket(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "replace")) % BUCKETS


def _shape(token: str) -> str:
    kinds = ["A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c for c in token[:64]]
    return "".join(k for i, k in enumerate(kinds) if i == 0 or kinds[i - 1] != k)[:10]


def token_features(token: str, words: frozenset[str]) -> list[int]:
    digits = sum(c.isdigit() for c in token)
    letters = sum(c.isalpha() for c in token)
    upper = sum(c.isupper() for c in token)
    n = len(token)
    turns = sum(a.isdigit() != b.isdigit() for a, b in zip(token, token[1:]))
    size = min(n.bit_length() * 2 + (n >> max(0, n.bit_length() - 2) & 1), 14)
    turns = min(turns, 8)
    both = digits > 0 and letters > 0
    share = min(4, 5 * digits // n)
    case = [c.isupper() if c.isalpha() else None for c in token]
    switches, longest, run = 0, 0, 0
    for a, b in zip([None, *case], case):
        run = 0 if b is None else run + 1 if a == b else 1
        switches += a is not None and b is not None and a != b
        longest = max(longest, run)
    names = [f"size={size}", f"digits={share}", f"turns={turns}", f"both={both},{size}", f"turns,size={turns},{size}",
             f"switches={min(switches, 8)},{size}", f"run={min(longest, 12)},{size}",
             f"mixed={min(switches + turns, 9)},{share},{size}", f"shape={_shape(token)}", f"case={min(4, 5 * upper // n)},{digits > 0},{n > 11}"]
    if token.lower() in words:
        names.append("word=" + token.lower())
    return [_bucket(x) for x in names]


def file_features(text: str) -> list[int]:
    n = len(text)
    digits = sum(map(text.count, "0123456789"))
    return [_bucket(f"file size={n.bit_length()}"), _bucket(f"file digits={min(9, 100 * digits // (n + 1))}"),
            _bucket(f"file assigns={min(3, text.count('=')).bit_length()}")]


# --------------------------------------------------------------- training
class Weights:
    """Emission tables for the own, left and right token and the file
    (buckets x 3 tags), transitions (3 x 3) and first tags (3)."""

    def __init__(self):
        self.emit = np.zeros((4, BUCKETS, 3), dtype=np.float32)
        self.move = np.zeros((3, 3), dtype=np.float32)
        self.move[O, I] = NEVER
        self.first = np.array([0, 0, NEVER], dtype=np.float32)
        self.trained = False
        self.words: frozenset[str] = frozenset()  # words with a feature of their own


def windows(text: str) -> list[tuple[list[str], list[int]]]:
    """Labelled token windows of a text: around each secret, and one more at
    a place given by the text's checksum."""
    found = [(m.start(), m.end(), m[0]) for m in TOKEN.finditer(text)]
    if not found:
        return []
    tags = [O] * len(found)
    for start, end in value_spans(text):
        inside = [i for i, (a, b, _) in enumerate(found) if a < end and b > start]
        for k, i in enumerate(inside):
            tags[i] = B if k == 0 else I
    middles = [i for i, t in enumerate(tags) if t == B][:SECRETS_A_TEXT]
    middles.append(zlib.crc32(text.encode("utf-8", "replace")) % len(found))
    out = []
    for mid in middles:
        low, high = max(0, mid - WINDOW), mid + WINDOW
        out.append(([t for _, _, t in found[low:high]], tags[low:high]))
    return out


def _recased(tokens: list[str], tags: list[int]) -> list[str]:
    """The window with the letters of its secrets in mixed case: the fixed
    patterns label mostly one case, secrets come in any."""
    return ["".join(c.upper() if (k + zlib.crc32(t.encode())) % 3 else c.lower() for k, c in enumerate(t))
            if tag != O else t for t, tag in zip(tokens, tags)]


# ---------------------------------------------------------------------------
# Parts of the names and classes of characters of made secrets.
# ---------------------------------------------------------------------------
OWNERS = "client db database aws service admin user private access auth session deploy root app my prod mail cloud".split()
THINGS = "key secret pass passphrase pwd auth credential credentials token cert signature pin login hash".split()
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALPHABETS = ["0123456789abcdef", "0123456789ABCDEF", LOWER + DIGITS, UPPER + DIGITS, LOWER + UPPER + DIGITS,
             LOWER + UPPER + DIGITS, LOWER + UPPER + DIGITS + "+/", LOWER + UPPER]


def _name(rng: random.Random) -> str:
    parts = [rng.choice(OWNERS), rng.choice(THINGS)] if rng.random() < 0.6 else [rng.choice(THINGS)]
    if rng.random() < 0.2:
        parts.insert(1, rng.choice(OWNERS))
    if rng.random() < 0.1:
        return "".join(rng.choice(UPPER) for _ in range(rng.randint(2, 3)))
    way = rng.randrange(4)
    if way == 0:
        return "".join([parts[0], *(p.capitalize() for p in parts[1:])])
    name = rng.choice("__-.").join(parts)
    return name.upper() if way == 1 else name


def _drawn(rng: random.Random) -> str:
    """A secret's value: characters of one class, some prefixed or in groups."""
    draw = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    letters, kind = rng.choice(ALPHABETS), rng.random()
    size = rng.randint(16, 48) if rng.random() < 0.8 else rng.randint(48, 160)
    if kind < 0.5:
        return draw(letters, size) + "=" * rng.choice([0, 0, 0, 1, 2])
    if kind < 0.7:  # one or two words before the rest
        lead = [draw(LOWER, rng.randint(2, 5)) for _ in range(rng.randint(1, 2))]
        return rng.choice("_-").join([*lead, draw(letters, size)])
    groups = rng.randint(2, 5)
    return rng.choice("--_.").join(draw(rng.choice([letters, letters, DIGITS]) if i < groups - 1 else letters,
                                        rng.randint(4, max(12, size // 2))) for i in range(groups))


def _decoy(rng: random.Random, words: list[str]) -> str:
    """A plain value."""
    some = lambda n: [rng.choice(words) for _ in range(n)]
    kind = rng.randrange(8)
    if kind == 0:
        return str(rng.randint(0, 10**rng.randint(1, 12)))
    if kind == 1:
        return "/" + "/".join(some(rng.randint(2, 5)))
    if kind == 2:
        return "https://" + ".".join(some(2)) + "/" + "-".join(some(rng.randint(2, 6)))
    if kind == 3:
        return "".join(w.capitalize() for w in some(rng.randint(2, 4)))
    if kind == 4:
        return rng.choice("_-.").join(some(rng.randint(2, 5)))
    if kind == 5:
        return f"{rng.randint(1990, 2030)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}" + rng.choice(["", "T10:20:30", " 10:20"])
    if kind == 6:
        return f"{rng.choice(words)}.{rng.choice(words)}{rng.randint(0, 99)}@{rng.choice(words)}.com"
    return rng.choice(["+", "", "0"]) + rng.choice("- ").join(str(rng.randint(10, 9999)) for _ in range(rng.randint(2, 5)))


def _placed(tokens: list[str], rng: random.Random, decoy: bool) -> tuple[list[str], list[int]]:
    """A plain window with a made secret, or a decoy, at some place."""
    words = [t.lower() for t in tokens if t.isalpha() and t.isascii()] or ["word"]
    value = _decoy(rng, words) if decoy else _drawn(rng)
    quote = rng.choice(["", "", '"', "'"])
    if rng.random() < 0.3:
        before, after = quote, quote + rng.choice(["", ".", ","])
    else:
        mark = rng.choice(["=", "=", " = ", ": ", ":", " := ", " is ", " "])
        before, after = rng.choice(["", "", "export ", "set ", quote]) + _name(rng) + mark + quote, quote + rng.choice(["", "", ",", ";"])
    text, tags, found = before + value + after, [], []
    for m in TOKEN.finditer(text):
        inside = not decoy and m.start() < len(before) + len(value) and m.end() > len(before)
        found.append(m[0])
        tags.append(O if not inside else I if tags and tags[-1] != O else B)
    low = max(0, min(rng.randrange(len(tokens) + 1), 2 * WINDOW - len(found)))
    tokens, tags = tokens[:low] + found + tokens[low:], [O] * low + tags + [O] * (len(tokens) - low)
    return tokens[:2 * WINDOW], tags[:2 * WINDOW]


def made_windows(plain: list[tuple[list[str], list[int], list[int]]], secrets: int = MADE_WINDOWS,
                 decoys: int = DECOY_WINDOWS) -> list[tuple[list[str], list[int], list[int]]]:
    """Plain windows with made secrets and decoys put in, the same in each run."""
    rng = random.Random(len(plain))
    out = []
    for k in range(secrets + decoys if plain else 0):
        tokens, _, of_file = plain[k % len(plain)]
        out.append((*_placed(tokens, rng, k >= secrets), of_file))
    return out


def train(sample: list[tuple[list[str], list[int], list[int]]], rounds: int = ROUNDS) -> Weights:
    """Weights from (tokens, tags, file features) windows."""
    w = Weights()
    sample = sample + [(_recased(tokens, tags), tags, of_file) for tokens, tags, of_file in sample if B in tags]
    sample += made_windows([x for x in sample if B not in x[1]])
    if not any(B in tags for _, tags, _ in sample):
        return w
    w.trained = True
    near: dict[str, int] = {}
    for tokens, tags, _ in sample:
        for i in (i for i, t in enumerate(tags) if t != O):
            for t in tokens[max(0, i - 2):i + 3]:
                near[t.lower()] = near.get(t.lower(), 0) + 1
    w.words = frozenset(sorted((t for t, k in near.items() if k > 2), key=lambda t: (-near[t], t))[:WORDS])
    length = 2 * WINDOW
    n = len(sample)
    width = 11
    feats = np.zeros((n, length, 4, width), dtype=np.int32)
    on = np.zeros((n, length, 4, width), dtype=np.float32)
    tags = np.zeros((n, length), dtype=np.int64)
    mask = np.zeros((n, length), dtype=bool)
    for s, (tokens, own_tags, of_file) in enumerate(sample):
        own = [token_features(t, w.words) for t in tokens]
        for i in range(len(tokens)):
            for part, fs in enumerate((own[i], own[i - 1] if i else [], own[i + 1] if i + 1 < len(own) else [], of_file)):
                feats[s, i, part, :len(fs)] = fs
                on[s, i, part, :len(fs)] = 1
        tags[s, :len(tokens)] = own_tags
        mask[s, :len(tokens)] = True
    parts = np.arange(4)[None, None, :, None]
    where = np.nonzero(on)
    cells = feats[where] + where[2] * BUCKETS
    allowed_move = (w.move > NEVER / 2).astype(np.float32)
    seen_emit = np.full_like(w.emit, 1e-6)
    seen_move = np.full_like(w.move, 1e-6)
    last = mask.sum(1) - 1
    rows = np.arange(n)
    gold = np.eye(3, dtype=np.float32)[tags] * mask[..., None]
    gold_move = np.zeros((3, 3), dtype=np.float32)
    both = mask[:, 1:]
    np.add.at(gold_move, (tags[:, :-1][both], tags[:, 1:][both]), 1)
    for _ in range(rounds):
        e = np.einsum("slpf,slpft->slt", on, w.emit[parts, feats])
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0] + w.first
        for t in range(1, length):
            step = _logsumexp(alpha[:, t - 1, :, None] + w.move[None], 1) + e[:, t]
            alpha[:, t] = np.where(mask[:, t, None], step, alpha[:, t - 1])
        total = _logsumexp(alpha[rows, last], 1)
        expected_move = np.zeros((3, 3), dtype=np.float32)
        for t in range(length - 2, -1, -1):
            ahead = e[:, t + 1] + beta[:, t + 1]
            step = _logsumexp(w.move[None] + ahead[:, None, :], 2)
            beta[:, t] = np.where(mask[:, t + 1, None], step, beta[:, t])
            p = np.exp(alpha[:, t, :, None] + w.move[None] + ahead[:, None, :] - total[:, None, None])
            expected_move += (p * mask[:, t + 1, None, None]).sum(0)
        node = np.exp(alpha + beta - total[:, None, None]) * mask[..., None]
        push = (gold - node)[where[0], where[1]]
        grad = np.stack([np.bincount(cells, push[:, t], 4 * BUCKETS) for t in range(3)], axis=1)
        grad = grad.reshape(w.emit.shape).astype(np.float32) - 0.02 * w.emit
        seen_emit += grad * grad
        w.emit += 0.5 * grad / np.sqrt(seen_emit)
        move = (gold_move - expected_move - 0.02 * w.move) * allowed_move
        seen_move += move * move
        w.move += 0.5 * move / np.sqrt(seen_move)
    return w


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def has_base_match(text: str = "text"):
    """Column: the text holds a base match.  Only texts with a mark that an
    assignment or access key needs go through the long pattern."""
    c = F.col(text)
    marked = c.contains("=") | c.contains(":") | c.contains("AKIA")
    return F.when(marked, c.rlike(MATCHED)).otherwise(c.rlike("[0-9a-f]{16}"))


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, secret_docs: int = SECRET_DOCS) -> Weights:
    """Train on windows of about ``sample_docs`` documents, ``secret_docs`` of
    them with a base match, chosen by the hash of their id; the windows are
    all that reaches the driver.  Texts are matched once: ids and matches are
    written, the picked ids (at most twice the sample) fetch their texts."""
    space = 1 << 40
    rows = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    known = materialize(rows.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(space)).alias("place"),
                                    has_base_match().alias("matched")))
    counts = {r["matched"]: r["count"] for r in known.groupBy("matched").count().collect()}
    limits = [min(space, size * space // max(counts.get(matched, 0), 1))
              for matched, size in ((True, secret_docs), (False, sample_docs - secret_docs))]
    picked = (known.filter(F.col("place") < F.when(F.col("matched"), limits[0]).otherwise(limits[1]))
              .select("doc_id").distinct())

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(i, k, tokens, tags, file_features(t))
                    for i, t in zip(pdf["doc_id"].tolist(), pdf["text"].tolist())
                    for k, (tokens, tags) in enumerate(windows(t))]
            yield pd.DataFrame(rows, columns=["doc_id", "k", "tokens", "tags", "file"])
    cuts = (rows.select("doc_id", "text").join(F.broadcast(picked), "doc_id", "left_semi")
            .mapInPandas(cut, "doc_id long, k int, tokens array<string>, tags array<int>, file array<int>").collect())
    cuts.sort(key=lambda r: (zlib.crc32(f"{r['doc_id']} {r['k']}".encode()), r["doc_id"], r["k"], r["tokens"]))
    secret = [r for r in cuts if B in r["tags"]][:SECRET_WINDOWS]
    plain = [r for r in cuts if B not in r["tags"]][:PLAIN_WINDOWS]
    return train([(r["tokens"], r["tags"], r["file"]) for r in secret + plain])


# --------------------------------------------------------------- decoding
class Tagger:
    """Viterbi spans of whole texts; keeps the scores of tokens it has met."""

    def __init__(self, w: Weights):
        self.w = w
        finite = w.move[w.move > NEVER / 2]
        # making one tag O, and an I after it B, changes three transitions
        self.reach = 3 * float(finite.max() - finite.min()) if w.trained else 0.0
        self._reset()

    def _reset(self) -> None:
        self.ids: dict[str, int] = {}
        self.alike: dict[tuple[int, int], int] = {}  # plain words of one length and case: one row
        self.rows = np.zeros((1 << 12, 3, 3), dtype=np.float32)  # own, as left, as right neighbour
        self.used = 0

    def _row(self, token: str) -> int:
        if self.used == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[self.used] = self.w.emit[:3, token_features(token, self.w.words)].sum(axis=1)
        self.used += 1
        return self.used - 1

    def _id(self, token: str) -> int:
        """The score row of a token not met before."""
        case = None
        if token.isalpha() and token.lower() not in self.w.words:
            case = 0 if token.islower() else 1 if token[0].isupper() and token[1:].islower() else None
        if case is None:
            i = self._row(token)
        else:
            key = (len(token), case)
            if key not in self.alike:
                self.alike[key] = self._row(token)
            i = self.alike[key]
        self.ids[token] = i
        return i

    def spans(self, text: str) -> list[tuple[int, int]]:
        tokens = TOKEN.findall(text) if self.w.trained else []
        if not tokens:
            return []
        if len(self.ids) > MAX_TOKENS:
            self._reset()
        get = self.ids.get
        ids = np.array([i if (i := get(t)) is not None else self._id(t) for t in tokens])
        e = self.rows[ids, 0]
        e[1:] += self.rows[ids[:-1], 1]
        e[:-1] += self.rows[ids[1:], 2]
        e += self.w.emit[3, file_features(text)].sum(axis=0)
        maybe = np.flatnonzero(self._maybe(e))
        if not len(maybe):
            return []
        found = [i for stretch in np.split(maybe, np.flatnonzero(np.diff(maybe) > 1) + 1)
                 for i in self._decode(e, int(stretch[0]), int(stretch[-1]) + 1)]
        if not found:
            return []
        places = [m.span() for m in TOKEN.finditer(text)]
        return [(places[a][0], places[b][1]) for a, b in found]

    def _maybe(self, e: np.ndarray) -> np.ndarray:
        """Tokens that some best path may tag as secret: for any other, O there
        (and B for an I after it) scores more."""
        gain = np.maximum(e[:, B], e[:, I]) - e[:, O] + self.reach
        gain[:-1] += np.maximum(0, e[1:, I] - e[1:, B])
        return gain >= 0

    def _decode(self, e: np.ndarray, low: int, high: int) -> list[tuple[int, int]]:
        """(first, last) tokens of the secrets in [low, high), where the
        tokens on either side are outside (or the text ends)."""
        move = self.w.move
        score = e[low] + (move[O] if low else self.w.first)
        back = []
        for t in range(low + 1, high):
            steps = score[:, None] + move
            back.append(steps.argmax(axis=0))
            score = steps.max(axis=0) + e[t]
        if high < len(e):
            score = score + move[:, O]
        tag = int(score.argmax())
        tags = [tag]
        for b in reversed(back):
            tag = int(b[tag])
            tags.append(tag)
        tags.reverse()
        out: list[tuple[int, int]] = []
        for i, tag in enumerate(tags):
            if tag == B:
                out.append((low + i, low + i))
            elif tag == I and out:
                out[-1] = (out[-1][0], low + i)
        return out


def scan_text(text: str | None, tagger: Tagger) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans); a CRF span inside a base span (closing marks at
    its ends aside) adds nothing."""
    if not text:
        return [], []
    base = base_spans(text)
    added = []
    for a, b in tagger.spans(text):
        low, high = b - len(text[a:b].lstrip(MARKS)), a + len(text[a:b].rstrip(MARKS))
        if not any(x <= low and high <= y for x, y, _ in base):
            added.append((a, b, "crf"))
    return base, sorted(base + added, key=_by_start)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(docs: DataFrame, weights: Weights) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = Tagger(weights)
        for pdf in batches:
            rows = []
            for text in pdf["text"].tolist():
                base, spans = scan_text(text, tagger)
                kinds = [k for _, _, k in base]
                rows.append((*(kinds.count(k) for k in KINDS[:3]),
                             hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])
            out.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield out
    return map_in_pandas(docs.select("doc_id", "text"), find,
                         "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
