"""Token counts by compiled finite-state transducers (operator 4).

A byte-level BPE vocabulary is compiled into two deterministic transducers;
neither builds the tokens.

1. The **splitter** reads character classes (letter, number, space, other
   white space, apostrophe, the letters of the contractions, other) and
   annotates transitions with where a pre-token ends (before this character,
   or one or two characters back).  A batch of texts is cut into chunks of
   ``CHUNK`` characters; every chunk is run from all states at once until its
   state map is constant, the maps compose in a parallel prefix scan (pointer
   doubling over the chunks, a map for each chunk), and the chunks are run
   again from their entry states to mark the ends.
2. The **counter** reads the bytes of a pre-token.  Its state holds, for every
   earlier place from which a token may still be running, the vocabulary's
   trie node, the last token before that place and the count there relative to
   the present one.  The last token of a BPE prefix is the only one that
   forms a valid pair with the token before it (pairs are checked against the
   library's model when a transition is compiled), so one transition is
   annotated with the change of the emitted-token count.  States are compiled
   when first met, kept by the worker and dropped when there are
   ``MAX_STATES``.

Counts of pre-tokens met before are kept in a bounded dictionary.  Special
strings inside a text count one token each, as the library does by default.

Edge cases: null and empty texts have 0 tokens; very long texts and very long
pre-tokens take linear time; lone surrogates cannot occur in a Spark string;
null doc_ids and repeated rows are kept; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from pricelake.llm.common import map_in_pandas

LIMIT = 512
CHUNK = 256
WARM_UP = 24
MAX_STATES = 60_000
MAX_PIECES = 400_000
MAX_PAIRS = 400_000
FEW = 8
BATCH_CHARS = 4_000_000

# Character classes of the splitter.
LETTER, NUMBER, SPACE, BLANK, QUOTE, OTHER, L_STMD, L_R, L_V, L_L, L_E, END = range(12)
# ---------------------------------------------------------------------------
# Unicode white space, and the contractions of the splitting
# pattern ('s 't 'm 'd end after one letter, 're 've 'll after two).
# ---------------------------------------------------------------------------
WHITE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")

# States: nothing pending; in a run of letters, numbers, others; a space that
# may join the next run; blanks (a run of white space) that end in a space or
# in another blank; an apostrophe that began a pre-token; the same and r, v, l.
(S0, S_LET, S_NUM, S_OTH, S_SP, S_RUN_SP, S_BL, S_RUN_BL, S_QU, S_QR, S_QV, S_QL, S_CON) = range(13)
N_STATES = 13


def classes() -> np.ndarray:
    """Class of every code point."""
    out = np.full(sys.maxunicode + 1, OTHER, dtype=np.uint8)
    for c in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            out[c] = LETTER
        elif kind == "N":
            out[c] = NUMBER
    out[WHITE] = BLANK
    out[0x20] = SPACE
    out[ord("'")] = QUOTE
    for c in ONE_LETTER:
        out[ord(c)] = L_STMD
    for c, k in (("r", L_R), ("v", L_V), ("l", L_L), ("e", L_E)):
        out[ord(c)] = k
    return out


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """(next state, ends) by state and class.  ends is a bit set: 1, a
    pre-token ends before this character; 2, one ends one character back.
    The filler after a text's end keeps the state."""
    step = np.zeros((N_STATES, 12), dtype=np.uint8)
    ends = np.zeros((N_STATES, 12), dtype=np.uint8)
    letters = (LETTER, L_STMD, L_R, L_V, L_L, L_E)

    def fresh(k: int) -> int:
        """State after a character of class k that begins a pre-token."""
        return (S_LET if k in letters else S_NUM if k == NUMBER else S_SP if k == SPACE else S_BL if k == BLANK
                else S_QU if k == QUOTE else S_OTH)

    def joined(k: int) -> int:
        """The same, if it joins a space before it."""
        return S_OTH if k == QUOTE else fresh(k)

    for k in range(12):
        white = k in (SPACE, BLANK)
        for s in range(N_STATES):
            step[s, k], ends[s, k] = fresh(k), 1
        step[S0, k], ends[S0, k] = fresh(k), 0
        for s, own in ((S_LET, letters), (S_NUM, (NUMBER,)), (S_OTH, (OTHER, QUOTE))):
            if k in own:
                step[s, k], ends[s, k] = s, 0
        # one white-space character so far
        for s in (S_SP, S_BL):
            if white:
                step[s, k], ends[s, k] = (S_RUN_SP if k == SPACE else S_RUN_BL), 0
        # two or more: the last one leaves the run when something follows
        for s in (S_RUN_SP, S_RUN_BL):
            if white:
                step[s, k], ends[s, k] = (S_RUN_SP if k == SPACE else S_RUN_BL), 0
            elif k != END:
                ends[s, k] = 2 if s == S_RUN_SP else 3
        for s in (S_SP, S_RUN_SP):
            if not white and k != END:
                step[s, k] = joined(k)
                ends[s, k] = 0 if s == S_SP else 2
        # an apostrophe that began a pre-token: a contraction, or others, or alone
        if k in (OTHER, QUOTE):
            step[S_QU, k], ends[S_QU, k] = S_OTH, 0
        elif k == L_STMD:
            step[S_QU, k], ends[S_QU, k] = S_CON, 0
        elif k in (L_R, L_V, L_L):
            step[S_QU, k], ends[S_QU, k] = {L_R: S_QR, L_V: S_QV, L_L: S_QL}[k], 0
        # apostrophe and r, v or l: with its second letter a contraction, else
        # the apostrophe was alone and the letter began a run
        for s, second in ((S_QR, L_E), (S_QV, L_E), (S_QL, L_L)):
            if k == second:
                step[s, k], ends[s, k] = S_CON, 0
            elif k in letters:
                step[s, k], ends[s, k] = S_LET, 2
            else:
                ends[s, k] = 3
    step[:, END], ends[:, END] = np.arange(N_STATES), 0
    return step, ends


class Counter:
    """The BPE counting transducer, compiled on demand from a vocabulary."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        self.model = tokenizer.model
        spec = json.loads(tokenizer.to_str())
        self.special = [t["content"] for t in spec["added_tokens"]]
        skip = set(self.special)
        own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in set(own)]
        byte = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}
        self.names: dict[int, str] = {}
        # the vocabulary's trie: node * 256 + byte -> node; each node's token, and
        # the tokens that go on from it, None where they are more than FEW
        self.child: dict[int, int] = {}
        self.token: list[int] = [-1]
        self.beyond: list[list[int] | None] = [None]
        for name, token in sorted(tokenizer.get_vocab().items()):
            if name in skip:
                continue
            self.names[token] = name
            node = 0
            for k, c in enumerate(name):
                at = node * 256 + byte[c]
                if at not in self.child:
                    self.child[at] = len(self.token)
                    self.token.append(-1)
                    self.beyond.append([])
                node = self.child[at]
                few = self.beyond[node]
                if few is not None and k < len(name) - 1:
                    few.append(token)
                    if len(few) > FEW:
                        self.beyond[node] = None
            self.token[node] = token
        self.pieces: dict[str, int] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.alive: dict[tuple[int, int], bool] = {}
        self._reset()

    def _reset(self) -> None:
        # state: ((trie node, last token or -1, count there minus count here), ...)
        self.states: list[tuple] = [((0, -1, 0),)]
        self.known: dict[tuple, int] = {self.states[0]: 0}
        self.moves: dict[int, tuple[int, int]] = {}  # state * 256 + byte -> state, change of the count

    def _pair(self, a: int, b: int) -> bool:
        """Whether tokens a, b are what the model makes of their joined text."""
        if a < 0:
            return True
        got = self.pairs.get((a, b))
        if got is None:
            if len(self.pairs) > MAX_PAIRS:
                self.pairs.clear()
            made = self.model.tokenize(self.names[a] + self.names[b])
            got = self.pairs[a, b] = len(made) == 2 and made[0].id == a
        return got

    def _goes_on(self, node: int, last: int) -> bool:
        """Whether a longer token from this place can still be the last one; a
        place that cannot is dead and leaves the state."""
        few = self.beyond[node]
        if few is None or (last < 0 and few):
            return True
        if not few:
            return False
        got = self.alive.get((node, last))
        if got is None:
            if len(self.alive) > MAX_PAIRS:
                self.alive.clear()
            got = self.alive[node, last] = any(self._pair(last, t) for t in few)
        return got

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        live, token, delta = [], -1, 0
        for node, last, less in self.states[state]:
            child = self.child.get(node * 256 + byte)
            if child is None:
                continue
            if token < 0 and self.token[child] >= 0 and self._pair(last, self.token[child]):
                token, delta = self.token[child], less + 1
            if self._goes_on(child, last):
                live.append((child, last, less))
        target = (*[(n, last, less - delta) for n, last, less in live], (0, token, 0))
        at = self.known.get(target)
        if at is None:
            at = self.known[target] = len(self.states)
            self.states.append(target)
        move = self.moves[state * 256 + byte] = (at, delta)
        return move

    def count(self, piece: str) -> int:
        """Tokens of one pre-token."""
        if len(self.states) > MAX_STATES:
            self._reset()
        state = total = 0
        get = self.moves.get
        for byte in piece.encode("utf-8"):
            state, delta = get(state * 256 + byte) or self._compile(state, byte)
            total += delta
        return total


class Counts:
    """Counts whole texts, a batch at a time."""

    def __init__(self, path: str):
        self.counter = Counter(path)
        self.cls = classes()
        self.step, self.ends = splitter()

    def texts(self, texts: list[str]) -> list[int]:
        totals = [0] * len(texts)
        parts, owner, size = [], [], 0
        for i, text in enumerate(texts):
            for special in self.counter.special:
                if special in text:
                    totals[i] += text.count(special)
                    text = text.replace(special, "\udc00")  # cannot occur in a Spark string
            for part in text.split("\udc00"):
                if part:
                    parts.append(part)
                    owner.append(i)
                    size += len(part)
            if size >= BATCH_CHARS:
                self._add(parts, owner, totals)
                parts, owner, size = [], [], 0
        self._add(parts, owner, totals)
        return totals

    def _add(self, parts: list[str], owner: list[int], totals: list[int]) -> None:
        if not parts:
            return
        pieces = self.counter.pieces
        for text, i, cuts in zip(parts, owner, self.split(parts)):
            total, a = 0, 0
            for b in cuts:
                piece = text[a:b]
                n = pieces.get(piece)
                if n is None:
                    n = self.counter.count(piece)
                    if len(pieces) > MAX_PIECES:
                        pieces.clear()
                    if len(piece) < 64:
                        pieces[piece] = n
                total += n
                a = b
            totals[i] += total

    def split(self, texts: list[str]) -> list[list[int]]:
        """Pre-token ends of each text (its length is the last one)."""
        lengths = np.array([len(t) for t in texts])
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
        n_chunks = -(-lengths // CHUNK)
        first = np.concatenate([[0], np.cumsum(n_chunks)])
        lanes = int(first[-1])
        grid = np.full(lanes * CHUNK, END, dtype=np.uint8)
        starts = np.concatenate([[0], np.cumsum(lengths)])
        shift = np.repeat(first[:-1] * CHUNK - starts[:-1], lengths)
        grid[np.arange(len(codes)) + shift] = self.cls[codes]
        grid = np.ascontiguousarray(grid.reshape(lanes, CHUNK).T)
        entry = self._entries(grid, first[:-1])
        marks = np.empty((CHUNK, lanes), dtype=np.uint8)
        flat_step, flat_ends = self.step.ravel(), self.ends.ravel()
        state = entry.astype(np.intp)
        for k in range(CHUNK):
            at = state * 12 + grid[k]
            marks[k] = flat_ends[at]
            state = flat_step[at].astype(np.intp)
        marks = marks.T.ravel()[np.arange(len(codes)) + shift]
        places = np.concatenate([np.flatnonzero(marks & 1), np.flatnonzero(marks & 2) - 1, starts[1:]])
        # an apostrophe with r, v or l at the very end: two pre-tokens
        last = state[first[1:] - 1]
        tail = starts[1:][(last == S_QR) | (last == S_QV) | (last == S_QL)] - 1
        places = np.unique(np.concatenate([places, tail]))
        places = places[places > 0]
        cut = np.searchsorted(places, starts[:-1], side="right")
        stop = np.searchsorted(places, starts[1:], side="right")
        return [(places[a:b] - s).tolist() for a, b, s in zip(cut, stop, starts[:-1])]

    def _entries(self, grid: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Entry state of each chunk: its predecessors' state maps composed."""
        lanes = grid.shape[1]
        maps = np.repeat(np.arange(N_STATES, dtype=np.uint8)[:, None], lanes, axis=1)
        for k in range(WARM_UP):
            maps = self.step[maps, grid[k]]
        constant = (maps == maps[0]).all(axis=0)
        single = maps[0]
        for k in range(WARM_UP, CHUNK):
            single = self.step[single, grid[k]]
        rest = np.flatnonzero(~constant)
        slow = maps[:, rest]
        for k in range(WARM_UP, CHUNK):
            if not len(rest):
                break
            slow = self.step[slow, grid[k, rest]]
        maps = np.broadcast_to(single, (N_STATES, lanes)).copy()
        maps[:, rest] = slow
        # a text's first chunk starts afresh: make the map before it constant
        before = np.concatenate([np.zeros((N_STATES, 1), dtype=np.uint8), maps[:, :-1]], axis=1)
        before[:, first] = S0
        reach = 1
        while reach < lanes and (before != before[0]).any():
            earlier = before[:, :-reach]
            before[:, reach:] = np.take_along_axis(before[:, reach:], earlier.astype(np.intp), axis=0)
            reach *= 2
        return before[0]


_LOADED: dict[str, Counts] = {}


def counts(path: str) -> Counts:
    """The worker's compiled transducers for a vocabulary file."""
    if path not in _LOADED:
        _LOADED[path] = Counts(path)
    return _LOADED[path]


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every document."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compiled = counts(path)
        for pdf in batches:
            texts = [t or "" for t in pdf["text"].tolist()]
            n = np.array(compiled.texts(texts), dtype=np.int64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy(), "n_bytes": [len(t.encode()) for t in texts],
                                "n_tokens": n, "over_limit": n > limit})
    return map_in_pandas(docs.select("doc_id", "text"), run,
                         "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
