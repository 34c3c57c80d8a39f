"""Token ids of whole texts by the tokenizers library, inside Python tasks.

The vocabulary's splitting pattern never joins across white space and its
normaliser treats characters on their own, so a text's ids are the ids of its
white-space separated chunks in order.  Chunks repeat, so each worker keeps
the ids of those it has met lately: when its dictionary is full it becomes the
one before, from which chunks met again move over, and a new one begins.
A chunk of plain Latin-1 characters goes through the library's BPE model
alone after lower-casing and splitting; any other chunk (combining marks,
other scripts, special strings) through the library's whole chain.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import regex

from pricelake.llm.common import kept

# About 200 bytes a chunk, for at most two dictionaries; the more a worker keeps,
# the fewer it meets anew.
MAX_CHUNKS = 300_000
# Latin-1 without its white space and controls: composed already, one-to-one in lower case.
_PLAIN = regex.compile(r"[\x21-\x7e\xa1-\xac\xae-\xff]+")
# str.split() cuts at Unicode white space and at these four, which are no white
# space to the vocabulary's pattern.
_ODD = re.compile("[\x1c-\x1f]")
_MARKS = frozenset(".,;:!?")


def _byte_chars() -> dict[int, str]:
    """Printable stand-ins of the 256 bytes, by the byte-level rule: printable
    Latin-1 bytes stand for themselves, the others follow from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class ChunkIds:
    """Ids of whole texts as little-endian 32-bit bytes.  ``chunks`` holds the
    chunks met lately, ``before`` those of the dictionary before; a lower-case
    pre-token is a chunk of its own."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self.whole = Tokenizer.from_file(path)
        spec = json.loads(self.whole.to_str())
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(split["pattern"]["Regex"])
        self.special = [t["content"] for t in spec["added_tokens"]]
        # the same model behind white space only, for pre-tokens side by side
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = None
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        suffix = spec["model"]["end_of_word_suffix"]
        vocab = self.whole.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)  # ids that end a pre-token
        self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.bytes = _byte_chars()
        self.chunks: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _cut(self, chunk: str) -> list[str]:
        """Lower-case pre-tokens of a plain chunk; none for any other chunk."""
        plain = chunk.isprintable() if chunk.isascii() else _PLAIN.fullmatch(chunk)
        if not chunk or not plain or ("<" in chunk and any(s in chunk for s in self.special)):
            return []
        low = chunk.lower()
        if low.isalpha():
            return [low]
        if low[-1] in _MARKS and low[:-1].isalpha():
            return [low[:-1], low[-1]]
        return self.split.findall(low)

    def _learn_pieces(self, pieces: list[str]) -> None:
        shown = [p if p.isascii() else "".join([self.bytes[b] for b in p.encode()]) for p in pieces]
        rows = self.bare.encode_batch_fast([" ".join(shown[i:i + 500]) for i in range(0, len(shown), 500)],
                                           add_special_tokens=False)
        ids = np.concatenate([np.array(r.ids, dtype="<u4") for r in rows])
        stops = (np.flatnonzero(self.ends[ids]) + 1) * 4
        blob, at = ids.tobytes(), 0
        for piece, stop in zip(pieces, stops.tolist(), strict=True):
            self.chunks[piece] = blob[at:stop]
            at = stop

    def _recall(self, chunks: set[str]) -> set[str]:
        """Chunks of the dictionary before move to the present one; the others."""
        old = self.before
        if not old:
            return chunks
        again = [c for c in chunks if c in old]
        self.chunks.update((c, old[c]) for c in again)
        return chunks.difference(again)

    def _learn(self, chunks: set[str]) -> None:
        known = self.chunks
        cuts, new = {}, set()
        for chunk in chunks:
            if chunk.isascii() and chunk.isalpha() and chunk.islower():  # its own pre-token
                new.add(chunk)
            elif cut := self._cut(chunk):
                cuts[chunk] = cut
                new.update(cut)
            else:
                known[chunk] = np.array(self.whole.encode(chunk, add_special_tokens=False).ids, dtype="<u4").tobytes()
        new = self._recall(new.difference(known))
        if new:
            self._learn_pieces(list(new))
        for chunk, cut in cuts.items():
            known[chunk] = known[cut[0]] if len(cut) == 1 else b"".join([known[p] for p in cut])

    def texts(self, texts: list[str | None], at_once: int = 400) -> Iterator[bytes]:
        """All ids of each text."""
        for i in range(0, len(texts), at_once):
            split = [() if not t else t.split(" ") if _ODD.search(t) else t.split() for t in texts[i:i + at_once]]
            met = set().union(*split)
            new = met.difference(self.chunks)
            if len(self.chunks) + len(new) > MAX_CHUNKS:
                self.before, self.chunks = self.chunks, {}
                new = met
            new = self._recall(new)
            if new:
                self._learn(new)
            get = self.chunks.__getitem__
            for chunks in split:
                yield b"".join(map(get, chunks))


def kept_as(path: str) -> str:
    """The name under which a worker keeps the dictionary of a vocabulary file."""
    return f"chunk ids {path}"


def chunk_ids(path: str) -> ChunkIds:
    """The worker's dictionary for a vocabulary file."""
    return kept(kept_as(path), lambda: ChunkIds(path))
