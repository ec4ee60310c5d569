"""Token ids by a public tokenizer, with the ids of pieces of text kept for reuse within a worker.

A text is cut where its tokenizer always cuts (before and after white space, and after a run of plain letters that a
mark follows), so that the ids of the pieces, put together, are those of the text. Natural text repeats its pieces,
and each is encoded once as long as the table has room. A text that holds one of the tokenizer's special tokens is
not cut.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

SPACE = "\t-\r \x85\xa0  -     　"
LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]+(?=[ ,.!\n]|\\Z)"
#: For each known file: how its texts may be cut.
PIECES = {
    "byte_bpe_50k.json": re.compile(f" ?{LETTERS}| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"),
    "word_bpe_49k.json": re.compile(f"{LETTERS}|[^{SPACE}]+"),
}
MOST_KEPT = 900_000
LONGEST_KEPT = 40
WORD_END = "</w>"

_ENCODERS: dict[str, "Encoder"] = {}


class Encoder:
    """Ids of texts as little-endian unsigned 16-bit bytes, those of the library without added tokens; ``whole`` without cutting."""

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids must fit in 16 bits")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cut = PIECES[name].findall
        self.kept: dict[str, bytes] = {}
        ends = [k for token, k in self.tokenizer.get_vocab().items() if token.endswith(WORD_END)]
        self.ends_word = np.zeros(1 << 16, dtype=bool)
        if len(ends) > 1:
            self.ends_word[ends] = True

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _words(self, new: list[str]) -> list[str]:
        """Keeps the ids of plain words where the last id of a word is marked, many in one call; returns the other pieces."""
        if not self.ends_word.any():
            return new
        words = [p for p in new if len(p) <= LONGEST_KEPT and p.isalpha() and (p.isascii() or max(p) <= "\xff")]
        for start in range(0, len(words), 4000):
            part = words[start:start + 4000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, dtype="<u2")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(part):
                data, at = ids.tobytes(), 0
                for piece, end in zip(part, (ends * 2).tolist()):
                    self.kept[piece] = data[at:end]
                    at = end
        return [p for p in new if p not in self.kept]

    def release(self) -> None:
        """Forget the pieces: for a task that shares its worker with other work to come."""
        self.kept.clear()

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.kept) > MOST_KEPT:
            self.kept.clear()
        special = [any(map(t.__contains__, self.special)) for t in texts]
        if any(special):
            plain = iter(self.encode([t for t, s in zip(texts, special) if not s]))
            return [array("H", self.whole(t)).tobytes() if s else next(plain) for t, s in zip(texts, special)]
        cut = [self.cut(t) for t in texts]
        new: set[str] = set()
        for pieces in cut:
            new.update(pieces)
        new = self._words([p for p in new if p not in self.kept])
        for start in range(0, len(new), 20_000):
            part = new[start:start + 20_000]
            for piece, coded in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self.kept[piece] = np.array(coded.ids, dtype="<u2").tobytes()
        known = self.kept.__getitem__
        joined = [b"".join(map(known, pieces)) for pieces in cut]
        for piece in new:
            if len(piece) > LONGEST_KEPT:
                del self.kept[piece]
        return joined


def encoder(name: str) -> Encoder:
    """The worker's encoder for a file of the public tokenizers."""
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(name)
    return _ENCODERS[name]
