"""Public tokenizers with a cache of pre-tokens, used inside tasks.

Byte-level BPE never merges over a pre-token's edge, so a text's ids are its
pre-tokens' ids joined.  Most pre-tokens of a corpus repeat; a bounded cache
per Python worker turns them into one dictionary look-up.
"""

from __future__ import annotations

import base64
import os
import re
import unicodedata
from array import array
from functools import lru_cache
from itertools import islice

import numpy as np

from lakeshore.llm.common import Cache

#: Folder of the public vocabulary files (a parameter of every function that reads one).
TOKENIZER_DIR = "/opt/tokenizers"
#: Last code point of the alphabets that the fast path splits by itself.
_PLAIN_END = 0x24F


def _char_class(prefix: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(_PLAIN_END + 1) if unicodedata.category(chr(c)).startswith(prefix))


def _plain_pattern() -> re.Pattern:
    """The vocabulary's published pre-token rule over code points up to U+024F."""
    letters, numbers, space = _char_class("L"), _char_class("N"), r"\t-\r \x85\xa0"
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+"
                      rf"|[{space}]+(?![^{space}])|[{space}]+")


_OTHER = re.compile(rf"[^\x00-{chr(_PLAIN_END)}‐-…]")
#: What ends a sentence or a line, in the scripts that have signs of their own for it.
_ENDS = tuple(c.encode() for c in ".!?\n。！？｡।॥؟۔…։።")
#: Entries of each word cache (about 60 MB a worker).
WORDS = 400_000
#: Pre-tokens turned into ids at a time in a very long text.
_SLICE = 200_000


class ByteBpe:
    """ids(text) equals ``Tokenizer.from_file(...).encode(text, add_special_tokens=False).ids``."""

    def __init__(self, folder: str, name: str = "byte_bpe_50k") -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(os.path.join(folder, f"{name}.json"))
        with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.specials = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.size = max(self.whole.get_vocab_size(), max(ranks.values()) + 1)
        pattern = _plain_pattern()
        self.split, self.find = pattern.findall, pattern.finditer
        # A piece is encoded alone, so the pattern here only has to keep it whole.
        self.encode = tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.cache: dict[str, bytes] = Cache(self._piece)
        ends = np.zeros(self.size, bool)
        for token, i in ranks.items():
            ends[i] = token.rstrip(b" \"')]").endswith(_ENDS)
        self.sentence_end = ends
        self.words = Cache(lambda word: array("I", self.encode(f" {word}")).tobytes(), WORDS)

    def word_ids(self, words: list[str]) -> np.ndarray:
        """Ids of the words, each with one space before it (no token of the vocabulary crosses a pre-token's edge)."""
        return np.frombuffer(b"".join(map(self.words.__getitem__, words)), "<u4")

    def _piece(self, piece: str) -> bytes:
        return array("I", self.encode(piece)).tobytes()

    def is_plain(self, text: str) -> bool:
        return (text.isascii() or not _OTHER.search(text)) and not any(s in text for s in self.specials)

    def ids(self, text: str) -> np.ndarray:
        """Unsigned 32-bit ids of the whole text."""
        if not self.is_plain(text):
            return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, "<u4")
        if len(text) < 4 * _SLICE:
            return np.frombuffer(b"".join(map(self.cache.__getitem__, self.split(text))), "<u4")
        pieces, out = (m.group() for m in self.find(text)), []
        while part := list(islice(pieces, _SLICE)):
            out.append(b"".join(map(self.cache.__getitem__, part)))
        return np.frombuffer(b"".join(out), "<u4")


class PieceBpe:
    """A sentencepiece vocabulary with byte fallback, word by word (its pieces never cross white space)."""

    def __init__(self, folder: str, name: str = "piece_bpe_32k") -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, f"{name}.model"))
        self.size = self.model.vocab_size()
        self.fallback = np.array([self.model.is_byte(i) or self.model.is_unknown(i) for i in range(self.size)])
        self.cache: dict[str, bytes] = {}

    def ids(self, words: list[str]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.cache.__getitem__, words)), "<u4")

    def learn(self, words: set[str]) -> None:
        """Encode the words not yet known in one call; ``ids`` of a text needs its words learned."""
        if len(self.cache) + len(words) > WORDS:
            self.cache.clear()
        missing = [w for w in words if w not in self.cache]
        if missing:
            self.cache.update(zip(missing, (array("I", x).tobytes() for x in self.model.encode(missing, num_threads=1))))


@lru_cache(maxsize=4)
def byte_bpe(folder: str = TOKENIZER_DIR) -> ByteBpe:
    """One tokenizer per Python worker."""
    return ByteBpe(folder)


@lru_cache(maxsize=4)
def piece_bpe(folder: str = TOKENIZER_DIR) -> PieceBpe:
    return PieceBpe(folder)
