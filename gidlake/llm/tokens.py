"""Token ids of whole texts with a public tokenizer, word by word through a bounded cache."""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain, repeat

import numpy as np

from gidlake.llm import common

END_ID = 1
# Longer texts are cut at white space while they are encoded; the ids are the same.
FRAGMENT_BYTES = 4 << 20
# Words remembered by one Python worker; beyond it only those that have come back stay.
CACHE_WORDS = 600_000

# A mark that ends a word after a letter is a piece of its own; set apart, it leaves fewer different words.
# The mark stands first in the pattern, so that a search jumps from mark to mark.
_MARK = re.compile(rb"[.,](?<=[a-z][.,])(?=[ \n])")
# Texts with these bytes (combining marks, special tokens) are not touched before the tokenizer sees them.
_TOUCHY = (b"\xcc", b"\xcd", b"<|")
_SPACE = re.compile(rb"[ \t\n\r\x0b\f]")


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# Words of plain Latin letters, then plain marks: such a word is one piece of letters and one of marks, whatever its case.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([.,;:!?#$%&*()\"+=/-]*)")


class WordEncoder:
    """Ids of texts, each followed by END_ID, for a tokenizer that drops white space.

    Such a tokenizer never joins characters over white space, so a text's ids are those of its words in a row. Words come
    back often; the ids of each are looked up once and kept. New plain words go to the tokenizer's own merge model piece by
    piece, all others through the whole tokenizer. Both give the ids of the whole text (tests compare them).
    """

    def __init__(self, path: str, cache_words: int | None = None):
        self.cache_words = cache_words
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        latin = "".join(map(chr, range(0xC0, 0x100)))
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.latin = str.maketrans({c: level.pre_tokenize_str(c)[0][0] for c in latin})
        self._reset()

    def _reset(self) -> None:
        self.index: dict[bytes | None, int] = {None: 0}
        self.pieces: dict[str, list[int]] = {"": []}
        self.flat, self.used = np.zeros(1 << 16, np.int32), 1
        self.flat[0] = END_ID
        self.starts, self.lengths = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.lengths[0] = 1
        self.again = np.zeros(1 << 16, bool)  # words that came back since they were learned, or kept

    def _forget(self) -> None:
        """Drop the words that have not come back; all words where that frees less than half of the cache."""
        self.again[0] = True
        kept = np.flatnonzero(self.again[:len(self.index)])
        if 2 * len(kept) > (self.cache_words or CACHE_WORDS):
            self._reset()
            return
        words, lengths = list(self.index), self.lengths[kept]
        first, self.used = np.cumsum(lengths) - lengths, int(lengths.sum())
        self.flat = self.flat[np.repeat(self.starts[kept] - first, lengths) + np.arange(self.used)]
        self.starts, self.lengths, self.again = first, lengths, np.zeros(len(kept), bool)
        self.index = {words[i]: n for n, i in enumerate(kept.tolist())}
        self.pieces = {"": []}

    def _piece(self, text: str) -> list[int]:
        ids = self.pieces.get(text)
        if ids is None:
            ids = self.pieces[text] = [t.id for t in self.model.tokenize(text if text.isascii() else text.translate(self.latin))]
        return ids

    def _new(self, words: list[str]) -> list[list[int]]:
        out, odd = [], []
        for i, word in enumerate(words):
            if word.isascii() and word.isalpha():
                out.append([t.id for t in self.model.tokenize(word.lower())])
            elif plain := _PLAIN.fullmatch(word):
                out.append(self._piece(plain[1].lower()) + self._piece(plain[2]))
            else:
                odd.append(i)
                out.append([])
        for i, e in zip(odd, self.tokenizer.encode_batch_fast([words[i] for i in odd], add_special_tokens=False), strict=True):
            out[i] = e.ids
        return out

    def _learn(self, words: list[bytes]) -> None:
        n = len(self.index)
        ids = self._new([w.decode() for w in words])
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        total = int(lengths.sum())
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(words) > len(self.starts):
            self.starts, self.lengths, self.again = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths, self.again))
        self.flat[self.used:self.used + total] = np.fromiter(chain.from_iterable(ids), np.int32, total)
        self.lengths[n:n + len(words)] = lengths
        self.starts[n:n + len(words)] = self.used + np.cumsum(lengths) - lengths
        self.index.update(zip(words, range(n, n + len(words)), strict=True))
        self.used += total

    def _ids(self, words: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each has."""
        for free in (self._forget, self._reset, None):
            where = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
            missing = np.flatnonzero(where < 0)
            new = list(dict.fromkeys([words[i] for i in missing.tolist()]))
            if not new or free is None or len(self.index) + len(new) <= (self.cache_words or CACHE_WORDS):
                break
            free()
        self.again[where if not new else where[where >= 0]] = True
        if new:
            self._learn(new)
            where[missing] = [self.index[words[i]] for i in missing.tolist()]
        lengths = self.lengths[where]
        total = int(lengths.sum())
        first = np.cumsum(lengths) - lengths
        return self.flat[np.repeat(self.starts[where] - first, lengths) + np.arange(total)], lengths

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the end of each text in them. A null text is an empty one."""
        parts, ends, at = [], [], 0
        words: list[bytes | None] = []
        counts: list[int] = []

        def flush() -> None:
            nonlocal at
            if counts:
                ids, lengths = self._ids(words)
                parts.append(ids)
                ends.append(at + np.cumsum(lengths)[np.cumsum(counts) - 1])
                at += len(ids)
                words.clear()
                counts.clear()

        for text in texts:
            text = text or b""
            if len(text) > FRAGMENT_BYTES:
                flush()
                own = [self._ids(f.split())[0] for f in fragments(plainer(text))] + [np.full(1, END_ID, np.int32)]
                parts.extend(own)
                at += sum(map(len, own))
                ends.append(np.array([at]))
                continue
            before = len(words)
            words.extend(plainer(text).split())
            words.append(None)
            counts.append(len(words) - before)
        flush()
        return (np.concatenate(parts) if parts else np.zeros(0, np.int32)), (np.concatenate(ends) if ends else np.zeros(0, np.int64))


def plainer(text: bytes) -> bytes:
    """A text with the same ids and fewer different words: ASCII letters in lower case, closing marks set apart.

    The tokenizer lowers letters itself and splits marks from letters. Lowering before it composes characters could matter
    only beside combining marks.
    """
    if any(b in text for b in _TOUCHY):
        return text
    return _MARK.sub(rb" \g<0>", text.lower())


def fragments(text: bytes, size: int = FRAGMENT_BYTES):
    """Parts of a text of about `size` bytes, cut at white space."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + size)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


@lru_cache(maxsize=1)
def encoder(path: str, cache_words: int | None = None) -> WordEncoder:
    """One encoder for each Python worker, kept until another operator uses the worker."""
    common.keep(encoder.cache_clear)
    return WordEncoder(path, cache_words)
