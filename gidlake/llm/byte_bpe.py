"""op13: byte-level BPE ids of whole texts and back, by backtracking over the longest tokens of an Aho-Corasick automaton.

A row of tokens is what the merges give exactly when each pair of neighbours is: merging the bytes of both ends in these two
tokens. So a piece is read from left to right, taking the longest token that its predecessor allows; where none fits, the
last token is taken back and a shorter one tried. A place that proved a dead end is not entered again, which keeps the work
linear in the piece. Whether two tokens may be neighbours is worked out once by plain merges of their few bytes and kept.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gidlake.llm import common

# Pieces and neighbour pairs one Python worker remembers; each memory starts anew beyond it. Longer pieces are not kept.
CACHE_PIECES, CACHE_PAIRS, CACHED_CHARS = 450_000, 400_000, 64
# A longer text is cut where a letter stands before a blank and a letter; pieces never reach over such a place.
FRAGMENT_CHARS = 1 << 20
_BETWEEN = re.compile(r"(?<=[A-Za-z])(?= [A-Za-z])")

_IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
_TEXT = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("text", pa.binary())])


def multi_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def piece_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


# --- pieces


@lru_cache(maxsize=1)
def _classes() -> dict[str, str]:
    """Ranges of letters, numbers and white space as the tokenizer library knows them; other Unicode tables differ in part."""
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([i]): i for i in range(256)}
    found = {}
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        kept = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)
        runs = [[c for _, c in run] for _, run in groupby(enumerate(map(ord, bytes(kept).decode())), lambda x: x[1] - x[0])]
        found[name] = "".join(f"\\U{run[0]:08x}-\\U{run[-1]:08x}" for run in runs)
    return found


def plain_pattern(pattern: str) -> str:
    r"""The pattern with \p{L}, \p{N}, \s and \S spelled out as ranges, for Python's own engine."""
    classes, out, inside = _classes(), [], False
    for part in re.findall(r"\\p\{[A-Z]\}|\\.|.", pattern, re.S):
        if part in classes:
            part = classes[part] if inside else f"[{classes[part]}]"
        elif part == r"\S" and not inside:
            part = f"[^{classes[chr(92) + 's']}]"
        elif part == r"\S" or part.startswith(r"\p"):
            raise ValueError(f"not supported in a piece pattern: {part}")
        elif part in "[]":
            inside = part == "["
        out.append(part)
    return "".join(out)


def fragments(text: str, size: int = FRAGMENT_CHARS) -> Iterator[str]:
    """Parts of a text of about `size` characters that have the pieces of the whole."""
    at = 0
    while at < len(text):
        cut = _BETWEEN.search(text, at + size)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


# --- tokens


class BytePairs:
    """Exact merges of byte strings by ranks; see the module's head for the method."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.ranks = ranks
        self.token = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.token[rank] = token
        self.size = list(map(len, self.token))
        self.widest = max(self.size)
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.shorter = [-1] * len(self.token)
        for token, rank in ranks.items():
            self.shorter[rank] = next((ranks[token[:k]] for k in range(len(token) - 1, 0, -1) if token[:k] in ranks), -1)
        self.pairs: dict[tuple[int, int], bool] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The merges done one by one, the lowest rank and then the leftmost first; for the bytes of two tokens."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            found = [self.ranks.get(a + b, len(self.token)) for a, b in zip(parts, parts[1:], strict=False)]
            low = min(found)
            if low == len(self.token):
                break
            i = found.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def allowed(self, last: int, following: int) -> bool:
        """Whether the two may be neighbours; `last` is -1 at the start of a piece."""
        known = self.pairs.get((last, following))
        if known is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            row = [following] if last < 0 else [last, following]
            known = self.pairs[last, following] = self.merge(b"".join(self.token[t] for t in row)) == row
        return known

    def longest(self, piece: str, at: int) -> int:
        """The longest token that starts at a place; every byte is a token, so the first match found starts there."""
        return next(self.automaton.iter_long(piece[at:at + self.widest]))[1]

    def encode(self, piece: bytes) -> list[int]:
        """A token is itself. Else the longest matches in a row, as far as neighbours allow, and from there on by backtracking."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        latin, known, ids, last, at = piece.decode("latin-1"), self.pairs, [], -1, 0
        for _, candidate in self.automaton.iter_long(latin):
            allowed = known.get((last, candidate))
            if allowed is None:
                allowed = self.allowed(last, candidate)
            if not allowed:
                return self._backtrack(latin, ids, at, self.shorter[candidate])
            ids.append(candidate)
            at += self.size[candidate]
            last = candidate
        if at != len(piece):
            raise ValueError("a byte has no token")
        return ids

    def _backtrack(self, piece: str, ids: list[int], at: int, candidate: int) -> list[int]:
        """Complete a row of tokens that ends at a place, where `candidate` is the longest token not tried yet."""
        size, shorter, allowed, n = self.size, self.shorter, self.allowed, len(piece)
        dead = bytearray(n + 1)
        while at < n:
            last = ids[-1] if ids else -1
            while candidate >= 0:
                end = at + size[candidate]
                if not dead[end] and allowed(last, candidate):
                    break
                candidate = shorter[candidate]
            if candidate >= 0:
                ids.append(candidate)
                at = end
                candidate = self.longest(piece, at) if at < n else -1
            else:
                dead[at] = 1
                if not ids:
                    raise ValueError("a byte has no token")
                at -= size[ids[-1]]
                candidate = shorter[ids.pop()]
        return ids


class _Pieces(dict):
    """Packed ids of pieces seen before."""

    def __init__(self, pairs: BytePairs):
        super().__init__()
        self.of = pairs

    def __missing__(self, piece: str) -> bytes:
        ids = self.of.encode(piece.encode())
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[piece] = packed
        return packed


@lru_cache(maxsize=1)
def _encoder(path: str) -> _Pieces:
    common.keep(_encoder.cache_clear)
    return _Pieces(BytePairs(read_ranks(path)))


@lru_cache(maxsize=1)
def _tokens(path: str) -> list[bytes]:
    common.keep(_tokens.cache_clear)
    ranks = read_ranks(path)
    return sorted(ranks, key=ranks.get) if sorted(ranks.values()) == list(range(len(ranks))) else BytePairs(ranks).token


def _encode(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    split = re.compile(pattern).findall
    known = _encoder(path)
    for batch in common.slices(batches):
        ids = []
        for text in batch.column("text").to_pylist():
            text = text.decode("utf-8", "replace")
            parts = fragments(text) if len(text) > FRAGMENT_CHARS else (text,)
            ids.append(b"".join(b"".join(map(known.__getitem__, split(part))) for part in parts))
        yield common.record_batch([batch.column("doc_id"), ids], _IDS)


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, ids) of every row: the ids of the whole text as packed little-endian unsigned 32-bit integers.

    `path` names a file of ranks, `pattern` what makes a piece; none may go from a letter over a blank to another letter. Each match of the pattern is encoded by itself, without
    special tokens; a piece that is a token is that token. Null and empty texts have no ids. Repeated rows and rows without
    an id are encoded like any other, further columns play no part, an empty table gives none. A text of any length is cut in
    fragments at places that no piece reaches over.
    """
    where, plain = path or multi_path(), plain_pattern(pattern or piece_pattern())
    return common.id_text(docs).mapInArrow(lambda batches: _encode(batches, where, plain), "doc_id long, ids binary")


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    token = _tokens(path).__getitem__
    for batch in common.slices(batches, "ids"):
        texts = [b"".join(map(token, np.frombuffer(ids, "<u4").tolist())) for ids in batch.column("ids").to_pylist()]
        yield common.record_batch([batch.column("doc_id"), batch.column("ids"), texts], _TEXT)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, text): the bytes that packed ids stand for. Null ids are none; an id without a token stops the job."""
    where = path or multi_path()
    rows = encoded.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids"))
    return rows.mapInArrow(lambda batches: _decode(batches, where), "doc_id long, ids binary, text binary")


def byte_bpe_digest(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """op13: (doc_id, n_tokens, ids_sha256, decoded_sha256) of every document, from its ids and the text decoded from them."""
    back = decode(encode(docs, path, pattern), path)
    return back.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))
