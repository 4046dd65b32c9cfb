"""op5: documents packed into sequences of at most 4096 tokens by bounded-space online best-fit."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gidlake.llm import common, tokens

SEQUENCE = 4096
# Bins kept open by one packer; the fullest is closed when another is needed beyond them. More hardly pack tighter.
OPEN_BINS = 128
# Pieces that one packer gets on average; bounds its rows whatever the table size, and the bins left open at its end.
GROUP_PIECES = 65_536
# Words one worker remembers here; fewer than the encoder would, as other operators share the executors in a pipeline.
CACHE_WORDS = 350_000

_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64())])
_PIECES_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"


class BestFit:
    """Bounded-space best-fit: open bins in a bitset keyed by their free space.

    An item goes to the open bin with the least free space that still holds it. If none does, a bin is opened; when all
    `open_bins` are in use, the fullest is closed first.
    """

    def __init__(self, size: int = SEQUENCE, open_bins: int = OPEN_BINS):
        self.size, self.open_bins = size, open_bins
        self.mask, self.open, self.made, self.closed = 0, 0, 0, 0
        self.bins: dict[int, list[int]] = {}

    def _take(self, free: int) -> int:
        stack = self.bins[free]
        number = stack.pop()
        if not stack:
            del self.bins[free]
            self.mask &= ~(1 << free)
        self.open -= 1
        return number

    def add(self, length: int) -> tuple[int, int]:
        """(bin, place in it) of an item."""
        fitting = self.mask >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.open >= self.open_bins:
                self._take((self.mask & -self.mask).bit_length() - 1)
                self.closed += 1
            free, number = self.size, self.made
            self.made += 1
        left = free - length
        if left:
            self.bins.setdefault(left, []).append(number)
            self.mask |= 1 << left
            self.open += 1
        return number, self.size - free


def _cut(batches: Iterator[pa.RecordBatch], path: str, size: int, cache_words: int) -> Iterator[pa.RecordBatch]:
    encoder = tokens.encoder(path, cache_words)
    for batch in common.slices(batches):
        ids, ends = encoder.encode(batch.column("text").to_pylist())
        ids = ids.astype("<u4")
        starts = np.concatenate([[0], ends[:-1]])
        counts = -(-(ends - starts) // size)
        rows = np.repeat(np.arange(len(counts)), counts)
        piece = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = piece * size
        length = np.minimum(size, (ends - starts)[rows] - start)
        first = starts[rows] + start
        view = memoryview(ids).cast("B")
        crc = [zlib.crc32(view[4 * a:4 * (a + n)]) for a, n in zip(first.tolist(), length.tolist(), strict=True)]
        yield common.record_batch([batch.column("doc_id").take(pa.array(rows)), piece, start, length, crc], _PIECES)


def pieces(docs: DataFrame, path: str, size: int = SEQUENCE, cache_words: int = CACHE_WORDS) -> DataFrame:
    """Token pieces of whole texts: documents longer than `size` are cut, others are one piece.

    The last id of a document is the end id, so an empty or null text is one piece of one token. Repeated rows are
    separate documents.
    """
    return common.id_text(docs).mapInArrow(lambda batches: _cut(batches, path, size, cache_words), _PIECES_DDL)


def pack(items: DataFrame, size: int = SEQUENCE, open_bins: int = OPEN_BINS, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add (sequence_id, offset) to rows of `pieces`, which should be a written table.

    Pieces are dealt evenly over groups of about `group_pieces` by their place in the table, never by their ids, so
    repeated rows spread too. Each group feeds one packer in the order of the table: a piece is placed when it comes, and only the free
    spaces of the open bins are kept.
    """
    n = items.count()
    groups = max(1, math.ceil(n / group_pieces))
    dealt = items.withColumn("place", F.monotonically_increasing_id())
    dealt = dealt.withColumn("bin_group", F.pmod(F.xxhash64("place"), F.lit(groups)))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        packer = BestFit(size, open_bins)
        placed = [packer.add(n) for n in table.column("length").to_pylist()]
        group = table.column("bin_group")[0].as_py() << 32
        return pa.table([*(table.column(c) for c in _PIECES.names), pa.array([group + b for b, _ in placed], pa.int64()),
                         pa.array([o for _, o in placed], pa.int64())], names=[*_PIECES.names, "sequence_id", "offset"])

    return dealt.groupBy("bin_group").applyInArrow(run, f"{_PIECES_DDL}, sequence_id long, offset long")


def best_fit_packing(docs: DataFrame, path: str | None = None, size: int = SEQUENCE, cache_words: int = CACHE_WORDS) -> DataFrame:
    """op5: one row per piece of every document with its sequence and place there, gapless from 0.

    `path` names the tokenizer file. Null and empty texts are one piece of the end id; repeated rows and rows without an id are packed like any
    other; texts of any length are encoded whole and cut in pieces of a sequence. An empty table gives no rows.
    """
    found = common.staged(pieces(docs, path or tokens.word_bpe_path(), size, cache_words), "op5-pieces")
    return pack(found, size)
