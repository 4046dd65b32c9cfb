"""op3: token ids in shards compressed by Re-Pair grammars, with random access into them."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gidlake.llm import common, tokens
from gidlake.settings import scratch_path

# Ids under one grammar; longer blocks have several. Bounds the memory of building and decoding.
SEGMENT_IDS = 1 << 19
# Ids gathered into one row of the file, whole documents only.
BLOCK_IDS = 1 << 20
# A pair is worth a rule from this many places on; a round makes at most this many rules.
MIN_COUNT, RULES_PER_ROUND, ROUNDS = 6, 4096, 4

_SEGMENT = pa.struct([("n_ids", pa.int64()), ("base", pa.int64()), ("rules", pa.binary()), ("lengths", pa.binary()),
                      ("symbols", pa.binary())])
_BLOCK = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("start", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                    ("n_tokens", pa.list_(pa.int64())), ("segments", pa.list_(_SEGMENT))])
_BLOCK_DDL = ("shard long, block long, start long, doc_ids array<long>, n_tokens array<long>, segments array<struct<n_ids: long, "
              "base: long, rules: binary, lengths: binary, symbols: binary>>")
_DOC = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


class Grammar:
    """Re-Pair: frequent id pairs are replaced by nonterminals, over and over.

    Terminals are below `base`; nonterminal base + i expands to the pair rules[i], and to lengths[i] ids in all. Every
    round counts all adjacent pairs exactly and takes the most frequent ones that cannot overlap: no symbol is the left
    of one and the right of another. A pair of equal symbols is taken where it is the most frequent of its symbol.
    """

    def __init__(self, base: int, rules: np.ndarray, lengths: np.ndarray, symbols: np.ndarray):
        self.base, self.rules, self.lengths, self.symbols = base, rules, lengths, symbols

    @classmethod
    def build(cls, ids: np.ndarray, base: int | None = None, min_count: int = MIN_COUNT,
              rules_per_round: int = RULES_PER_ROUND, rounds: int = ROUNDS) -> Grammar:
        base = max(int(base or 0), int(ids.max(initial=0)) + 1)
        symbols = ids.astype(np.uint32)
        made: list[tuple[int, int]] = []
        lengths = np.zeros(0, np.uint32)
        for _ in range(rounds):
            wide = base + len(made) > 1 << 16
            room = rules_per_round if wide else min(rules_per_round, (1 << 16) - base - len(made))
            if len(symbols) < 2 or room < 1:
                break
            kind, shift = (np.uint64, np.uint64(32)) if wide else (np.uint32, np.uint32(16))
            keys = symbols[:-1].astype(kind) << shift | symbols[1:].astype(kind)
            ordered = np.sort(keys)
            edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]]))
            counts = np.diff(edge)
            often = np.flatnonzero(counts >= min_count)
            if not often.size:
                break
            often = often[np.lexsort((ordered[edge[often]], -counts[often]))]
            chosen = cls._apart(ordered[edge[often]], counts[often], int(shift), base + len(made))[:room]
            if not len(chosen):
                break
            lefts, rights = (chosen >> shift).astype(np.int64), (chosen & kind((1 << int(shift)) - 1)).astype(np.int64)
            symbols = cls._replace(symbols, keys, chosen, lefts, rights, base + len(made))
            size = np.concatenate([np.ones(base, np.uint32), lengths])
            lengths = np.concatenate([lengths, size[lefts] + size[rights]])
            made += zip(lefts.tolist(), rights.tolist(), strict=True)
        return cls(base, np.array(made, np.uint32).reshape(-1, 2), lengths, symbols)

    @staticmethod
    def _apart(keys: np.ndarray, counts: np.ndarray, shift: int, n: int) -> np.ndarray:
        """Those pairs, in order, that cannot overlap: each symbol keeps the side on which its pairs are more frequent."""
        left, right = (keys >> keys.dtype.type(shift)).astype(np.int64), (keys & keys.dtype.type((1 << shift) - 1)).astype(np.int64)
        twin = left == right
        as_left = np.bincount(left[~twin], counts[~twin], n)
        as_right = np.bincount(right[~twin], counts[~twin], n)
        as_twin = np.bincount(left[twin], counts[twin], n)
        alone = as_twin > np.maximum(as_left, as_right)
        on_left = ~alone & (as_left >= as_right)
        return keys[np.where(twin, alone[left], on_left[left] & ~on_left[right] & ~alone[right])]

    @staticmethod
    def _replace(symbols: np.ndarray, keys: np.ndarray, chosen: np.ndarray, left: np.ndarray, right: np.ndarray, first: int) -> np.ndarray:
        names = np.argsort(chosen)
        wanted = chosen[names]
        lefts, rights = np.zeros(first, bool), np.zeros(first, bool)
        lefts[left], rights[right] = True, True
        at = np.flatnonzero(lefts[symbols[:-1]] & rights[symbols[1:]])
        found = np.minimum(np.searchsorted(wanted, keys[at]), len(wanted) - 1)
        hit = wanted[found] == keys[at]
        at, found = at[hit], found[hit]
        same = symbols[at] == symbols[at + 1]
        if same.any():  # in a run of one symbol every second place starts a pair
            runs = at[same]
            begins = np.concatenate([[True], np.diff(runs) > 1])
            origin = np.maximum.accumulate(np.where(begins, runs, 0))
            keep = np.ones(len(at), bool)
            keep[np.flatnonzero(same)[(runs - origin) % 2 == 1]] = False
            at, found = at[keep], found[keep]
        out = symbols.copy()
        out[at] = first + names[found]
        stays = np.ones(len(out), bool)
        stays[at + 1] = False
        return out[stays]

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        while (deep := symbols >= self.base).any():
            out = np.repeat(symbols, 1 + deep)
            at = (np.cumsum(1 + deep) - 1 - deep)[deep]
            pair = self.rules[symbols[deep] - self.base]
            out[at], out[at + 1] = pair[:, 0], pair[:, 1]
            symbols = out
        return symbols

    def ids(self) -> np.ndarray:
        """All ids: each nonterminal is expanded once, then copied to its places."""
        whole = self.expand(np.arange(self.base + len(self.rules), dtype=np.uint32))
        size = np.concatenate([np.ones(self.base, np.int64), self.lengths.astype(np.int64)])
        own = size[self.symbols]
        shift = (np.cumsum(size) - size)[self.symbols] - (np.cumsum(own) - own)
        return whole[np.repeat(shift, own) + np.arange(int(own.sum()))]

    def slice(self, start: int, end: int) -> np.ndarray:
        """Ids start to end, expanding only the symbols that cover them."""
        size = np.concatenate([np.ones(self.base, np.int64), self.lengths.astype(np.int64)])
        ends = np.cumsum(size[self.symbols])
        first, last = np.searchsorted(ends, start, "right"), np.searchsorted(ends, end, "left")
        before = int(ends[first - 1]) if first else 0
        return self.expand(self.symbols[first:last + 1])[start - before:end - before]

    def pack(self, n_ids: int) -> dict:
        kind = "<u2" if self.base + len(self.rules) <= 1 << 16 else "<u4"
        return {"n_ids": n_ids, "base": self.base, "rules": self.rules.astype(kind).tobytes(),
                "lengths": self.lengths.astype("<u4").tobytes(), "symbols": self.symbols.astype(kind).tobytes()}

    @classmethod
    def unpack(cls, row: dict) -> Grammar:
        lengths = np.frombuffer(row["lengths"], "<u4")
        kind = "<u2" if row["base"] + len(lengths) <= 1 << 16 else "<u4"
        return cls(row["base"], np.frombuffer(row["rules"], kind).astype(np.uint32).reshape(-1, 2), lengths,
                   np.frombuffer(row["symbols"], kind).astype(np.uint32))


def _segments(ids: np.ndarray, vocabulary: int) -> list[dict]:
    return [Grammar.build(part := ids[i:i + SEGMENT_IDS], vocabulary).pack(len(part)) for i in range(0, len(ids), SEGMENT_IDS)]


def _compress(batches: Iterator[pa.RecordBatch], path: str, vocabulary: int) -> Iterator[pa.RecordBatch]:
    encoder, shard = tokens.encoder(path), TaskContext.get().partitionId()
    docs, counts, parts, held, block, start = [], [], [], 0, 0, 0
    for batch in common.slices(batches):
        ids, ends = encoder.encode(batch.column("text").to_pylist())
        docs += batch.column("doc_id").to_pylist()
        counts += np.diff(ends, prepend=0).tolist()
        parts.append(ids)
        held += len(ids)
        if held >= BLOCK_IDS:
            yield _block(shard, block, start, docs, counts, parts, vocabulary)
            block, start = block + 1, start + held
            docs, counts, parts, held = [], [], [], 0
    if docs:
        yield _block(shard, block, start, docs, counts, parts, vocabulary)


def _block(shard, block, start, docs, counts, parts, vocabulary) -> pa.RecordBatch:
    row = {"shard": shard, "block": block, "start": start, "doc_ids": docs, "n_tokens": counts,
           "segments": _segments(np.concatenate(parts), vocabulary)}
    return pa.RecordBatch.from_pylist([row], schema=_BLOCK)


def write_ids(docs: DataFrame, out: str, path: str | None = None) -> None:
    """Write the ids of all documents, in ascending doc_id order, as a folder of Parquet shards.

    A shard is a range of doc_ids; each of its rows is a block: doc_ids and token counts in order, the ids before it in
    the shard, and the grammars of its ids. Symbols and rules are little-endian unsigned integers of 16 bits, or of 32 where
    ids do not fit. Null ids come first; rows with one id keep the order of the table and may spread over shards.
    """
    path = path or tokens.word_bpe_path()
    vocabulary = max(tokens.encoder(path).tokenizer.get_vocab_size(), tokens.END_ID + 1)
    ranged = (common.id_text(docs).withColumn("place", F.monotonically_increasing_id())
              .repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place").select("doc_id", "text"))
    ranged.mapInArrow(lambda batches: _compress(batches, path, vocabulary), _BLOCK_DDL).write.parquet(out)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ends = np.cumsum([s["n_ids"] for s in row["segments"]])
            parts = iter(row["segments"])
            stops = np.cumsum(row["n_tokens"])
            crcs, crc, at, have = [], 0, 0, 0
            view = memoryview(b"")
            for stop in stops.tolist():  # one segment is decoded at a time
                crc = 0
                while at < stop:
                    if at == have:
                        segment = next(parts)
                        view = memoryview(Grammar.unpack(segment).ids().astype("<u4")).cast("B")
                        low, have = have, have + segment["n_ids"]
                    upto = min(stop, have)
                    crc = zlib.crc32(view[4 * (at - low):4 * (upto - low)], crc)
                    at = upto
                crcs.append(crc)
            assert not len(ends) or have == ends[-1]
            first = row["start"] + row["base_start"] + stops - np.array(row["n_tokens"])
            yield common.record_batch([row["doc_ids"], first, row["n_tokens"], crcs], _DOC)


def shard_starts(blocks: DataFrame) -> DataFrame:
    """(shard, base_start): ids before each shard. One row per written partition, so its window and broadcast stay small."""
    sizes = blocks.select("shard", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).groupBy("shard").agg(F.sum("n").alias("n"))
    return sizes.selectExpr("shard", "coalesce(sum(n) over (order by shard rows between unbounded preceding and 1 preceding), 0) base_start")


def read_documents(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files `write_ids` left."""
    blocks = spark.read.schema(_BLOCK_DDL).parquet(out)
    joined = blocks.join(F.broadcast(shard_starts(blocks)), "shard")
    return joined.mapInArrow(_decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_slice(spark: SparkSession, out: str, start: int, end: int) -> list[int]:
    """Ids start to end of the whole corpus: only blocks and symbols that cover them are decoded."""
    blocks = spark.read.schema(_BLOCK_DDL).parquet(out)
    own = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)
    hits = (blocks.join(F.broadcast(shard_starts(blocks)), "shard").withColumn("first", F.col("start") + F.col("base_start"))
            .filter((F.col("first") < end) & (F.col("first") + own > start)).select("first", "segments").orderBy("first"))
    got: list[int] = []
    for row in hits.toLocalIterator():
        at = row["first"]
        for segment in row["segments"]:
            low, high = max(start, at), min(end, at + segment["n_ids"])
            if low < high:
                got += Grammar.unpack(segment.asDict()).slice(low - at, high - at).tolist()
            at += segment["n_ids"]
    return got


def repair_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """op3: encode, compress, write, read back: one row per document. An empty table gives no rows.

    Null and empty texts are the end id alone; repeated rows and rows without an id are documents of their own; texts of any length are encoded
    whole and may span several segments; further columns play no part.
    """
    out = scratch_path(docs.sparkSession, "op3-ids")
    write_ids(docs, out, path)
    return read_documents(docs.sparkSession, out)
