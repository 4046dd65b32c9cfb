"""op7: documents that hold passages of a benchmark, found in suffix arrays of document shards."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from gidlake.llm import common

WINDOW = 13
# Benchmark words searched in one pass over the documents; a larger benchmark takes several passes.
BLOCK_WORDS = 500_000
# A document is contaminated if 1 in this many of its words is hit.
SHARE = 20
# Item names that a task hands on at once.
ITEMS_HELD = 200_000

_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_FOUND = pa.schema([("doc_id", pa.int64()), ("text", pa.binary()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("hits", pa.binary()),
                    ("items", pa.list_(pa.string()))])
_FOUND_DDL = "doc_id long, text binary, n_words long, n_hit long, hits binary, items array<string>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


class Benchmark:
    """Word ids of benchmark items in a row, each item followed by 0, and where its windows start.

    A window is WINDOW words in a row, or a whole item of fewer words. Items without words have none. Windows that several places
    of the benchmark share are one for `window_hits`.
    """

    def __init__(self, items: list[tuple[str | None, bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        self.names = [name for name, _ in items]
        ids, starts, sizes, owners, item_starts = [0], [], [], [], []
        for k, (_, text) in enumerate(items):
            own = words_of(text)
            item_starts.append(len(ids))
            size = min(WINDOW, len(own))
            for i in range(len(own) - size + 1 if own else 0):
                starts.append(len(ids) + i)
                sizes.append(size)
                owners.append(k)
            ids += [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in own]
            ids.append(0)
        self.ids = np.array([*ids, *[0] * WINDOW], np.int32)
        self.starts, self.sizes, self.owners = (np.array(x, np.int64) for x in (starts, sizes, owners))
        self.item_starts = np.array(item_starts, np.int64)
        self.shortest = int(self.sizes.min()) if len(sizes) else 0
        number: dict[bytes, int] = {}
        window = np.array([number.setdefault(self.ids[s:s + n].tobytes(), len(number)) for s, n in zip(starts, sizes, strict=True)], np.int64)
        first = np.unique(window, return_index=True)[1]
        self.window_starts, self.window_sizes = self.starts[first], self.sizes[first]
        # The named items of each different window, in a row, and where each window's begin. Items without an id have no name.
        named = np.array([name is not None for name in self.names], bool)[self.owners] if len(starts) else np.zeros(0, bool)
        held = np.unique(np.column_stack([window[named], self.owners[named]]), axis=0).reshape(-1, 2)
        self.window_items = held[:, 1]
        self.items_from = np.searchsorted(held[:, 0], np.arange(len(number) + 1))


def suffix_array(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Places `at` in the order of the suffixes of ids that start there, by doubling the words compared.

    Ids of 0 end a suffix; what follows plays no part. Suffixes of the same words keep the order of their places.
    """
    rank, width, classes = ids.astype(np.int64), 1, -1
    while True:
        after = np.zeros(len(ids), np.int64)
        after[:-width] = rank[width:]
        after[rank == 0] = 0
        keys = rank * (int(rank.max(initial=0)) + 1) + after
        order = np.argsort(keys, kind="stable")
        changed = np.concatenate([[False], keys[order][1:] != keys[order][:-1]])
        fresh = np.zeros(len(ids), np.int64)
        fresh[order] = np.cumsum(changed) + 1
        fresh[rank == 0] = 0
        rank, width = fresh, 2 * width
        if changed.sum() == classes or width >= len(ids):
            return at[np.argsort(rank[at], kind="stable")]
        classes = changed.sum()


def _order(shard: np.ndarray, places: np.ndarray, tests: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """-1, 0 or 1 for each (place, test): how the suffix there compares with the test's first `sizes` words."""
    sign = np.zeros(len(places), np.int64)
    live = np.arange(len(places))
    for k in range(int(sizes.max(initial=0))):
        live = live[(sizes[live] > k) & (sign[live] == 0)]
        sign[live] = np.sign(shard[places[live] + k].astype(np.int64) - tests[starts[live] + k])
    return sign


def search(shard: np.ndarray, order: np.ndarray, tests: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Binary search of every test suffix in a suffix array: (first, end) of the suffixes that begin with its `sizes` words."""
    bounds = []
    for upper in (False, True):
        lo, hi = np.zeros(len(starts), np.int64), np.full(len(starts), len(order), np.int64)
        while (live := np.flatnonzero(lo < hi)).size:
            mid = (lo[live] + hi[live]) // 2
            sign = _order(shard, order[mid], tests, starts[live], sizes[live])
            right = (sign < 0) | (upper & (sign == 0))
            lo[live[right]] = mid[right] + 1
            hi[live[~right]] = mid[~right]
        bounds.append(lo)
    return bounds[0], bounds[1]


def longest_matches(shard: np.ndarray, order: np.ndarray, bench: Benchmark) -> np.ndarray:
    """Rows (item, place in the shard, word of the item, words): verbatim matches that hold a window and cannot grow.

    Windows found at neighbouring places of the same item and shift are one match.
    """
    first, end = search(shard, order, bench.ids, bench.starts, bench.sizes)
    hit = np.flatnonzero(end > first)
    n = (end - first)[hit]
    which = np.repeat(hit, n)
    place = order[np.repeat(first[hit] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
    item, word = bench.owners[which], bench.starts[which] - bench.item_starts[bench.owners[which]]
    by = np.lexsort((place, place - word, item))
    item, word, place, size = item[by], word[by], place[by], bench.sizes[which][by]
    fresh = np.concatenate([[True], (np.diff(item) != 0) | (np.diff(place - word) != 0) | (np.diff(place) != 1)])[:len(item)]
    at = np.flatnonzero(fresh)
    windows = np.diff(np.append(at, len(item)))
    return np.column_stack([item[at], place[at], word[at], size[at] + windows - 1])


def window_hits(shard: np.ndarray, order: np.ndarray, bench: Benchmark) -> tuple[np.ndarray, np.ndarray]:
    """(window, place) of every occurrence of a different window. A place begins at most one window of each size, so this grows with
    the shard, however many items share a window."""
    first, end = search(shard, order, bench.ids, bench.window_starts, bench.window_sizes)
    n = end - first
    places = order[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
    return np.repeat(np.arange(len(n)), n), places


def _long_runs(ids: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids with every run of fewer than `shortest` nonzero ones set to 0, and the places with that many left in their run."""
    zero = np.flatnonzero(np.concatenate([ids == 0, [True]]))
    left = zero[np.searchsorted(zero, np.arange(len(ids)))] - np.arange(len(ids))
    begins = np.concatenate([[True], ids[:-1] == 0])
    whole = left[np.maximum.accumulate(np.where(begins, np.arange(len(ids)), 0))]
    return np.where(whole >= shortest, ids, 0), np.flatnonzero(left >= shortest)


def scan_shard(texts: list[bytes], bench: Benchmark, find=longest_matches) -> tuple:
    """Words of each text, where each starts among all words of the shard (one place apart), and what `find` finds in the suffix
    array; None where there is nothing to search.

    Words the benchmark lacks are 0 and end every match, so only runs of its own words enter the suffix array.
    """
    lists = [words_of(t) for t in texts]
    counts = [len(x) for x in lists]
    begin = np.cumsum([0, *(c + 1 for c in counts)])[:-1]
    ids = np.fromiter(map(bench.vocabulary.get, chain.from_iterable((*x, b"") for x in lists), repeat(0)), np.int32,
                      sum(counts) + len(counts))
    if not bench.shortest or not len(ids):
        return counts, begin, None
    ids, at = _long_runs(ids, bench.shortest)
    if not len(at):
        return counts, begin, None
    padded = np.concatenate([ids, np.zeros(WINDOW, np.int32)])
    return counts, begin, find(padded, _shard_order(padded, np.flatnonzero(ids), at), bench)


def _shard_order(padded: np.ndarray, dense: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Suffix array of the places `at`, built over the kept words alone with one 0 between runs."""
    gap = np.concatenate([[True], np.diff(dense) > 1])
    new = np.arange(len(dense)) + np.cumsum(gap)
    small = np.zeros(int(new[-1]) + 2, np.int32)
    small[new] = padded[dense]
    back = np.zeros(len(small), np.int64)
    back[new] = dense
    return back[suffix_array(small, new[np.searchsorted(dense, at)])]


def _items_of(window: np.ndarray, bench: Benchmark) -> list[str]:
    """Names of the items that hold one of these windows."""
    parts = [bench.window_items[bench.items_from[w]:bench.items_from[w + 1]] for w in window.tolist()]
    return [bench.names[k] for k in np.unique(np.concatenate(parts)).tolist()] if parts else []


def _scan(batches: Iterator[pa.RecordBatch], bench: Benchmark, last: bool, keep_text: bool = False) -> Iterator[pa.RecordBatch]:
    """Add a block's hits to those of earlier blocks; all other columns stay. The last block hands on no bitmaps, and texts only on demand.

    Items are listed document by document and handed on ITEMS_HELD at a time; documents with the same windows share a list.
    """
    common.release()
    for batch in common.slices(batches):
        counts, begin, found = scan_shard([t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()], bench, window_hits)
        window, place = found if found is not None else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        marks = np.zeros(sum(counts) + len(counts) + 1, np.int64)
        np.add.at(marks, place, 1)
        np.add.at(marks, place + bench.window_sizes[window] if len(place) else place, -1)
        marks = np.cumsum(marks) > 0
        pairs = np.unique(np.column_stack([np.searchsorted(begin, place, "right") - 1, window]), axis=0).reshape(-1, 2)
        cuts = np.searchsorted(pairs[:, 0], np.arange(len(counts) + 1))
        known: dict[bytes, list[str]] = {}
        rows: list[list] = [[], [], []]
        start, held = 0, 0

        def flush(end: int) -> pa.RecordBatch:
            part = batch.slice(start, end - start)
            new = {"n_words": counts[start:end], "n_hit": rows[0], "hits": [None] * (end - start) if last else rows[1], "items": rows[2]}
            if last and not keep_text:
                new["text"] = [None] * (end - start)
            return pa.RecordBatch.from_arrays([pa.array(new[f.name], f.type) if f.name in new else part.column(k) for k, f in enumerate(part.schema)],
                                              schema=part.schema)

        for i, (b, c, old, before) in enumerate(zip(begin.tolist(), counts, batch.column("hits").to_pylist(), batch.column("items"), strict=True)):
            own = np.packbits(marks[b:b + c])
            own = own if old is None else own | np.frombuffer(old, np.uint8)
            windows = pairs[cuts[i]:cuts[i + 1], 1]
            if (key := windows.tobytes()) not in known:
                known[key] = sorted(set(_items_of(windows, bench)))
            names = known[key] if not before.is_valid or not len(before) else sorted({*known[key], *before.as_py()})
            for column, value in zip(rows, (int(np.bitwise_count(own).sum()), own.tobytes(), names), strict=True):
                column.append(value)
            held += len(names)
            if held > ITEMS_HELD:
                yield flush(i + 1)
                start, held, rows = i + 1, 0, [[], [], []]
        if start < len(counts):
            yield flush(len(counts))


_MATCH = pa.schema([("doc_id", pa.int64()), ("item_id", pa.string()), ("doc_word", pa.int64()), ("item_word", pa.int64()), ("n_words", pa.int64())])


def _locate(batches: Iterator[pa.RecordBatch], bench: Benchmark) -> Iterator[pa.RecordBatch]:
    common.release()
    for batch in common.slices(batches):
        _, begin, found = scan_shard(batch.column("text").to_pylist(), bench)
        found = np.zeros((0, 4), np.int64) if found is None else found
        doc = np.searchsorted(begin, found[:, 1], "right") - 1
        yield common.record_batch([batch.column("doc_id").take(pa.array(doc)), [bench.names[k] for k in found[:, 0].tolist()],
                                   found[:, 1] - begin[doc], found[:, 2], found[:, 3]], _MATCH)


def matches(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, doc_word, item_word, n_words): longest verbatim matches of at least a window, with their places."""
    out = None
    for bench in benchmark_blocks(benchmark, block_words):
        shared = docs.sparkSession.sparkContext.broadcast(bench)
        part = common.id_text(docs).mapInArrow(lambda batches, b=shared: _locate(batches, b.value),
                                               "doc_id long, item_id string, doc_word long, item_word long, n_words long")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], "doc_id long, item_id string, doc_word long, item_word long, n_words long")


def benchmark_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Benchmark]:
    """The benchmark in blocks of about `block_words` words. It streams to the driver one partition at a time; only one block is held."""
    rows = benchmark.select(F.col("item_id").cast("string"), F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    items, held = [], 0
    for name, text in rows.toLocalIterator():
        items.append((name, bytes(text)))
        held += len(text) // 4
        if held >= block_words:
            yield Benchmark(items)
            items, held = [], 0
    if items:
        yield Benchmark(items)


_STATE = ("0L n_words", "0L n_hit", "cast(null as binary) hits", "cast(null as array<string>) items")


def _searched(rows: DataFrame, benchmark: DataFrame, block_words: int, keep_text: bool) -> DataFrame:
    """Rows with a text and the columns of _STATE, after a pass for each block of the benchmark."""
    blocks = benchmark_blocks(benchmark, block_words)
    schema = StructType([StructField(f.name, f.dataType) for f in rows.schema])
    bench, k = next(blocks, Benchmark([])), 0
    while bench is not None:
        after = next(blocks, None)
        shared = rows.sparkSession.sparkContext.broadcast(bench)
        rows = rows.mapInArrow(lambda batches, b=shared, last=after is None: _scan(batches, b.value, last, keep_text), schema)
        bench, k = after, k + 1
        if bench is not None and k % 2 == 0:  # so that few Python workers share a stage
            rows = common.staged(rows, "op7-marks")
    return rows


def is_contaminated(n_hit: str = "n_hit", n_words: str = "n_words") -> Column:
    return (F.col(n_hit) > 0) & (SHARE * F.col(n_hit) >= F.col(n_words))


def contamination(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """op7: how much of each document lies in occurrences of benchmark windows.

    Every batch of documents is a shard with its own suffix array; every window of the benchmark is searched in it. A
    benchmark of more than `block_words` words (by its bytes) is searched block by block, each pass adding its marks to a bitmap per
    document. Windows of items without an id hit like all others, but these items are not counted or listed; repeated ids count once.
    Null and empty texts have no words, texts of any length are searched whole, repeated rows are judged alike. An empty table gives no
    rows, an empty benchmark no hits.
    """
    found = _searched(common.id_text(docs).selectExpr("doc_id", "text", *_STATE), benchmark, block_words, False)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        is_contaminated().alias("contaminated"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs without the contaminated rows. Every row is judged where it is, whatever its id; odd rows as in contamination."""
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")  # apart from the columns of the search, whatever their names
    rows = docs.select(others, "text").selectExpr("row", "text", *_STATE)
    kept = _searched(rows, benchmark, block_words, True).filter(~is_contaminated())
    return kept.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
