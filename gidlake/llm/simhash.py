"""op9: near-duplicate documents by 64-bit SimHash, linked in a self-join of the fingerprints' binary trie."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from gidlake.llm import common

SHINGLE, SEED, BITS, BUDGET = 3, 42, 64, 2
# A task joins two subtries; the trie is cut so deep that they have about this many fingerprints.
SUBTRIE = 16_384
# Pairs of subtries with more rows than this are cut again, deeper.
TOO_LARGE = 262_144
# Inside a task: node pairs followed at once, products compared directly, fingerprint pairs compared at once.
FRONTIER, DIRECT, COMPARED = 100_000, 64, 1 << 21

_FINGERPRINT = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])

_hash = partial(xxh64_intdigest, seed=SEED)
# The masks of a 4-bit step that the budget allows, with the bits each changes.
_STEP = 4
_MASKS = [(m, m.bit_count()) for m in range(1 << _STEP) if m.bit_count() <= BUDGET]


def fingerprint(text: bytes) -> int:
    """A bit is 1 if it is set in over half the shingles' hashes; a text without words has none set."""
    words = text.lower().split()
    if not words:
        return 0
    k = min(SHINGLE, len(words))
    ones, n = np.zeros(BITS, np.int64), len(words) - k + 1
    shingles = map(_hash, map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False)))
    for at in range(0, n, 65_536):
        part = np.fromiter(shingles, np.uint64, min(65_536, n - at))
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    common.release()
    for batch in common.slices(batches):
        yield common.record_batch([batch.column("doc_id"), [fingerprint(t) for t in batch.column("text").to_pylist()]], _FINGERPRINT)


def fingerprints(docs: DataFrame) -> DataFrame:
    return common.id_text(docs).mapInArrow(_fingerprints, "doc_id long, fp long")


# --- subtrie pairs


def _deeper(rows: DataFrame, depth: int, step: int) -> DataFrame:
    """Deal rows (ga, gb, depth, err, side, fp) of node pairs of one depth to the pairs of their children that stay in the budget."""
    masks = [(m, m.bit_count()) for m in range(1 << step) if m.bit_count() <= BUDGET]
    choices = F.array(*(F.struct(F.lit(m).cast("long").alias("mask"), F.lit(d).alias("bits")) for m, d in masks))
    own = F.shiftrightunsigned("fp", BITS - depth - step).bitwiseAND(F.lit((1 << step) - 1).cast("long"))
    dealt = (rows.withColumn("own", own).withColumn("c", F.explode(choices)).filter(F.col("err") + F.col("c.bits") <= BUDGET)
             .withColumn("other", F.col("own").bitwiseXOR(F.col("c.mask"))))
    twin = F.col("ga") == F.col("gb")  # a node with itself: each pair of its children once

    def child(parent: str, sub: Column) -> Column:
        return F.shiftleft(parent, step).bitwiseOR(sub)

    first = F.when(twin, F.least("own", "other")).otherwise(F.when(F.col("side") == 0, F.col("own")).otherwise(F.col("other")))
    second = F.when(twin, F.greatest("own", "other")).otherwise(F.when(F.col("side") == 0, F.col("other")).otherwise(F.col("own")))
    side = F.when(twin, (F.col("own") > F.col("other")).cast("int")).otherwise(F.col("side"))
    return dealt.select(child("ga", first).alias("ga"), child("gb", second).alias("gb"), F.lit(depth + step).alias("depth"),
                        (F.col("err") + F.col("c.bits")).alias("err"), side.alias("side"), "fp")


def _step_for(rows: int) -> int:
    return min(8, max(1, math.ceil(math.log2(max(2.0, rows / SUBTRIE)))))


def subtrie_pairs(distinct: DataFrame, n: int) -> list[DataFrame]:
    """Rows of every pair of subtries whose prefixes differ in at most BUDGET bits, cut until each fits a task."""
    ready, depth = [], 0
    rows = distinct.select(*(F.lit(0).cast("long").alias(g) for g in ("ga", "gb")), F.lit(0).alias("depth"), F.lit(0).alias("err"),
                           F.lit(0).alias("side"), "fp")
    largest = n
    while largest > TOO_LARGE or (not ready and n > SUBTRIE and depth == 0):
        step = min(_step_for(largest), BITS - depth)
        rows = common.staged(_deeper(rows, depth, step), "op9-pairs")
        depth += step
        sizes = common.staged(rows.groupBy("ga", "gb").count(), "op9-sizes")
        largest = sizes.agg(F.max("count")).first()[0]
        if depth == BITS or largest <= TOO_LARGE:
            break
        large = sizes.filter(F.col("count") > TOO_LARGE).select("ga", "gb")
        ready.append(rows.join(large, ["ga", "gb"], "left_anti"))
        rows = common.staged(rows.join(large, ["ga", "gb"], "left_semi"), "op9-large")
    return [*ready, rows]


# --- inside a task


def trie_links(a: np.ndarray, b: np.ndarray, depth: int, err: int, twin: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted fingerprints a, b that differ in at most BUDGET bits; with `twin`, a is b and pairs come once.

    Walks both tries together, four levels a step. A pair of nodes is a range in each array and the bits that differ so
    far; pairs over the budget are dropped, small ones are compared directly.
    """
    todo = [(depth, *(np.array([x], np.int64) for x in (0, len(a), 0, len(b), err)))]
    while todo:
        depth, alo, ahi, blo, bhi, used = todo.pop()
        small = ((ahi - alo) * (bhi - blo) <= DIRECT) | (depth >= BITS)
        if small.any():
            yield from _compare(a, b, alo[small], ahi[small], blo[small], bhi[small], twin)
            alo, ahi, blo, bhi, used = (x[~small] for x in (alo, ahi, blo, bhi, used))
        if not len(alo):
            continue
        if len(alo) > FRONTIER:
            todo += [(depth, *(x[i:i + FRONTIER] for x in (alo, ahi, blo, bhi, used))) for i in range(0, len(alo), FRONTIER)]
            continue
        step = min(_STEP, BITS - depth)
        a_cuts, b_cuts = _children(a, alo, ahi, depth, step), _children(b, blo, bhi, depth, step)
        found = []
        sub = np.arange(1 << step)
        for mask, bits in _MASKS:
            if mask >> step:
                continue
            within = np.flatnonzero(used + bits <= BUDGET)
            ac, bc = a_cuts[within], b_cuts[within]
            full = (ac[:, sub + 1] > ac[:, sub]) & (bc[:, (sub ^ mask) + 1] > bc[:, sub ^ mask])
            if twin:
                full &= ac[:, sub] <= bc[:, sub ^ mask]
            i, x = np.nonzero(full)
            y = x ^ mask
            found.append((ac[i, x], ac[i, x + 1], bc[i, y], bc[i, y + 1], used[within[i]] + bits))
        todo.append((depth + step, *(np.concatenate(x) for x in zip(*found, strict=True))))


def _children(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int, step: int) -> np.ndarray:
    """Cuts of each node's range at its 2^step children."""
    nodes, back = np.unique(lo, return_inverse=True)  # nodes of one depth are disjoint ranges
    ends = np.zeros(len(nodes), np.int64)
    ends[back] = hi
    shift = np.uint64(BITS - depth - step)
    prefix = keys[nodes] >> np.uint64(BITS - depth) << np.uint64(step) if depth else np.zeros(len(nodes), np.uint64)
    bounds = (prefix[:, None] + np.arange(1, 1 << step, dtype=np.uint64)) << shift
    inner = np.searchsorted(keys, bounds.ravel()).reshape(bounds.shape)
    return np.column_stack([nodes, inner, ends])[back]


def _compare(a, b, alo, ahi, blo, bhi, twin) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    product = (ahi - alo) * (bhi - blo)
    part = np.cumsum(product) // COMPARED
    for k in np.unique(part):
        own = part == k
        n, wide, size = product[own], (bhi - blo)[own], int(product[own].sum())
        place = np.arange(size) - np.repeat(np.cumsum(n) - n, n)
        row, col = np.divmod(place, np.repeat(wide, n))
        i, j = np.repeat(alo[own], n) + row, np.repeat(blo[own], n) + col
        near = np.bitwise_count(a[i] ^ b[j]) <= BUDGET
        if twin:
            near &= i < j
        yield i[near], j[near]


def _join_group(table: pa.Table) -> pa.Table:
    """Star edges that connect what the links of one subtrie pair connect: fewer than its rows, however many links."""
    ga, gb, depth, err = (table.column(c)[0].as_py() for c in ("ga", "gb", "depth", "err"))
    fp, side = (table.column(c).to_numpy() for c in ("fp", "side"))
    a = np.sort(fp[side == 0].view(np.uint64))
    b = a if ga == gb else np.sort(fp[side == 1].view(np.uint64))
    offset = 0 if ga == gb else len(a)
    both = a if ga == gb else np.concatenate([a, b])
    root = np.arange(len(both))
    if len(a) and len(b):
        for i, j in trie_links(a, b, depth, err, ga == gb):
            root = common.local_roots(len(both), i, j + offset, root)
    linked = np.flatnonzero(root != np.arange(len(both)))
    return pa.table([both[linked].view(np.int64), both[root[linked]].view(np.int64)], schema=_EDGE)


def simhash_components(docs: DataFrame) -> DataFrame:
    """op9: (doc_id, fingerprint, component_id) of every row.

    Fingerprints link at BUDGET or fewer differing bits; component_id is the smallest doc_id reachable. Copies share a
    fingerprint and meet once. Null and empty texts have fingerprint zero, rows without an id take part but name no component. Texts of any length
    take part whole, repeated rows are copies, further columns play no part, and an empty table gives no rows.
    """
    rows = common.staged(fingerprints(docs), "op9-rows")
    distinct = common.staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "op9-distinct")
    edges = [part.groupBy("ga", "gb", "depth", "err").applyInArrow(_join_group, "a long, b long")
             for part in subtrie_pairs(distinct.select("fp"), distinct.count())]
    linked = edges[0]
    for more in edges[1:]:
        linked = linked.unionByName(more)
    roots = common.staged(common.components(linked, "op9-links"), "op9-roots")
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = common.staged(named, "op9-named")
    smallest = named.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    smallest = common.staged(smallest, "op9-smallest")
    of_fp = common.staged(named.join(smallest, "root").select("fp", "component_id"), "op9-components")
    return (rows.join(of_fp, "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))
