"""op10: approximate nearest neighbours along several shifted Hilbert curves of projected vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gidlake.llm import common

NEAREST = 5
# Curves added at once, rows of one window (a query sees its own and both neighbours), and the recall to be reached.
CURVES, WINDOW, RECALL = 16, 1024, 0.94
# Rounds of curves at most; where they do not reach RECALL, all queries are answered by exact products.
ROUNDS = 4
# Exact products: bytes of query vectors sent to the tasks at once, queries and vectors of one product.
ASKED_BYTES, TILE_QUERIES, TILE_VECTORS = 16 << 20, 1024, 4096
# Projected dimensions and bits of each; together the bits of a key.
DIMENSIONS, BITS = 8, 7
# Bounds of what is fitted or measured: vectors for the axes, queries searched exhaustively.
SAMPLE, PROBES = 8192, 96
SEED = 11

_HIT = pa.schema([("query", pa.int64()), ("found", pa.int64()), ("score", pa.float64())])
_HIT_DDL = "query long, found long, score double"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of integer cells (rows of coordinates below 2^bits) along the Hilbert curve.

    Works on all rows at once, by the transform of axes to transposed index: undo the rotations from the highest bit down,
    then read the Gray code off, then weave the bits of the axes.
    """
    x = np.ascontiguousarray(cells.T.astype(np.uint64))
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):
        top, below = one << np.uint64(b), (one << np.uint64(b)) - one
        for axis in x:
            turn = (axis & top) > 0
            swap = np.where(turn, np.uint64(0), (x[0] ^ axis) & below)
            x[0] ^= np.where(turn, below, swap)
            axis ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> np.uint64(b) & one > 0, (one << np.uint64(b)) - one, np.uint64(0))
    x ^= flip
    key = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for axis in x:
            key = key << one | (axis >> np.uint64(b) & one)
    return key.astype(np.int64)


class Curves:
    """Projections of unit vectors to grids, one for each curve: random mixtures of the sample's axes, the wider an axis
    the more it counts, each grid shifted by a random part of its width."""

    def __init__(self, sample: np.ndarray, first: int, curves: int):
        self.first = first
        centred = sample - sample.mean(0)
        width, axes = np.linalg.eigh(centred.T @ centred / len(sample))
        self.maps, self.low, self.step = [], [], []
        for c in range(first, first + curves):
            rng = np.random.default_rng(SEED + c)
            project = (axes * (width / max(width[-1], 1e-12))) @ rng.normal(size=(sample.shape[1], DIMENSIONS))
            placed = sample @ project
            low, high = placed.min(0), placed.max(0)
            span = np.maximum(high - low, 1e-9) * 1.25  # room for the shift
            self.maps.append(project)
            self.low.append(low - rng.random(DIMENSIONS) * 0.2 * span)
            self.step.append((1 << BITS) / span)

    def keys(self, unit: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        for i, (project, low, step) in enumerate(zip(self.maps, self.low, self.step, strict=True)):
            cells = np.clip(np.floor((unit @ project - low) * step), 0, (1 << BITS) - 1)
            yield self.first + i, hilbert_keys(cells, BITS)


def _matrix(column) -> np.ndarray:
    """Rows of float64 from packed vectors."""
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(1, keepdims=True)  # keeps squares of tiny and huge values in range
    x = x / scale
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row pair in double precision: the same for the same two vectors wherever they meet."""
    dot = (a * b).sum(1)
    return dot / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def _best(query_ids, queries, ids, vectors, k) -> pa.RecordBatch:
    """The k nearest of `vectors` for each query, by exact score, ties to the smaller id."""
    rough = _unit(queries) @ _unit(vectors).T
    k = min(k, len(ids))
    last = np.partition(rough, -k, axis=1)[:, -k][:, None]
    q, v = np.nonzero(rough >= last - 1e-9)
    score = cosines(queries[q], vectors[v])
    order = np.lexsort((ids[v], -score, q))
    q, v, score = q[order], v[order], score[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    keep = place < k
    return common.record_batch([query_ids[q[keep]], ids[v[keep]], score[keep]], _HIT)


def vectors_of(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, vec) of usable rows, vec packed as float64: not null, finite throughout, not zero, of the most common length."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    ok = (F.col("v").isNotNull() & F.col("vec_id").isNotNull()
          & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0))
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter(ok)
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype("<f8") + 0.0
            wide = len(flat) // max(batch.num_rows, 1) * 8
            raw = flat.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([raw[i:i + wide] for i in range(0, len(raw), max(wide, 1))], pa.binary())], ["vec_id", "vec"])

    return rows.filter(F.size("v") == (size["n"] if size else 0)).mapInArrow(run, "vec_id long, vec binary")


def _keyed(batches: Iterator[pa.RecordBatch], curves: Curves) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("curve", pa.int32()), ("key", pa.int64()), ("rep", pa.int64())])
    for batch in batches:
        if batch.num_rows:
            for curve, key in curves.keys(_unit(_matrix(batch.column("vec")))):
                yield common.record_batch([np.full(len(key), curve), key, batch.column("rep")], schema)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("curve", pa.int32()), ("rep", pa.int64()), ("part", pa.int32()), ("place", pa.int64())])
    part, counts = TaskContext.get().partitionId(), {}
    for batch in batches:
        curve = batch.column("curve").to_numpy()
        place = np.zeros(len(curve), np.int64)
        for c in np.unique(curve).tolist():
            own = np.flatnonzero(curve == c)
            place[own] = counts.get(c, 0) + np.arange(len(own))
            counts[c] = counts.get(c, 0) + len(own)
        yield common.record_batch([batch.column("curve"), batch.column("rep"), np.full(len(curve), part), place], schema)


def _in_window(table: pa.Table) -> pa.Table:
    asks = table.filter(table.column("asks"))
    held = table.filter(pa.compute.invert(table.column("asks")))
    if not len(asks) or not len(held):
        return pa.table([[], [], []], schema=_HIT)
    batch = _best(asks.column("rep").to_numpy(), _matrix(asks.column("vec").combine_chunks()), held.column("rep").to_numpy(),
                  _matrix(held.column("vec").combine_chunks()), NEAREST + 1)
    return pa.Table.from_batches([batch])


def window_hits(classes: DataFrame, queries: DataFrame, curves: Curves) -> DataFrame:
    """(query, found, score): the nearest vectors of each query within its windows on each curve.

    Vectors are range-partitioned by curve and key; their places along a curve, from counts per partition, cut it into
    windows of WINDOW rows. A query goes to its own window and to both neighbours, so no window has more than four times
    its rows, however keys are spread.
    """
    keyed = classes.mapInArrow(lambda batches: _keyed(batches, curves), "curve int, key long, rep long")
    order = ("curve", "key", "rep")
    placed = common.staged(keyed.repartitionByRange(*order).sortWithinPartitions(*order)
                           .mapInArrow(_numbered, "curve int, rep long, part int, place long"), "op10-places")
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("curve", "part").count().select("curve", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("begin"))
    cell = F.floor((F.col("place") + F.col("begin")) / WINDOW)
    # One row for each curve and partition, so the broadcast does not grow with the vectors of a partition.
    windows = placed.join(F.broadcast(starts), ["curve", "part"]).select("curve", "rep", cell.alias("window"))
    rows = windows.join(classes, "rep")
    asks = (windows.join(queries, "rep").join(classes, "rep")
            .select("rep", "curve", F.explode(F.sequence(F.col("window") - 1, F.col("window") + 1)).alias("window"), "vec", F.lit(True).alias("asks")))
    both = rows.select("rep", "curve", "window", "vec", F.lit(False).alias("asks")).unionByName(asks)
    return common.staged(both.groupBy("curve", "window").applyInArrow(_in_window, _HIT_DDL), "op10-hits")


def _top(hits: DataFrame, k: int) -> DataFrame:
    once = hits.groupBy("query", "found").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "found"))
    return once.withColumn("n", rank).filter(F.col("n") <= k).drop("n")


def exhaustive(classes: DataFrame, probes: list[tuple[int, bytes]]) -> DataFrame:
    """The true nearest vectors of a bounded list of queries, in blocks of all vectors."""
    ids = np.array([i for i, _ in probes], np.int64)
    asked = np.frombuffer(b"".join(v for _, v in probes), "<f8").reshape(len(ids), -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _best(ids, asked, batch.column("rep").to_numpy(), _matrix(batch.column("vec")), NEAREST + 1)

    return _top(classes.mapInArrow(run, _HIT_DDL), NEAREST + 1)


class Nearest:
    """The k nearest vectors so far of a block of queries, by exact score, ties to the smaller id."""

    def __init__(self, asked: np.ndarray, k: int):
        self.asked, self.unit, self.k = asked, _unit(asked), k
        self.score = np.full((len(asked), k), -np.inf)
        self.found = np.full((len(asked), k), -1, np.int64)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        unit = _unit(vectors)
        for t in range(0, len(self.asked), TILE_QUERIES):
            rough = self.unit[t:t + TILE_QUERIES] @ unit.T
            bar = self.score[t:t + TILE_QUERIES, -1]
            if np.isneginf(bar).any():
                k = min(self.k, len(ids))
                bar = np.where(np.isneginf(bar), np.partition(rough, -k, axis=1)[:, -k], bar)
            q, v = np.nonzero(rough >= bar[:, None] - 1e-9)
            if len(q):
                self._merge(q + t, ids[v], cosines(self.asked[q + t], vectors[v]))

    def _merge(self, q: np.ndarray, found: np.ndarray, score: np.ndarray) -> None:
        own = np.unique(q)
        q = np.concatenate([q, np.repeat(own, self.k)])
        found, score = np.concatenate([found, self.found[own].ravel()]), np.concatenate([score, self.score[own].ravel()])
        real = np.isfinite(score)
        q, found, score = q[real], found[real], score[real]
        order = np.lexsort((-score, found, q))  # an id with several vectors counts once, by its best
        q, found, score = q[order], found[order], score[order]
        once = np.concatenate([[True], (np.diff(q) != 0) | (np.diff(found) != 0)])
        q, found, score = q[once], found[once], score[once]
        order = np.lexsort((found, -score, q))
        q, found, score = q[order], found[order], score[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = place < self.k
        self.found[q[keep], place[keep]], self.score[q[keep], place[keep]] = found[keep], score[keep]


def exact_hits(classes: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query, found, score): the true k nearest vectors of all queries, in blocked products with all vectors.

    Queries go to the tasks in blocks of bounded bytes, one pass over the vectors for each block; a task keeps k vectors a query.
    """
    asking = common.staged(queries.join(classes, "rep"), "op10-asking")
    size = asking.agg(F.coalesce(F.sum(F.length("vec") + 8), F.lit(0))).first()[0]
    blocks = max(1, -(-size // ASKED_BYTES))
    hits = []
    for block in range(blocks):
        rows = asking.filter(F.pmod(F.xxhash64("rep"), F.lit(blocks)) == block).collect()
        if rows:
            ids = np.array([r.rep for r in rows], np.int64)
            asked = np.frombuffer(b"".join(bytes(r.vec) for r in rows), "<f8").reshape(len(ids), -1)
            hits.append(common.staged(classes.mapInArrow(_exact_task(ids, asked, k), _HIT_DDL), "op10-exact"))
    every = hits[0]
    for more in hits[1:]:
        every = every.unionByName(more)
    return common.staged(_top(every, k), "op10-exact-top")


def _exact_task(ids: np.ndarray, asked: np.ndarray, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = Nearest(asked, k)
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_VECTORS):
                part = batch.slice(at, TILE_VECTORS)
                near.add(part.column("rep").to_numpy(), _matrix(part.column("vec")))
        for t in range(0, len(ids), TILE_QUERIES):
            q, place = np.nonzero(np.isfinite(near.score[t:t + TILE_QUERIES]))
            yield common.record_batch([ids[q + t], near.found[q + t, place], near.score[q + t, place]], _HIT)

    return run


def measured_recall(hits: DataFrame, truth: DataFrame) -> float:
    """Share of the true nearest vectors, the query's own left out, that were found."""
    wanted = truth.filter("query <> found")
    row = (wanted.join(hits.select("query", "found").distinct().withColumn("hit", F.lit(1)), ["query", "found"], "left")
           .agg(F.coalesce(F.avg(F.coalesce("hit", F.lit(0))), F.lit(1.0))).first())
    return float(row[0])


def nearest_neighbours(embeddings: DataFrame, every: int = 50, nearest: int = NEAREST) -> DataFrame:
    """op10: (query_id, rank, vec_id, score, recall) of the `nearest` found for every vec_id divisible by `every`.

    Equal vectors are one class in the index, so a large group of copies takes one place on each curve; answers name the
    class members with the smallest ids. Curves are added until the recall measured on PROBES queries reaches RECALL;
    if ROUNDS of them do not, all queries are answered by exact products, so that no table is too large for the windows.
    Rows without an id or a usable vector take no part; repeated ids with equal vectors count once.
    """
    spark = embeddings.sparkSession
    all_rows = common.staged(vectors_of(embeddings).distinct(), "op10-vectors")
    own = Window.partitionBy("vec").orderBy("vec_id")
    members = (all_rows.withColumn("n", F.row_number().over(own)).filter(F.col("n") <= nearest + 1))
    members = common.staged(members.withColumn("rep", F.min("vec_id").over(Window.partitionBy("vec"))), "op10-members")
    classes = common.staged(members.filter("n = 1").select("rep", "vec"), "op10-classes")
    wanted = all_rows.filter(F.col("vec_id") % every == 0)
    asked = common.staged(wanted.join(classes.select("rep", "vec"), "vec").select("vec_id", "rep"), "op10-asked")
    queries = common.staged(asked.select("rep").distinct(), "op10-queries")
    sample = classes.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("vec").toPandas()["vec"].tolist()
    schema = "query_id long, rank int, vec_id long, score double, recall double"
    if not sample:
        return spark.createDataFrame([], schema)
    axes = _unit(np.frombuffer(b"".join(map(bytes, sample)), "<f8").reshape(len(sample), -1))
    probes = [(r.rep, bytes(r.vec)) for r in queries.join(classes, "rep").orderBy(F.xxhash64("rep"), "rep").limit(PROBES).collect()]
    if not probes:
        return spark.createDataFrame([], schema)
    truth = common.staged(exhaustive(classes, probes), "op10-truth")
    hits, recall = None, 0.0
    for r in range(ROUNDS):
        new = window_hits(classes, queries, Curves(axes, r * CURVES, CURVES))
        hits = new if hits is None else common.staged(_top(hits.unionByName(new), nearest + 1), "op10-merged")
        recall = measured_recall(hits, truth)
        if recall >= RECALL:
            break
    if recall < RECALL:
        hits = exact_hits(classes, queries, nearest + 1)
        recall = measured_recall(hits, truth)
    found = _top(hits, nearest + 1).join(members.select(F.col("rep").alias("found"), "vec_id"), "found")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    lists = (found.withColumn("n", rank).filter(F.col("n") <= nearest + 1).groupBy("query")
             .agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near")))
    lists = common.staged(lists, "op10-lists")
    joined = asked.withColumnRenamed("vec_id", "query_id").join(lists, F.col("rep") == F.col("query"))
    kept = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, nearest)
    return (joined.select("query_id", F.posexplode(kept).alias("at", "x"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"), F.lit(recall).alias("recall")))
