"""Helpers the operators share: input columns, staged tables, Arrow batches cut by bytes, component labelling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gidlake.settings import scratch_path

# Bytes of text that one step inside a task handles at once; bounds the Python objects alive in a worker.
CHUNK_BYTES = 4 << 20


# What operators keep in a Python worker between tasks: functions that drop it.
_kept: list = []


def keep(drop) -> None:
    """Note a cache that outlives a task."""
    _kept.append(drop)


def release() -> None:
    """Drop what other operators left in this worker; called where an operator's task starts."""
    while _kept:
        _kept.pop()()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): the id as long, the text as UTF-8 bytes, null as empty. Other columns play no part."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write df once to the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unique_ids(docs: DataFrame, label: str, key: str = "doc_id") -> DataFrame:
    """docs with one row for each id, the one whose other columns are smallest; rows without an id stay. Only ids that
    come more than once are shuffled with their columns."""
    repeated = staged(docs.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1").select(key), label)
    if repeated.isEmpty():
        return docs
    rest = [c for c in docs.columns if c != key]
    once = docs.join(repeated, key, "left_semi").groupBy(key).agg(F.min(F.struct(*rest)).alias("row")).select(key, "row.*")
    return docs.join(repeated, key, "left_anti").select(docs.columns).unionByName(once.select(docs.columns))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that `column` holds about `limit` bytes in each; a longer row comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = np.flatnonzero(np.diff(part)) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            yield batch.slice(start, end - start)


def record_batch(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type)
                                       for c, f in zip(columns, schema, strict=True)], schema=schema)


def components(edges: DataFrame, label: str, max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable over edges (a, b), for every node that has an edge.

    Alternates the large-star and small-star steps, each a grouped minimum and a join, until no edge changes. A hot node
    has many partners: its minimum is a partial aggregate, and minima are written before they are joined, so that adaptive
    execution can split the hot side. Every step is written to the shared folder. It stops with an error rather than return unfinished labels.
    """
    pairs = staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    mark = _fingerprint(pairs)
    for _ in range(max_rounds if mark[0] else 0):
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), label)
        large = staged(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                       .filter("a <> b").distinct(), label)
        least = staged(large.groupBy("a").agg(F.min("b").alias("m")), label)
        small = (large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        pairs = staged(small, label)
        now = _fingerprint(pairs)
        if now == mark:
            break
        mark = now
    else:
        if mark[0]:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))


def _fingerprint(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("b", "a"))).first()
    return tuple(row)


def local_roots(n: int, a: np.ndarray, b: np.ndarray, parent: np.ndarray | None = None) -> np.ndarray:
    """Smallest index reachable from each of n indices over links (a, b), by repeated minimum and pointer jumping."""
    root = np.arange(n) if parent is None else parent
    while len(a):
        ra, rb = root[a], root[b]
        keep = ra != rb
        if not keep.any():
            break
        a, b, ra, rb = a[keep], b[keep], ra[keep], rb[keep]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root
