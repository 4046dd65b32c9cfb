"""Batches that stay as they are while new gids arrive."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gidlake.operators.skew import positions
from gidlake.sources.keyed_store import BUCKETS, KeyedStore


def batch_ledger(spark: SparkSession, root: str, buckets: int = BUCKETS) -> KeyedStore:
    """A ledger of (gid, position): places in the order in which gids were given out, without gaps."""
    return KeyedStore(spark, root, "gid", StructType.fromDDL("gid string, position bigint"), buckets)


def give_places(ledger: KeyedStore, gids: DataFrame) -> int:
    """Add the gids that have no place yet behind all others, in the order of their md5; places given before never change. A job that
    is run again adds nothing. `gids` should be a written table."""
    wanted = gids.select("gid").filter("gid is not null").distinct()
    known = ledger.read(ledger.buckets_of(wanted))
    new = wanted.join(known, "gid", "left_anti")
    start = ledger.read().agg(F.coalesce(F.max("position") + 1, F.lit(0))).first()[0]
    return ledger.append(positions(new, "gid").withColumn("position", F.col("position") + F.lit(start)))


def stable_batches(ledger: KeyedStore, batch_size: int) -> DataFrame:
    """(gid, batch_id): every batch but the last has exactly `batch_size` gids, and a full batch stays as it is."""
    return ledger.read().select("gid", F.floor(F.col("position") / batch_size).cast("bigint").alias("batch_id"))


def append_batches(batches: Iterable[DataFrame]) -> DataFrame:
    """The rows of all batches; a field that a batch has not got is null."""
    whole, *more = batches
    for batch in more:
        whole = whole.unionByName(batch, allowMissingColumns=True)
    return whole
