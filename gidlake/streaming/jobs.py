"""Incremental assembly, gid dedup and windowed error counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gidlake.functions.values import zone_free_micros
from gidlake.operators.assembly import Landing, assemble
from gidlake.operators.discovery import normalize_gid
from gidlake.operators.geo import cache_store
from gidlake.sources.keyed_store import KeyedStore, bucket_of
from gidlake.streaming.waiting import Waiting

EPOCH = "1970-01-01 00:00:00"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Folders that inputs landed for a stream are dealt over.
GID_BUCKETS = 64


def stream_gids(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """Gids arriving as parquet files."""
    return spark.readStream.schema("gid string").option("maxFilesPerTrigger", files_per_batch).parquet(path)


def dedup_stream(gids: DataFrame) -> DataFrame:
    """Every gid once over the life of the stream.

    The state, one entry for each gid ever seen, is kept by RocksDB outside the heap, with its versions in the checkpoint.
    Repeats within a micro-batch are dropped by a partial aggregate before the shuffle.
    """
    gids.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return normalize_gid(gids.select("gid")).dropDuplicates(["gid"])


def dedup_within(gids: DataFrame, ts: str, delay: str) -> DataFrame:
    """T02 with bounded state: a gid is dropped if it came before within `delay` of event time.

    A gid's entry leaves the state once the watermark, the latest time seen less `delay`, has passed it, so the state holds the gids of about one
    delay, however long the stream runs. Rows later than the watermark, and rows without a time, are dropped.
    """
    gids.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    timed = gids.select("gid", as_instant(ts).alias("at")).filter("at is not null")
    return normalize_gid(timed).withWatermark("at", delay).dropDuplicatesWithinWatermark(["gid"]).select("gid", as_zone_free(F.col("at")).alias(ts))


def waiting_gids(wanted: DataFrame, known: DataFrame, wait_seconds: float = 3600) -> DataFrame:
    """(gid, ready): each wanted gid once, as soon as a source knows it, in whatever order the two come.

    `known` is a stream of gids from the sources as they land. A wanted gid that no source knows is kept in the state; it comes out with
    `ready` false after each wait, and as ready once its record lands. Repeats on either side change nothing. The clock is the
    batches' own time, the same when a batch is retried; so no row is ever late.
    """
    spark = wanted.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    sides = [normalize_gid(side.select("gid")).withColumn("wanted", F.lit(flag)) for side, flag in ((wanted, True), (known, False))]
    timed = sides[0].unionByName(sides[1]).withColumn("at", F.current_timestamp()).withWatermark("at", "0 seconds")
    return timed.select("gid", "wanted", "at", F.unix_millis("at").alias("millis")).groupBy("gid").transformWithState(
        Waiting(int(wait_seconds * 1000)), "gid string, ready boolean", "Append", "EventTime")


def land_by_bucket(landing: Landing, root: str, buckets: int = GID_BUCKETS) -> Landing:
    """Write the inputs keyed by gid as folders per gid bucket, and the geocode cache as a store, so a micro-batch reads only the buckets
    of its gids and of the keys they look up."""
    def placed(df: DataFrame, name: str) -> DataFrame:
        path = f"{root}/{name}"
        keyed = df.withColumn("gid_bucket", bucket_of("gid", buckets))
        keyed.repartition("gid_bucket", F.pmod(F.hash(*df.columns[:2]), F.lit(8))).write.mode("overwrite").partitionBy("gid_bucket").parquet(path)
        return df.sparkSession.read.schema(keyed.schema).parquet(path)

    cache = landing.geocode_cache
    if not isinstance(cache, KeyedStore):
        store = cache_store(landing.feed.sparkSession, f"{root}/geocode_cache", buckets)
        if not store.version():
            store.append(cache)
        cache = store
    return Landing(*(placed(getattr(landing, name), name) for name in Landing._fields[:-1]), cache)


def narrowed(landing: Landing, gids: DataFrame, buckets: int = GID_BUCKETS) -> Landing:
    """Landed inputs of some gids only; the cache is keyed differently and is pruned when it is looked up.

    Inputs landed by bucket are pruned to the buckets of the gids, a list of at most `buckets` numbers.
    """
    bucketed = "gid_bucket" in landing.feed.columns
    wanted = [r.b for r in gids.select(bucket_of("gid", buckets).alias("b")).distinct().collect()] if bucketed else []

    def of(df: DataFrame) -> DataFrame:
        pruned = df.filter(F.col("gid_bucket").isin(wanted)).drop("gid_bucket") if bucketed else df
        return pruned.join(gids, "gid", "left_semi")

    return Landing(*(of(getattr(landing, name)) for name in Landing._fields[:-1]), landing.geocode_cache)


def start_assembly(gids: DataFrame, landing: Landing | Callable[[], Landing], out: str, checkpoint: str, run_ts: str,
                   buckets: int = GID_BUCKETS, known: DataFrame | None = None, wait_seconds: float = 3600) -> StreamingQuery:
    """Assemble each micro-batch into its own folder; a retried batch overwrites its folder.

    A gid that comes again in the same or a later batch is not assembled again. Land the inputs with land_by_bucket
    first, or every batch reads them whole. Pass a function for inputs that grow while the stream runs; it is called for each batch.
    With `known`, a stream of gids from landing sources, gids that no source knows yet wait for their record (waiting_gids); those
    overdue are listed under `overdue`.
    """
    waits = known is not None

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, at = batch.sparkSession, f"{out}/gids/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(at)
        wanted = spark.read.schema(batch.schema).parquet(at)
        if waits:
            wanted.filter("not ready").select("gid").write.mode("overwrite").parquet(f"{out}/overdue/batch_id={batch_id}")
            wanted = wanted.filter("ready").select("gid")
        landed = landing() if callable(landing) else landing
        done = assemble(wanted, narrowed(landed, wanted, buckets), run_ts, stage=f"{out}/located/batch_id={batch_id}")
        done.projects.write.mode("overwrite").parquet(f"{out}/projects/batch_id={batch_id}")
        done.failures.write.mode("overwrite").parquet(f"{out}/failures/batch_id={batch_id}")

    stream = waiting_gids(gids, known, wait_seconds) if waits else dedup_stream(gids)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def as_instant(ts: str) -> Column:
    """Zone-free timestamp column read as UTC, whatever the session's zone."""
    return F.timestamp_micros(zone_free_micros(F.col(ts)))


def as_zone_free(instant: Column) -> Column:
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.lit(EPOCH).cast("timestamp_ntz"))


def windowed_errors(errors: DataFrame, lateness: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Errors per closed window; counted per task before the shuffle, state bounded by the watermark."""
    timed = errors.select(as_instant("ts").alias("at")).withWatermark("at", lateness)
    counted = timed.groupBy(F.window("at", width)).agg(F.count("*").alias("errors"))
    return counted.select(as_zone_free(F.col("window.start")).alias("window_start"), "errors")


def run_to_folder(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Append everything available now to a parquet folder and wait for it."""
    query = (stream.writeStream.outputMode("append").format("parquet").option("path", out)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
