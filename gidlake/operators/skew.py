"""Joins and nested groups that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import Window

from gidlake.settings import scratch_path, shuffles_removed

# A key is hot when it holds more than 1/HOT_SHARE of all rows, so there are fewer than HOT_SHARE hot keys.
HOT_SHARE = 1000
# Rows of a hot key meant for one task; rows without a key go to SALTS tasks.
ROWS_PER_TASK = 500_000
SALTS = 128


def heavy_keys(df: DataFrame, on: str, share: int = HOT_SHARE) -> DataFrame:
    """(key, n) of keys holding more than 1/share of the non-null rows: fewer than `share` rows, whatever the input size."""
    counts = df.filter(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.filter(F.col("n") * share > total).select(on, "n")


def skew_join(big: DataFrame, small: DataFrame, on: str, how: str, spread: Column,
              hot: DataFrame | None = None, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Equi-join in which each hot key of `big` is dealt over as many tasks as its rows need, two at least.

    Only the hot keys of `small` are copied per task. Rows of `big` without a key are dealt out as well, so an outer
    join does not gather them in one task. `hot` has (key, n) rows and is broadcast; heavy_keys bounds its size. Keys without
    n are dealt over two tasks.
    """
    hot = heavy_keys(big, on) if hot is None else hot
    deals = F.greatest(F.ceil(F.col("n") / rows_per_task), F.lit(2)).cast("int") if "n" in hot.columns else F.lit(2)
    marks = F.broadcast(hot.select(on, deals.alias("deals")))
    deal = F.pmod(F.xxhash64(spread), F.coalesce("deals", F.lit(SALTS))).cast("int")
    dealt = (big.join(marks, on, "left")
             .withColumn("salt", F.when(F.col("deals").isNotNull() | F.col(on).isNull(), deal).otherwise(F.lit(0)))
             .drop("deals"))
    copies = F.when(F.col("deals").isNotNull(), F.sequence(F.lit(0), F.col("deals") - 1)).otherwise(F.array(F.lit(0)))
    copied = small.join(marks, on, "left").withColumn("salt", F.explode(copies)).drop("deals")
    return dealt.join(copied, [on, "salt"], how).drop("salt")


def written(df: DataFrame, label: str) -> DataFrame:
    """df written to a new folder below the shared one and read back."""
    path = scratch_path(df.sparkSession, label)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def long_groups(df: DataFrame, on: str, page_size: int) -> DataFrame:
    """(key, parts) of groups with more than `page_size` rows, whatever else is in the table.

    Written to the shared folder, so a join with it can be split at a hot key; it is never broadcast by hint.
    """
    sizes = df.groupBy(on).agg(F.count("*").alias("n")).filter(F.col("n") > page_size)
    return written(sizes.select(on, F.ceil(F.col("n") / page_size).cast("int").alias("parts")), "groups")


def counted_groups(counts: DataFrame, on: str, n: str, page_size: int) -> DataFrame:
    """long_groups from a table that has the sizes of its groups already."""
    sizes = counts.filter(F.col(n) > page_size)
    return written(sizes.select(on, F.ceil(F.col(n) / page_size).cast("int").alias("parts")), "groups")


def in_pages(df: DataFrame, on: str, order: list[str], page_size: int, groups: DataFrame) -> DataFrame:
    """Add (part, parts): part = (rank in group, in `order`) div page_size, the same rule for every group.

    `order` must tell the rows of a group apart. Rows of a group of at most `page_size` are part 0 without being ranked.
    Longer groups are sorted in ranges of (key, order): a row's rank is its place in its range, plus the rows of its key in
    earlier ranges, so no task ranks a whole hot group. `groups` is a written table; without long groups, df is read once.
    """
    if groups.isEmpty():
        return df.withColumns({"part": F.lit(0), "parts": F.lit(1)})
    marked = df.join(groups, on, "left")
    short = marked.filter("parts is null").withColumn("part", F.lit(0)).withColumn("parts", F.lit(1))
    placed = written(marked.filter("parts is not null").repartitionByRange(on, *order)
                      .withColumn("range_part", F.spark_partition_id()), "ranges")
    before = Window.partitionBy(on).orderBy("range_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(on, "range_part").agg(F.count("*").alias("n")).select(
        on, "range_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy(on, "range_part").orderBy(*order))
    part = F.floor((F.col("start") + place - 1) / page_size).cast("int")
    long = placed.join(starts, [on, "range_part"]).withColumn("part", part)
    columns = [*df.columns, "part", "parts"]
    return short.select(columns).unionByName(long.select(columns))


def one_row_per_part(df: DataFrame, on: str, groups: DataFrame) -> DataFrame:
    """Rows of unique keys repeated for each part of their group, with (part, parts). `groups` is a written table."""
    if groups.isEmpty():
        return df.withColumns({"part": F.lit(0), "parts": F.lit(1)})
    counted = df.join(groups, on, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    return counted.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))


def first_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row per key, the first in `order`.

    The optimizer runs the rank-1 filter before the shuffle too, so a hot key sends one row per task.
    """
    ranking: WindowSpec = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank_in_key", F.row_number().over(ranking)).filter("rank_in_key = 1").drop("rank_in_key")


def positions(df: DataFrame, key: str, digits: int = 3) -> DataFrame:
    """Add position, 0, 1, 2 ... without gaps in the order of the keys' md5, for unique keys, without a global window.

    The first hex digits of the md5 give 16^digits buckets of equal size, ranked apart from each other; the bucket offsets are a
    running sum over at most 16^digits counts.
    """
    hashed = df.withColumn("md5_key", F.md5(F.col(key))).withColumn("bucket", F.substring("md5_key", 1, digits))
    counts = hashed.groupBy("bucket").agg(F.count("*").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    in_bucket = Window.partitionBy("bucket").orderBy("md5_key", key)
    ranked = hashed.join(F.broadcast(offsets), "bucket").withColumn(
        "position", F.col("offset") + F.row_number().over(in_bucket) - 1)
    return ranked.drop("md5_key", "bucket", "offset")


def even_batches(df: DataFrame, key: str, batch_size: int, digits: int = 3) -> DataFrame:
    """Add batch_id, slices of exactly `batch_size` rows (the last may be short), for unique keys."""
    placed = positions(df, key, digits)
    return placed.withColumn("batch_id", F.floor(F.col("position") / batch_size).cast("bigint")).drop("position")
