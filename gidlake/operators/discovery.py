"""Which gids exist: feed filter, scope, union, limit, batches and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gidlake.functions.text import split_list
from gidlake.settings import TEST_MODE_COUNTRIES

# Default closed ranges of the feed filter.
DEFAULT_RANGE = (0, 10000)


def _within(c: Column, bounds: tuple) -> Column | None:
    low, high = bounds
    if low is not None and high is not None:
        return c.between(low, high)
    if low is not None:
        return c >= low
    return c <= high if high is not None else None


def filter_projects(df: DataFrame, country: str | None = None, marketcap: tuple = DEFAULT_RANGE,
                    outstandingshares: tuple = DEFAULT_RANGE, project_size: tuple = (None, None),
                    commodities: list[str] | None = None) -> DataFrame:
    """Conjunction of simple predicates, so it reaches the scan; a null bound means no predicate."""
    predicates = [
        F.col("country") == country if country is not None else None,
        _within(F.col("marketcap"), marketcap),
        _within(F.col("outstandingshares"), outstandingshares),
        _within(F.col("project_size"), project_size),
        F.arrays_overlap(split_list(F.col("commodities")), F.array(*map(F.lit, commodities)))
        if commodities else None,
    ]
    for predicate in predicates:
        df = df if predicate is None else df.filter(predicate)
    return df


def normalize_gid(df: DataFrame, column: str = "gid") -> DataFrame:
    """Text gids, none null or empty."""
    return df.withColumn(column, F.col(column).cast("string")).filter(F.col(column) != "")


def country_scope(df: DataFrame, mode: str, countries: list[str] | None = None) -> DataFrame:
    """Test mode works on the listed or the default countries, production on the listed or all."""
    wanted = countries or (TEST_MODE_COUNTRIES if mode == "test" else None)
    return df.filter(F.col("country").isin(wanted)) if wanted else df


def discover_gids(feed: DataFrame, urls: DataFrame) -> DataFrame:
    """Each gid once; both sides are reduced before and during the shuffle."""
    return normalize_gid(feed.select("gid")).union(normalize_gid(urls.select("gid"))).distinct()


def limit_gids(feed_gids: DataFrame, all_gids: DataFrame, limit: int | None) -> DataFrame:
    """When there are more than `limit` gids, keep the first `limit` feed gids and no other.

    Only limit + 1 rows are ever gathered.
    """
    if not limit:
        return all_gids
    head = all_gids.orderBy("gid").limit(limit + 1)
    found = head.agg(F.count("*")).scalar()
    wanted = normalize_gid(feed_gids.select("gid")).distinct().orderBy("gid").limit(limit)
    return wanted.filter(found > limit).union(head.filter(found <= limit))


def discovery_counts(feed: DataFrame, urls: DataFrame) -> DataFrame:
    """Gids in all, unique gids, and unique gids of the feed."""
    sides = (normalize_gid(feed.select("gid", F.lit(True).alias("in_feed")))
             .unionByName(normalize_gid(urls.select("gid", F.lit(False).alias("in_feed")))))
    per_gid = sides.groupBy("gid").agg(F.bool_or("in_feed").alias("in_feed"))
    return per_gid.agg(F.count("*").alias("total_gids"), F.count("gid").alias("unique_gids"),
                       F.count_if("in_feed").alias("api_gids"))


def gids_per_country(feed: DataFrame) -> DataFrame:
    """Distinct first, so a hot country is counted from one row per gid and task."""
    pairs = normalize_gid(feed.select("country", "gid")).distinct()
    return pairs.groupBy("country").agg(F.count("*").alias("gids"))
