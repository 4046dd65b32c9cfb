"""What all sources say of a gid in one row, kept up to date delivery by delivery.

Every field is a partial aggregate: the best value with the key it won by, or a sum. So rows of two deliveries merge into the row
of both, in any order, and a gid with very many edges has one row like any other. Assembly reads this table instead of joining
the sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gidlake.operators.assembly import Assembled, Landing, finish, page_fields, resolve, safe_fields
from gidlake.operators.companies import primary_order
from gidlake.operators.geo import fill_center
from gidlake.sources.keyed_store import BUCKETS, PLACE, KeyedStore

# Each kept value and the key it wins by: the smallest or the largest.
SMALLEST = {"primary_company": "primary_key", "first_edge": "first_key", "page": "page_key", "center": "center_key"}
LARGEST = {"feed": "feed_key", "project_url": "url_key"}
SUMS = ("relationship_count", "jv_count")


def _merged(rows: DataFrame, **made: Column) -> DataFrame:
    """One row for each gid from rows of the state; `made` are fields that the rows hold in other columns. Rows of a store come with their place in
    it, which a gid has one of, and keep it.

    A value and its key are one struct, compared by the key first, so neither is kept twice.
    """
    def best(pick, value: str, key: str) -> Column:
        by = made.get(key, F.col(key))
        return pick(F.when(by.isNotNull(), F.struct(by.alias("key"), made.get(value, F.col(value)).alias("value")))).alias(value)

    names = {**SMALLEST, **LARGEST}
    place = [c for c in PLACE if c in rows.columns]
    picked = rows.groupBy(*place[:1], "gid", *place[1:]).agg(
        *(best(F.min, v, k) for v, k in SMALLEST.items()), *(best(F.max, v, k) for v, k in LARGEST.items()),
        *(F.sum(made.get(c, F.col(c))).alias(c) for c in SUMS), F.min("first_seen").alias("first_seen"))
    return picked.select("gid", *(F.col(v)["value"].alias(v) for v in names), *(F.col(v)["key"].alias(k) for v, k in names.items()), *SUMS, "first_seen", *place)


def delivery_state(landing: Landing, seen: Column) -> DataFrame:
    """The state of one delivery; any of its tables may be empty. `seen` marks its place among deliveries.

    Rows are reduced in each task before they are shuffled; for that they are sorted, so an edge holds its company and its position once until then.
    Load orders (country_ord and row_ord, rec_ord, row_ord) must hold across deliveries where a later row is to win.
    """
    parts = [
        landing.edges.select("gid", "company_details", "company_name", "relationship_type", "percentage", "ord", F.lit(1).cast("bigint").alias("relationship_count")),
        landing.feed.filter(F.col("gid") != "").select("gid", F.struct(*safe_fields()).alias("feed"), F.struct("country_ord", "row_ord").alias("feed_key")),
        landing.page_records.select("gid", F.struct(*page_fields()).alias("page"), F.col("rec_ord").alias("page_key")),
        landing.url_index.select("gid", F.col("url").alias("project_url"), F.col("row_ord").alias("url_key")),
        landing.map_centers.select("gid", F.struct("latitude", "longitude").alias("center"), F.struct("latitude", "longitude").alias("center_key")),
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    order = primary_order(F.col("percentage"), F.col("relationship_type"), F.col("ord"))
    return _merged(rows.withColumn("first_seen", seen), primary_company=F.col("company_details"), primary_key=F.when(F.col("relationship_count").isNotNull(), order),
                   first_edge=F.struct("company_details", "company_name"), first_key=F.col("ord"), jv_count=(F.col("relationship_type") == "jv").cast("bigint"))


def state_store(spark: SparkSession, root: str, schema: StructType, buckets: int = BUCKETS) -> KeyedStore:
    """The store of the state; `schema` is that of delivery_state."""
    return KeyedStore(spark, root, "gid", schema, buckets)


def add_delivery(store: KeyedStore, delivery: DataFrame, name: str) -> int:
    """Merge a delivery's state into the store; only buckets of its gids are read and rewritten. A delivery whose name has been added
    before changes nothing, so a job may be run again. `delivery` should be a written table."""
    if name in store.notes():
        return store.version()
    return store.merge(delivery, _merged, name, placed=True)


def sources_of(state: DataFrame, gids: DataFrame | None = None) -> DataFrame:
    """The rows of combine_sources, for the wanted gids or for all of the state. No source is joined with another."""
    return state if gids is None else gids.select("gid").distinct().join(state, "gid", "left")


def assemble_state(state: DataFrame, cache: DataFrame | KeyedStore, run_ts: str, gids: DataFrame | None = None, hot_keys: DataFrame | None = None,
                   stage: str | None = None) -> Assembled:
    """assemble() for gids of the state, or for all that a source knows."""
    rows = sources_of(state, gids)
    located = fill_center(resolve(rows, "center")).drop("center")
    failures = rows.filter("feed is null and page is null").select("gid")
    return Assembled(finish(located, cache, run_ts, hot_keys, stage), failures if gids is not None else failures.limit(0))


def assemble_from(store: KeyedStore, gids: DataFrame, cache: DataFrame | KeyedStore, run_ts: str, stage: str | None = None) -> Assembled:
    """assemble() for some gids of a store of states; only their buckets are read."""
    wanted = store.read(store.buckets_of(gids)).drop("key_bucket")
    return assemble_state(wanted, cache, run_ts, gids, stage=stage)
