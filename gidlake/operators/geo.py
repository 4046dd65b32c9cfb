"""Location enrichment by keyed lookup and cache upkeep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gidlake import schemas
from gidlake.functions.text import coalesce_truthy
from gidlake.functions.values import (address_iso, address_state, forward_key, needs_forward, needs_map,
                                      needs_reverse, reverse_key, to_double, truthy)
from gidlake.operators.skew import first_per_key, heavy_keys, skew_join
from gidlake.sources.keyed_store import BUCKETS, KeyedStore

MAP_SOURCE = "scraper_map"
GEOCODE_SOURCE = "geocode"


def _location(**changes: Column) -> Column:
    return F.struct(*[changes.get(f, F.col(f"location.{f}")).alias(f) for f in schemas.LOCATION_FIELDS])


def backfill_map_centers(projects: DataFrame, centers: DataFrame) -> DataFrame:
    """Both coordinates from the map table when either is missing."""
    center = first_per_key(centers, ["gid"], F.asc("latitude"), F.asc("longitude")).select(
        "gid", F.struct("latitude", "longitude").alias("center"))
    return fill_center(projects.join(center, "gid", "left")).drop("center")


def fill_center(projects: DataFrame) -> DataFrame:
    """J06 for projects that carry their `center`."""
    take = needs_map(F.col("location.latitude"), F.col("location.longitude")) & F.col("center").isNotNull()
    moved = _location(latitude=F.col("center.latitude"), longitude=F.col("center.longitude"),
                      location_source=coalesce_truthy(F.col("location.location_source"), F.lit(MAP_SOURCE)))
    return projects.withColumn("location", F.when(take, moved).otherwise(F.col("location")))


def lookup_key(location: Column) -> Column:
    """The cache key a location needs, null when it needs none."""
    lat, lon, state, text = (location[c] for c in ("latitude", "longitude", "state", "location_string"))
    return (F.when(needs_reverse(lat, lon, state), reverse_key(lat, lon))
            .when(needs_forward(lat, lon, state, text), forward_key(text)))


def parse_payload(payload: Column) -> Column:
    return F.from_json(payload, schemas.GEOCODE_DDL)


def hot_geocode_keys(feed_locations: DataFrame) -> DataFrame:
    """Lookup keys shared by very many rows; a bounded list (see heavy_keys) that only guides the dealing."""
    return heavy_keys(feed_locations.select(lookup_key(F.col("location")).alias("cache_key")), "cache_key")


def enrich_locations(projects: DataFrame, cache: DataFrame, hot_keys: DataFrame | None = None) -> DataFrame:
    """One equi-join on the cache key, then the address fields.

    Rows that need nothing carry a key of their own instead of null, so they stay spread over all tasks.
    Given `hot_keys`, rows of a shared coordinate are dealt over several tasks.
    """
    keyed = projects.withColumn("cache_key", lookup_key(F.col("location")))
    payloads = cache.select("cache_key", "payload")
    if hot_keys is None:
        spread = keyed.withColumn("cache_key", F.coalesce("cache_key", F.concat(F.lit("none:"), "gid")))
        joined = spread.join(payloads, "cache_key", "left")
    else:
        joined = skew_join(keyed, payloads, "cache_key", "left", spread=F.col("gid"), hot=hot_keys)
    return (joined.withColumn("hit", parse_payload(F.col("payload")))
            .withColumn("location", _enriched()).drop("cache_key", "payload", "hit"))


def _enriched() -> Column:
    addr, old = F.col("hit.address"), F.col("location")
    fields = {
        "state": F.coalesce(F.nullif(address_state(addr), F.lit("")), old["state"]),
        "country": F.coalesce(addr["country"], old["country"]),
        "postcode": addr["postcode"], "iso3166_2": address_iso(addr), "county": addr["county"],
        "territory": addr["territory"], "geocoded": F.lit(True),
        "location_source": coalesce_truthy(old["location_source"], F.lit(GEOCODE_SOURCE)),
    }
    placed = {"latitude": F.coalesce(to_double(F.col("hit.lat")), old["latitude"]),
              "longitude": F.coalesce(to_double(F.col("hit.lon")), old["longitude"])}
    hit = F.col("hit").isNotNull()
    return (F.when(F.col("cache_key").startswith("rev:") & hit & addr.isNotNull(), _location(**fields))
            .when(F.col("cache_key").startswith("fwd:") & hit, _location(**fields, **placed))
            .otherwise(old))


def geocode_work_list(projects: DataFrame, cache: DataFrame) -> DataFrame:
    """Needed keys no cache entry answers; a stored miss counts as an answer."""
    needed = projects.select(lookup_key(F.col("location")).alias("cache_key")).filter("cache_key is not null")
    return needed.distinct().join(cache.select("cache_key"), "cache_key", "left_anti")


def new_entries(cache: DataFrame, fetched: DataFrame) -> DataFrame:
    """Fetched answers to keys that the cache has not got, one for each key."""
    return (first_per_key(fetched.select("cache_key", "payload"), ["cache_key"], F.asc_nulls_last("payload"))
            .join(cache.select("cache_key"), "cache_key", "left_anti"))


def upsert_geocode_cache(cache: DataFrame, fetched: DataFrame) -> DataFrame:
    """Entries of the cache stay; new keys are added once, misses as a null payload."""
    return cache.select("cache_key", "payload").unionByName(new_entries(cache, fetched))


def cache_store(spark: SparkSession, root: str, buckets: int = BUCKETS) -> KeyedStore:
    """A geocode cache that grows in place, dealt by key over buckets."""
    return KeyedStore(spark, root, "cache_key", StructType.fromDDL("cache_key string, payload string"), buckets)


def grow_cache(store: KeyedStore, fetched: DataFrame) -> int:
    """Add answers to the store: only buckets of fetched keys are read, and only new entries are written. `fetched` should be
    a written table; rows without a key are left out."""
    keyed = fetched.filter("cache_key is not null")
    known = store.read(store.buckets_of(keyed))
    return store.append(new_entries(known, keyed))


def cache_for(projects: DataFrame, cache: DataFrame | KeyedStore) -> DataFrame:
    """The part of the cache that the projects look up: of a store only the buckets of their keys, else the cache as it is."""
    if isinstance(cache, KeyedStore):
        return cache.read(cache.buckets_of(projects.select(lookup_key(F.col("location")).alias("cache_key"))))
    return cache


def attach_page_map(records: DataFrame, maps: DataFrame, cache: DataFrame) -> DataFrame:
    """Map result of each page record (status 'ok' only), then the reverse-geocoded address."""
    found = first_per_key(maps.filter("status = 'ok'"), ["gid"], F.asc("lat"), F.asc("lng")).select(
        "gid", F.col("lat").cast("double").alias("latitude"), F.col("lng").cast("double").alias("longitude"),
        F.col("zoom").alias("map_zoom"), F.col("lib").alias("map_lib"), F.lit(MAP_SOURCE).alias("location_source"))
    placed = records.join(found, "gid", "left")
    key = reverse_key(F.col("latitude"), F.col("longitude")).alias("cache_key")
    hot = heavy_keys(found.select(key), "cache_key")
    hit = (skew_join(placed.select("*", key), cache.select("cache_key", "payload"), "cache_key", "left",
                     spread=F.col("gid"), hot=hot)
           .withColumn("address", parse_payload(F.col("payload"))["address"]))
    addr = F.col("address")
    return hit.select(
        *placed.columns[:-1],
        F.when(addr.isNotNull(), coalesce_truthy(F.col("location_source"), F.lit(GEOCODE_SOURCE)))
        .otherwise(F.col("location_source")).alias("location_source"),
        F.when(truthy(addr["country"]), addr["country"]).alias("country"),
        F.nullif(address_state(addr), F.lit("")).alias("state"),
        addr["postcode"].alias("postcode"), address_iso(addr).alias("iso3166_2"),
        addr["county"].alias("county"), addr["territory"].alias("territory"))
