"""One project record per gid from feed, edges, page records, URLs, map centres and the geocode cache.

Covers P03, P12, P17, J01, J02, J05, J10, W02, O04. Every input is brought to one row per gid first; the joins
then share the gid partitioning, so each input is shuffled once and no join can multiply rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gidlake import schemas
from gidlake.functions.text import coalesce_truthy, location_country, location_state
from gidlake.functions.values import centroid_latitude, centroid_longitude, run_clock, truthy, union_sources
from gidlake.operators.companies import (edge_summary, operator_company, scraped_company, single_edge,
                                         _no_position, EDGE_COLUMNS)
from gidlake.operators.geo import backfill_map_centers, cache_for, enrich_locations, hot_geocode_keys
from gidlake.operators.skew import first_per_key, skew_join
from gidlake.settings import scratch_path
from gidlake.sources.keyed_store import KeyedStore
from gidlake.sources.readers import url_map


class Landing(NamedTuple):
    """The landed inputs of one run. A cache kept as a store is read by the buckets of the keys looked up."""

    feed: DataFrame
    edges: DataFrame
    page_records: DataFrame
    url_index: DataFrame
    map_centers: DataFrame
    geocode_cache: DataFrame | KeyedStore


class Assembled(NamedTuple):
    """projects: one row per completed gid; failures: gids no source knows."""

    projects: DataFrame
    failures: DataFrame


def latest_feed(feed: DataFrame) -> DataFrame:
    """The row loaded last wins for a repeated gid."""
    return first_per_key(feed.filter(F.col("gid") != ""), ["gid"], F.desc("country_ord"), F.desc("row_ord"))


def first_record(records: DataFrame) -> DataFrame:
    """First page record of each gid."""
    return first_per_key(records, ["gid"], F.asc("rec_ord"))


def feed_location() -> Column:
    return F.struct(
        F.col("location").alias("location_string"),
        centroid_latitude(F.col("centroid")).alias("latitude"),
        centroid_longitude(F.col("centroid")).alias("longitude"),
        location_country(F.col("location")).alias("country"),
        location_state(F.col("location")).alias("state"),
        coalesce_truthy(F.col("mineral_district_camp"), F.col("mineral_district")).alias("mineral_district"),
        F.col("area_m2"),
        F.lit(None).cast("boolean").alias("geocoded"),
        F.lit("api").alias("location_source"),
        *[F.lit(None).cast("string").alias(c) for c in ("postcode", "iso3166_2", "county", "territory")],
    )


def safe_fields() -> list[Column]:
    """The project fields of a feed row; company fields are not taken over."""
    return [F.coalesce("project_name", F.lit("")).alias("name"), feed_location().alias("location"),
            F.col("stage"), F.col("commodities"), F.col("operator"), F.array(F.lit("api")).alias("data_sources"),
            F.lit("discovered").alias("processing_stage")]


def safe_project(feed: DataFrame) -> DataFrame:
    """Project-level feed fields only."""
    return feed.select("gid", *safe_fields())


def blank_location() -> Column:
    return F.from_json(F.lit("{}"), schemas.LOCATION_DDL)


def scraped_fields() -> list[Column]:
    """The project fields of a page record."""
    return [F.coalesce("project_name", F.lit("")).alias("name"), blank_location().alias("location"),
            F.col("stage"), F.col("commodities"), F.col("operator"), F.array(F.lit("scraper")).alias("data_sources"),
            F.lit("discovered").alias("processing_stage")]


def page_fields() -> list[Column]:
    """scraped_fields with the company that the record names."""
    company = scraped_company(F.col("company_id"), F.col("company_name"), F.col("operator"))
    return [*scraped_fields(), company.alias("scraped_company")]


def scraped_project(records: DataFrame) -> DataFrame:
    """Minimal project of a page record."""
    return records.select("gid", *scraped_fields())


def minimal_projects(gids: DataFrame, feed: DataFrame, records: DataFrame) -> DataFrame:
    """Gids without a feed row that a page record can stand in for."""
    unfed = gids.select("gid").join(feed.select("gid").distinct(), "gid", "left_anti")
    return scraped_project(unfed.join(first_record(records), "gid"))


def failed_gids(gids: DataFrame, feed: DataFrame, records: DataFrame) -> DataFrame:
    """Gids neither in the feed nor among the page records."""
    known = feed.select("gid").union(records.select("gid")).distinct()
    return gids.select("gid").distinct().join(known, "gid", "left_anti")


def fill_operator(operator: Column, primary_name: Column, first_name: Column) -> Column:
    """A missing operator becomes the primary company's name, else the first edge's."""
    return F.when(truthy(operator), operator).otherwise(
        F.coalesce(F.nullif(primary_name, F.lit("")), F.nullif(first_name, F.lit("")), operator))


def with_stage(projects: DataFrame, stage: str, moment: Column) -> DataFrame:
    """Stage and its time stamp."""
    return projects.withColumns({"processing_stage": F.lit(stage), "updated_at": moment})


def _prefixed(df: DataFrame, name: str) -> DataFrame:
    return df.select("gid", F.struct(*[c for c in df.columns if c != "gid"]).alias(name))


def combine_sources(gids: DataFrame, landing: Landing) -> DataFrame:
    """All sources of a gid side by side, one row per gid."""
    feed = safe_project(latest_feed(landing.feed))
    page = first_record(landing.page_records).select("gid", *page_fields())
    return (gids.select("gid").distinct()
            .join(_prefixed(feed, "feed"), "gid", "left")
            .join(edge_summary(landing.edges), "gid", "left")
            .join(_prefixed(page, "page"), "gid", "left")
            .join(url_map(landing.url_index), "gid", "left"))


def resolve(sources: DataFrame, *more: str) -> DataFrame:
    """Pick the project base and its company tier from combine_sources rows (J04, P17, A14, W01); `more` columns are carried along."""
    has_feed, has_page = F.col("feed").isNotNull(), F.col("page").isNotNull()
    on_page = F.col("page.scraped_company")
    by_edges = F.coalesce(F.col("relationship_count"), F.lit(0)) > 0
    from_operator = F.when(has_feed, operator_company(F.col("feed.operator")))
    tier = (F.when(by_edges, 1).when(on_page.isNotNull(), 2)
            .when(from_operator.isNotNull(), 3).otherwise(0))
    company = (F.when(by_edges & has_feed, F.col("primary_company"))
               .when(by_edges, F.col("first_edge.company_details"))
               .otherwise(F.coalesce(on_page, from_operator)))
    edge_source = (F.when(by_edges, F.lit("relationships"))
                   .when(tier == 2, F.lit("scraper")).when(tier == 3, F.lit("api")))
    base = F.coalesce("feed", F.col("page").dropFields("scraped_company"))
    picked = sources.filter(has_feed | has_page).select(
        "gid", base.alias("base"), tier.alias("company_tier"), company.alias("primary_company"),
        F.when(by_edges, F.col("first_edge.company_name")).otherwise(company["name"]).alias("first_name"),
        F.when(by_edges, F.col("relationship_count")).when(tier > 0, 1).otherwise(0)
        .cast("bigint").alias("relationship_count"),
        F.coalesce("jv_count", F.lit(0)).cast("bigint").alias("jv_count"),
        edge_source.alias("edge_source"), "project_url", *more)
    own = F.col("base.data_sources")
    return picked.select(
        "gid", F.col("base.name").alias("name"), F.col("base.location").alias("location"),
        F.col("base.stage").alias("stage"), F.col("base.commodities").alias("commodities"),
        fill_operator(F.col("base.operator"), F.col("primary_company.name"), F.col("first_name")).alias("operator"),
        "primary_company", "company_tier", "relationship_count", "jv_count",
        union_sources(own, F.array("edge_source")).alias("data_sources"),
        F.col("base.processing_stage").alias("processing_stage"), "project_url", *more)


def locate(gids: DataFrame, landing: Landing) -> DataFrame:
    """Projects of all sources with map centres filled in, before any address is looked up."""
    return backfill_map_centers(resolve(combine_sources(gids, landing)), landing.map_centers)


def finish(projects: DataFrame, cache: DataFrame | KeyedStore, run_ts: str, hot_keys: DataFrame | None = None, stage: str | None = None) -> DataFrame:
    """Located projects with their addresses, completed.

    With a cache kept as a store, or `stage`, the projects are written there (to a scratch folder without it) before the look-up, so
    the store is read by their buckets only and keys shared by very many projects are dealt over tasks.
    """
    if stage is not None or isinstance(cache, KeyedStore):
        spark, schema = projects.sparkSession, projects.schema
        path = stage or scratch_path(spark, "located")
        projects.write.mode("overwrite").parquet(path)
        projects = spark.read.schema(schema).parquet(path)
        hot_keys = hot_geocode_keys(projects) if hot_keys is None else hot_keys
    projects = enrich_locations(projects, cache_for(projects, cache), hot_keys)
    moment = run_clock(run_ts)
    return with_stage(projects.withColumns({"created_at": moment, "errors": F.array().cast("array<string>")}), "completed", moment)


def assemble(gids: DataFrame, landing: Landing, run_ts: str, hot_keys: DataFrame | None = None, stage: str | None = None) -> Assembled:
    """Steps one to six for every gid: base record, company, location, stage. `stage` as for finish."""
    return Assembled(finish(locate(gids, landing), landing.geocode_cache, run_ts, hot_keys, stage),
                     failed_gids(gids, landing.feed, landing.page_records))


def project_edges(projects: DataFrame, edges: DataFrame, hot: DataFrame | None = None, dealt: bool = False) -> DataFrame:
    """Flat edges of assembled projects with the project name: landed ones by join, the rest from the project. `hot` are the gids with very many
    edges, as for skew_join; where there are none, `dealt` leaves the edges of a gid in one partition, by its hash."""
    named = projects.select("gid", F.col("name").alias("project_name"))
    rows = edges.select(*EDGE_COLUMNS)
    landed = rows.repartition("gid").join(named, "gid") if dealt else skew_join(rows, named, "gid", "inner", spread=F.col("ord"), hot=hot)
    alone = projects.filter(F.col("company_tier") > 1)
    share = F.when(F.col("company_tier") == 3, F.lit(100.0))
    single = (alone.select("gid", F.col("name").alias("project_name"), _no_position(edges),
                           *single_edge(F.col("primary_company"), None), share.alias("operator_share"))
              .withColumn("percentage", F.col("operator_share")).drop("operator_share"))
    return landed.unionByName(single.repartition("gid") if dealt else single)
