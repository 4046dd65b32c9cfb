"""One query per operator over the test tables; every result has scalar columns only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gidlake import schemas
from gidlake.functions import text, values
from gidlake.operators import assembly, batches, companies, discovery, geo, html, marts, skew, state
from gidlake.plans import bindings as b
from gidlake.plans.bindings import RUN_TS, SETTINGS
from gidlake.settings import scratch_path, shuffles_removed
from gidlake.sources import bucketed, published, readers, writers
from gidlake.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PREFIX = SETTINGS.company_prefix


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def count_of(c: Column | str) -> Column:
    return F.count(c).cast("bigint")


def discovered(spark: SparkSession, sf: str) -> DataFrame:
    return discovery.discover_gids(b.feed(spark, sf), b.url_index(spark, sf))


def assembled(spark: SparkSession, sf: str) -> assembly.Assembled:
    return assembly.assemble(discovered(spark, sf), b.landing(spark, sf), RUN_TS)


def projects_of(spark: SparkSession, sf: str) -> DataFrame:
    return assembled(spark, sf).projects


def staged(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Projects and flat edges written once to the shared folder and read back, as a run does before publishing."""
    root = scratch_path(spark, "staged")
    with shuffles_removed(spark):
        projects_of(spark, sf).write.parquet(f"{root}/projects")
        projects = spark.read.parquet(f"{root}/projects")
        return projects, bucketed.write_edges(projects, b.edges(spark, sf), f"{root}/edges")


# Sources


@query
def s01_countries(spark, sf):
    path = scratch_path(spark, "countries")
    names = b.countries(spark, sf).agg(F.transform(
        F.sort_array(F.collect_list(F.struct("country_ord", "country"))), lambda c: c["country"]).alias("country"))
    names.write.json(path)
    return readers.read_countries(spark, path)


@query
def s02_project_feed(spark, sf):
    path = scratch_path(spark, "feed")
    b.feed_bodies(spark, sf).write.json(path)
    rows = readers.read_project_feed(spark, path)
    return rows.select("country", "country_ord", "row_ord", "gid", "project_name", "location", "area_m2", "stage",
                       values.centroid_longitude(F.col("centroid")).alias("longitude"),
                       values.centroid_latitude(F.col("centroid")).alias("latitude"))


@query
def s02_feed_arrays(spark, sf):
    """Raw responses, one array a country."""
    path = scratch_path(spark, "feed-arrays")
    objects = F.col("body").substr(F.lit(2), F.length("body") - 2)
    rows = b.feed_bodies(spark, sf).filter(F.col("body").startswith("[")).select("country", objects.alias("o"))
    arrays = rows.groupBy("country").agg(F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list("o")), ",\n"), F.lit("]")).alias("value"))
    arrays.write.partitionBy("country").text(path)
    feed = readers.read_feed_arrays(spark, path, b.countries(spark, sf))
    # The sorted texts of a country stand in the order of their numbers as text, which row_ord must follow.
    earlier = F.lag("gid").over(Window.partitionBy("country").orderBy("row_ord"))
    return feed.select("country", "country_ord", "gid", "project_name", "location", "area_m2", "stage",
                       values.centroid_longitude(F.col("centroid")).alias("longitude"), F.coalesce(earlier <= F.col("gid"), F.lit(True)).alias("in_order"))


@query
def s03_relationship_bodies(spark, sf):
    path = scratch_path(spark, "bodies")
    b.relationship_bodies(spark, sf).select("gid", "body").write.json(path)
    rows = readers.read_relationship_bodies(spark, path)

    def entries(key: str) -> Column:
        return F.coalesce(F.size(f"doc.{key}"), F.lit(0))

    return rows.groupBy("gid").agg(
        count_of("*").alias("bodies"), F.sum(entries("jv")).alias("jv_entries"),
        F.sum(entries("nsrs")).alias("nsr_entries"), F.sum(entries("option")).alias("option_entries"))


@query
def s04_url_index(spark, sf):
    path = scratch_path(spark, "urls")
    rows = b.url_rows(spark, sf).select(
        F.expr("case when ID % 51 = 0 then null else cast(cast(ID as double) as string) end").alias("ID"), "URL")
    old = rows.filter("ID is not null").select("ID", F.concat(F.lit("old:"), "URL").alias("URL"))
    old.unionByName(rows.filter("ID is null")).write.option("header", True).csv(f"{path}/1")
    rows.filter("cast(cast(ID as double) as bigint) % 2 = 0").coalesce(1).write.option("header", True).csv(f"{path}/2")
    return readers.url_map(readers.read_url_index(spark, f"{path}/*")).withColumnRenamed("project_url", "url")


@query
def s05_pages(spark, sf):
    pages = readers.read_pages(spark, f"{sf}/pages.parquet")
    return pages.select("page_id", "url", F.length("html").cast("bigint").alias("html_chars"))


@query
def s06_geocode_cache(spark, sf):
    path = scratch_path(spark, "cache")
    entry = F.concat(F.lit('{"'), "cache_key", F.lit('":'), F.coalesce("payload", F.lit("null")), F.lit("}"))
    b.geocode_cache(spark, sf).select(entry.alias("value")).write.text(path)
    cache = readers.read_geocode_cache(spark, path, layout="json_map")
    return cache.select("cache_key", "is_negative", F.get_json_object("payload", "$.address.country").alias("country"))


@query
def s07_company_links(spark, sf):
    path = scratch_path(spark, "links")
    b.company_link_bodies(spark, sf).select(F.col("body").alias("value")).write.text(path)
    return readers.read_company_links(spark, path)


@query
def s08_read_export(spark, sf):
    projects, edges = staged(spark, sf)
    path = writers.write_projects(projects, edges, scratch_path(spark, "export"), RUN_TS)
    rows = readers.read_projects(spark, f"{path}/projects")
    return rows.filter("part = 0").select(
        "gid", "name", "processing_stage", F.col("location.area_m2").alias("area_m2"),
        F.col("primary_company.name").alias("company_name"),
        values.iso_format(F.col("created_at")).alias("created_at"))


@query
def s08_company_array(spark, sf):
    """Company documents as JSON arrays, read by byte ranges."""
    projects, edges = staged(spark, sf)
    path = scratch_path(spark, "company-arrays")
    documents = marts.company_documents(marts.project_documents(projects, edges, counted=True), RUN_TS, PREFIX, heads=marts.document_heads(projects))
    return readers.read_company_array(spark, writers.write_arrays(documents, path)).select(
        "company_id", "company_name", "total_projects", F.size("projects").cast("bigint").alias("listed"),
        F.array_join("countries", ", ").alias("countries"))


@query
def s09_metrics_history(spark, sf):
    path = scratch_path(spark, "metrics")
    events = b.table(spark, sf, "events").withColumn("day", F.date_trunc("DAY", F.col("ts").cast("timestamp_ntz")))
    failed = F.count_if(F.col("event_type") == "error")
    runs = events.groupBy("day").agg(
        F.count("*").alias("total_projects"), failed.alias("failed_projects"),
        F.min("ts").alias("start_time"), F.max("ts").alias("end_time"),
        F.create_map(F.lit("failed"), failed).alias("error_summary"))
    one_file_each = runs.withColumn("run", F.date_format("day", "yyyyMMdd")).drop("day").repartition("run")
    one_file_each.write.partitionBy("run").options(**writers.JSON_OPTIONS).json(path)
    history = readers.read_metrics(spark, path)
    return history.select("total_projects", "failed_projects", F.col("error_summary")["failed"].alias("failed_errors"),
                          F.round(marts.duration_seconds(F.col("start_time"), F.col("end_time")), 3).alias("seconds"))


# Sinks


@query
def k01_write_projects(spark, sf):
    projects, edges = staged(spark, sf)
    path = writers.write_projects(projects, edges, scratch_path(spark, "export"), RUN_TS)
    meta = spark.read.json(f"{path}/metadata")
    total, version = meta.select("total_projects").scalar(), meta.select("version").scalar()
    rows = readers.read_projects(spark, f"{path}/projects")
    return rows.select("gid", "name", "part", F.size("company_relationships").cast("bigint").alias("relationships"),
                       text.list_to_string(F.col("data_sources")).alias("data_sources"),
                       total.alias("total_projects"), version.alias("version"))


@query
def k02_write_companies(spark, sf):
    projects, edges = staged(spark, sf)
    path = writers.write_companies_with_projects(projects, edges, scratch_path(spark, "export"), RUN_TS, PREFIX)
    return readers.read_company_documents(spark, path).select(
        "company_id", "company_url", "total_projects", "part", F.size("projects").cast("bigint").alias("listed"))


def _contents(rows: DataFrame, output: str, key: str, *columns: Column | str) -> DataFrame:
    """(output, key, said): what an export says of each key, as text."""
    said = F.concat_ws("|", *(F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("-")) for c in columns))
    return rows.select(F.lit(output).alias("output"), F.col(key).alias("key"), said.alias("said"))


def _mart_contents(spark: SparkSession, path: str) -> DataFrame:
    read = {name: spark.read.parquet(f"{path}/{name}") for name in writers.MART_NAMES}
    return batches.append_batches([
        _contents(read["Projects"], "Projects", "gid", "project_name", "stage", "commodities", "operator", "project_url", "country", "state",
                  "data_sources", "processing_stage", "has_errors"),
        _contents(read["Companies"], "Companies", "company_id", "company_name", "company_url", "project_count", "countries", "data_source"),
        _contents(read["Relationships"], "Relationships", "gid", "project_name", "company_id"),
        _contents(read["Data_Sources"], "Data_Sources", "data_source", "project_count"),
        _contents(read["Processing_Summary"], "Processing_Summary", "metric", "value")])


@query
def k03_export_marts(spark, sf):
    projects, edges = staged(spark, sf)
    return _mart_contents(spark, writers.export_marts(projects, edges, scratch_path(spark, "export"), RUN_TS, PREFIX))


@query
def k04_write_metrics(spark, sf):
    done = assembled(spark, sf)
    metrics = marts.run_metrics(done.projects, done.failures, b.error_events(spark, sf), RUN_TS, "2025-01-31 12:00:10")
    path = writers.write_metrics(metrics, scratch_path(spark, "export"), RUN_TS)
    return readers.read_metrics(spark, path).select(
        "total_projects", "completed_projects", "failed_projects", "api_projects", "scraped_projects",
        "relationships_enriched", "duration_seconds", F.round("success_rate", 6).alias("success_rate"),
        F.size("error_summary").cast("bigint").alias("error_types"))


def _over_parts(documents: DataFrame, *head: str) -> DataFrame:
    """Documents made one over all their parts: the columns of `head`, which every part repeats, and the sum of `listed`."""
    return documents.groupBy(*head).agg(F.sum("listed").alias("listed"))


def _new_projects(documents: DataFrame) -> DataFrame:
    """Company documents with how many projects they have that the part before has not, as `listed`; a project with very many edges comes as several
    entries in a row."""
    gids = F.transform("projects", lambda p: p["gid"])
    ends = documents.select("company_id", "company_name", "total_projects", "part", F.size(F.array_distinct(gids)).cast("bigint").alias("n"),
                            F.get(gids, F.lit(0)).alias("first"), F.try_element_at(gids, F.lit(-1)).alias("last"))
    before = F.lag("last").over(Window.partitionBy("company_id").orderBy("part"))
    return ends.withColumn("listed", F.col("n") - F.coalesce(F.col("first") == before, F.lit(False)).cast("int"))


@query
def k05_export_all(spark, sf):
    """Published as one set, then read through its pointer."""
    projects, edges = staged(spark, sf)
    root = scratch_path(spark, "export")
    published.publish_all(projects, edges, root, RUN_TS, PREFIX)
    paths = published.published(spark, root)
    documents = readers.read_projects(spark, paths["projects_json"] + "/projects").select(
        "gid", "name", text.list_to_string(F.col("data_sources")).alias("sources"), F.size("company_relationships").cast("bigint").alias("listed"))
    listed = _new_projects(readers.read_company_documents(spark, paths["companies_json"]))
    return batches.append_batches([
        _contents(_over_parts(documents, "gid", "name", "sources"), "projects_json", "gid", "name", "listed", "sources"),
        _contents(_over_parts(listed, "company_id", "company_name", "total_projects"), "companies_json", "company_id", "company_name", "total_projects", "listed"),
        _mart_contents(spark, paths["marts"])])


@query
def k06_upsert_geocode_cache(spark, sf):
    cache = b.geocode_cache(spark, sf)
    fetched = b.parts(spark, sf).select(
        F.expr("format_string('rev:%.8f,%.8f', (n * 53 % 18000) / 100.0D - 90, (n * 37 % 36000) / 100.0D - 180)")
        .alias("cache_key"),
        F.expr("case when n % 4 = 0 then null else concat('{\"fetched\":', n % 36000, '}') end").alias("payload"))
    store = geo.cache_store(spark, scratch_path(spark, "cache"), 16)
    geo.grow_cache(store, cache)
    for part in (0, 1, 0):  # the third brings nothing new
        geo.grow_cache(store, fetched.filter(F.pmod(F.hash("cache_key"), F.lit(2)) == part))
    return store.read().select("cache_key", "payload", F.col("payload").isNull().alias("is_negative"))


@query
def k07_run_names(spark, sf):
    named = writers.with_run_id(b.parts(spark, sf), RUN_TS)
    return named.select("gid", "run_id", F.lit(writers.stamped("/out", " Marts__", RUN_TS)).alias("folder"))


# Projections and predicates


@query
def p01_filter_projects(spark, sf):
    kept = discovery.filter_projects(b.feed(spark, sf), country="NATION_3", outstandingshares=(900, 5000),
                                     project_size=(10, None), commodities=["red", "bolt"])
    return kept.select("gid", "country", "row_ord", "commodities", "marketcap", "project_size")


@query
def p02_normalize_gid(spark, sf):
    raw = b.parts(spark, sf).select(F.expr("case when n % 6 = 0 then '' when n % 6 = 1 then null else gid end")
                                    .alias("gid"))
    return discovery.normalize_gid(raw)


@query
def p03_safe_project(spark, sf):
    flat = assembly.safe_project(assembly.latest_feed(b.feed(spark, sf)))
    return flat.select("gid", "name", "stage", "commodities", "operator", "processing_stage",
                       F.col("location.location_string").alias("location_string"),
                       F.col("location.mineral_district").alias("mineral_district"),
                       F.col("location.area_m2").alias("area_m2"),
                       F.col("location.location_source").alias("location_source"),
                       text.list_to_string(F.col("data_sources")).alias("data_sources"))


@query
def p04_centroid(spark, sf):
    short = b.parts(spark, sf).select("gid", F.struct(F.expr(
        "case n % 4 when 0 then null when 1 then array() when 2 then array(n * 1.5D) "
        "else array(n * 1.5D, n * 0.25D) end").alias("coordinates")).alias("centroid"))
    return short.select("gid", values.centroid_longitude(F.col("centroid")).alias("longitude"),
                        values.centroid_latitude(F.col("centroid")).alias("latitude"))


@query
def p05_split_location(spark, sf):
    rows = b.feed(spark, sf).select("gid", "row_ord", F.expr(
        "case when row_ord % 7 = 0 then '' when row_ord % 7 = 1 then concat('Inner, ', location) else location end")
        .alias("location"))
    return rows.select("gid", "row_ord", text.location_country(F.col("location")).alias("country"),
                       text.location_state(F.col("location")).alias("state"))


@query
def p06_coalesce_truthy(spark, sf):
    return b.feed(spark, sf).select("gid", "row_ord", text.coalesce_truthy(
        F.col("mineral_district_camp"), F.col("operator"), F.col("mineral_district")).alias("picked"))


@query
def p07_flatten_projects(spark, sf):
    return marts.flatten_projects(projects_of(spark, sf))


@query
def p08_relationship_company(spark, sf):
    company = F.col("company_details")
    return b.edges(spark, sf).select("gid", "ownership_id", *[company[c].alias(c) for c in (
        "id", "name", "ticker", "exchange", "website", "headquarters", "industry", "sector", "data_source")])


@query
def p09_company_url(spark, sf):
    return b.page_records(spark, sf).select(
        "gid", "rec_ord", companies.company_url(F.col("company_id"), PREFIX).alias("company_url"))


@query
def p10_has_company(spark, sf):
    rows = b.parts(spark, sf).select("gid", F.when(F.expr("n % 3 <> 0"), F.struct(
        F.expr("case when n % 5 = 0 then '' else gid end").alias("id"))).alias("primary_company"))
    documents = marts.with_company(rows, drop_blank_id=True).select("gid", F.lit("documents").alias("used_for"))
    return documents.unionByName(
        marts.with_company(rows, drop_blank_id=False).select("gid", F.lit("mart").alias("used_for")))


@query
def p11_country_scope(spark, sf):
    scoped = discovery.country_scope(b.feed(spark, sf), "test", ["NATION_1", "NATION_7"])
    return scoped.select("country", "gid", "row_ord")


@query
def p12_updates(spark, sf):
    flat = assembly.safe_project(assembly.latest_feed(b.feed(spark, sf)))
    staged_rows = assembly.with_stage(flat, "assembled", values.run_clock(RUN_TS))
    changed = staged_rows.withColumns({
        "data_sources": values.add_source(F.col("data_sources"), "scraper"),
        "errors": values.add_error(values.add_error(F.lit(None), F.col("stage")), F.lit("late"))})
    return changed.select("gid", "processing_stage", values.iso_format(F.col("updated_at")).alias("updated_at"),
                          F.array_join("data_sources", ", ").alias("data_sources"),
                          F.array_join("errors", "; ").alias("errors"))


@query
def p13_operator_company(spark, sf):
    company = companies.operator_company(F.col("operator"))
    return assembly.latest_feed(b.feed(spark, sf)).select(
        "gid", company["id"].alias("id"), company["name"].alias("name"),
        company["relationship_type"].alias("relationship_type"), company["data_source"].alias("data_source"))


@query
def p14_scraped_company(spark, sf):
    company = companies.scraped_company(F.col("company_id"), F.col("company_name"), F.col("operator"))
    return b.page_records(spark, sf).select("gid", "rec_ord", company["id"].alias("id"), company["name"].alias("name"),
                                            company["data_source"].alias("data_source"))


@query
def p15_validate_enum(spark, sf):
    kinds = b.edge_rows(spark, sf).select("gid", F.expr(
        "case when l_linenumber = 7 then 'lease' when l_linenumber = 6 then null else kind end").alias("kind"))
    good, bad = values.split_enum(kinds, "kind", schemas.RELATIONSHIP_TYPES)
    both = good.select("kind", F.lit(True).alias("accepted")).unionByName(bad.select("kind", F.lit(False).alias("accepted")))
    return both.groupBy("kind", "accepted").agg(count_of("*").alias("edges"))


@query
def p16_address_fields(spark, sf):
    hit = geo.parse_payload(F.col("payload"))
    cache = b.geocode_cache(spark, sf).select("cache_key", hit["address"].alias("a"))
    return cache.select("cache_key", values.address_state(F.col("a")).alias("state"),
                        values.address_iso(F.col("a")).alias("iso3166_2"), F.col("a.postcode").alias("postcode"),
                        F.col("a.county").alias("county"), F.col("a.territory").alias("territory"),
                        F.coalesce("a.country", F.lit("old")).alias("country"))


@query
def p17_fill_operator(spark, sf):
    summary = companies.edge_summary(b.edges(spark, sf))
    joined = assembly.latest_feed(b.feed(spark, sf)).join(summary, "gid")
    return joined.select("gid", assembly.fill_operator(
        F.col("operator"), F.col("primary_company.name"), F.col("first_edge.company_name")).alias("operator"))


@query
def p18_needs(spark, sf):
    rows = assembly.safe_project(assembly.latest_feed(b.feed(spark, sf)))
    lat, lon, state, place = (F.col(f"location.{c}") for c in ("latitude", "longitude", "state", "location_string"))
    return rows.select("gid", values.needs_map(lat, lon).alias("needs_map"),
                       values.needs_reverse(lat, lon, state).alias("needs_reverse"),
                       values.needs_forward(lat, lon, state, place).alias("needs_forward"))


# Joins


@query
def j01_gid_to_feed(spark, sf):
    last = assembly.latest_feed(b.feed(spark, sf))
    return discovered(spark, sf).join(last, "gid", "left").select("gid", "project_name", "country", "row_ord")


@query
def j02_gid_to_url(spark, sf):
    return discovered(spark, sf).join(readers.url_map(b.url_index(spark, sf)), "gid", "left")


@query
def j03_gid_to_relationships(spark, sf):
    linked = companies.edges_of_gids(discovered(spark, sf), b.edges(spark, sf))
    return linked.select("gid", "company_id", "relationship_type", "percentage", "ownership_id", "optionee_id")


@query
def j04_resolve_companies(spark, sf):
    resolved = companies.resolve_companies(
        discovered(spark, sf), b.edges(spark, sf), assembly.first_record(b.page_records(spark, sf)),
        assembly.latest_feed(b.feed(spark, sf)))
    return resolved.select("gid", "company_id", "company_name", "relationship_type", "percentage", "ownership_id",
                           "data_source")


@query
def j05_minimal_projects(spark, sf):
    made = assembly.minimal_projects(discovered(spark, sf), b.feed(spark, sf), b.page_records(spark, sf))
    return made.select("gid", "name", "stage", "commodities", "operator",
                       F.array_join("data_sources", ", ").alias("data_sources"))


@query
def j06_map_backfill(spark, sf):
    flat = assembly.safe_project(assembly.latest_feed(b.feed(spark, sf)))
    both = flat.unionByName(assembly.minimal_projects(discovered(spark, sf), b.feed(spark, sf),
                                                      b.page_records(spark, sf)))
    moved = geo.backfill_map_centers(both, b.map_centers(spark, sf))
    return moved.select("gid", F.col("location.latitude").alias("latitude"),
                        F.col("location.longitude").alias("longitude"),
                        F.col("location.location_source").alias("location_source"))


def _feed_enriched(spark: SparkSession, sf: str) -> DataFrame:
    flat = assembly.safe_project(assembly.latest_feed(b.feed(spark, sf)))
    hot = geo.hot_geocode_keys(flat.select("location"))
    return geo.enrich_locations(flat, b.geocode_cache(spark, sf), hot).select("gid", "location.*")


@query
def j07_reverse_geocode(spark, sf):
    return _feed_enriched(spark, sf).select("gid", "country", "state", "postcode", "iso3166_2", "geocoded",
                                            "location_source")


@query
def j08_forward_geocode(spark, sf):
    return _feed_enriched(spark, sf).select("gid", "latitude", "longitude", "country", "state", "county", "geocoded")


@query
def j09_geocode_work_list(spark, sf):
    flat = assembly.safe_project(assembly.latest_feed(b.feed(spark, sf)))
    return geo.geocode_work_list(flat, b.geocode_cache(spark, sf))


@query
def j10_failed_gids(spark, sf):
    return assembly.failed_gids(discovered(spark, sf), b.feed(spark, sf), b.page_records(spark, sf))


@query
def j11_row_match(spark, sf):
    parsed = html.parsed_pages(b.project_pages(spark, sf), "elements", "tables")
    facts = html.table_facts(html.property_tables(F.col("page")), F.col("gid"))
    wide = parsed.select("gid", html.page_title(F.col("page")).alias("title"),
                         html.first_where(facts, lambda t: t["wide"]).alias("facts"))
    row = html.target_row(F.col("facts"), F.col("title"))
    return wide.select("gid", row["project_name"].alias("row_name"), row["commodities"].alias("commodities"),
                       row["stage"].alias("stage"))


# Aggregations


@query
def a01_discovery_counts(spark, sf):
    return discovery.discovery_counts(b.feed(spark, sf), b.url_index(spark, sf))


@query
def a02_gids_per_country(spark, sf):
    return discovery.gids_per_country(b.feed(spark, sf))


@query
def a03_companies_with_projects(spark, sf):
    projects, edges = staged(spark, sf)
    # Pages of ten, so that real groups are cut at this size.
    documents = marts.company_documents(marts.project_documents(projects, edges, counted=True), RUN_TS, PREFIX, limit=10, heads=marts.document_heads(projects))
    inner = F.aggregate("projects", F.lit(0).cast("bigint"), lambda n, p: n + F.size(p["company_relationships"]))
    return documents.select(
        "company_id", "company_name", "company_url", "total_projects", "part", "parts",
        F.size("projects").cast("bigint").alias("listed"), F.array_join("countries", ", ").alias("countries"),
        inner.alias("relationships"), F.get("projects", F.lit(0))["gid"].alias("first_gid"),
        F.md5(F.array_join(F.transform("projects", lambda p: F.concat(p["gid"], F.lit(":"), F.array_join(F.transform(
            p["company_relationships"], lambda e: e["company_id"]), ","))), ";")).alias("members_md5"),
        F.col("additional_company_data.company_info.data_source").alias("data_source"))


@query
def a04_companies_mart(spark, sf):
    return marts.companies_mart(projects_of(spark, sf), PREFIX)


@query
def a05_data_sources(spark, sf):
    return marts.data_sources_mart(projects_of(spark, sf))


@query
def a06_processing_summary(spark, sf):
    return marts.processing_summary(projects_of(spark, sf))


@query
def a07_source_set(spark, sf):
    return marts.source_set(projects_of(spark, sf)).select(F.array_join("data_sources", ", ").alias("data_sources"))


@query
def a08_run_counters(spark, sf):
    done = assembled(spark, sf)
    return marts.run_counters(done.projects, done.failures)


@query
def a09_error_summary(spark, sf):
    return marts.error_summary(b.error_events(spark, sf))


@query
def a10_success_rate(spark, sf):
    per_user = b.table(spark, sf, "events").groupBy("user_id").agg(
        F.count_if(F.col("event_type") != "view").alias("total"),
        F.count_if(F.col("event_type") == "click").alias("completed"))
    return per_user.select("user_id", F.round(marts.success_rate(F.col("completed"), F.col("total")), 6)
                           .alias("success_rate"))


@query
def a11_duration(spark, sf):
    start = F.col("o_orderdate").cast("timestamp_ntz")
    end = F.timestamp_add("MICROSECOND", F.col("o_orderkey") * 1500000, start)
    orders = b.table(spark, sf, "orders").select(
        "o_orderkey", start.alias("begun"), F.when(F.expr("o_orderkey % 7 <> 0"), end).alias("ended"))
    return orders.select("o_orderkey", marts.duration_seconds(F.col("begun"), F.col("ended")).alias("seconds"))


def _outcomes(spark: SparkSession, sf: str) -> DataFrame:
    gids = discovered(spark, sf)
    failed = assembly.failed_gids(gids, b.feed(spark, sf), b.page_records(spark, sf))
    numbered = skew.even_batches(gids, "gid", SETTINGS.batch_size)
    marked = failed.withColumn("failed", F.lit(True))
    return numbered.join(marked, "gid", "left").select("gid", "batch_id", F.col("failed").isNull().alias("completed"))


@query
def a12_batch_totals(spark, sf):
    return marts.batch_totals(_outcomes(spark, sf))


@query
def a13_relationship_digest(spark, sf):
    return companies.relationship_digest(b.edges(spark, sf), limit=10).select("gid", "part", "parts", "digest")


@query
def a14_lineage_union(spark, sf):
    flat = assembly.safe_project(assembly.latest_feed(b.feed(spark, sf)))
    resolved = companies.resolve_companies(
        flat, b.edges(spark, sf), assembly.first_record(b.page_records(spark, sf)),
        assembly.latest_feed(b.feed(spark, sf)))
    united = companies.lineage_union(flat, resolved)
    return united.select("gid", F.array_join("data_sources", ", ").alias("data_sources"))


@query
def a15_relationship_presence(spark, sf):
    return companies.relationship_presence(b.edges(spark, sf))


# Windows


@query
def w01_primary_company(spark, sf):
    return companies.primary_company(b.edges(spark, sf)).select(
        "gid", "company_id", "company_name", "relationship_type", "percentage")


@query
def w02_last_write_wins(spark, sf):
    return assembly.latest_feed(b.feed(spark, sf)).select("gid", "country", "row_ord", "location")


@query
def w03_batches(spark, sf):
    return skew.even_batches(discovered(spark, sf), "gid", SETTINGS.batch_size)


@query
def w03_stable_batches(spark, sf):
    """A second discovery adds gids behind those of the first."""
    root = scratch_path(spark, "ledger")
    ledger = batches.batch_ledger(spark, f"{root}/ledger", 16)
    for name, gids in (("feed", b.feed(spark, sf).select("gid")), ("all", discovered(spark, sf))):
        gids.distinct().write.parquet(f"{root}/{name}")
        batches.give_places(ledger, spark.read.parquet(f"{root}/{name}"))
    return batches.stable_batches(ledger, SETTINGS.batch_size)


@query
def w04_state_by_delivery(spark, sf):
    """W01, W02, W04 kept up to date: three deliveries merged into one row for each gid."""
    landing, root = b.landing(spark, sf), scratch_path(spark, "state")
    store = None
    for day in range(3):
        late = landing._replace(feed=landing.feed.filter(F.col("country_ord") % 3 == day), edges=landing.edges.filter(F.pmod(F.hash("ord"), F.lit(3)) == day),
                                **({} if day == 1 else {n: getattr(landing, n).limit(0) for n in ("page_records", "url_index", "map_centers")}))
        state.delivery_state(late, F.lit(day)).write.parquet(f"{root}/day={day}")
        delivery = spark.read.parquet(f"{root}/day={day}")
        store = store or state.state_store(spark, f"{root}/store", delivery.schema, 16)
        state.add_delivery(store, delivery, f"day {day}")
        state.add_delivery(store, delivery, f"day {day}")
    return store.read().filter("feed is not null or relationship_count > 0").select(
        "gid", F.col("primary_company.id").alias("primary_id"), F.col("first_edge.company_name").alias("first_name"), "relationship_count", "jv_count",
        F.col("feed_key.row_ord").alias("row_ord"), F.col("feed.location.location_string").alias("location"), "project_url")


@query
def w04_first_seen(spark, sf):
    mart = marts.companies_mart(projects_of(spark, sf), PREFIX)
    return mart.select("company_id", "company_name", "ticker", "data_source")


@query
def w05_value_on_next_line(spark, sf):
    lines = F.split(F.concat(F.lit("Stage:\n"), "text", F.lit("\nCommodities: \n"), "source", F.lit("\nOperator:")), "\n")
    kept = F.filter(F.transform(lines, lambda line: F.trim(line)), lambda line: line != "")
    pairs = b.table(spark, sf, "documents").select("doc_id", F.explode(html.value_on_next_line(kept)).alias("p"))
    return pairs.select("doc_id", F.col("p.field").alias("field"), F.md5("p.value").alias("value_md5"))


@query
def w06_priority_pick(spark, sf):
    parsed = html.parsed_pages(b.project_pages(spark, sf), "elements")
    page = F.col("page")
    return parsed.select("gid", html.page_title(page).alias("title"),
                         F.coalesce(html.company_link(page, SETTINGS.base_host)["company_id"],
                                    html.fast_company_id(page)).alias("company_id"))


@query
def w07_last_name_match(spark, sf):
    match = _company_match(spark, sf)
    return match.select("gid", "matched_by", "commodities")


# Sorts and limits


@query
def o01_companies_by_size(spark, sf):
    mart = marts.companies_mart(projects_of(spark, sf), PREFIX)
    return marts.by_size(mart, "project_count", "company_id").select("company_id", "project_count")


@query
def o02_sources_by_size(spark, sf):
    return marts.by_size(marts.data_sources_mart(projects_of(spark, sf)), "project_count", "data_source")


@query
def o03_limit_gids(spark, sf):
    feed = b.feed(spark, sf)
    return discovery.limit_gids(feed, discovered(spark, sf), 25)


@query
def o04_first_record(spark, sf):
    return assembly.first_record(b.page_records(spark, sf)).select("gid", "project_name", "company_id", "company_name")


@query
def o05_sorted_countries(spark, sf):
    return marts.companies_mart(projects_of(spark, sf), PREFIX).select("company_id", "countries")


# Set operations


@query
def u01_union_gids(spark, sf):
    return discovered(spark, sf)


@query
def u02_union_sources(spark, sf):
    rows = b.parts(spark, sf).select("gid", F.expr("case when n % 2 = 0 then array('scraper') else array('api') end")
                                     .alias("one"), F.expr("case when n % 3 = 0 then array('api', 'relationships') "
                                                           "else array('scraper') end").alias("two"))
    return rows.select("gid", F.array_join(values.union_sources(F.col("one"), F.col("two")), ", ").alias("data_sources"))


@query
def u03_concat_edges(spark, sf):
    edges = readers.relationship_edges(b.relationship_bodies(spark, sf))
    return edges.select("gid", F.col("body_ord.l_orderkey").alias("body"), F.col("ord").cast("bigint").alias("ord"),
                        "company_id", "company_name", "relationship_type", "percentage", "ownership_id",
                        "optionee_id", "comments", F.col("company_details.ticker").alias("ticker"))


@query
def u04_append_batches(spark, sf):
    rows = _outcomes(spark, sf)
    even, odd = rows.filter("batch_id % 2 = 0"), rows.filter("batch_id % 2 = 1").withColumn("late", F.lit(True))
    return batches.append_batches([even, odd]).select("gid", "batch_id", "completed")


@query
def u05_table_fragments(spark, sf):
    fragments = html.table_fragments(html.parsed_pages(b.project_pages(spark, sf), "tables", keep_html=True), "gid")
    return fragments.select("gid", F.length("table_html").cast("bigint").alias("chars"),
                            F.md5("table_html").alias("html_md5"))


# Scalar functions


@query
def f01_normalize_text(spark, sf):
    return b.table(spark, sf, "documents").select("doc_id", F.md5(text.normalize_text(F.col("text"))).alias("text_md5"))


@query
def f02_proper_case(spark, sf):
    name = F.concat(F.lit("  the "), "c_mktsegment", F.lit("  SHOP of\t"), "c_name", F.lit(" "))
    return b.table(spark, sf, "customer").select("c_custkey", text.proper_case(name).alias("name"))


@query
def f03_slug(spark, sf):
    name = F.concat("p_name", F.lit(" (No."), "p_brand", F.lit(") & Co., \"Ltd\"/o'"), "p_type")
    return b.parts(spark, sf).select("gid", text.slug(name).alias("slug"))


@query
def f04_gid_from_link(spark, sf):
    link = F.expr("case n % 5 when 0 then concat('/project-profile?gid=', n) when 1 then concat('/x?a=1&gid=', n, '&b=2') "
                  "when 2 then concat('open(gid=', n, ')') when 3 then concat('/map?gid=1&companyId=', n) else '/none' end")
    rows = b.parts(spark, sf).select("gid", link.alias("link"))
    return rows.select("gid", text.gid_from_link(F.col("link")).alias("strict"),
                       text.gid_anywhere(F.col("link")).alias("loose"),
                       text.gid_from_link(F.col("link"), "companyId").alias("company"),
                       text.gid_after(F.col("link"), "project-profile").alias("after"))


@query
def f05_absolute_url(spark, sf):
    hrefs = ["/a/b", "c/d?x=1", "//h.example/x", "https://z.example/q", "mailto:a@b", "#f", "?q=1", "", "../up", "./same"]
    rows = b.table(spark, sf, "pages").select("page_id", "url", F.posexplode(F.array(*map(F.lit, hrefs))).alias("pos", "href"))
    return rows.select("page_id", F.col("pos").cast("bigint").alias("pos"),
                       text.absolute_url(F.col("url"), F.col("href")).alias("absolute"))


@query
def f06_dash_to_null(spark, sf):
    value = F.expr("case n % 4 when 0 then '-' when 1 then '' when 2 then null else p_name end")
    return b.parts(spark, sf).select("gid", text.dash_to_null(value).alias("value"))


@query
def f07_label_field(spark, sf):
    label = F.expr("element_at(array('Project Name', 'Operator', 'Main Commodities', 'STAGE', 'Ticker/Exchange', "
                   "'Project Operator', 'Area', 'Operator Stage'), cast(n % 8 as int) + 1)")
    return b.parts(spark, sf).select("gid", text.label_field(label).alias("field"))


@query
def f08_list_to_string(spark, sf):
    words = F.split("p_name", " ")
    return b.parts(spark, sf).select("gid", text.list_to_string(F.array_append(words, F.col("p_type"))).alias("listed"))


@query
def f09_pct_string(spark, sf):
    sizes = b.table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 97).alias("part"),
                                                (F.col("o_orderkey") % 89 + F.col("o_orderkey") % 97).alias("whole"))
    return sizes.select("o_orderkey", values.pct_string(F.col("part"), F.col("whole")).alias("rate"))


@query
def f10_coordinate_key(spark, sf):
    lat, lon = F.expr("(n * 53 % 18000) / 7.0D - 90"), F.expr("case when n % 9 = 0 then null else n / 3.0D end")
    return b.parts(spark, sf).select("gid", values.reverse_key(lat, lon).alias("cache_key"))


@query
def f11_to_double(spark, sf):
    raw = F.expr("case n % 4 when 0 then '' when 1 then 'n/a' when 2 then concat(n, '.25') else concat(' ', n, ' ') end")
    return b.parts(spark, sf).select("gid", values.to_double(raw).alias("number"))


@query
def f12_iso_time(spark, sf):
    moment = F.col("ts").cast("timestamp_ntz")
    rows = b.table(spark, sf, "events").select("event_id", values.iso_format(moment).alias("iso"))
    return rows.select("event_id", "iso", values.iso_format(values.iso_parse(F.col("iso"))).alias("again"))


@query
def f13_run_clock(spark, sf):
    return b.parts(spark, sf).select("gid", values.iso_format(values.run_clock(RUN_TS)).alias("stamped_at"))


@query
def f14_stable_bucket(spark, sf):
    return b.table(spark, sf, "customer").select("c_custkey", values.stable_bucket(F.col("c_name")).alias("bucket"),
                                                 values.synthetic_id(F.col("c_name")).alias("id"))


@query
def f15_flags(spark, sf):
    rows = b.parts(spark, sf).select("gid", F.expr("case when n % 2 = 0 then array() else split(p_name, ' ') end")
                                     .alias("items"), F.expr("case n % 3 when 0 then null when 1 then '' else p_type end")
                                     .alias("state"))
    return rows.select("gid", values.has_items(F.col("items")).alias("has_items"), values.truthy(F.col("state")).alias("has_state"))


@query
def f16_split_list(spark, sf):
    raw = F.concat(F.lit(" ,"), F.regexp_replace("p_name", " ", " , "), F.lit(",, "), "p_type")
    return b.parts(spark, sf).select("gid", F.explode(text.split_list(raw)).alias("item"))


@query
def f17_json_rows(spark, sf):
    rows = b.table(spark, sf, "supplier").select(
        "s_suppkey", "s_name", F.when(F.expr("s_suppkey % 2 = 0"), F.col("s_nationkey")).alias("nation"))
    return marts.json_lines(rows)


@query
def f18_map_default(spark, sf):
    bags = F.expr("case n % 3 when 0 then map('k', p_name) when 1 then map('k', cast(null as string)) else map('z', '1') end")
    body = F.expr("case n % 3 when 0 then concat('{\"k\":', n, '}') when 1 then 'broken' else '{}' end")
    return b.parts(spark, sf).select("gid", values.map_get(bags, "k", F.lit("none")).alias("from_map"),
                                     values.json_get(body, "$.k", "bigint", F.lit(-1)).cast("bigint").alias("from_json"))


# Pages


@query
def h01_html_nodes(spark, sf):
    pages = html.parsed_pages(readers.read_pages(spark, f"{sf}/pages.parquet"), "elements")
    anchors = html.html_elements(pages, "page_id").filter("tag = 'a'")
    return anchors.select("page_id", "href", "text")


@query
def h01_html_cells(spark, sf):
    """The first row of every table of every page, tables inside cells too."""
    cells = html.html_cells(html.parsed_pages(b.project_pages(spark, sf), "tables"), "gid")
    return cells.filter("row_no = 0").select("gid", F.col("table_no").cast("bigint").alias("table_no"), F.col("col_no").cast("bigint").alias("col_no"), "tag", "text")


@query
def h02_page_title(spark, sf):
    pages = html.parsed_pages(readers.read_pages(spark, f"{sf}/pages.parquet"), "elements")
    return pages.select("page_id", html.page_title(F.col("page")).alias("title"))


@query
def h03_page_links(spark, sf):
    pages = html.parsed_pages(readers.read_pages(spark, f"{sf}/pages.parquet"), "elements")
    return html.page_links(pages, "page_id", F.col("url")).select("page_id", "href", "url", "gid")


@query
def h04_company_link(spark, sf):
    link = html.company_link(F.col("page"), SETTINGS.base_host)
    pages = html.parsed_pages(b.project_pages(spark, sf), "elements").select("gid", link.alias("link"))
    return pages.select("gid", "link.*")


@query
def h05_company_heading(spark, sf):
    pages = html.parsed_pages(b.project_pages(spark, sf), "elements")
    return pages.select("gid", html.company_heading(F.col("page")).alias("anywhere"),
                        html.company_heading(F.col("page"), "#right-sider").alias("in_sider"),
                        html.company_heading(F.col("page"), "#modal-nav-buttons").alias("in_nav"))


@query
def h06_fast_company_id(spark, sf):
    pages = html.parsed_pages(b.project_pages(spark, sf), "elements")
    return pages.select("gid", html.fast_company_id(F.col("page")).alias("company_id"))


@query
def h07_table_kind(spark, sf):
    labels = F.transform(html.property_tables(F.col("page")), lambda t: F.struct(
        t["table_no"].cast("bigint").alias("table_no"), html.header_labels(t).alias("labels")))
    kinds = F.transform(labels, lambda t: F.struct(t["table_no"], html.is_header_table(t["labels"]).alias("is_header")))
    pages = html.parsed_pages(b.project_pages(spark, sf), "tables").select("gid", F.explode(kinds).alias("k"))
    return pages.select("gid", "k.*")


@query
def h08_column_index(spark, sf):
    columns = F.transform(html.property_tables(F.col("page")), lambda t: F.struct(
        t["table_no"].cast("bigint").alias("table_no"), html.is_header_table(html.header_labels(t)).alias("wide"),
        html.column_index(html.header_labels(t)).alias("c")))
    pages = html.parsed_pages(b.project_pages(spark, sf), "tables").select("gid", F.explode(columns).alias("t")).filter("t.wide")
    return pages.select("gid", "t.table_no", *[F.col(f"t.c.{name}").cast("bigint").alias(name) for _, name in text.LABEL_FIELDS])


def _start_record(page: Column) -> Column:
    return F.struct(html.page_title(page).alias("project_name"),
                    *[F.lit(None).cast("string").alias(f) for f in html.RECORD_FIELDS[1:]])


@query
def h09_target_row_fill(spark, sf):
    page = F.col("page")
    wide = F.filter(html.table_facts(html.property_tables(page), F.col("gid")), lambda t: t["wide"])
    filled = F.aggregate(wide, _start_record(page), html.fold_table)
    pages = html.parsed_pages(b.project_pages(spark, sf), "elements", "tables").select("gid", filled.alias("r"))
    return pages.select("gid", "r.project_name", "r.commodities", "r.stage")


def _label_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Facts of every label/value block of every page, with the block's number."""
    facts = html.table_facts(html.property_tables(F.col("page")), F.col("gid"))
    tables = html.parsed_pages(b.project_pages(spark, sf), "tables").select("gid", F.explode(facts).alias("t"))
    return tables.filter("not t.wide").select("gid", F.col("t.table_no").cast("bigint").alias("table_no"), "t")


@query
def h10_key_values(spark, sf):
    return _label_tables(spark, sf).select("gid", "table_no", *[F.col(f"t.{name}").alias(name) for _, name in text.LABEL_FIELDS])


@query
def h11_ownership_links(spark, sf):
    owners = _label_tables(spark, sf).select("gid", "table_no", F.explode("t.owners").alias("o"))
    return owners.select("gid", "table_no", "o.id", "o.name")


@query
def h12_primary_page_company(spark, sf):
    company = html.primary_page_company(F.col("t.owners"), F.col("t.operator"))
    return _label_tables(spark, sf).select("gid", "table_no", company.alias("c")).select("gid", "table_no", "c.id", "c.name")


def _company_match(spark: SparkSession, sf: str) -> DataFrame:
    match = html.company_projects_match(F.col("page"), F.col("gid"), F.col("project_name"))
    return html.parsed_pages(b.company_pages(spark, sf), "tables").select("gid", match.alias("m")).select("gid", "m.*")


@query
def h13_company_projects(spark, sf):
    return _company_match(spark, sf)


@query
def h14_label_lines(spark, sf):
    pages = html.parsed_pages(b.project_pages(spark, sf), "lines")
    pairs = pages.select("gid", F.explode(html.label_lines(F.col("page"))).alias("p"))
    return pairs.select("gid", "p.field", "p.value")


@query
def h15_two_pass_merge(spark, sf):
    page = F.col("page")
    folded = html.fold_tables(html.property_tables(page), _start_record(page), F.col("gid"))
    pages = html.parsed_pages(b.project_pages(spark, sf), "elements", "tables").select("gid", folded.alias("r"))
    return pages.select("gid", *[F.col(f"r.{f}").alias(f) for f in html.RECORD_FIELDS])


@query
def h16_page_records(spark, sf):
    return html.page_records(html.parsed_pages(b.project_pages(spark, sf)), PREFIX).drop("rec_ord")


@query
def h17_page_map(spark, sf):
    records = assembly.first_record(b.page_records(spark, sf)).select("gid", "project_name")
    return geo.attach_page_map(records, b.page_maps(spark, sf), b.geocode_cache(spark, sf))


# Streaming


def _gid_files(spark: SparkSession, gids: DataFrame) -> str:
    path = scratch_path(spark, "gids")
    gids.select("gid").repartition(4, "gid").write.parquet(path)
    return path


@query
def t01_incremental_assembly(spark, sf):
    root = scratch_path(spark, "incremental")
    gids = discovered(spark, sf)
    stream = jobs.stream_gids(spark, _gid_files(spark, gids.unionByName(gids)), files_per_batch=2)  # every gid comes twice
    landing = jobs.land_by_bucket(b.landing(spark, sf), f"{root}/landing", 8)
    jobs.start_assembly(stream, landing, f"{root}/out", f"{root}/checkpoint", RUN_TS, 8).awaitTermination()
    done = spark.read.parquet(f"{root}/out/projects")
    return done.select("gid", "name", "operator", "processing_stage", F.col("primary_company.id").alias("company_id"),
                       F.col("location.state").alias("state"), "relationship_count")


@query
def t01_waiting_gids(spark, sf):
    """All gids are wanted before any feed row lands; the feed lands in two parts, with a restart in between."""
    root, landing = scratch_path(spark, "waiting"), b.landing(spark, sf)
    placed = jobs.land_by_bucket(landing, f"{root}/landing", 8)
    discovered(spark, sf).select("gid").write.parquet(f"{root}/wanted")
    for part in (0, 1):
        feed = landing.feed.filter(F.col("gid").cast("bigint") % 2 == part)
        feed.write.mode("append").parquet(f"{root}/feed")
        feed.select("gid").distinct().write.mode("append").parquet(f"{root}/known")

        def landed():
            return placed._replace(feed=spark.read.schema(landing.feed.schema).parquet(f"{root}/feed").withColumn("gid_bucket", jobs.bucket_of("gid", 8)))

        jobs.start_assembly(jobs.stream_gids(spark, f"{root}/wanted"), landed, f"{root}/out", f"{root}/checkpoint", RUN_TS, 8,
                            known=jobs.stream_gids(spark, f"{root}/known")).awaitTermination()
    return spark.read.parquet(f"{root}/out/projects").select("gid", "name", F.col("primary_company.id").alias("company_id"), "relationship_count")


@query
def t02_dedup_within(spark, sf):
    root = scratch_path(spark, "dedup-within")
    b.feed(spark, sf).select("gid", F.expr("make_timestamp_ntz(2025, 1, 1, cast(country_ord as int) % 24, 0, 0)").alias("ts")).write.parquet(f"{root}/in")
    gids = spark.readStream.schema("gid string, ts timestamp_ntz").parquet(f"{root}/in")
    jobs.run_to_folder(jobs.dedup_within(gids, "ts", "2 days"), f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out").select("gid", F.to_date("ts").cast("string").alias("day"))


@query
def t02_stream_dedup(spark, sf):
    root = scratch_path(spark, "dedup")
    gids = jobs.stream_gids(spark, _gid_files(spark, b.feed(spark, sf)), files_per_batch=2)
    jobs.run_to_folder(jobs.dedup_stream(gids), f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


@query
def t03_stream_errors(spark, sf):
    root = scratch_path(spark, "errors")
    events = spark.readStream.schema(b.table(spark, sf, "events").schema).parquet(f"{sf}/event[s].parquet")
    windows = jobs.windowed_errors(events.filter("event_type = 'error'"))
    jobs.run_to_folder(windows, f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")
