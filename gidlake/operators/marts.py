"""Published tables: flat marts, company-nested documents and run metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gidlake.functions.text import coalesce_truthy, list_to_string
from gidlake.functions.values import (has_items, iso_format, pct_string, run_clock, to_json_full, truthy,
                                      zone_free_micros)
from gidlake.operators.companies import EDGES_PER_PART, company_url
from gidlake.operators.skew import counted_groups, in_pages, long_groups, one_row_per_part, written

# Fixed value: marker of how the company record was enriched.
ENRICHMENT_SOURCE = "new_architecture"

# Projects gathered into one company document; larger companies are published in several parts.
PROJECTS_PER_PART = 5000

LOCATION_COLUMNS = ["location_string", "latitude", "longitude", "country", "state", "mineral_district", "area_m2",
                    "location_source", "iso3166_2", "postcode", "county", "territory"]


def flatten_projects(projects: DataFrame) -> DataFrame:
    """Projects mart, 24 columns."""
    return projects.select(
        "gid", F.col("name").alias("project_name"), "stage", "commodities", "operator", "project_url",
        *[F.col(f"location.{c}").alias(c) for c in LOCATION_COLUMNS],
        list_to_string(F.col("data_sources")).alias("data_sources"), "processing_stage",
        iso_format(F.col("created_at")).alias("created_at"), iso_format(F.col("updated_at")).alias("updated_at"),
        has_items(F.col("errors")).alias("has_errors"), F.size("errors").cast("bigint").alias("error_count"))


def with_company(projects: DataFrame, drop_blank_id: bool) -> DataFrame:
    """P10: projects that have a primary company; documents also drop empty ids, the mart keeps them."""
    kept = projects.filter(F.col("primary_company").isNotNull())
    return kept.filter(F.col("primary_company.id") != "") if drop_blank_id else kept


def project_order() -> Column:
    """Load order of projects: numeric gids by value, then the rest by text."""
    return F.struct(F.coalesce(F.col("gid").try_cast("bigint"), F.lit(9223372036854775807)).alias("number"),
                    F.col("gid").alias("text"))


def companies_mart(projects: DataFrame, company_prefix: str) -> DataFrame:
    """One row per company with first-seen attributes, project count and its countries.

    Counted per (company, country) first, so a company with a huge share of projects is reduced by partial
    aggregates to a row per country and task.
    """
    located = with_company(projects, drop_blank_id=False).select(
        F.col("primary_company.id").alias("company_id"), F.col("primary_company").alias("company"),
        F.nullif(F.col("location.country"), F.lit("")).alias("country"), project_order().alias("seen"))
    per_country = located.groupBy("company_id", "country").agg(
        F.count("*").alias("n"), F.min_by("company", "seen").alias("company"), F.min("seen").alias("seen"))
    per_company = per_country.groupBy("company_id").agg(
        F.sum("n").alias("project_count"), F.min_by("company", "seen").alias("company"),
        list_to_string(F.collect_set("country")).alias("countries"))
    return per_company.select(
        "company_id", F.col("company.name").alias("company_name"),
        company_url(F.col("company_id"), company_prefix).alias("company_url"),
        *[F.col(f"company.{c}").alias(c) for c in
          ("ticker", "exchange", "website", "ceo", "headquarters", "industry")],
        "project_count", "countries", F.col("company.data_source").alias("data_source"))


def by_size(marts: DataFrame, count: str, key: str) -> DataFrame:
    """Largest first, equal sizes by key."""
    return marts.orderBy(F.desc(count), F.asc(key))


def relationships_mart(edges: DataFrame) -> DataFrame:
    """Relationships mart, 10 columns, from project_edges rows."""
    return edges.select("gid", "project_name", "company_id", "company_name", "relationship_type", "percentage",
                        "ownership_id", "optionee_id", "comments", F.col("data_source").alias("source"))


def data_sources_mart(projects: DataFrame) -> DataFrame:
    """A05."""
    return (projects.select(F.explode("data_sources").alias("data_source"))
            .groupBy("data_source").agg(F.count("*").alias("project_count")))


def source_set(projects: DataFrame) -> DataFrame:
    """Every source that occurs, in one row."""
    used = projects.select(F.explode("data_sources").alias("source")).distinct()
    return used.agg(F.sort_array(F.collect_list("source")).alias("data_sources"))


def run_counters(projects: DataFrame, failures: DataFrame) -> DataFrame:
    """Counters of a whole run in one row."""
    done = projects.select(F.lit(True).alias("completed"),
                           (F.col("primary_company.data_source") == "relationships").alias("enriched"),
                           F.array_contains("data_sources", "api").alias("api"),
                           F.array_contains("data_sources", "scraper").alias("scraped"))
    lost = failures.select(F.lit(False).alias("completed"), F.lit(False).alias("enriched"),
                           F.lit(False).alias("api"), F.lit(False).alias("scraped"))
    return done.unionByName(lost).agg(
        F.count("*").alias("total_projects"), F.count_if("completed").alias("completed_projects"),
        F.count_if(~F.col("completed")).alias("failed_projects"), F.count_if("api").alias("api_projects"),
        F.count_if("scraped").alias("scraped_projects"),
        F.count_if("enriched").alias("relationships_enriched"))


def success_rate(completed: Column, total: Column) -> Column:
    """A10."""
    return F.when(total == 0, F.lit(0.0)).otherwise(completed / total * 100)


def duration_seconds(start: Column, end: Column) -> Column:
    """Null when either end is null."""
    return (zone_free_micros(end) - zone_free_micros(start)) / 1e6


def error_summary(errors: DataFrame) -> DataFrame:
    """Count per error type."""
    return errors.groupBy("error_type").agg(F.count("*").alias("errors"))


def error_map(errors: DataFrame) -> DataFrame:
    """A09 as one map; error types are a short vocabulary."""
    pair = F.struct("error_type", "errors")
    return error_summary(errors).agg(F.map_from_entries(F.collect_list(pair)).alias("error_summary"))


def processing_summary(projects: DataFrame) -> DataFrame:
    """Seven (metric, value) rows from one pass."""
    linked = F.col("primary_company").isNotNull()
    counts = projects.agg(
        F.count("*").alias("total"), F.count_if(F.col("processing_stage") == "completed").alias("completed"),
        F.count_if(F.col("processing_stage") == "failed").alias("failed"), F.count_if(linked).alias("linked"),
        F.count_if(F.col("primary_company.data_source") == "relationships").alias("from_edges"))
    # Metric names of the summary table.
    rows = {
        "Total Projects": F.col("total").cast("string"),
        "Completed Projects": F.col("completed").cast("string"),
        "Failed Projects": F.col("failed").cast("string"),
        "Projects with Companies": F.col("linked").cast("string"),
        "Companies from Relationships API": F.col("from_edges").cast("string"),
        "Company Resolution Rate": pct_string(F.col("linked"), F.col("total")),
        "Relationships API Success Rate": pct_string(F.col("from_edges"), F.col("total")),
    }
    pairs = [x for name, value in rows.items() for x in (F.lit(name), value)]
    return counts.select(F.stack(F.lit(len(rows)), *pairs).alias("metric", "value"))


def batch_totals(outcomes: DataFrame) -> DataFrame:
    """Completed and failed per batch and, with a null batch_id, overall."""
    return outcomes.rollup("batch_id").agg(
        F.count_if("completed").alias("completed"), F.count_if(~F.col("completed")).alias("failed"))


def run_metrics(projects: DataFrame, failures: DataFrame, errors: DataFrame, start: str, end: str) -> DataFrame:
    """The metrics record of a run: counters, times, error counts and rate, over the whole run."""
    first, last = run_clock(start), run_clock(end)
    return run_counters(projects, failures).select(
        "total_projects", "completed_projects", "failed_projects", F.lit(0).cast("bigint").alias("skipped_projects"),
        "api_projects", "scraped_projects", "relationships_enriched",
        first.alias("start_time"), last.alias("end_time"),
        error_map(errors).scalar().alias("error_summary"),
        duration_seconds(first, last).alias("duration_seconds"),
        success_rate(F.col("completed_projects"), F.col("total_projects")).alias("success_rate"))


def _listed(df: DataFrame, on: str, order: list[str], value: str, limit: int, groups: DataFrame, deal: bool = False) -> DataFrame:
    """(key, part, ordered array of `value`) in pages of `limit` rows. With `deal`, wide rows are dealt before they are gathered, so no task sorts all it
    reads of them to gather the few of a key that lie together."""
    pairs = F.sort_array(F.collect_list(F.struct(*order, value)))
    pages = in_pages(df, on, order, limit, groups)
    # Where every part is 0 it is no grouping column, or the lists are shuffled again for the join by key.
    keys = [on] if groups.isEmpty() else [on, "part"]
    lists = (pages.repartition(*keys) if deal else pages).groupBy(*keys).agg(pairs.alias("pairs"))
    lists = lists if "part" in keys else lists.withColumn("part", F.lit(0))
    return lists.select(on, "part", F.transform("pairs", lambda p: p[value]).alias("listed"))


def document_heads(projects: DataFrame, limit: int = EDGES_PER_PART) -> DataFrame:
    """Projects repeated for each page of `limit` edges, by their relationship_count: the rows of project_documents without edges."""
    return one_row_per_part(projects, "gid", _edge_groups(projects, limit))


def _edge_groups(projects: DataFrame, limit: int) -> DataFrame:
    return counted_groups(projects, "gid", "relationship_count", limit)


def project_documents(projects: DataFrame, edges: DataFrame, limit: int = EDGES_PER_PART, counted: bool = False) -> DataFrame:
    """Projects with their edges nested, in pages of `limit` edges in edge order. With `counted`, how many edges a project has is taken from
    its relationship_count, so edges are shuffled once, to be nested."""
    edge = F.struct("company_id", "company_name", "relationship_type", "percentage", "ownership_id",
                    "optionee_id", "comments", "company_details", "data_source")
    groups = _edge_groups(projects, limit) if counted else long_groups(edges, "gid", limit)
    lists = _listed(edges.select("gid", "ord", edge.alias("edge")), "gid", ["ord"], "edge", limit, groups)
    no_edges = F.array().cast(lists.schema["listed"].dataType)
    company_type = projects.schema["primary_company"].dataType.simpleString()
    numbered = one_row_per_part(projects, "gid", groups)
    return numbered.join(lists, ["gid", "part"], "left").select(
        "gid", "name", "location", "stage", "commodities", "operator",
        F.coalesce("listed", no_edges).alias("company_relationships"), "primary_company",
        F.array().cast(f"array<{company_type}>").alias("stakeholders"), "data_sources", "processing_stage",
        "project_url", "created_at", "updated_at", "errors", "part", "parts")


def company_documents(documents: DataFrame, run_ts: str, company_prefix: str,
                      limit: int = PROJECTS_PER_PART, heads: DataFrame | None = None) -> DataFrame:
    """A document per company with its projects nested, from project_documents rows.

    Projects come in pages of `limit`, in load order; each page is a part that repeats the header, and every project
    is in exactly one. Header and list meet on (company, part), so the parts of a hot company stay in different tasks.
    Headers and sizes come from `heads`, the document_heads of the same projects; without it, from the documents.
    """
    def of_company(df: DataFrame) -> DataFrame:
        return with_company(df, drop_blank_id=True).withColumn("company_id", F.col("primary_company.id"))

    kept, known = of_company(documents), of_company(documents if heads is None else heads)
    project = F.struct(*[c for c in documents.columns if c not in ("part", "parts")])
    rows = kept.select("company_id", "gid", project_order().alias("seen"), F.col("part").alias("slice"),
                       project.alias("project"))
    headers = _company_headers(known)
    headers = written(headers, "headers")
    groups = counted_groups(headers, "company_id", "n_documents", limit)
    lists = _listed(rows, "company_id", ["seen", "slice"], "project", limit, groups, deal=True)
    headers = one_row_per_part(headers, "company_id", groups)
    no_projects = F.array().cast(lists.schema["listed"].dataType)
    return headers.join(lists, ["company_id", "part"], "left").select(
        "company_id", coalesce_truthy(F.col("company.name"), F.lit("Unknown")).alias("company_name"),
        company_url(F.col("company_id"), company_prefix).alias("company_url"), "countries", "total_projects",
        "part", "parts", F.coalesce("listed", no_projects).alias("projects"),
        F.struct(F.col("company").alias("company_info"), F.lit(ENRICHMENT_SOURCE).alias("enrichment_source"),
                 run_clock(run_ts).alias("api_response_timestamp")).alias("additional_company_data"))


def _company_headers(kept: DataFrame) -> DataFrame:
    """Per company: first-seen record, projects, documents (pages of projects) and countries."""
    per_country = (kept.select(
        "company_id", F.col("primary_company").alias("company"), project_order().alias("seen"),
        (F.col("part") == 0).alias("is_head"),
        F.when(truthy(F.col("location.country")), F.col("location.country")).alias("country"))
        .groupBy("company_id", "country").agg(
            F.count_if("is_head").alias("n"), F.count("*").alias("n_documents"),
            F.min_by("company", "seen").alias("company"), F.min("seen").alias("seen")))
    return per_country.groupBy("company_id").agg(
        F.sum("n").alias("total_projects"), F.sum("n_documents").alias("n_documents"),
        F.min_by("company", "seen").alias("company"),
        F.sort_array(F.collect_set("country")).alias("countries"))


def projects_metadata(projects: DataFrame, run_ts: str) -> DataFrame:
    """Envelope of the projects export, one row."""
    # Fixed value: version of the export layout.
    version = "2.0"
    per_set = projects.groupBy("data_sources").agg(F.count("*").alias("n"))
    return per_set.agg(
        F.sum("n").alias("total_projects"), F.lit(run_ts).alias("generated_at"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("data_sources")))).alias("data_sources"),
        F.lit(version).alias("version"))


def json_lines(df: DataFrame) -> DataFrame:
    """each row as one JSON text with null fields kept."""
    return df.select(to_json_full(F.struct(*df.columns)).alias("value"))
