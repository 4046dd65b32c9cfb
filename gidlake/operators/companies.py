"""Companies of a project: tiers, primary company, digest and lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gidlake.functions.text import blank_to_null, coalesce_truthy
from gidlake.functions.values import synthetic_id
from gidlake.operators.skew import first_per_key, in_pages, long_groups, skew_join

EDGE_COLUMNS = ["gid", "ord", "company_id", "company_name", "relationship_type", "percentage",
                "ownership_id", "optionee_id", "comments", "company_details", "data_source"]

# Fixed value: name of a company known by id only.
UNKNOWN_COMPANY = "Unknown Company"

# Edges of one project gathered into one text or document; longer lists are cut into parts.
EDGES_PER_PART = 10000


def company_url(company_id: Column, prefix: str) -> Column:
    """P09."""
    return F.when(blank_to_null(company_id).isNotNull(), F.concat(F.lit(prefix), company_id))


def minimal_company(id_: Column, name: Column, source: str, relationship: str | None = None) -> Column:
    no_text = F.lit(None).cast("string")
    empty = [no_text.alias(c) for c in
             ("ticker", "exchange", "website", "ceo", "headquarters", "phone", "industry", "sector")]
    return F.struct(id_.alias("id"), name.alias("name"), *empty,
                    F.lit(None).cast("double").alias("ownership_percentage"),
                    F.lit(relationship).cast("string").alias("relationship_type"),
                    F.lit(source).alias("data_source"), F.lit(None).cast("timestamp_ntz").alias("fetched_at"))


def operator_company(name: Column) -> Column:
    """Company made from an operator name; null without one."""
    return F.when(blank_to_null(name).isNotNull(), minimal_company(synthetic_id(name), name, "api", "operator"))


def scraped_company(company_id: Column, company_name: Column, operator: Column) -> Column:
    """Company of a page record; null when it names neither an id nor a company or operator."""
    name = blank_to_null(coalesce_truthy(company_name, operator))
    id_ = blank_to_null(company_id)
    return F.when(id_.isNotNull() | name.isNotNull(),
                  minimal_company(F.coalesce(id_, synthetic_id(name)),
                                  F.coalesce(name, F.lit(UNKNOWN_COMPANY)), "scraper"))


def single_edge(company: Column, percentage: float | None) -> list[Column]:
    """Edge columns of a project whose only company is `company` (tiers two and three)."""
    return [company["id"].alias("company_id"), company["name"].alias("company_name"),
            F.lit("operator").alias("relationship_type"), F.lit(percentage).cast("double").alias("percentage"),
            F.lit(None).cast("bigint").alias("ownership_id"), F.lit(None).cast("bigint").alias("optionee_id"),
            F.lit(None).cast("string").alias("comments"), company.alias("company_details"),
            company["data_source"].alias("data_source")]


def _no_position(edges: DataFrame) -> Column:
    return F.lit(None).cast(edges.schema["ord"].dataType).alias("ord")


def edges_of_gids(gids: DataFrame, edges: DataFrame) -> DataFrame:
    """The landed edges of the wanted gids."""
    return skew_join(edges, gids.select("gid").distinct(), "gid", "left_semi", spread=F.col("ord"))


def resolve_companies(gids: DataFrame, edges: DataFrame, first_records: DataFrame,
                      feed: DataFrame) -> DataFrame:
    """Landed edges; for gids without any the page record's company; for the rest the feed operator.

    `first_records` and `feed` hold one row per gid.
    """
    wanted = gids.select("gid").distinct()
    tier1 = edges_of_gids(gids, edges).select(*EDGE_COLUMNS)
    have_edges = edges.select("gid").distinct()
    left_over = wanted.join(have_edges, "gid", "left_anti")
    record = scraped_company(F.col("company_id"), F.col("company_name"), F.col("operator"))
    tier2 = (left_over.join(first_records, "gid").withColumn("company", record)
             .filter(F.col("company").isNotNull()))
    operator = (left_over.join(tier2.select("gid"), "gid", "left_anti").join(feed, "gid")
                .withColumn("company", operator_company(F.col("operator"))).filter(F.col("company").isNotNull()))
    return (tier1
            .unionByName(tier2.select("gid", _no_position(edges), *single_edge(F.col("company"), None)))
            .unionByName(operator.select("gid", _no_position(edges), *single_edge(F.col("company"), 100.0))))


def primary_order(percentage: Column, kind: Column, position: Column) -> Column:
    """W01 sort key: jv edges first, larger share first, then the order they came in."""
    is_jv = kind == "jv"
    return F.struct(F.when(is_jv, 0).otherwise(1).alias("not_jv"),
                    F.when(is_jv, -F.coalesce(percentage, F.lit(0.0))).otherwise(F.lit(0.0)).alias("minus_share"),
                    position.alias("position"))


def edge_summary(edges: DataFrame) -> DataFrame:
    """One row per gid: primary and first company, edge counts.

    Everything is a partial aggregate, so a gid with very many edges sends one row per task. Edges landed as their summary
    are taken as they are.
    """
    if "first_edge" in edges.columns:
        return edges
    rank = primary_order(F.col("percentage"), F.col("relationship_type"), F.col("ord"))
    return edges.groupBy("gid").agg(
        F.min_by("company_details", rank).alias("primary_company"),
        F.min_by(F.struct("company_details", "company_name"), F.col("ord")).alias("first_edge"),
        F.count("*").alias("relationship_count"),
        F.count_if(F.col("relationship_type") == "jv").alias("jv_count"),
    )


def primary_company(edges: DataFrame) -> DataFrame:
    """The edge whose company is the project's primary one."""
    rank = primary_order(F.col("percentage"), F.col("relationship_type"), F.col("ord"))
    return first_per_key(edges, ["gid"], rank)


def relationship_presence(edges: DataFrame) -> DataFrame:
    """Counts and jv flag per gid with edges."""
    return edges.groupBy("gid").agg(
        F.count("*").alias("relationship_count"),
        F.bool_or(F.col("relationship_type") == "jv").alias("has_jv"))


def relationship_digest(edges: DataFrame, limit: int = EDGES_PER_PART) -> DataFrame:
    """`type:name (pct%)` joined in edge order, in pages of `limit` edges; the pages in order are the whole digest."""
    share = F.when(F.coalesce(F.col("percentage"), F.lit(0.0)) != 0,
                   F.concat(F.lit(" ("), F.col("percentage").cast("string"), F.lit("%)"))).otherwise(F.lit(""))
    entry = F.concat("relationship_type", F.lit(":"), "company_name", share)
    rows = edges.select("gid", "ord", entry.alias("entry"))
    parts = in_pages(rows, "gid", ["ord"], limit, long_groups(edges, "gid", limit))
    listed = F.sort_array(F.collect_list(F.struct("ord", "entry")))
    return (parts.groupBy("gid", "part", "parts").agg(listed.alias("entries"))
            .select("gid", "part", "parts",
                    F.array_join(F.transform("entries", lambda e: e["entry"]), ", ").alias("digest")))


def lineage_union(projects: DataFrame, edges: DataFrame) -> DataFrame:
    """(gid, data_sources) with the sources of its edges added; at most one row per source is shuffled."""
    own = projects.select("gid", F.explode("data_sources").alias("source"))
    linked = edges.select("gid", F.col("data_source").alias("source"))
    known = projects.select("gid")
    return (own.unionByName(linked.distinct().join(known, "gid", "left_semi")).groupBy("gid")
            .agg(F.sort_array(F.collect_set("source")).alias("data_sources")))
