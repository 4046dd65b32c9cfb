"""Hot keys: a third or more of the rows on one key, results still whole."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from gidlake.operators import companies, marts, skew


@pytest.fixture(scope="module")
def hot_rows(spark):
    """6000 rows, half of them on key 'hot', 100 without a key."""
    return spark.range(6000).select(
        F.expr("case when id % 2 = 0 then 'hot' when id < 200 then null else concat('k', id % 500) end").alias("key"),
        F.col("id").alias("ord"))


def test_heavy_keys(hot_rows):
    assert [r.key for r in skew.heavy_keys(hot_rows, "key", share=10).collect()] == ["hot"]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_skew_join_equals_plain_join(spark, hot_rows, how):
    small = spark.createDataFrame([("hot", 1), ("k3", 2), ("k5", 3), ("other", 4)], "key string, v int")
    def rows(df):
        return Counter(tuple(sorted(r.asDict().items(), key=str)) for r in df.collect())

    salted = skew.skew_join(hot_rows, small, "key", how, spread=F.col("ord"))
    assert rows(salted) == rows(hot_rows.join(small, "key", how))


def test_hot_keys_are_dealt_by_their_rows(spark, hot_rows):
    small = spark.createDataFrame([("hot", 1)], "key string, v int")
    joined = skew.skew_join(hot_rows, small, "key", "inner", F.col("ord"), hot=spark.createDataFrame([("hot", 3000)], "key string, n bigint"), rows_per_task=100)
    assert joined.count() == 3000 and [r.n for r in skew.heavy_keys(hot_rows, "key", share=10).collect()] == [3000]


def test_skew_join_deals_the_hot_key(spark, hot_rows):
    small = spark.createDataFrame([("hot", 1)], "key string, v int")
    plan = skew.skew_join(hot_rows, small, "key", "inner", spread=F.col("ord"))
    assert "salt" in plan._jdf.queryExecution().optimizedPlan().toString()


def test_pages_are_ranks_in_order(hot_rows):
    rows = hot_rows.filter("key is not null")
    groups = skew.long_groups(rows, "key", 100)
    assert [tuple(r) for r in groups.collect()] == [("hot", 30)]
    paged = skew.in_pages(rows, "key", ["ord"], 100, groups).collect()
    assert len(paged) == rows.count()
    ranks = Counter()
    for r in sorted(paged, key=lambda r: (r.key, r.ord)):
        assert (r.part, r.parts) == ((ranks[r.key] // 100, 30) if r.key == "hot" else (0, 1))
        ranks[r.key] += 1


def test_pages_do_not_depend_on_other_groups(spark):
    alone = spark.range(40).select(F.lit("a").alias("key"), F.col("id").alias("ord"))
    among = alone.unionByName(spark.range(3000).select(F.expr("concat('k', id % 700)"), F.col("id")).toDF("key", "ord"))

    def pages(df):
        return {(r.ord, r.part, r.parts) for r in skew.in_pages(df, "key", ["ord"], 10, skew.long_groups(df, "key", 10)).filter("key = 'a'").collect()}

    assert pages(alone) == pages(among) == {(i, i // 10, 4) for i in range(40)}


def test_even_batches_are_exact(spark):
    gids = spark.range(1037).select(F.col("id").cast("string").alias("gid"))
    got = skew.even_batches(gids, "gid", 100).collect()
    sizes = Counter(r.batch_id for r in got)
    assert len({r.gid for r in got}) == 1037
    assert [sizes[i] for i in range(11)] == [100] * 10 + [37]


def edges(spark, n, key):
    company = companies.minimal_company(F.col("company_id"), F.lit("C"), "relationships")
    return spark.range(n).select(
        F.expr(key).alias("gid"), F.col("id").alias("ord"), F.expr("cast(id % 7 as string)").alias("company_id"),
        F.lit("C").alias("company_name"), F.lit("jv").alias("relationship_type"),
        F.expr("cast(id % 90 as double)").alias("percentage"), F.lit(1).cast("bigint").alias("ownership_id"),
        F.lit(None).cast("bigint").alias("optionee_id"), F.lit(None).cast("string").alias("comments")).withColumn(
            "company_details", company).withColumn("data_source", F.lit("relationships"))


def test_digest_parts_hold_every_edge(spark):
    rows = edges(spark, 900, "case when id % 3 < 2 then '1' else cast(id as string) end")
    parts = companies.relationship_digest(rows, limit=50).collect()
    hot = [r for r in parts if r.gid == "1"]
    assert {r.parts for r in hot} == {12}
    assert sum(len(r.digest.split(", ")) for r in parts) == 900
    whole = companies.relationship_digest(rows).filter("gid = '1'").first()
    assert whole.digest == ", ".join(r.digest for r in sorted(hot, key=lambda r: r.part))


def test_primary_company_of_a_hot_gid(spark):
    rows = edges(spark, 900, "'1'")
    row = companies.primary_company(rows).first()
    assert (row.percentage, row.ord) == (89.0, 89)
    summary = companies.edge_summary(rows).first()
    assert summary.relationship_count == 900 and summary.primary_company.id == str(89 % 7)


def test_company_documents_in_parts(spark):
    company = companies.minimal_company(F.expr("case when id % 2 = 0 then 'big' else cast(id as string) end"),
                                        F.lit("Big"), "relationships")
    from gidlake.operators.assembly import blank_location

    projects = spark.range(400).select(
        F.col("id").cast("string").alias("gid"), F.lit("p").alias("name"), blank_location().alias("location"),
        *[F.lit(None).cast("string").alias(c) for c in ("stage", "commodities", "operator", "project_url")],
        company.alias("primary_company"), F.lit(1).alias("company_tier"), F.lit(1).alias("relationship_count"),
        F.array(F.lit("api")).alias("data_sources"), F.lit("completed").alias("processing_stage"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"), F.lit(None).cast("timestamp_ntz").alias("updated_at"),
        F.array().cast("array<string>").alias("errors"))
    rows = edges(spark, 600, "case when id % 3 = 0 then '0' else cast(id % 400 as string) end")
    documents = marts.project_documents(projects, rows, limit=40)
    listed = documents.collect()
    assert sum(len(r.company_relationships) for r in listed) == 600
    hot = [r for r in listed if r.gid == "0"]
    assert len(hot) == hot[0].parts == 6
    out = marts.company_documents(documents, "2025-01-01 00:00:00", "u", limit=30).collect()
    big = [r for r in out if r.company_id == "big"]
    assert {r.total_projects for r in big} == {200}
    assert len(big) == big[0].parts > 5
    order = [p.gid for r in sorted(big, key=lambda r: r.part) for p in r.projects]
    assert list(dict.fromkeys(order)) == [str(i) for i in range(0, 400, 2)]
    assert sum(len(p.company_relationships) for r in out for p in r.projects) == 600
