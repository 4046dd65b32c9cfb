"""Outputs published as one, batches that stay, inputs joined as they lie."""

import os
import re
from functools import partial

import pytest
from pyspark.sql import functions as F

from gidlake.operators import assembly, batches, marts
from gidlake.plans import bindings as b
from gidlake.settings import SHUFFLES_GO, scratch_path, shuffles_removed
from gidlake.plans.queries import QUERIES
from gidlake.sources import bucketed, published, writers

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    landing = b.landing(spark, SF_DIR)
    gids = landing.feed.select("gid").distinct().orderBy("gid").limit(20)
    assembly.assemble(gids, landing, b.RUN_TS).projects.write.parquet(f"{root}/projects")
    projects = spark.read.parquet(f"{root}/projects")
    assembly.project_edges(projects, landing.edges).write.parquet(f"{root}/edges")
    return projects, spark.read.parquet(f"{root}/edges")


def test_a_run_broken_between_outputs_leaves_the_old_set(spark, tables, tmp_path, monkeypatch):
    root = str(tmp_path)
    projects, edges = tables
    assert published.published(spark, root) == {}
    first = published.publish_all(projects, edges, root, b.RUN_TS, "p/")
    assert published.published(spark, root) == first
    with monkeypatch.context() as broken:
        broken.setattr(writers, "export_marts", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            published.publish_all(projects.limit(1), edges, root, b.RUN_TS, "p/")
    assert published.published(spark, root) == first
    assert spark.read.json(f"{first['projects_json']}/projects").filter("part = 0").count() == projects.count()
    second = published.publish_all(projects.limit(1), edges, root, b.RUN_TS, "p/")
    assert published.published(spark, root) == second != first and published.published(spark, root, 1) == first
    assert spark.read.parquet(f"{second['marts']}/Projects").count() == 1
    assert spark.read.parquet(f"{first['marts']}/Projects").count() == projects.count()


def test_two_writers_cannot_publish_one_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    published.point(spark, root, {"a": "x"})
    monkeypatch.setattr(published, "versions", lambda *_: [])
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        published.point(spark, root, {"a": "y"})


def test_new_gids_never_move_old_ones(spark, tmp_path):
    ledger = batches.batch_ledger(spark, str(tmp_path / "ledger"), 8)
    old = {}
    for gids in (range(25), range(20, 47), range(5), range(100, 104)):
        frame = spark.createDataFrame([(str(g),) for g in gids] * 2 + [(None,)], "gid string")
        batches.give_places(ledger, frame)
        got = {r.gid: r.batch_id for r in batches.stable_batches(ledger, 10).collect()}
        assert old.items() <= got.items()
        old = got
        sizes = sorted((list(got.values()).count(k) for k in set(got.values())), reverse=True)
        assert len(got) == sum(sizes) and all(n == 10 for n in sizes[:-1])
    assert sorted(old, key=int) == [str(g) for g in (*range(47), *range(100, 104))]


def exchanges_above_scans(plan):
    """For each bucketed scan of a plan, the exchanges between it and the first join above it."""
    lines = [(len(re.match(r"[ :+\-*|()0-9]*", line)[0]), line) for line in plan.splitlines() if line.strip()]
    found = []
    for i, (depth, line) in enumerate(lines):
        if "FileScan" in line and "Bucketed: true" in line:
            above = []
            for d, other in reversed(lines[:i]):
                if d < depth:
                    depth = d
                    above.append(other)
                    if "Join" in other:
                        break
            found.append([a for a in above if "Exchange" in a])
    return found


def test_assembly_of_bucketed_inputs_shuffles_no_landed_side(spark, tmp_path):
    landing = b.landing(spark, SF_DIR)
    gids = landing.feed.select("gid").distinct()
    plain = assembly.assemble(gids, landing, b.RUN_TS).projects
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        placed = bucketed.land_bucketed(landing, "landed_test", str(tmp_path), 8)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        by_bucket = assembly.assemble(gids, placed, b.RUN_TS).projects
        plan = by_bucket._jdf.queryExecution().executedPlan().toString()
        scans = exchanges_above_scans(plan)
        assert len(scans) == 5 and not any(scans), scans
        assert by_bucket.exceptAll(plain).count() == plain.exceptAll(by_bucket).count() == 0
        for name in bucketed.REDUCED:
            spark.sql(f"DROP TABLE landed_test_{name}")
        again = bucketed.open_bucketed(spark, "landed_test", str(tmp_path), landing, 8)
        assert assembly.assemble(gids, again, b.RUN_TS).projects.exceptAll(plain).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
        for name in bucketed.REDUCED:
            spark.sql(f"DROP TABLE IF EXISTS landed_test_{name}")


def test_edges_landed_as_their_summary(spark):
    edges = b.edges(spark, SF_DIR)
    once = bucketed.edge_summary(edges)
    assert bucketed.edge_summary(once) is once and once.agg(F.sum("relationship_count")).first()[0] == edges.count()


def test_documents_are_compressed(spark, tables, tmp_path):
    for path in (writers.write_projects(*tables, str(tmp_path), b.RUN_TS) + "/projects", writers.write_companies_with_projects(*tables, str(tmp_path), b.RUN_TS, "p/")):
        files = [name for name in spark.read.text(path).inputFiles()]
        assert files and all(name.endswith(".json.gz") for name in files)


def test_a_join_with_suppliers_is_planned_by_their_own_size(spark):
    plan = b.edges(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_feed_rows_of_a_gid_lie_together(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    held = b.feed(spark, SF_DIR).select("gid", F.spark_partition_id().alias("p")).distinct().groupBy("gid").count()
    assert held.filter("count > 1").count() == 0 < held.count()
    spark.conf.unset("spark.sql.adaptive.enabled")


def test_nested_lists_are_shuffled_once(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    documents = marts.project_documents(*tables, counted=True)
    plan = documents._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2  # projects, and edges before they are nested


def test_all_parts_of_an_export_are_read(spark, monkeypatch):
    """Lists of a few entries a part say the same of each key as lists that fit one."""
    def said():
        rows = QUERIES["k05_export_all"](spark, SF_DIR).filter("output in ('projects_json', 'companies_json')").collect()
        assert len({(r.output, r.key) for r in rows}) == len(rows)
        return {(r.output, r.key): r.said for r in rows}

    whole = said()
    for name, limit in (("project_documents", 7), ("document_heads", 7), ("company_documents", 3)):
        monkeypatch.setattr(marts, name, partial(getattr(marts, name), limit=limit))
    assert said() == whole


def many_edges(spark, hot):
    """2,400 projects with two edges each, the first with `hot` more, and one without any."""
    company = F.expr("case when id % 3 = 0 then 'x' else cast(id % 90 as string) end")
    from gidlake.operators.assembly import blank_location
    from gidlake.operators.companies import minimal_company

    projects = spark.range(2401).select(
        F.col("id").cast("string").alias("gid"), F.concat(F.lit("p"), "id").alias("name"), blank_location().alias("location"),
        *[F.lit(None).cast("string").alias(c) for c in ("stage", "commodities", "operator", "project_url")],
        minimal_company(company, F.lit("C"), "relationships").alias("primary_company"), F.when(F.col("id") == 2400, 2).otherwise(1).alias("company_tier"),
        F.when(F.col("id") == 0, 2 + hot).when(F.col("id") < 2400, 2).otherwise(1).cast("bigint").alias("relationship_count"), F.array(F.lit("api")).alias("data_sources"),
        F.lit("completed").alias("processing_stage"), F.lit(None).cast("timestamp_ntz").alias("created_at"), F.lit(None).cast("timestamp_ntz").alias("updated_at"),
        F.array().cast("array<string>").alias("errors"))
    edges = spark.range(4800 + hot).select(
        F.when(F.col("id") < 4800, F.col("id") % 2400).otherwise(0).cast("string").alias("gid"), F.col("id").alias("ord"), F.lit("7").alias("company_id"),
        F.lit("C").alias("company_name"), F.lit("jv").alias("relationship_type"), F.lit(1.5).alias("percentage"), F.col("id").alias("ownership_id"),
        F.lit(None).cast("bigint").alias("optionee_id"), F.lit(None).cast("string").alias("comments"),
        minimal_company(F.lit("7"), F.lit("C"), "relationships").alias("company_details"), F.lit("relationships").alias("data_source"))
    return projects, edges


@pytest.mark.parametrize("hot", [0, 500])
def test_written_edges_are_project_edges(spark, hot):
    projects, edges = many_edges(spark, hot)
    written = bucketed.write_edges(projects, edges, scratch_path(spark, "test-edges"))
    plain = assembly.project_edges(projects, edges)
    assert written.columns == plain.columns and sorted(map(str, written.collect())) == sorted(map(str, plain.collect()))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("edges_")]
    documents = marts.project_documents(projects, written, counted=True)
    if not hot:  # edges are not shuffled again to be nested
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = marts.project_documents(projects, written, counted=True)._jdf.queryExecution().executedPlan().toString()
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert plan.count("Exchange hashpartitioning") == 1
    assert sorted(map(str, documents.collect())) == sorted(map(str, marts.project_documents(projects, plain, limit=10000).collect()))


def shuffle_files(spark):
    # Blocks of the executor's disk, apart from files a statement has under way.
    return sum(name.endswith(".data") for folder in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
               for _, _, names in os.walk(folder.getPath()) for name in names)


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    def write(name):
        before = shuffle_files(spark)
        spark.range(1000).repartition(3, "id").write.parquet(str(tmp_path / name))
        return shuffle_files(spark) - before

    assert write("kept") > 0
    with shuffles_removed(spark):
        assert write("gone") <= 0
    assert spark.conf.get(SHUFFLES_GO) == "false"
