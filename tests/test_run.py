"""The staged run on the smallest tables: invariants over its outputs."""

import pytest
from pyspark.sql import functions as F

from gidlake.plans import bindings as b
from gidlake.plans import run as runs
from gidlake.settings import PortalSettings, check_shared, remove_scratch, scratch_path
from gidlake.sources import readers

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def result(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("published"))
    return runs.run(spark, b.landing(spark, SF_DIR), PortalSettings(), root, b.RUN_TS, "2025-01-31 12:00:07",
                    b.error_events(spark, SF_DIR))


def test_every_gid_is_completed_or_failed(result):
    done, lost = result.projects.count(), result.failures.count()
    assert done + lost == result.gids.count() == result.gids.distinct().count()
    assert result.projects.select("gid").distinct().count() == done


def test_published_sums(spark, result):
    marts = {name: spark.read.parquet(f"{result.outputs['marts']}/{name}")
             for name in ("Projects", "Companies", "Relationships")}
    linked = result.projects.filter("primary_company is not null").count()
    assert marts["Projects"].count() == result.projects.count() and len(marts["Projects"].columns) == 24
    assert marts["Companies"].agg(F.sum("project_count")).first()[0] == linked and len(marts["Companies"].columns) == 12
    assert marts["Relationships"].count() == result.projects.agg(F.sum("relationship_count")).first()[0]
    assert len(marts["Relationships"].columns) == 10


def test_documents_nest_everything_once(spark, result):
    documents = readers.read_company_documents(spark, result.outputs["companies_json"])
    nested = documents.select(F.explode("projects").alias("p")).select("p.*")
    assert nested.count() == nested.select("gid").distinct().count()
    edges = nested.agg(F.sum(F.size("company_relationships"))).first()[0]
    assert edges == result.edges.count()
    projects = readers.read_projects(spark, result.outputs["projects_json"] + "/projects")
    assert projects.count() == result.projects.count()


def test_metrics_of_the_whole_run(spark, result):
    row = readers.read_metrics(spark, result.outputs["metrics"]).first()
    assert row.completed_projects == result.projects.count()
    assert row.duration_seconds == 7.0 and 0 < row.success_rate <= 100
    assert sum(row.error_summary.values()) == b.error_events(spark, SF_DIR).count()


def test_test_mode_limits_to_feed_gids(spark):
    settings = PortalSettings(mode="test", countries=["NATION_3", "NATION_8"])
    gids = runs.discover(b.landing(spark, SF_DIR), settings)
    assert gids.count() == 10
    known = b.feed(spark, SF_DIR).filter("country in ('NATION_3', 'NATION_8')")
    assert gids.join(known, "gid", "left_anti").count() == 0


def test_stage_can_be_removed(spark, tmp_path):
    path = scratch_path(spark, "spent")
    spark.range(3).write.parquet(path)
    remove_scratch(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        remove_scratch(spark, str(tmp_path))


def test_a_local_folder_on_a_cluster_stops_the_job():
    for folder in ("file:/warehouse", "/warehouse", "file:///warehouse"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            check_shared("spark://host:7077", folder)
        check_shared("local[4]", folder)
    check_shared("yarn", "hdfs://host/warehouse")
