"""A whole run: discover, assemble, enrich, publish. Each stage is written to the shared folder before the next reads
it, so a lost executor costs one stage's tasks and later stages carry no long lineage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from gidlake.operators import assembly, discovery, geo, marts
from gidlake.operators.assembly import Landing
from gidlake.settings import TEST_MODE_MAX_PROJECTS, PortalSettings, scratch_path, shuffles_removed, tune_session
from gidlake.sources.bucketed import write_edges
from gidlake.sources.published import publish_all


@dataclass(frozen=True)
class RunResult:
    """Written tables and published paths of a run. `stage` is the folder of the tables; settings.remove_scratch
    removes it once they are not needed."""

    gids: DataFrame
    projects: DataFrame
    edges: DataFrame
    failures: DataFrame
    outputs: dict[str, str]
    stage: str


def _written(df: DataFrame, path: str) -> DataFrame:
    with shuffles_removed(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discover(landing: Landing, settings: PortalSettings) -> DataFrame:
    """Gids to work on, by the settings' mode, countries and limit."""
    feed = discovery.country_scope(landing.feed, settings.mode, settings.countries)
    limit = settings.max_projects or (TEST_MODE_MAX_PROJECTS if settings.mode == "test" else None)
    return discovery.limit_gids(feed, discovery.discover_gids(feed, landing.url_index), limit)


def run(spark: SparkSession, landing: Landing, settings: PortalSettings, root: str, run_ts: str, end_ts: str,
        errors: DataFrame | None = None) -> RunResult:
    """All stages; the outputs are published together (sources.published). `errors` holds error_type rows noted while landing; end_ts closes the run's clock."""
    tune_session(spark)
    stage = scratch_path(spark, "run")
    scoped = landing._replace(feed=discovery.country_scope(landing.feed, settings.mode, settings.countries))
    gids = _written(discover(landing, settings), f"{stage}/gids")
    # The keys that enrichment will look up: one row per gid, after the map centres have filled coordinates in.
    located = geo.backfill_map_centers(assembly.safe_project(assembly.latest_feed(scoped.feed)), scoped.map_centers)
    hot = geo.hot_geocode_keys(located)
    done = assembly.assemble(gids, scoped, run_ts, hot)
    projects = _written(done.projects, f"{stage}/projects")
    failures = _written(done.failures, f"{stage}/failures")
    edges = write_edges(projects, landing.edges, f"{stage}/edges")
    noted = errors if errors is not None else spark.createDataFrame([], "error_type string")
    metrics = marts.run_metrics(projects, failures, noted, run_ts, end_ts)
    outputs = publish_all(projects, edges, root, run_ts, settings.company_prefix, metrics)
    return RunResult(gids, projects, edges, failures, outputs, stage)
