"""All outputs of a run published as one (K01-K05): readers see the last whole set.

Every run writes below a folder of its own. A pointer, a table of (output, path) that must not exist yet, is written when
all outputs are there; readers take the pointer with the largest version. Two runs cannot make one version, and a run that
breaks between two outputs leaves readers on the set before.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from gidlake.sources import writers
from gidlake.sources.keyed_store import finished_folders

_POINTER = "output string, path string"


def versions(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(name.removeprefix("version=")) for name in finished_folders(spark, f"{root}/pointer"))


def point(spark: SparkSession, root: str, paths: dict[str, str]) -> int:
    """Make `paths` the published set; fails if another run has published the next version meanwhile."""
    version = max(versions(spark, root), default=0) + 1
    spark.createDataFrame(list(paths.items()), _POINTER).coalesce(1).write.mode("errorifexists").parquet(f"{root}/pointer/version={version}")
    return version


def published(spark: SparkSession, root: str, version: int | None = None) -> dict[str, str]:
    """Paths of the last published set, or of an earlier one; none before the first."""
    known = versions(spark, root)
    if not known:
        return {}
    rows = spark.read.schema(_POINTER).parquet(f"{root}/pointer/version={version or known[-1]}").collect()
    return {r.output: r.path for r in rows}


def publish_all(projects: DataFrame, edges: DataFrame, root: str, run_ts: str, company_prefix: str, metrics: DataFrame | None = None) -> dict[str, str]:
    """Write documents, marts and metrics, then publish them together; their paths."""
    own = f"{root}/runs/{writers.run_id(run_ts)}-{uuid.uuid4().hex[:8]}"
    paths = writers.export_all(projects, edges, own, run_ts, company_prefix)
    if metrics is not None:
        paths["metrics"] = writers.write_metrics(metrics, f"{own}/reports", run_ts)
    point(projects.sparkSession, root, paths)
    return paths
