"""Run settings, session tuning and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

# Country lists used when no country file can be read.
COUNTRIES_WHEN_MISSING = ["Australia", "Canada", "United States of America", "Brazil"]
COUNTRIES_WHEN_UNREADABLE = ["Australia", "Canada"]
TEST_MODE_COUNTRIES = ["Australia"]
TEST_MODE_MAX_PROJECTS = 10


@dataclass(frozen=True)
class PortalSettings:
    """What one run works on: the portal's address, the country scope and the batch size."""

    base_host: str = "https://portal.example"
    mode: str = "production"
    countries: list[str] = field(default_factory=list)
    max_projects: int | None = None
    batch_size: int = 100

    @property
    def company_prefix(self) -> str:
        return f"{self.base_host}/company-profile?gid="

    @property
    def project_prefix(self) -> str:
        return f"{self.base_host}/project-profile?gid="


def tune_session(spark: SparkSession) -> SparkSession:
    """Turn on the adaptive rules the plans rely on; sizes stay with the cluster's settings."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


# Fixed value: the session's setting that removes the shuffle files of a statement at its end.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Fixed value: the session's setting that makes partitions of a union one where its parts are dealt alike, so parts of one partition each become one task.
UNIONS_MERGE = "spark.sql.unionOutputPartitioning"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Statements run within have this setting of the session."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffles_removed(spark: SparkSession) -> AbstractContextManager[None]:
    """Statements run within leave no shuffle files: these go when a statement ends, not when the driver next collects its garbage. For
    writes, whose plan nothing runs again."""
    return setting(spark, SHUFFLES_GO, "true")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir); below the session's warehouse where it is unset. On a cluster that warehouse
    must not be a folder of one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    check_shared(spark.sparkContext.master, warehouse)
    return f"{warehouse}/_scratch"


def check_shared(master: str, folder: str) -> None:
    """Stop where executors of other machines would write to a local folder."""
    if not master.startswith("local") and (folder.startswith("file:") or "://" not in folder):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; {folder} is local to a machine")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/gidlake/{label}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Remove a folder that scratch_path named; anything outside the shared folder is refused."""
    if not path.startswith(f"{shared_folder(spark).rstrip('/')}/gidlake/"):
        raise ValueError(f"not a scratch folder: {path}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
