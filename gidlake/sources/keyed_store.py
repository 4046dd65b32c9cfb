"""Tables that grow in place: rows dealt over key buckets, each a list of generations, with a manifest that names the live ones.

    <root>/data/key_bucket=<b>/generation=<g>/...      rows of one bucket written by one commit
    <root>/manifest/version=<v>/...                    (key_bucket, generation, position, note) of every live generation

A commit writes its new generations first and its manifest last, as a folder that must not exist yet. Readers take the manifest
with the largest version, so they see a whole commit or none, and two writers cannot both make one version. Files of
generations that a commit does not replace keep their names. What a broken commit left is in no manifest.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

BUCKETS = 256
# A bucket with more generations than this is rewritten as one when it is added to.
MOST_GENERATIONS = 8
# Where a row lies: its bucket, and one of several files there.
PLACE = ("key_bucket", "key_slot")

_MANIFEST = "key_bucket int, generation string, position int, note string"


def bucket_of(key: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def finished_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in `path` that a finished write has left."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    files = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(fs_path(path)):
        return []
    return [s.getPath().getName() for s in files.listStatus(fs_path(path)) if files.exists(fs_path(s.getPath(), "_SUCCESS"))]


@dataclass(frozen=True)
class KeyedStore:
    """A store below `root` of rows with the columns of `schema`, dealt by `key` over `buckets` buckets. The number of buckets bounds every list
    that the driver holds, and stays for the life of the store."""

    spark: SparkSession
    root: str
    key: str
    schema: StructType
    buckets: int = BUCKETS

    def version(self) -> int:
        """The last finished commit, 0 before the first."""
        return max((int(name.removeprefix("version=")) for name in finished_folders(self.spark, f"{self.root}/manifest")), default=0)

    def generations(self, version: int | None = None) -> dict[int, list[str]]:
        """Live generations of each bucket, oldest first."""
        version = self.version() if version is None else version
        found: dict[int, list[str]] = {}
        if version:
            rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest/version={version}").collect()
            for row in sorted((r for r in rows if r.generation), key=lambda r: (r.key_bucket, r.position)):
                found.setdefault(row.key_bucket, []).append(row.generation)
        return found

    def notes(self) -> set[str]:
        """What the commits of the store were named; a commit may name one thing that it added."""
        if not self.version():
            return set()
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest/version=*").filter("note is not null")
        return {r.note for r in rows.select("note").distinct().collect()}

    def read(self, buckets: Iterable[int] | None = None, version: int | None = None) -> DataFrame:
        """Live rows, of the given buckets only or of all, with their key_bucket. Only folders of live generations are listed."""
        live = self.generations(version)
        wanted = live if buckets is None else {b: live[b] for b in set(buckets) & set(live)}
        paths = [f"{self.root}/data/key_bucket={b}/generation={g}" for b, gs in sorted(wanted.items()) for g in gs]
        if not paths:
            return self.spark.createDataFrame([], self._placed())
        rows = self.spark.read.schema(self._placed()).option("basePath", f"{self.root}/data").parquet(*paths)
        return rows.select(*self.columns, "key_bucket")

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def _placed(self) -> StructType:
        return StructType([*self.schema.fields, StructField("key_bucket", IntegerType())])

    def buckets_of(self, keys: DataFrame) -> list[int]:
        """Buckets that hold the keys of a table, null keys apart: a list of at most `buckets` numbers."""
        held = keys.filter(F.col(self.key).isNotNull()).select(bucket_of(self.key, self.buckets).alias("b")).distinct()
        return sorted(r.b for r in held.collect())

    def _dealt(self, rows: DataFrame) -> DataFrame:
        placed = rows.select(*self.columns).withColumns({"key_bucket": bucket_of(self.key, self.buckets), "key_slot": F.pmod(F.hash(self.key), F.lit(8))})
        return placed.repartition(*PLACE)

    def _write(self, rows: DataFrame, generation: str) -> list[int]:
        """Rows as a generation of each bucket they fall into; the buckets. Files are sorted by key, so a look-up skips row groups. Rows that
        have their place lie by it."""
        dealt = rows if set(PLACE) <= set(rows.columns) else self._dealt(rows)
        dealt = dealt.select(*self.columns, "key_bucket", F.lit(generation).alias("generation")).sortWithinPartitions("key_bucket", self.key)
        dealt.write.partitionBy("key_bucket", "generation").mode("append").parquet(f"{self.root}/data")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/data/key_bucket=*/generation={generation}")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path)
        return sorted(int(f.getPath().getParent().getName().removeprefix("key_bucket=")) for f in found)

    def _commit(self, live: dict[int, list[str]], version: int, note: str | None = None) -> int:
        rows = [(b, g, i, note) for b, gs in live.items() for i, g in enumerate(gs)] or [(0, None, 0, note)]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/manifest/version={version}")
        return version

    def append(self, rows: DataFrame, note: str | None = None) -> int:
        """Add rows as new generations of their buckets. No old file is rewritten but those of buckets in many generations."""
        version = self.version() + 1
        live = self.generations(version - 1)
        generation = f"{version}-{uuid.uuid4().hex[:8]}"
        for bucket in self._write(rows, generation):
            live.setdefault(bucket, []).append(generation)
        long = [b for b, gs in live.items() if len(gs) > MOST_GENERATIONS]
        if long:
            whole = f"{generation}-whole"
            paths = [f"{self.root}/data/key_bucket={b}/generation={g}" for b in long for g in live[b]]
            self._write(self.spark.read.schema(self.schema).parquet(*paths), whole)
            live |= {b: [whole] for b in long}
        return self._commit(live, version, note)

    def merge(self, rows: DataFrame, combine: Callable[[DataFrame], DataFrame], note: str | None = None, placed: bool = False) -> int:
        """Replace the buckets of `rows` by combine(their old rows and `rows`); all others keep their files. `rows` should be written.

        With `placed`, combine gets the rows with the columns of PLACE, already dealt by them, and must group by these as well and return them;
        so all is shuffled once.
        """
        version = self.version() + 1
        live = self.generations(version - 1)
        touched = self.buckets_of(rows)
        generation = f"{version}-{uuid.uuid4().hex[:8]}"
        both = self.read(touched, version - 1).drop("key_bucket").unionByName(rows.select(*self.columns))
        written = self._write(combine(self._dealt(both) if placed else both), generation)
        return self._commit({b: gs for b, gs in live.items() if b not in touched} | {b: [generation] for b in written}, version, note)

    def remove_dead(self, keep_versions: int = 2) -> list[str]:
        """Delete the generations that none of the last versions names, those of broken commits too; run it with no commit under way."""
        version = self.version()
        live = {(b, g) for v in range(max(1, version - keep_versions + 1), version + 1) for b, gs in self.generations(v).items() for g in gs}
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path
        data = fs_path(f"{self.root}/data")
        files = data.getFileSystem(self.spark._jsc.hadoopConfiguration())
        gone = []
        for bucket in files.listStatus(data) if files.exists(data) else []:
            name = bucket.getPath().getName()
            for made in files.listStatus(bucket.getPath()) if name.startswith("key_bucket=") else []:
                generation = made.getPath().getName().removeprefix("generation=")
                if (int(name.removeprefix("key_bucket=")), generation) not in live:
                    files.delete(made.getPath(), True)
                    gone.append(f"{name}/{generation}")
        return sorted(gone)
