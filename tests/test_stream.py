from datetime import datetime

from pyspark.sql import Row
from pyspark.sql import functions as F

from gidlake.plans import bindings as b
from gidlake.operators import assembly
from gidlake.streaming import jobs
from gidlake.streaming.waiting import Waiting

SF_DIR = "/root/testdata/sf0.001"


def put(spark, path, *gids):
    spark.createDataFrame([(g,) for g in gids], "gid string").coalesce(1).write.mode("append").parquet(str(path))


def test_dedup_remembers_earlier_runs(spark, tmp_path):
    source, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    put(spark, source, "1", "1", "2", "")
    jobs.run_to_folder(jobs.dedup_stream(jobs.stream_gids(spark, str(source))), str(out), str(state))
    put(spark, source, "2", "3", None)
    jobs.run_to_folder(jobs.dedup_stream(jobs.stream_gids(spark, str(source))), str(out), str(state))
    assert sorted(r.gid for r in spark.read.parquet(str(out)).collect()) == ["1", "2", "3"]


def test_late_errors_and_open_window(spark, tmp_path):
    source = tmp_path / "in"
    moments = ["2024-01-01 05:00:00", "2024-01-01 23:59:59", "2024-01-02 01:30:00", "2024-01-03 00:30:00"]
    rows = [(datetime.fromisoformat(m),) for m in moments]
    spark.createDataFrame(rows, "ts timestamp_ntz").coalesce(1).write.parquet(str(source))
    stream = spark.readStream.schema("ts timestamp_ntz").parquet(str(source))
    jobs.run_to_folder(jobs.windowed_errors(stream), str(tmp_path / "out"), str(tmp_path / "state"))
    got = sorted((str(r.window_start), r.errors) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("2024-01-01 00:00:00", 2)]


def test_windows_do_not_depend_on_the_session_zone(spark):
    frame = spark.createDataFrame([(datetime(2024, 3, 31, 2, 30),)], "ts timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        back = frame.select(jobs.as_zone_free(jobs.as_instant("ts")).alias("t")).first().t
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert back == datetime(2024, 3, 31, 2, 30)


def test_incremental_assembly_equals_one_batch(spark, tmp_path):
    landing = b.landing(spark, SF_DIR)
    gids = landing.feed.select("gid").distinct()
    source, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    gids.repartition(3, "gid").write.parquet(str(source))
    for _ in range(2):
        stream = jobs.stream_gids(spark, str(source), files_per_batch=1)
        jobs.start_assembly(stream, landing, str(out), str(state), b.RUN_TS).awaitTermination()
    pieces = spark.read.parquet(f"{out}/projects")
    assert pieces.select("batch_id").distinct().count() > 1
    whole = assembly.assemble(gids, landing, b.RUN_TS).projects
    columns = ["gid", "name", "operator", "relationship_count", "primary_company", "location", "data_sources"]
    assert pieces.select(columns).exceptAll(whole.select(columns)).count() == 0
    assert pieces.count() == whole.count() == pieces.select(F.countDistinct("gid")).first()[0]


def test_a_gid_that_comes_again_is_assembled_once(spark, tmp_path):
    landing = jobs.land_by_bucket(b.landing(spark, SF_DIR), str(tmp_path / "landing"), 8)
    gids = [r.gid for r in b.feed(spark, SF_DIR).select("gid").distinct().orderBy("gid").limit(3).collect()]
    source, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    for _ in range(2):
        put(spark, source, *gids, gids[0])
        stream = jobs.stream_gids(spark, str(source), files_per_batch=1)
        jobs.start_assembly(stream, landing, str(out), str(state), b.RUN_TS, 8).awaitTermination()
    assert sorted(r.gid for r in spark.read.parquet(f"{out}/projects").collect()) == gids


def test_a_batch_reads_its_buckets_only(spark, tmp_path):
    landing = jobs.land_by_bucket(b.landing(spark, SF_DIR), str(tmp_path / "landing"), 8)
    wanted = spark.createDataFrame([("1",)], "gid string")
    plan = jobs.narrowed(landing, wanted, 8).edges._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(gid_bucket" in plan or "PartitionFilters: [gid_bucket" in plan


class Asked:
    """A handle, its one value state and the clock, with what was asked of them."""

    def __init__(self):
        self.calls, self.value = [], None

    def getValueState(self, *_):
        return self

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = value

    def registerTimer(self, at):
        self.calls.append(f"timer {at}")

    def getCurrentWatermarkInMs(self):
        return 5000


def test_a_waiting_gid_asks_little_of_its_state():
    asked, gid = Asked(), Waiting(1000)
    gid.init(asked)

    def come(*sides, millis=100):
        asked.calls.clear()
        return [tuple(r) for r in gid.handleInputRows(("7",), iter([Row(wanted=w, millis=millis) for w in sides]), asked)]

    def expire():
        asked.calls.clear()
        return [tuple(r) for r in gid.handleExpiredTimer(("7",), asked, None)]

    assert come(True, True) == [] and asked.calls == ["get", "timer 1100", "update"]
    assert come(True, millis=300) == [] and asked.calls == ["get"]
    assert expire() == [("7", False)] and asked.calls == ["get", "timer 6000"]
    assert come(False) == [("7", True)] and asked.calls == ["get", "update"]
    assert come(True, False) == [] and asked.calls == ["get"]
    assert expire() == [] and asked.calls == ["get"]
