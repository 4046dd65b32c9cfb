"""Tables that grow in place, and the look-ups and streams that use them."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gidlake.operators import assembly, companies, geo, state
from gidlake.plans import bindings as b
from gidlake.sources.keyed_store import KeyedStore
from gidlake.streaming import jobs

SF_DIR = "/root/testdata/sf0.001"


def entries(spark, keys, said):
    rows = [(f"rev:{k}", None if k % 5 == 0 else json.dumps({"n": said})) for k in keys]
    return spark.createDataFrame(rows, "cache_key string, payload string")


def files(root):
    return set(glob.glob(f"{root}/data/*/*/*.parquet"))


def rows(frame):
    return sorted(tuple(r) for r in frame.select("cache_key", F.coalesce("payload", F.lit("none"))).collect())


def test_two_upserts_keep_old_files_and_equal_the_full_rewrite(spark, tmp_path):
    store = geo.cache_store(spark, str(tmp_path / "cache"), 16)
    assert store.version() == 0 and store.read().isEmpty()
    full = entries(spark, [], "")
    kept = set()
    for keys, said in ((range(40), "one"), (range(35, 47), "two"), (range(3), "three"), ([], "none")):
        fetched = entries(spark, [*keys, *keys], said)
        geo.grow_cache(store, fetched)
        full = geo.upsert_geocode_cache(full, fetched)
        assert rows(store.read()) == rows(full)
        now = files(store.root)
        assert kept <= now
        kept = now
    assert store.version() == 4 and len(rows(store.read())) == 47
    # Only buckets of new keys got a new generation.
    new = {r.b for r in entries(spark, range(40, 47), "").select(jobs.bucket_of("cache_key", 16).alias("b")).collect()}
    before, after = store.generations(1), store.generations(2)
    assert {k for k, v in after.items() if v != before.get(k)} == new
    assert rows(store.read(version=1)) == rows(entries(spark, range(40), "one"))


def test_many_generations_become_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("gidlake.sources.keyed_store.MOST_GENERATIONS", 2)
    store = geo.cache_store(spark, str(tmp_path / "cache"), 2)
    for k in range(5):
        geo.grow_cache(store, entries(spark, range(10 * k, 10 * k + 10), str(k)))
    assert max(map(len, store.generations().values())) <= 2 and store.read().count() == 50
    before = rows(store.read())
    gone = store.remove_dead(keep_versions=1)
    assert gone and rows(store.read()) == before and {os.path.basename(os.path.dirname(f)).split("=")[1] for f in files(store.root)} <= {
        g for gs in store.generations().values() for g in gs}


def test_a_broken_commit_changes_nothing(spark, tmp_path, monkeypatch):
    store = geo.cache_store(spark, str(tmp_path / "cache"), 4)
    store.append(entries(spark, range(8), "old"))
    before = rows(store.read())
    with monkeypatch.context() as broken:
        broken.setattr(KeyedStore, "_commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.append(entries(spark, range(100, 108), "lost"))
    assert rows(store.read()) == before and store.version() == 1
    store.append(entries(spark, range(100, 102), "new"))
    assert len(rows(store.read())) == 10
    assert len(store.remove_dead()) > 0 and len(rows(store.read())) == 10


def test_merge_rewrites_touched_buckets_only(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "sums"), "k", StructType.fromDDL("k string, n long"), 8)
    add = lambda df: df.groupBy("k").agg(F.sum("n").alias("n"))
    store.merge(spark.createDataFrame([(str(i), i) for i in range(30)], "k string, n long"), add)
    before = store.generations()
    store.merge(spark.createDataFrame([("3", 10), ("new", 1)], "k string, n long"), add)
    got = {r.k: r.n for r in store.read().collect()}
    assert got == {str(i): i for i in range(30)} | {"3": 13, "new": 1}
    assert sum(v != before.get(k) for k, v in store.generations().items()) <= 2


def test_look_up_reads_its_buckets_only(spark, tmp_path):
    landing = b.landing(spark, SF_DIR)
    store = geo.cache_store(spark, str(tmp_path / "cache"), 64)
    store.append(landing.geocode_cache)
    gids = landing.feed.filter("gid % 11 = 0 and gid % 9 <> 0 and gid % 6 <> 0 and gid % 8 <> 0").select("gid").distinct().orderBy("gid").limit(2)
    projects = assembly.locate(gids, landing)
    pruned = geo.cache_for(projects, store)
    read = {f.split("key_bucket=")[1].split("/")[0] for f in pruned.inputFiles()}
    assert 0 < len(read) <= 2 < len(store.generations())
    plain = assembly.assemble(gids, landing, b.RUN_TS).projects
    by_store = assembly.assemble(gids, landing._replace(geocode_cache=store), b.RUN_TS).projects
    assert plain.exceptAll(by_store).count() == by_store.exceptAll(plain).count() == 0
    assert by_store.filter("location.geocoded").count() > 0


def deliveries(spark, n):
    """The landed inputs dealt by row over n days, repeats of a gid on several of them."""
    landing = b.landing(spark, SF_DIR)

    def day(df, k, *by):
        return df.filter(F.pmod(F.hash(*by), F.lit(n)) == k)

    return landing, [landing._replace(
        feed=day(landing.feed, k, "gid", "row_ord"), edges=day(landing.edges, k, "ord"), page_records=day(landing.page_records, k, "gid", "rec_ord"),
        url_index=day(landing.url_index, k, "url"), map_centers=day(landing.map_centers, k, "gid")) for k in range(n)]


def test_state_merged_day_by_day_equals_the_full_run(spark, tmp_path):
    landing, days = deliveries(spark, 3)
    whole = state.delivery_state(landing, F.lit(0))
    store = state.state_store(spark, str(tmp_path / "state"), whole.schema, 8)
    for k in (1, 0, 2):
        delivery = state.delivery_state(days[k], F.lit(0))
        delivery.write.parquet(f"{tmp_path}/day{k}")
        version = state.add_delivery(store, spark.read.parquet(f"{tmp_path}/day{k}"), f"day {k}")
        assert state.add_delivery(store, spark.read.parquet(f"{tmp_path}/day{k}"), f"day {k}") == version
    merged = store.read().drop("key_bucket").select(whole.columns)
    assert merged.count() == whole.count() > 0
    assert merged.exceptAll(whole).count() == 0
    gids = landing.feed.select("gid").union(landing.url_index.select("gid")).distinct()
    plain = assembly.assemble(gids, landing, b.RUN_TS)
    by_state = state.assemble_from(store, gids, landing.geocode_cache, b.RUN_TS)
    columns = plain.projects.columns
    assert by_state.projects.select(columns).exceptAll(plain.projects).count() == 0
    assert by_state.projects.count() == plain.projects.count()
    assert by_state.failures.exceptAll(plain.failures).count() == plain.failures.exceptAll(by_state.failures).count() == 0


def test_a_merge_into_the_state_shuffles_once(spark, tmp_path):
    landing, days = deliveries(spark, 2)
    one, two = (state.delivery_state(day, F.lit(k)) for k, day in enumerate(days))
    store = state.state_store(spark, str(tmp_path / "state"), one.schema, 4)
    state.add_delivery(store, one, "first")
    dealt = store._dealt(store.read().drop("key_bucket").unionByName(two))
    merged = state._merged(dealt)
    assert dealt._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(key_bucket") == 1
    assert merged._jdf.queryExecution().executedPlan().toString().count("Exchange ") == dealt._jdf.queryExecution().executedPlan().toString().count("Exchange ")
    state.add_delivery(store, two, "second")
    whole = state.delivery_state(landing, F.lit(0)).drop("first_seen")
    got = store.read().select(whole.columns)
    assert got.count() == whole.count() and got.exceptAll(whole).count() == 0


def test_edges_of_one_place_give_one_company_in_any_order(spark):
    landing, _ = deliveries(spark, 1)
    twice = landing.edges.unionByName(landing.edges.withColumns({
        "company_name": F.concat(F.lit("A "), "company_name"), "company_details": F.col("company_details").withField("name", F.lit("A"))}))
    for n in (1, 3):
        row = state.delivery_state(landing._replace(edges=twice.repartition(n)), F.lit(0)).filter("relationship_count > 0")
        assert {(r.p, r.f) for r in row.select(F.col("primary_company.name").alias("p"), F.substring("first_edge.company_name", 1, 2).alias("f")).collect()} == {("A", "A ")}


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    landing, _ = deliveries(spark, 1)
    whole = state.delivery_state(landing, F.lit(1))
    store = state.state_store(spark, str(tmp_path / "state"), whole.schema, 16)
    state.add_delivery(store, whole, "first")
    before = store.generations()
    one = landing.feed.select("gid").first().gid
    late = landing._replace(**{n: getattr(landing, n).filter(F.col("gid") == one) for n in landing._fields[:-1]})
    state.add_delivery(store, state.delivery_state(late, F.lit(2)), "second")
    assert sum(v != before[k] for k, v in store.generations().items()) == 1
    row = store.read().filter(F.col("gid") == one).first()
    edges = companies.edge_summary(landing.edges).filter(F.col("gid") == one).first()
    assert row.first_seen == 1 and (edges is None or row.relationship_count == 2 * edges.relationship_count)


def put(spark, path, *gids):
    spark.createDataFrame([(g,) for g in gids], "gid string").coalesce(1).write.mode("append").parquet(str(path))


def test_a_gid_before_its_record_is_assembled_once_across_a_restart(spark, tmp_path):
    feed = b.feed(spark, SF_DIR)
    gids = [r.gid for r in feed.select("gid").distinct().orderBy("gid").limit(3).collect()]
    wanted, known, out = (str(tmp_path / n) for n in ("wanted", "known", "out"))
    landed = tmp_path / "feed"
    unknown = b.landing(spark, SF_DIR)

    def landing():
        return unknown._replace(feed=spark.read.schema(feed.schema).parquet(str(landed)), page_records=unknown.page_records.limit(0))

    def arrive(gid):
        feed.filter(F.col("gid") == gid).write.mode("append").parquet(str(landed))
        put(spark, known, gid)

    def go():
        jobs.start_assembly(jobs.stream_gids(spark, wanted), landing, out, str(tmp_path / "state"), b.RUN_TS, 4,
                            known=jobs.stream_gids(spark, known), wait_seconds=0.2).awaitTermination()
        return sorted(r.gid for r in spark.read.parquet(f"{out}/projects").collect())

    arrive(gids[0])
    put(spark, wanted, *gids, "nobody")
    assert go() == [gids[0]]
    arrive(gids[1])
    put(spark, wanted, gids[0], gids[1])
    assert go() == gids[:2]
    arrive(gids[2])
    arrive(gids[1])
    assert go() == gids
    overdue = {r.gid for r in spark.read.parquet(f"{out}/overdue").collect()}
    assert "nobody" in overdue and gids[0] not in overdue
    assert spark.read.parquet(f"{out}/failures").count() == 0


def test_dedup_state_shrinks_behind_the_watermark(spark, tmp_path):
    source, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    held = []
    for day in range(1, 7):
        moments = [(str(100 * day + k % 30), f"2024-01-{day:02d} {k % 20:02d}:00:00") for k in range(60)]
        moments += [("always", f"2024-01-{day:02d} 12:00:00")]
        spark.createDataFrame(moments, "gid string, ts string").select("gid", F.col("ts").cast("timestamp_ntz").alias("ts")).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema("gid string, ts timestamp_ntz").parquet(str(source))
        query = (jobs.dedup_within(stream, "ts", "1 day").writeStream.format("parquet").option("path", str(out))
                 .option("checkpointLocation", str(state)).trigger(availableNow=True).start())
        query.awaitTermination()
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = [r.gid for r in spark.read.parquet(str(out)).collect()]
    assert {g for g in got if g != "always"} == {str(100 * d + k) for d in range(1, 7) for k in range(30)}
    assert max(held) <= 31 * 3 and held[-1] <= held[2] and len(got) < 6 * 31 + 6
    assert 1 <= got.count("always") <= 6
