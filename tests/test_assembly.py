"""Hand-made landed inputs, one case per gid."""

import json

import pytest
from pyspark.sql import functions as F

from gidlake.operators import assembly, companies, discovery, geo, marts
from gidlake.operators.assembly import Landing
from gidlake.sources import readers

RUN_TS = "2025-02-01 10:00:00"


def feed_row(gid, ord_=0, country="Peru", **fields):
    base = dict(country=country, country_ord=ord_, row_ord=0, gid=gid, project_name=f"P{gid}", location=None, centroid=None,
                mineral_district_camp=None, mineral_district=None, area_m2=None, stage=None, commodities=None, operator=None)
    base.update(fields)
    return tuple(base.values())


FEED = ("country string, country_ord int, row_ord bigint, gid string, project_name string, location string, "
        "centroid struct<coordinates: array<double>>, mineral_district_camp string, mineral_district string, "
        "area_m2 string, stage string, commodities string, operator string")
RECORD = ("gid string, rec_ord int, project_name string, company_id string, company_name string, operator string, "
          "stage string, commodities string")


@pytest.fixture(scope="module")
def landing(spark):
    feed = spark.createDataFrame([
        feed_row("1", 0, location="Lima, Peru", operator="First"),
        feed_row("1", 1, country="Chile", location="Norte, Chile", operator="", centroid=([10.0, 20.0],),
                 mineral_district_camp="", mineral_district="D"),
        feed_row("2", operator="Solo"), feed_row("3", location="Nowhere"), feed_row("4", centroid=([5.0],)),
        feed_row("5", centroid=([1.0, 2.0],)), feed_row("6", centroid=([3.0, 4.0],)), feed_row("", operator="blank")], FEED)
    bodies = {
        "1": {"jv": [{"id": 1, "company_name": "A", "percentage": 40}, {"id": 2, "company_name": "B", "percentage": 50},
                     {"id": 3, "company_name": "C", "percentage": 50}]},
        "5": {"nsrs": [{"id": 7, "company_name": "N", "percentage": 90}], "option": [[{"id": 8, "company_name": "O"}]]},
        "8": {"option": [[{"id": 5, "company_name": ""}]], "nsrs": [],
              "jv": [{"id": 6, "company_name": "Low", "percentage": 1}, {"id": 9, "company_name": "High", "percentage": 99}]},
        "6": {"jv": [{"id": 11, "company_name": "Null share"}, {"id": 12, "company_name": "Zero", "percentage": 0}]}}
    edges = readers.relationship_edges(spark.createDataFrame(
        [(g, json.dumps(b)) for g, b in bodies.items()], "gid string, body string"))
    records = spark.createDataFrame([
        ("8", 0, "Scraped", None, None, "Op8", "Drill", "Cu"), ("9", 1, "late", "1", "x", None, None, None),
        ("9", 0, None, "", "Nine Co", None, None, None), ("4", 0, "n", None, None, None, None, None),
        ("3", 0, "n", "33", None, None, None, None)], RECORD)
    urls = readers.url_index(spark.createDataFrame([("1", "u1", 0), ("9", "u9", 0), ("77", "u77", 0)],
                                                   "ID string, URL string, row_ord bigint"))
    centers = spark.createDataFrame([("2", -1.5, 2.5), ("1", 0.0, 0.0), ("9", 8.0, 9.0)],
                                    "gid string, latitude double, longitude double")
    cache = spark.createDataFrame([
        ("rev:2.00000000,1.00000000", json.dumps({"address": {"province": "Pro", "country": "Land", "postcode": "77",
                                                              "ISO3166-2-lvl6": "L-6"}})),
        ("rev:4.00000000,3.00000000", None), ("rev:-1.50000000,2.50000000", json.dumps({"error": "no address"})),
        ("fwd:nowhere", json.dumps({"lat": "6.5", "lon": "", "address": {"state": "Some"}})),
        ("rev:8.00000000,9.00000000", json.dumps({"address": {"state": "S9"}}))], "cache_key string, payload string")
    return Landing(feed, edges, records, urls, centers, cache)


@pytest.fixture(scope="module")
def done(landing):
    gids = discovery.discover_gids(landing.feed, landing.url_index).union(
        landing.feed.sparkSession.createDataFrame([("8",)], "gid string"))
    return assembly.assemble(gids, landing, RUN_TS)


@pytest.fixture(scope="module")
def rows(done):
    return {r.gid: r for r in done.projects.collect()}


def test_one_row_per_known_gid_and_the_rest_failed(done, rows):
    assert sorted(rows) == ["1", "2", "3", "4", "5", "6", "8", "9"]
    assert [r.gid for r in done.failures.collect()] == ["77"]


def test_last_loaded_feed_row_wins(rows):
    assert (rows["1"].location.country, rows["1"].location.state) == ("Chile", "Norte")
    assert rows["1"].location.mineral_district == "D"
    assert rows["1"].project_url == "u1"


def test_primary_is_the_largest_jv_and_the_earliest_of_ties(rows):
    assert rows["1"].primary_company.name == "B"
    assert rows["1"].operator == "B"
    assert rows["6"].primary_company.name == "Null share"


def test_first_edge_without_jv_and_for_scraped_projects(rows):
    assert rows["5"].primary_company.name == "N"
    assert rows["8"].primary_company.name == "Low" and rows["8"].name == "Scraped"
    assert rows["8"].data_sources == ["relationships", "scraper"]


def test_company_tiers(rows):
    assert {g: r.company_tier for g, r in rows.items()} == {
        "1": 1, "2": 3, "3": 2, "4": 0, "5": 1, "6": 1, "8": 1, "9": 2}
    assert rows["2"].primary_company.relationship_type == "operator" and rows["2"].data_sources == ["api"]
    assert rows["3"].primary_company.id == "33" and rows["3"].primary_company.name == "Unknown Company"
    assert rows["3"].data_sources == ["api", "scraper"] and rows["3"].operator == "Unknown Company"
    assert rows["4"].primary_company is None
    assert rows["9"].primary_company.id.startswith("operator_") and rows["9"].operator == "Nine Co"


def test_map_centres_fill_both_coordinates_only_when_one_is_missing(rows):
    assert (rows["1"].location.latitude, rows["1"].location.longitude) == (20.0, 10.0)
    assert (rows["2"].location.latitude, rows["2"].location.location_source) == (-1.5, "api")
    assert (rows["4"].location.latitude, rows["4"].location.longitude) == (None, 5.0)
    assert rows["9"].location.location_source == "scraper_map"


def test_reverse_and_forward_lookup(rows):
    five = rows["5"].location
    assert (five.state, five.country, five.postcode, five.iso3166_2, five.geocoded) == ("Pro", "Land", "77", "L-6", True)
    assert rows["6"].location.geocoded is None and rows["2"].location.geocoded is None
    three = rows["3"].location
    assert (three.latitude, three.longitude, three.state, three.geocoded) == (6.5, None, "Some", True)
    assert three.country == "Nowhere"
    assert rows["9"].location.state == "S9"


def test_hot_keys_change_nothing(landing, done, rows):
    gids = done.projects.select("gid")
    hot = landing.geocode_cache.select("cache_key")
    again = {r.gid: r for r in assembly.assemble(gids, landing, RUN_TS, hot).projects.collect()}
    assert again == rows


def test_flat_edges(done, landing):
    got = assembly.project_edges(done.projects, landing.edges).collect()
    shares = {(r.gid, r.relationship_type): r.percentage for r in got if r.gid in "239"}
    assert shares == {("2", "operator"): 100.0, ("3", "operator"): None, ("9", "operator"): None}
    assert len(got) == 3 + 2 + 2 + 3 + 3
    assert {r.project_name for r in got if r.gid == "1"} == {"P1"}


def test_resolved_edges_agree_with_projects(landing, done):
    resolved = companies.resolve_companies(done.projects.select("gid"), landing.edges,
                                           assembly.first_record(landing.page_records), assembly.latest_feed(landing.feed))
    assert resolved.count() == assembly.project_edges(done.projects, landing.edges).count()


def test_marts_keep_their_sums(done):
    prefix = "https://h.example/company-profile?gid="
    mart = marts.companies_mart(done.projects, prefix).collect()
    assert sum(r.project_count for r in mart) == 7
    assert marts.companies_mart(done.projects.limit(0), prefix).count() == 0
    summary = {r.metric: r.value for r in marts.processing_summary(done.projects).collect()}
    assert summary["Total Projects"] == "8" and summary["Company Resolution Rate"] == "87.5%"
    counters = marts.run_counters(done.projects, done.failures).first()
    assert (counters.total_projects, counters.completed_projects, counters.failed_projects) == (9, 8, 1)


def test_empty_company_id_kept_in_the_mart_only(spark):
    frame = spark.createDataFrame([("1", ("",)), ("2", ("x",)), ("3", None)], "gid string, primary_company struct<id: string>")
    assert marts.with_company(frame, drop_blank_id=False).count() == 2
    assert marts.with_company(frame, drop_blank_id=True).count() == 1


def test_work_list_and_cache_upsert(spark, landing):
    flat = assembly.safe_project(assembly.latest_feed(landing.feed))
    need = [r.cache_key for r in geo.geocode_work_list(flat, landing.geocode_cache).collect()]
    assert need == []
    fetched = spark.createDataFrame([("fwd:nowhere", "new"), ("a", None), ("b", "x"), ("b", "x")],
                                    "cache_key string, payload string")
    merged = {r.cache_key: r.payload for r in geo.upsert_geocode_cache(landing.geocode_cache, fetched).collect()}
    assert merged["a"] is None and merged["b"] == "x" and '"lat"' in merged["fwd:nowhere"]
    assert len(merged) == 7


@pytest.mark.parametrize("limit, expected", [(2, ["1", "2"]), (100, None), (None, None)])
def test_limit_keeps_feed_gids_only(landing, limit, expected):
    every = discovery.discover_gids(landing.feed, landing.url_index)
    got = sorted(r.gid for r in discovery.limit_gids(landing.feed, every, limit).collect())
    assert got == (expected or ["1", "2", "3", "4", "5", "6", "77", "9"])


def test_country_scope(spark):
    frame = spark.createDataFrame([("Australia",), ("Peru",)], "country string")
    def scope(*a):
        return sorted(r.country for r in discovery.country_scope(frame, *a).collect())

    assert scope("test") == ["Australia"] and scope("production") == ["Australia", "Peru"]
    assert scope("production", ["Peru"]) == ["Peru"]


def test_filter_ranges(spark):
    frame = spark.createDataFrame([("a", "Peru", 0.0, 10000.0, 5, "Cu, Au"), ("b", "Peru", None, 1.0, 5, "Cu"),
                                   ("c", "Peru", 1.0, 10001.0, 5, "Au"), ("d", "Chile", 1.0, 1.0, 5, "Au")],
                                  "gid string, country string, marketcap double, outstandingshares double, "
                                  "project_size int, commodities string")
    def kept(**k):
        return [r.gid for r in discovery.filter_projects(frame, **k).collect()]

    assert kept(country="Peru") == ["a"]
    assert kept(commodities=["Au"]) == ["a", "d"]
    assert kept(project_size=(6, None)) == [] and kept(project_size=(None, 5)) == ["a", "d"]


def test_success_rate_and_duration(one):
    assert one(marts.success_rate(F.col("c"), F.col("t")), c=0, t=0) == 0.0
    assert one(marts.success_rate(F.col("c"), F.col("t")), c=1, t=4) == 25.0
    start, end = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"), F.lit("2025-01-01 00:00:02.936686").cast("timestamp_ntz")
    assert one(marts.duration_seconds(start, end)) == pytest.approx(2.936686)
    assert one(marts.duration_seconds(start, F.lit(None).cast("timestamp_ntz"))) is None


def test_fetched_pages_become_projects(spark, landing):
    """Pages to records to projects: the fallback for gids that the feed lacks."""
    from gidlake.operators import html

    owner = "<a href='/company-profile?gid=61'>Gold Fields Ltd</a>"
    facts = (("Operator", "Gold Fields Ltd"), ("Main <b>Commodities</b>", "Au, Cu"), ("Stage", "Drill"), ("Ownership", owner))
    table = "".join(f"<tr><td>{k}</td><td>{v}</td></tr>" for k, v in facts)
    markup = f"<h1>Big <i>Hill</i><br>North</h1><h3 id=company-name>Gold <b>Fields</b> Ltd</h3><table class=properties-wrapper-table>{table}</table>"
    pages = spark.createDataFrame([("901", markup), ("902", "<p>empty</p>"), ("2", markup)], "gid string, html string")
    records = html.page_records(html.parsed_pages(pages), "https://portal.example/company-profile?gid=")
    gids = spark.createDataFrame([("901",), ("902",), ("2",), ("903",)], "gid string")
    done = assembly.assemble(gids, landing._replace(page_records=records), RUN_TS)
    got = {r.gid: r for r in done.projects.collect()}
    assert set(got) == {"901", "902", "2"} and [r.gid for r in done.failures.collect()] == ["903"]
    project = got["901"]
    assert (project.name, project.operator, project.stage, project.commodities) == ("Big Hill North", "Gold Fields Ltd", "Drill", "Au, Cu")
    assert (project.primary_company.id, project.primary_company.name) == ("61", "Gold Fields Ltd")
    assert "scraper" in project.data_sources and got["2"].name == "P2"
