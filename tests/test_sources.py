import json

import pytest

from pyspark.sql import functions as F

from gidlake.plans.bindings import RUN_TS
from gidlake.sources import readers, writers


def lines(path, *records):
    path.write_text("\n".join(json.dumps(r) for r in records))
    return str(path)


def test_countries_fallbacks(spark, tmp_path):
    good = tmp_path / "c.json"
    good.write_text('{"country": ["Peru", "Chile"]}')
    assert [tuple(r) for r in readers.read_countries(spark, str(good)).collect()] == [("Peru", 0), ("Chile", 1)]
    missing = readers.read_countries(spark, str(tmp_path / "none.json"))
    assert missing.count() == 4
    broken = tmp_path / "b.json"
    broken.write_text('{"country": [')
    assert [r.country for r in readers.read_countries(spark, str(broken)).collect()] == ["Australia", "Canada"]


def test_feed_bodies(spark, tmp_path):
    rows = [{"gid": 5, "project_name": "A", "centroid": {"coordinates": [1.5]}}, {"gid": "x6"}, {"gid": ""}]
    path = lines(tmp_path / "f.json",
                 {"country": "Peru", "country_ord": 0, "body": json.dumps(rows)},
                 {"country": "Chile", "country_ord": 1, "body": '{"message": "no list"}'},
                 {"country": "Cuba", "country_ord": 2, "body": "broken"}, {"country": "Fiji", "country_ord": 3})
    got = readers.read_project_feed(spark, path).collect()
    assert [(r.country, r.row_ord, r.gid) for r in got] == [("Peru", 0, "5"), ("Peru", 1, "x6"), ("Peru", 2, "")]
    assert got[0].centroid.coordinates == [1.5]


def edges_of(spark, *bodies):
    frame = spark.createDataFrame([(str(i), b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)],
                                  "gid string, body string")
    return readers.relationship_edges(frame).orderBy(F.col("gid").cast("int"), "ord").collect()


def test_edges_keep_body_order_and_fields(spark):
    body = {
        "option": [[{"id": 9, "company_name": "O1", "optionee": 9, "projectcompanyoptions": 4, "comments": "c",
                     "percentage": 12}], "stray", None, [{"id": "10", "company_name": "O2"}]],
        "nsrs": [{"id": 3, "company_name": "N", "percentage": "2.5", "projectCompanyNsr": 8}],
        "jv": [{"id": 1, "company_name": "J", "percentage": 60, "projectCompanyOwnership": 7, "root_ticker": "TT"},
               {"company_name": "K", "percentage": None}]}
    got = edges_of(spark, body)
    assert [(r.relationship_type, r.company_id, r.company_name) for r in got] == [
        ("jv", "1", "J"), ("jv", "", "K"), ("nsr", "3", "N"), ("option", "9", "O1"), ("option", "10", "O2")]
    assert [r.ord for r in got] == [0, 1, 2, 3, 4]
    assert [r.percentage for r in got] == [60.0, None, 2.5, None, None]
    assert [r.ownership_id for r in got] == [7, None, 8, 4, None]
    assert [r.optionee_id for r in got] == [None, None, None, 9, None]
    assert got[3].comments == "c" and got[0].company_details.ticker == "TT"


def test_null_lists_and_bad_bodies_give_no_edges(spark):
    got = edges_of(spark, {"jv": None, "nsrs": [{"id": 1}]}, {}, "", "broken", "[]", {"option": None})
    assert [(r.gid, r.relationship_type) for r in got] == [("0", "nsr")]


def test_unusable_bodies_count_as_absent(spark):
    frame = spark.createDataFrame([("1", "{}"), ("2", "x"), ("3", '{"jv":[]}'), ("4", None)], "gid string, body string")
    assert [r.gid for r in readers.usable_bodies(frame).collect()] == ["3"]


def test_url_index_ids(spark):
    frame = spark.createDataFrame([("9799.0", "a", 0), (None, "b", 1), ("12", "c", 2), (" K-1 ", "d", 3)], "ID string, URL string, row_ord int")
    assert {(r.gid, r.url) for r in readers.url_index(frame).collect()} == {("9799", "a"), ("12", "c"), ("K-1", "d")}


def test_url_map_takes_the_last_row(spark):
    frame = spark.createDataFrame([("1", "a", 0), ("1", "b", 2), ("1", "c", 1)], "gid string, url string, row_ord bigint")
    assert [tuple(r) for r in readers.url_map(frame).collect()] == [("1", "b")]


def test_later_files_and_rows_win(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ID,URL\n1,old\n2,first\n2,second\n")
    (tmp_path / "b.csv").write_text("ID,URL\n1,new\n" + "".join(f"{i},x\n" for i in range(10, 5000)))
    got = {r.gid: r.project_url for r in readers.url_map(readers.read_url_index(spark, str(tmp_path))).collect()}
    assert (got["1"], got["2"], len(got)) == ("new", "second", 4992)


def test_geocode_cache_layouts(spark, tmp_path):
    path = tmp_path / "cache.json"
    path.write_text('{"rev:1,2": {"lat": "1"}, "fwd:x": null}')
    got = {r.cache_key: (r.payload, r.is_negative) for r in
           readers.read_geocode_cache(spark, str(path), layout="json_map").collect()}
    assert got == {"rev:1,2": ('{"lat":"1"}', False), "fwd:x": (None, True)}
    assert readers.read_geocode_cache(spark, str(tmp_path / "no"), layout="json_map").count() == 0
    path.write_text(json.dumps({"rev:1,2": {"lat": "1"}, "fwd:x": None}, indent=2))
    assert {r.cache_key: r.is_negative for r in readers.read_geocode_cache(spark, str(path), layout="json_map").collect()} == {"rev:1,2": False, "fwd:x": True}
    path.write_text('{"a": null}\n{"b": {"lat": "2"}}\n')
    assert sorted(r.cache_key for r in readers.read_geocode_cache(spark, str(path), layout="json_map").collect()) == ["a", "b"]
    path.write_text("{broken")
    with pytest.raises(Exception, match="no JSON object"):
        readers.read_geocode_cache(spark, str(path), layout="json_map").collect()
    path.write_text('{"cache_key": "a", "payload": null}\n{"cache_key": "b", "payload": "{}"}\n')
    assert readers.read_geocode_cache(spark, str(path), layout="json_lines").filter("is_negative").first().cache_key == "a"


@pytest.mark.parametrize("field, value", [("processing_stage", "bogus"), ("data_sources", ["api", "bogus"]), ("primary_company", {"id": "1", "data_source": "bogus"}),
                                          ("company_relationships", [{"relationship_type": "bogus"}]), ("company_relationships", [{"data_source": "bogus"}]),
                                          ("stakeholders", [{"relationship_type": "bogus"}])])
def test_unknown_enum_values_stop_the_job(spark, tmp_path, field, value):
    known = {"gid": "1", "processing_stage": "completed", "data_sources": ["api"], "company_relationships": None}
    assert readers.read_projects(spark, lines(tmp_path / "good.json", known)).count() == 1
    with pytest.raises(Exception, match="unknown .*: bogus"):
        readers.read_projects(spark, lines(tmp_path / "bad.json", dict(known, **{field: value}))).select("gid").collect()


def test_company_links_id_kinds(spark, tmp_path):
    link = {"id": 1, "company_id": 2, "file_title": "t", "file_name": None, "file_data": "d", "date_created": "2025"}
    path = lines(tmp_path / "l.json", {"company_id": 37, "companyName": "A", "links": [link, link]},
                 {"company_id": "38", "companyName": None, "links": []}, {"company_id": None, "extra": 1})
    got = readers.read_company_links(spark, path).collect()
    assert sorted((r.company_id or "-", r.link_id or 0) for r in got) == [("-", 0), ("37", 1), ("37", 1), ("38", 0)]


def test_company_array_file(spark, tmp_path):
    company = {"id": "7", "name": "Ore Co", "data_source": "relationships", "fetched_at": "2031-02-03T04:05:06.789012"}
    edge = {"company_id": "7", "company_name": "Ore Co", "relationship_type": "jv", "percentage": 100, "ownership_id": 3,
            "company_details": company, "data_source": "relationships"}
    project = {"gid": "1", "name": "P", "location": {"country": "Peru", "area_m2": "120345.678901234000"},
               "company_relationships": [edge, dict(edge, relationship_type="option", percentage=None)],
               "primary_company": company, "data_sources": ["api", "relationships"], "processing_stage": "completed",
               "created_at": "2031-02-03T04:05:06.789012", "errors": []}
    path = tmp_path / "out.json"
    path.write_text(json.dumps([{"company_id": "7", "company_name": "Ore Co", "countries": ["Peru"], "total_projects": 1,
                                 "projects": [project], "additional_company_data": {"company_info": company}}], indent=1))
    row = readers.read_company_array(spark, str(path)).first()
    assert row.projects[0].location.area_m2 == "120345.678901234000"
    assert [e.percentage for e in row.projects[0].company_relationships] == [100.0, None]
    assert row.projects[0].created_at.isoformat() == "2031-02-03T04:05:06.789012"
    assert row.additional_company_data.company_info.name == "Ore Co"


def test_run_names():
    assert writers.run_id(RUN_TS) == "20250131_120000"
    assert writers.stamped("/o/", " p__", "2025-01-31T12:00:00.5") == "/o/p_20250131_120000"
    assert writers.export_all(None, None, "/o", RUN_TS, "x") == {}
