"""Arrays cut over byte ranges against json itself."""

import json
import random

import pytest
from pyspark.sql import functions as F

from gidlake.sources import arrays, readers, writers


@pytest.fixture
def ranges(spark):
    """Sets the size of byte ranges."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: (spark.conf.set("spark.sql.files.maxPartitionBytes", str(size)), spark.conf.set("spark.sql.files.openCostInBytes", "0"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.set("spark.sql.files.openCostInBytes", "4m")


def odd_objects(n, seed):
    rng = random.Random(seed)
    texts = ["", "}", "{", '"', '\\"', "\\", "a, b", "[{]}", "}}{{", 'é"}\U0001d4b3', "line\nbreak", "x" * 300, '\\\\"}']

    def value(depth):
        kind = rng.randrange(6 if depth < 4 else 3)
        if kind < 3:
            return rng.choice([rng.choice(texts), rng.random(), None, rng.randrange(100)])
        if kind == 3:
            return [value(depth + 1) for _ in range(rng.randrange(4))]
        return {rng.choice(texts) + str(i): value(depth + 1) for i in range(rng.randrange(4))}

    return [{"id": str(i), "v": value(0), "w": value(1)} for i in range(n)]


@pytest.mark.parametrize("size, indent", [(37, None), (200, 1), (5000, None), (10**8, 2)])
def test_elements_of_arrays_and_lines(spark, tmp_path, ranges, size, indent):
    wanted = {}
    for k, n in enumerate((20 if size < 100 else 300, 1, 0, 9)):
        items = odd_objects(n, k)
        wanted[f"a{k}.json"] = items
        (tmp_path / f"a{k}.json").write_text(" " * k + json.dumps(items, indent=indent, ensure_ascii=k % 2 == 0) + "\n")
    wanted["lines.json"] = odd_objects(9, 9)
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, wanted["lines.json"])))
    (tmp_path / "none.json").write_text('{"error": "none"}')
    wanted["none.json"] = [{"error": "none"}]
    ranges(size)
    if size == 37:
        assert arrays.json_pieces(spark, str(tmp_path)).rdd.getNumPartitions() > 50
    got = {}
    for r in arrays.json_elements(spark, str(tmp_path)).collect():
        got.setdefault(r.file.rsplit("/", 1)[1], {})[r.element_no] = json.loads(r.text)
    assert {f: [rows[i] for i in sorted(rows)] for f, rows in got.items()} == {f: rows for f, rows in wanted.items() if rows}
    assert all(sorted(rows) == list(range(len(rows))) for rows in got.values())


@pytest.mark.parametrize("size", [10, 10_000])
def test_entries_that_are_no_objects_and_unfinished_files(spark, tmp_path, ranges, size):
    (tmp_path / "a.json").write_text('[null, 1, {"a": 1}, "}", "{", [{"x": {}}], [], {"b": {"c": 2}}, [{"y": 0}, 2]]')
    (tmp_path / "b.json").write_text('[{"a": 1}, {"b": {"c": ')
    (tmp_path / "c.json").write_text("")
    ranges(size)
    got = [(r.file[-6:], json.loads(r.text)) for r in arrays.json_elements(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == [("a.json", {"a": 1}), ("a.json", {"b": {"c": 2}}), ("b.json", {"a": 1})]


def test_company_array_equals_lines(spark, tmp_path, ranges):
    docs = [{"company_id": str(i), "company_name": f'C "{i}" }}', "countries": ["Peru"], "total_projects": i,
             "projects": [{"gid": str(k), "name": "n" * (k % 50), "location": {"latitude": k / 2}} for k in range(i % 7)]} for i in range(400)]
    (tmp_path / "array.json").write_text(json.dumps(docs, indent=2))
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, docs)))
    ranges(3000)
    array = readers.read_company_array(spark, str(tmp_path / "array.json"))
    lines = readers.read_company_documents(spark, str(tmp_path / "lines.json"))
    assert array.columns == lines.columns and array.count() == 400
    assert array.exceptAll(lines).count() == 0


def test_feed_arrays(spark, tmp_path, ranges):
    for country, files in {"Peru": [[{"gid": 1, "project_name": "a"}, {"gid": "2"}], [{"gid": 1, "project_name": "late"}]], "New Land": [[{"gid": 3}]]}.items():
        for k, rows in enumerate(files):
            path = tmp_path / f"country={country}" / f"{k}.json"
            path.parent.mkdir(exist_ok=True)
            path.write_text(json.dumps(rows))
    (tmp_path / "country=Peru" / "2.json").write_text('"nothing"')
    ranges(20)
    countries = spark.createDataFrame([("Peru", 1), ("New Land", 0)], "country string, country_ord int")
    got = readers.read_feed_arrays(spark, str(tmp_path), countries).select("country", "country_ord", "row_ord", "gid", "project_name")
    assert sorted(map(tuple, got.collect()), key=str) == [
        ("New Land", 0, 0, "3", None), ("Peru", 1, 0, "1", "a"), ("Peru", 1, 1, "2", None), ("Peru", 1, 2, "1", "late")]
    assert got.filter(F.col("gid").isNull()).count() == 0


def test_arrays_are_written_by_every_task_that_has_documents(spark, tmp_path):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    docs = spark.range(0, 100, 1, 5).filter("id < 60 or id = 99").selectExpr("cast(id as string) company_id", "id total_projects", "'a\n\"}' company_name")
    writers.write_arrays(docs, str(tmp_path / "out"))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    held = [json.loads(p.read_text()) for p in (tmp_path / "out").glob("part-*") if p.stat().st_size]
    assert sorted(map(len, held)) == [1, 20, 20, 20] and {d["company_name"] for own in held for d in own} == {'a\n"}'}
    read = readers.read_company_array(spark, str(tmp_path / "out"))
    assert sorted(int(r.company_id) for r in read.collect()) == [*range(60), 99]
    writers.write_arrays(docs.limit(0), str(tmp_path / "none"))
    assert readers.read_company_array(spark, str(tmp_path / "none")).count() == 0
