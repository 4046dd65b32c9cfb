import pytest
from pyspark.sql import functions as F

from gidlake.functions import text, values


@pytest.mark.parametrize("raw, country, state", [
    ("New South Wales, Australia", "Australia", "New South Wales"), ("Australia", "Australia", None),
    ("A, B, C", "C", "A"), ("", None, None), (None, None, None), ("A,B", "A,B", None)])
def test_split_location(one, raw, country, state):
    assert one(text.location_country(F.col("x")), x=raw) == country
    assert one(text.location_state(F.col("x")), x=raw) == state


def test_truthy_coalesce_keeps_last_value(one):
    assert one(text.coalesce_truthy(F.col("a"), F.col("b")), a="", b="x") == "x"
    assert one(text.coalesce_truthy(F.col("a"), F.col("b")), a=None, b="") == ""
    assert one(text.coalesce_truthy(F.col("a"), F.col("b")), a="y", b="x") == "y"


def test_normalize_text_takes_unicode_spaces(one):
    assert one(text.normalize_text(F.col("x")), x="  Gold  \tMINE\n") == "gold mine"


def test_proper_case_and_slug(one):
    assert one(text.proper_case(F.col("x")), x=" red  RING ltd") == "Red Ring Ltd"
    assert one(text.slug(F.col("x")), x="A & B (Co.) 'x'/\"y\", z") == "a-and-b-co-x-y-z"


@pytest.mark.parametrize("href, url", [
    ("/a", "https://h.example/a"), ("b?c=1", "https://h.example/x/b?c=1"), ("//o.example/z", "https://o.example/z"),
    ("https://q.example", "https://q.example"), ("", "https://h.example/x/y?p=1"), ("../../../a", "https://h.example/a"),
    ("./k/../m", "https://h.example/x/m"), ("?z=2", "https://h.example/x/y?z=2"),
    ("#top", "https://h.example/x/y?p=1#top"), ("mailto:a@b", "mailto:a@b"), (None, None)])
def test_absolute_url(one, href, url):
    assert one(text.absolute_url(F.lit("https://h.example/x/y?p=1"), F.col("h")), h=href) == url


def test_gid_in_links(one):
    assert one(text.gid_from_link(F.col("x")), x="/p?gid=12&y=1") == "12"
    assert one(text.gid_from_link(F.col("x")), x="gid=12") is None
    assert one(text.gid_anywhere(F.col("x")), x="go('gid=7')") == "7"
    assert one(text.gid_after(F.col("x"), "company-profile"), x="/company-profile?gid=A-1&z=2") == "A-1"


@pytest.mark.parametrize("part, whole, shown", [(1, 16, "6.3%"), (0, 5, "0.0%"), (5, 5, "100.0%"), (2, 3, "66.7%"),
                                                (0, 0, "0.0%")])
def test_pct_string(one, part, whole, shown):
    assert one(values.pct_string(F.col("p"), F.col("w")), p=part, w=whole) == shown


def test_numbers_and_keys(one):
    assert one(values.to_double(F.col("x")), x="") is None
    assert one(values.to_double(F.col("x")), x=" 1.5 ") == 1.5
    assert one(values.to_double(F.col("x")), x="n/a") is None
    assert one(values.reverse_key(F.col("a"), F.col("b")), a=-30.5, b=146.067993095) == "rev:-30.50000000,146.06799310"
    assert one(values.forward_key(F.col("x")), x="  New  South\tWales ") == "fwd:new south wales"


def test_strict_enum_stops(spark):
    good = spark.createDataFrame([("jv",), (None,)], "k string")
    assert [r[0] for r in good.select(values.validate_enum(F.col("k"), ["jv"], "kind")).collect()] == ["jv", None]
    bad = spark.createDataFrame([("lease",)], "k string").select(values.validate_enum(F.col("k"), ["jv"], "kind"))
    with pytest.raises(Exception, match="unknown kind: lease"):
        bad.collect()


def test_map_default_only_for_absent_keys(one):
    present = F.create_map(F.lit("k"), F.lit(None).cast("string"))
    assert one(values.map_get(present, "k", F.lit("d"))) is None
    assert one(values.map_get(present, "z", F.lit("d"))) == "d"


def test_iso_round_trip(one):
    moment = values.iso_parse(F.col("x"))
    assert one(values.iso_format(moment), x="2025-09-24T18:10:49.874076") == "2025-09-24T18:10:49.874076"


def test_add_source_and_error(one):
    assert one(values.add_source(F.lit(None), "api")) == ["api"]
    assert one(values.add_error(F.array(F.lit("a")), F.lit("b"))) == ["a", "b"]


def test_address_state_order(one):
    address = F.from_json(F.col("x"), "state string, state_district string, region string, province string, "
                                      "territory string, `ISO3166-2-lvl4` string, `ISO3166-2-lvl6` string")
    assert one(values.address_state(address), x='{"state":"","province":"P","territory":"T"}') == "P"
    assert one(values.address_iso(address), x='{"ISO3166-2-lvl6":"XX-6"}') == "XX-6"
