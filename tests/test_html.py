import time

import pytest
from pyspark.sql import functions as F

from gidlake.functions import html as html_functions
from gidlake.functions.html import PARTS, _read
from gidlake.operators import html

BASE = "https://h.example"


@pytest.fixture(scope="module")
def page(spark):
    """First row of expressions over one parsed page."""

    def read(markup, **columns):
        frame = spark.createDataFrame([("42", markup)], "gid string, html string")
        row = html.parsed_pages(frame).select(*[c(F.col("page")).alias(n) for n, c in columns.items()]).first()
        return row if len(columns) > 1 else row[0]

    return read


@pytest.mark.parametrize("markup, title", [
    ("<h1>Any</h1><h1 id='project_title'> Under </h1><h1 id=project-title>Dash</h1>", "Dash"),
    ("<h1>Any</h1><h1 id='project_title'>Under</h1>", "Under"), ("<h1> </h1><h1>Sec<b>ond</b></h1>", "Second"),
    ("<h2>x</h2>", None), ("", None), ("<h1 id=project-title>A &amp; B", "A & B")])
def test_title(page, markup, title):
    assert page(markup, t=html.page_title) == title


def test_scripts_and_comments_hold_no_links(spark):
    frame = spark.createDataFrame([("1", "<!-- <a href='/c'>c</a> --><script>'<a href=\"/s\">'</script><a href=/ok>k</a>"
                                         "<a data-url='/d?gid=5'>d</a><a onclick=\"go('gid=9')\">o</a>")],
                                  "gid string, html string")
    got = html.page_links(html.parsed_pages(frame), "gid", F.lit(BASE)).orderBy("pos").collect()
    assert [(r.url, r.pos) for r in got] == [(BASE + "/ok", 0), (BASE + "/d?gid=5", 1), (None, 2)]


@pytest.mark.parametrize("markup, url, company", [
    ("<a href='/company-profile?gid=1'></a><div id=right-sider><a id=company-news-btn href=' /company-profile?gid=7&x=1 '>",
     BASE + "/company-profile?gid=7&x=1", "7"),
    ("<a id=company-news-btn href='/elsewhere'></a><div id=modal_nav_buttons><a id=company_profile data-url='' href='/c'>",
     BASE + "/c", None),
    ("<a data-url='/d'></a><a href='https://o.example/company-profile?gid=9'>", "https://o.example/company-profile?gid=9", "9"),
    ("<a href='/p'></a><a data-url='/d'>", BASE + "/d", None), ("<a href='/p'>p</a>", None, None)])
def test_company_link_priority(page, markup, url, company):
    link = page(markup, l=lambda p: html.company_link(p, BASE))
    assert (link.company_url, link.company_id, link.found) == (url, company, url is not None)


@pytest.mark.parametrize("markup, company", [
    ("<a id=company-news-btn href='/project-profile?gid=1'></a><a id=project-news-btn href='/company-profile?gid=2'>", "2"),
    ("<iframe id=project-map src='/map?gid=1&companyId=3'></iframe><a href='/company-profile?gid=4'>", "3"),
    ("<a href='/company-profile?gid=x'></a><a href='/company-profile?gid=4'>", "4"), ("<a href='/none'>", None)])
def test_fast_company_id(page, markup, company):
    assert page(markup, c=html.fast_company_id) == company


def test_heading_scope(page):
    got = page("<h3 id=company-name>A</h3><div id=right-sider><h3 id='company-name'>B <i>c</i></h3></div>",
               any=html.company_heading, inner=lambda p: html.company_heading(p, "#right-sider"))
    assert (got["any"], got.inner) == ("A", "Bc")


def test_column_claims(page):
    head = "".join(f"<th>{t}</th>" for t in ("Stage of project", "Project", "Operator project", "Commodities", "Stage"))
    table = f"<table class=properties-wrapper-table><tr>{head}</tr></table>"

    def labels(p):
        return html.header_labels(F.get(html.property_tables(p), F.lit(0)))

    got = page(table, i=lambda p: html.column_index(labels(p)), wide=lambda p: html.is_header_table(labels(p)))
    assert got.wide
    assert (got.i.project_name, got.i.stage, got.i.operator, got.i.commodities) == (0, 4, 2, 3)


def test_unclosed_cells_and_nested_tables(spark):
    markup = "<table><tr><td>a<td>b<tr><th>c<table><tr><td>inner</table>d</table><p>after"
    frame = spark.createDataFrame([("1", markup)], "gid string, html string")
    got = {(r.table_no, r.row_no, r.col_no): r.text for r in html.html_cells(html.parsed_pages(frame), "gid").collect()}
    assert got == {(0, 0, 0): "a", (0, 0, 1): "b", (0, 1, 0): "cinnerd", (1, 0, 0): "inner"}


def record_of(spark, markup):
    frame = spark.createDataFrame([("42", markup)], "gid string, html string")
    return html.page_records(html.parsed_pages(frame), BASE + "/company-profile?gid=").first()


def rows(*cells):
    return "".join("<tr>" + "".join(f"<td>{c}</td>" for c in row) + "</tr>" for row in cells)


def table(*cells):
    return f"<table class='properties-wrapper-table'>{rows(*cells)}</table>"


def test_record_of_key_values_then_projects_table(spark):
    links = "<a onclick=\"open('gid=5')\">Alpha</a><a href='/company-profile?gid=6'>Big Op Ltd</a><a href='?gid=7'> </a>"
    markup = ("<h1>Gold Hill</h1>" + table(("Operator", "big op"), ("Commodities", "-"), ("Ownership", links), ("Ticker", "T:1"))
              + table(("Project", "Commodities", "Stage"), ("other", "Cu", "Old"), ("gold  HILL", "Au", "New")))
    got = record_of(spark, markup)
    assert (got.project_name, got.operator, got.commodities, got.stage) == ("Gold Hill", "big op", "Au", "New")
    assert (got.company_id, got.company_name, got.ticker_exchange) == ("6", "Big Op", "T:1")
    assert got.company_url == BASE + "/company-profile?gid=6" and not got.company_profile_link_found


def test_row_linking_to_the_gid_beats_the_name(spark):
    markup = "<h1>Gold</h1>" + table(("Project", "Commodities", "Stage"), ("Gold", "Cu", "by name"),
                                     ("x<a href='/project-profile?gid=420'>n</a>", "Zn", "longer id"),
                                     ("y<a href='/project-profile?gid=42&a=1'>n</a>", "Au", "by gid"))
    assert record_of(spark, markup).stage == "by gid"


def test_text_lines_fill_what_is_missing(spark):
    markup = ("<h1>G</h1>" + table(("Stage", "Drill")) + "<div class='x main-profile-container'><p>Operator:</p><p>Op Co</p>"
              "<span>Stage:</span><br>late<div>Commodities:</div></div><div>Project:</div><div>outside</div>")
    got = record_of(spark, markup)
    assert (got.stage, got.operator, got.commodities, got.company_name) == ("Drill", "Op Co", None, "Op Co")


def test_company_name_stands_in_for_operator(spark):
    got = record_of(spark, "<h3 id=company-name>gold CORP</h3>")
    assert (got.company_name, got.operator, got.project_name) == ("Gold Corp", "Gold Corp", None)


def test_div_block_counts_when_no_table_has_the_class(spark):
    markup = "<div class='properties-wrapper-table'><table>" + rows(("Stage", "Old")) + "</table></div><table>" + \
        rows(("Stage", "No")) + "</table>"
    assert record_of(spark, markup).stage == "Old"


COMPANY_HEAD = "<tr><th>Project</th><th>T</th><th>Commodities</th><th>Stage</th><th></th></tr>"


@pytest.mark.parametrize("body, expected", [
    (rows(("Gold", "", "a", "b", ""), ("GOLD ", "", "c", "", "<a href='/l'>l</a>")), ("c", None, "/l", "name")),
    (rows(("Gold", "", "a", "b", ""), ("z", "", "g", "h", "<a href='/project-profile?gid=42&x'>l</a>"),
          ("Gold", "", "e", "f", "")), ("g", "h", "/project-profile?gid=42&x", "gid")),
    (rows(("Gold", "", "a")), (None, None, None, None)), (rows(("other", "", "a", "b", "")), (None, None, None, None))])
def test_company_projects_table(page, body, expected):
    markup = table(("Project", "x")) + f"<table class=properties-wrapper-table>{COMPANY_HEAD}{body}</table>"
    got = page(markup, m=lambda p: html.company_projects_match(p, F.col("gid"), F.lit("gold")))
    assert tuple(got) == expected


def test_fragments_drop_copies(spark):
    frame = spark.createDataFrame([("1", table(("a", "b")) * 2 + table(("c", "d")))], "gid string, html string")
    got = [r.table_html for r in html.table_fragments(html.parsed_pages(frame, "tables", keep_html=True), "gid").collect()]
    assert got == [table(("a", "b")), table(("c", "d"))]


def test_rows_of_inner_tables_count_for_the_outer_block(spark):
    inner = "<table>" + rows(("Stage", "Drill"), ("Commodities", "Zn")) + "</table>"
    got = record_of(spark, table(("Commodities", "Cu"), ("Details", inner), ("Ticker", "T:2")))
    assert (got.stage, got.commodities, got.ticker_exchange) == ("Drill", "Cu", "T:2")


def test_an_inner_property_table_is_a_block_of_its_own(page):
    blocks = page(table(("A", table(("b", "c")))), t=html.property_tables)
    assert [[["".join(c.texts) for c in row] for row in b.rows] for b in blocks] == [[["A", "bc", "b", "c"], ["b", "c"]], [["b", "c"]]]
    assert [b.table_no for b in blocks] == [0, 1]


def test_a_block_of_two_tables_has_one_header_decision(spark):
    wide = "<table>" + rows(("Project", "Commodities", "Stage"), ("Gold", "Au", "Old")) + "</table>"
    first = "<table>" + rows(("Stage", "Drill")) + "</table>"
    labels = record_of(spark, f"<h1>Gold</h1><div class='properties-wrapper-table'>{first}{wide}</div>")
    assert (labels.stage, labels.commodities) == ("Drill", None)
    header = record_of(spark, f"<h1>Gold</h1><div class='properties-wrapper-table'>{wide}{first}</div>")
    assert (header.stage, header.commodities) == ("Old", "Au")


def test_fragment_of_a_block_is_the_whole_block(spark):
    block = "<div class='x properties-wrapper-table'>" + rows(("a", "b")) + "<table>" + rows(("c", "d")) + "</table></div>"
    frame = spark.createDataFrame([("1", block + "<p>" + block)], "gid string, html string")
    assert [r.table_html for r in html.table_fragments(html.parsed_pages(frame, "tables", keep_html=True), "gid").collect()] == [block]


def test_the_row_of_a_link_is_the_innermost_one(page):
    link = "<table><tr><td>in</td><td>Cu</td><td><a href='/project-profile?gid=42'>l</a></td></tr></table>"
    markup = table(("Project", "Commodities", "Stage"), ("out", link, "x"))
    got = page(markup, t=lambda p: html.row_linking_to(F.get(html.property_tables(p), F.lit(0)), F.lit("42")))
    assert ["".join(c.texts) for c in got] == ["in", "Cu", "l"]


def test_end_tags_left_out_are_implied(page, spark):
    frame = spark.createDataFrame([("1", "<a href=/1>one<a href=/2>two<div><a href=/3>three</div>four<h1>t<h1>u</h1>v")], "gid string, html string")
    got = [(r.tag, r.text) for r in html.html_elements(html.parsed_pages(frame), "gid").collect()]
    assert got == [("a", "one"), ("a", "two"), ("a", "three"), ("h1", "t"), ("h1", "u")]
    markup = "<table class=properties-wrapper-table><tbody><td>a<td>b<tbody><tr><td>c</tr><td>d</table>"
    read = page(markup, t=lambda p: F.get(html.property_tables(p), F.lit(0))["rows"])
    assert [["".join(c.texts) for c in row] for row in read] == [["a", "b"], ["c"], ["d"]]


@pytest.mark.parametrize("piece", ["<a href='/x'>word ", "<a href=x><div>w", "<h1>w", "<h1><p>w", "<td>w", "<tr><td><a>w", "<div id=right-sider>w</p>",
                                   "<table class=properties-wrapper-table><tr><td>w</p>"])
def test_time_and_size_are_linear_in_open_elements(piece):
    def cost(n):
        best = min(_timed(lambda: _read(piece * n, frozenset(PARTS)), time.perf_counter) for _ in range(3))
        read = _read(piece * n, frozenset(PARTS))
        return best, sum(map(len, read.values()))

    (first, small), (second, large) = cost(5_000), cost(20_000)
    assert large <= 4.1 * small and second < 8 * first + 0.5  # quadratic work would take 16 times as long


def _timed(run, clock):
    begun = clock()
    run()
    return clock() - begun


def test_null_html_stays_null(spark):
    frame = spark.createDataFrame([("1", None)], "gid string, html string")
    assert html.parsed_pages(frame).first().page is None


def test_names_in_records_are_visible_text(spark):
    got = record_of(spark, '<h1>Big <br>Hill <span>North</span></h1><h3 id="company-name">Gold <b>Fields</b> Ltd</h3>')
    assert (got.project_name, got.company_name, got.rec_ord) == ("Big Hill North", "Gold Fields Ltd", 0)


def test_only_wanted_parts_are_built(spark):
    frame = spark.createDataFrame([("1", "<h1>T</h1><p>line</p>" + table(("a", "b")))], "gid string, html string")
    read = {p: html.parsed_pages(frame, p).first().page.asDict() for p in ("elements", "tables", "lines")}
    sizes = {p: [len(page[k]) for k in ("elements", "tables", "cells", "lines")] for p, page in read.items()}
    assert sizes == {"elements": [1, 0, 0, 0], "tables": [0, 1, 2, 0], "lines": [0, 0, 0, 4]}


@pytest.mark.parametrize("markup", ["<table class=x><tr><td>" * 300, "<div id=a class='b c'>" * 400 + "<a href=x>y</a>" * 400])
def test_output_grows_with_the_page_not_its_nesting(spark, markup):
    frame = spark.createDataFrame([("1", markup)], "gid string, html string")
    size = len(html.parsed_pages(frame).select(F.to_json("page").alias("j")).first().j)
    assert size < 25 * len(markup)


PLAIN = ('<title>x</title><div id="right-sider"><h3 id="company-name">C</h3><a href="?gid=1&amp;b=2" id="project-news-btn">n</a></div><iframe src="/m?a=1&copy=2">'
         '</iframe><table class="wide properties-wrapper-table"><tr><th>A<th>B</th><tr><td>1 &lt; 2<td><a href="/x">y</a></table><br>end')


@pytest.mark.parametrize("odd", ["", "<!-- a <td> -->", "<a href=x>", "<script>'<td>'</script>", "<title>a<b></title>", "<", "</ td>", "<li/>", "& b &amp c"])
def test_plain_tags_read_as_html_parser_reads_them(odd):
    for parts in (("elements",), ("tables",), ("lines",), ("elements", "tables", "lines")):
        for page in (odd + PLAIN, PLAIN + odd, PLAIN[:230] + odd + PLAIN[230:]):
            assert html_functions._read(page, frozenset(parts)) == html_functions._read(page, frozenset(parts), lambda tag: None)


def test_plain_pages_take_the_short_way(monkeypatch):
    monkeypatch.setattr(html_functions._PageReader, "goahead", lambda *_: 1 / 0)
    assert len(html_functions._read(PLAIN[:-3], frozenset(["tables"]))["rows"]) == 2


def test_cells_rows_and_plain_elements_take_no_calls(monkeypatch):
    started, closed = [], []
    for name, seen in (("_start", started), ("_close_top", closed)):
        own = getattr(html_functions._PageReader, name)
        monkeypatch.setattr(html_functions._PageReader, name, lambda self, x, own=own, seen=seen: seen.append(x) or own(self, x))
    page = "<table>" + "<tr><td><p>a</p></td><td><b>b</b></td></tr>" * 50 + "</table>"
    read = html_functions._read(page, frozenset(PARTS))
    assert (len(read["rows"]), len(read["cells"]), len(started), len(closed)) == (50, 100, 1, 1)
