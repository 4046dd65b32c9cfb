"""Project and company fields out of fetched pages.

A page is parsed once into one struct and everything below is an expression on it, so a page never leaves
its row: no shuffle, no window, and no page size or page count gathers rows in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gidlake.functions.html import (CELL_DDL, PARTS, below, block_rows, element_text, node_text, parse_html, spaced_text,
                                    visible_text)
from gidlake.functions.text import (LABEL_FIELDS, absolute_url, blank_to_null, coalesce_truthy, dash_to_null,
                                    gid_after, gid_anywhere, gid_from_link, label_field, normalize_text,
                                    proper_case)
from gidlake.operators.companies import company_url

# Class of the property tables, of the text container, and its line labels in match order.
TABLE_CLASS = ".properties-wrapper-table"
TEXT_CONTAINER = ".main-profile-container"
LINE_LABELS = [("project:", "project_name"), ("operator:", "operator"),
               ("commodities:", "commodities"), ("stage:", "stage")]

RECORD_FIELDS = ["project_name", "operator", "commodities", "stage", "ticker_exchange", "company_id",
                 "company_name"]


def first_where(items: Column, wanted: Callable[[Column], Column]) -> Column:
    return F.try_element_at(F.filter(items, wanted), F.lit(1))


def last_where(items: Column, wanted: Callable[[Column], Column]) -> Column:
    return F.try_element_at(F.filter(items, wanted), F.lit(-1))


def has_text(c: Column, part: str) -> Column:
    return F.coalesce(F.contains(c, F.lit(part)), F.lit(False))


def inside(node: Column, *marks: str) -> Column:
    return F.arrays_overlap(node["scope"], F.array(*map(F.lit, marks)))


def parsed_pages(pages: DataFrame, *parts: str, keep_html: bool = False) -> DataFrame:
    """Pages with the html replaced by its parsed struct; only the named parts of it are built (all, if none is named)."""
    parsed = pages.withColumn("page", parse_html(F.col("html"), parts or PARTS))
    return parsed if keep_html else parsed.drop("html")


def html_cells(parsed: DataFrame, key: str) -> DataFrame:
    """Table cells in long form, by the table and row that hold them."""
    cell = parsed.select(key, F.col("page.texts").alias("texts"), F.explode("page.cells").alias("c"))
    return cell.select(key, "c.table_no", "c.row_no", "c.col_no", "c.tag",
                       F.array_join(below(F.col("texts"), F.col("c.t0"), F.col("c.t1")), "").alias("text"))


def html_elements(parsed: DataFrame, key: str) -> DataFrame:
    """Headings and link elements in long form."""
    texts = F.transform("page.elements", lambda e: F.struct(e.alias("e"), node_text(F.col("page"), e).alias("text")))
    return parsed.select(key, F.explode(texts).alias("x")).select(
        key, "x.e.pos", "x.e.tag", "x.e.id", "x.e.href", "x.e.onclick", "x.e.src", "x.e.data_url", "x.text")


def page_title(page: Column, text: Callable[[Column, Column], Column] = node_text) -> Column:
    """The project title heading, else the first heading with text. `text` reads a heading: its pieces run together,
    or visible_text."""
    def h1(element_id: str) -> Column:
        found = first_where(page["elements"], lambda e: (e["tag"] == "h1") & (e["id"] == element_id))
        return blank_to_null(text(page, found))

    filled = first_where(page["elements"], lambda e: (e["tag"] == "h1") & (e["t1"] > e["t0"]))
    return F.coalesce(h1("project-title"), h1("project_title"), blank_to_null(text(page, filled)))


def page_links(parsed: DataFrame, key: str, base: Column) -> DataFrame:
    """Every anchor with its absolute address and the gid in it."""
    anchors = F.filter("page.elements", lambda e: e["tag"] == "a")
    link = parsed.select(key, base.alias("base"), F.explode(anchors).alias("e"))
    target = coalesce_truthy(F.col("e.href"), F.col("e.data_url"))
    return link.select(
        key, F.col("e.pos").alias("pos"), F.col("e.href").alias("href"), F.col("e.data_url").alias("data_url"),
        F.col("e.onclick").alias("onclick"), absolute_url(F.col("base"), target).alias("url"),
        F.coalesce(gid_from_link(target), gid_anywhere(F.col("e.onclick"))).alias("gid"))


def company_link(page: Column, base_host: str) -> Column:
    """struct(company_url, company_id, found) of the best company link of a page."""
    elements = page["elements"]
    news = first_where(elements, lambda e: (e["tag"] == "a") & (e["id"] == "company-news-btn")
                       & inside(e, "#right-sider"))
    nav = first_where(elements, lambda e: (e["tag"] == "a") & (e["id"] == "company_profile")
                      & inside(e, "#modal-nav-buttons", "#modal_nav_buttons"))
    profile = first_where(elements, lambda e: (e["tag"] == "a") & has_text(e["href"], "company-profile?gid="))
    data = first_where(elements, lambda e: (e["tag"] == "a") & e["data_url"].isNotNull())
    trimmed = [F.trim(c) for c in (news["href"], nav["data_url"], nav["href"], profile["href"],
                                   data["href"], data["data_url"])]
    best = blank_to_null(coalesce_truthy(*trimmed))
    return F.struct(absolute_url(F.lit(base_host), best).alias("company_url"),
                    gid_after(best, "company-profile").alias("company_id"),
                    best.isNotNull().alias("found"))


def company_heading(page: Column, within: str | None = None, text: Callable[[Column, Column], Column] = node_text) -> Column:
    """Text of h3#company-name, optionally only inside an element; `text` as for page_title."""
    def wanted(e: Column) -> Column:
        named = (e["tag"] == "h3") & (e["id"] == "company-name")
        return named & inside(e, within) if within else named

    return blank_to_null(text(page, first_where(page["elements"], wanted)))


def fast_company_id(page: Column) -> Column:
    """Company id from known buttons, the map frame, then any company-profile anchor."""
    elements = page["elements"]

    def button(element_id: str) -> Column:
        href = first_where(elements, lambda e: e["id"] == element_id)["href"]
        return F.when(has_text(href, "company-profile"), gid_from_link(href))

    frame = gid_from_link(first_where(elements, lambda e: e["id"] == "project-map")["src"], "companyId")
    anchor = first_where(elements, lambda e: (e["tag"] == "a") & has_text(e["href"], "company-profile?gid=")
                         & gid_from_link(e["href"]).isNotNull())
    return F.coalesce(button("company-news-btn"), button("project-news-btn"), frame, gid_from_link(anchor["href"]))


def property_blocks(page: Column) -> Column:
    """The blocks of a page that hold properties: tables with the class, else div blocks with it, each as a whole."""
    def of(tag: str) -> Column:
        return F.filter(page["tables"], lambda t: (t["tag"] == tag) & F.array_contains(t["marks"], TABLE_CLASS))

    return F.when(F.size(of("table")) > 0, of("table")).otherwise(of("div"))


def read_block(page: Column, block: Column) -> Column:
    """A block with all rows below it (`rows`), their link ranges (`spans`) and the links by place (`hrefs`)."""
    links = F.transform(below(page["links"], block["l0"], block["l1"]), lambda a, i: F.struct((block["l0"] + i).alias("at"), a["href"].alias("href")))
    return F.struct(block["table_no"].alias("table_no"), block_rows(page, block).alias("rows"),
                    below(page["rows"], block["r0"], block["r1"]).alias("spans"), links.alias("hrefs"))


def property_tables(page: Column) -> Column:
    """The property blocks of a page, read."""
    return F.transform(property_blocks(page), lambda t: read_block(page, t))


def table_fragments(parsed: DataFrame, key: str) -> DataFrame:
    """The text of each property block once per page, tables inside it included; the pages must have kept their html."""
    texts = F.array_distinct(F.transform(property_blocks(F.col("page")),
                                         lambda t: F.substring(F.col("html"), t["start"] + 1, t["end"] - t["start"])))
    return parsed.select(key, F.explode(texts).alias("table_html"))


def header_labels(table: Column) -> Column:
    first = F.coalesce(F.try_element_at(table["rows"], F.lit(1)), F.array().cast(f"array<{CELL_DDL}>"))
    return F.transform(first, lambda c: F.lower(element_text(c)))


def is_header_table(labels: Column) -> Column:
    """At least three columns, one naming the project and one the commodities."""
    return ((F.size(labels) >= 3) & F.exists(labels, lambda h: F.contains(h, F.lit("project")))
            & F.exists(labels, lambda h: F.contains(h, F.lit("commodit"))))


def column_index(labels: Column) -> Column:
    """Struct of the 0-based column each field claims; a column goes to its first unclaimed field."""
    fields = [name for _, name in LABEL_FIELDS]
    start = F.struct(*[F.lit(None).cast("int").alias(f) for f in fields], F.lit(0).alias("next"))

    def claim(acc: Column, label: Column) -> Column:
        choice = F.lit(None).cast("string")
        for key, name in reversed(LABEL_FIELDS):
            free = F.contains(label, F.lit(key)) & acc[name].isNull()
            choice = F.when(free, F.lit(name)).otherwise(choice)
        updated = [F.when(choice == f, acc["next"]).otherwise(acc[f]).alias(f) for f in fields]
        return F.struct(*updated, (acc["next"] + 1).alias("next"))

    return F.aggregate(labels, start, claim)


def _cell_text(row: Column, index: Column) -> Column:
    return element_text(F.get(row, index))


def data_rows(table: Column) -> Column:
    rows = table["rows"]
    return F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0)))


def row_fields(row: Column, columns: Column) -> Column:
    """The project fields of a projects-table row; null without a row."""
    return F.when(row.isNotNull(), F.struct(
        blank_to_null(_cell_text(row, columns["project_name"])).alias("project_name"),
        dash_to_null(_cell_text(row, columns["commodities"])).alias("commodities"),
        dash_to_null(_cell_text(row, columns["stage"])).alias("stage")))


def row_linking_to(table: Column, gid: Column) -> Column:
    """The innermost row around the first link to the gid's project."""
    at = first_where(table["hrefs"], lambda a: F.coalesce(F.regexp_extract(a["href"], r"project-profile\?gid=(\d+)", 1) == gid, F.lit(False)))["at"]
    around = F.transform(table["spans"], lambda r, i: F.when((r["l0"] <= at) & (at < r["l1"]), i))
    return F.get(table["rows"], F.array_max(around))


def target_row(facts: Column, project_name: Column) -> Column:
    """The row linking to the gid, else the first with the project's name, else the first."""
    same_name = first_where(facts["data"], lambda r: F.coalesce(
        (normalize_text(r["project_name"]) == normalize_text(project_name)) & (project_name != ""), F.lit(False)))
    return F.coalesce(facts["by_gid"], same_name, F.try_element_at(facts["data"], F.lit(1)))


def key_value_rows(table: Column) -> Column:
    """Rows of a label/value table as (field, label, value, links), valueless rows left out."""
    pairs = F.transform(F.filter(table["rows"], lambda r: F.size(r) >= 2), lambda r: F.struct(
        label_field(element_text(F.get(r, F.lit(0)))).alias("field"),
        F.lower(element_text(F.get(r, F.lit(0)))).alias("label"),
        dash_to_null(element_text(F.get(r, F.lit(1)))).alias("value"),
        F.get(r, F.lit(1))["links"].alias("links")))
    return F.filter(pairs, lambda p: p["value"].isNotNull())


def ownership_companies(pairs: Column) -> Column:
    """(id, name) of the companies linked in ownership cells, in page order."""
    owners = F.filter(pairs, lambda p: F.contains(p["label"], F.lit("ownership")))
    links = F.flatten(F.transform(owners, lambda p: p["links"]))
    found = F.transform(links, lambda a: F.struct(
        F.coalesce(gid_anywhere(a["onclick"]), gid_anywhere(a["href"])).alias("id"),
        element_text(a).alias("name")))
    return F.filter(found, lambda c: c["id"].isNotNull() & (c["name"] != ""))


def primary_page_company(candidates: Column, operator: Column) -> Column:
    """The first company whose name contains the operator's, else the first one."""
    alike = first_where(candidates, lambda c: F.contains(F.lower(c["name"]), F.lower(operator)))
    return F.coalesce(F.when(operator != "", alike), F.try_element_at(candidates, F.lit(1)))


def table_facts(tables: Column, gid: Column) -> Column:
    """What each property table says by itself, worked out once per table.

    Chained transforms bind the intermediate values, so no sub-expression is evaluated twice.
    """
    read = F.transform(tables, lambda t: F.struct(
        t["table_no"].alias("table_no"), row_linking_to(t, gid).alias("linked"), header_labels(t).alias("labels"), data_rows(t).alias("data"),
        key_value_rows(t).alias("pairs")))
    indexed = F.transform(read, lambda t: F.struct(
        t["table_no"].alias("table_no"), is_header_table(t["labels"]).alias("wide"), column_index(t["labels"]).alias("columns"),
        t["linked"].alias("linked"), t["data"].alias("data"),
        t["pairs"].alias("pairs")))

    def said(t: Column, name: str) -> Column:
        return F.when(~t["wide"], first_where(t["pairs"], lambda p: p["field"] == name)["value"]).alias(name)

    return F.transform(indexed, lambda t: F.struct(
        t["table_no"].alias("table_no"), t["wide"].alias("wide"),
        F.when(t["wide"], row_fields(t["linked"], t["columns"])).alias("by_gid"),
        F.when(t["wide"], F.transform(t["data"], lambda r: row_fields(r, t["columns"]))).alias("data"),
        *[said(t, name) for _, name in LABEL_FIELDS],
        F.when(~t["wide"], ownership_companies(t["pairs"])).alias("owners")))


def fold_table(record: Column, facts: Column) -> Column:
    """The record with what one more table adds; a filled field is never replaced."""
    bound = F.transform(F.array(F.struct(
        facts.alias("facts"), target_row(facts, record["project_name"]).alias("row"),
        coalesce_truthy(record["operator"], facts["operator"]).alias("operator"))), lambda b: F.struct(
            b["facts"].alias("facts"), b["row"].alias("row"), b["operator"].alias("operator"),
            F.when(record["company_id"].isNull(), primary_page_company(b["facts"]["owners"], b["operator"]))
            .alias("company")))

    def merged(b: Column) -> Column:
        values = {f: coalesce_truthy(record[f], b["row"][f], b["facts"][f])
                  for f in ("project_name", "commodities", "stage")}
        values["operator"] = b["operator"]
        values["ticker_exchange"] = coalesce_truthy(record["ticker_exchange"], b["facts"]["ticker_exchange"])
        values["company_id"] = F.coalesce(record["company_id"], b["company"]["id"])
        values["company_name"] = F.when(b["company"].isNotNull(), coalesce_truthy(
            record["company_name"], b["operator"], b["company"]["name"])).otherwise(record["company_name"])
        return F.struct(*[values[f].alias(f) for f in RECORD_FIELDS])

    return F.get(F.transform(bound, merged), F.lit(0))


def fold_tables(tables: Column, start: Column, gid: Column) -> Column:
    """All tables in page order; later ones only fill what is still missing."""
    return F.aggregate(table_facts(tables, gid), start, fold_table)


def label_lines(page: Column) -> Column:
    """(field, value) where a line holding a label is followed by another line."""
    lines = F.transform(F.filter(page["lines"], lambda n: F.array_contains(n["scope"], TEXT_CONTAINER)),
                        lambda n: n["text"])
    return value_on_next_line(lines)


def value_on_next_line(lines: Column) -> Column:
    """(field, value) pairs of an array of text lines."""
    def named(line: Column) -> Column:
        low, found = F.lower(line), F.lit(None).cast("string")
        for key, name in reversed(LINE_LABELS):
            found = F.when(F.contains(low, F.lit(key)), F.lit(name)).otherwise(found)
        return found

    pairs = F.transform(lines, lambda line, i: F.struct(named(line).alias("field"), F.get(lines, i + 1).alias("value")))
    return F.filter(pairs, lambda p: p["field"].isNotNull() & p["value"].isNotNull())


def first_line_value(pairs: Column, name: str) -> Column:
    return first_where(pairs, lambda p: p["field"] == name)["value"]


def finish_record(record: DataFrame) -> DataFrame:
    """Company and operator stand in for each other, company names in proper case."""
    company = proper_case(blank_to_null(coalesce_truthy(F.col("company_name"), F.col("operator"))))
    return record.withColumn("company_name", company).withColumn(
        "operator", coalesce_truthy(F.col("operator"), F.col("company_name")))


def page_records(parsed: DataFrame, company_prefix: str) -> DataFrame:
    """Scraped records (gid, project and company fields) from parsed project pages with a gid column.

    They are landed page records as they are: `rec_ord` is 0, so a gid should have one page here. Names in headings are the
    visible text, inline markup and line breaks included.
    """
    page = F.col("page")
    start = F.struct(page_title(page, visible_text).alias("project_name"),
                     *[F.lit(None).cast("string").alias(f) for f in RECORD_FIELDS[1:-1]],
                     company_heading(page, text=visible_text).alias("company_name"))
    folded = parsed.select("gid", "page", fold_tables(property_tables(page), start, F.col("gid")).alias("rec"))
    listed = folded.withColumn("pairs", label_lines(page))
    fields = ["project_name", "operator", "commodities", "stage"]
    texts = {f: coalesce_truthy(F.col(f"rec.{f}"), first_line_value(F.col("pairs"), f)) for f in fields}
    company_id = F.coalesce("rec.company_id", fast_company_id(page))
    flat = listed.select(
        "gid", F.lit(0).alias("rec_ord"), *[texts[f].alias(f) for f in fields], F.col("rec.ticker_exchange").alias("ticker_exchange"),
        company_id.alias("company_id"), F.col("rec.company_name").alias("company_name"),
        company_url(company_id, company_prefix).alias("company_url"),
        F.exists(page["elements"], lambda e: F.coalesce(e["id"] == "company-news-btn", F.lit(False)))
        .alias("company_profile_link_found"))
    return finish_record(flat)


def company_projects_match(page: Column, gid: Column, project_name: Column) -> Column:
    """struct(commodities, stage, project_summary_href, matched_by) from a company page's projects table.

    A row linking to the gid beats every name match; among name matches the last one counts.
    """
    def of(tag: str) -> Column:
        return F.filter(page["tables"], lambda t: (t["tag"] == tag) & F.array_contains(t["marks"], TABLE_CLASS))

    def is_projects(t: Column) -> Column:
        head = F.array_join(header_labels(t), ",")
        return (F.contains(head, F.lit("project")) & F.contains(head, F.lit("commodit"))
                & F.contains(head, F.lit("stage")))

    tables = F.transform(of("table"), lambda t: read_block(page, t))
    held = F.transform(F.slice(of("div"), 1, 1), lambda t: read_block(page, t))
    table = F.coalesce(first_where(tables, is_projects), F.get(held, F.lit(0)))
    cells = F.transform(data_rows(table), lambda r: F.filter(r, lambda c: c["tag"] == "td"))
    rows = F.transform(F.filter(cells, lambda r: F.size(r) >= 4), lambda r: F.struct(
        normalize_text(spaced_text(F.get(r, F.lit(0)))).alias("name"),
        blank_to_null(_cell_text(r, F.lit(2))).alias("commodities"),
        blank_to_null(_cell_text(r, F.lit(3))).alias("stage"),
        first_where(F.get(r, F.lit(4))["links"], lambda a: a["href"].isNotNull())["href"].alias("href")))
    by_gid = first_where(rows, lambda r: F.coalesce(gid_after(r["href"], "project-profile") == gid, F.lit(False)))
    by_name = last_where(rows, lambda r: F.coalesce(
        (r["name"] == normalize_text(project_name)) & (project_name != ""), F.lit(False)))
    hit = F.coalesce(by_gid, by_name)
    return F.struct(hit["commodities"].alias("commodities"), hit["stage"].alias("stage"),
                    hit["href"].alias("project_summary_href"),
                    F.when(by_gid.isNotNull(), F.lit("gid")).when(by_name.isNotNull(), F.lit("name"))
                    .alias("matched_by"))
