"""The domain's landed tables as views over the test tables (a fixed arithmetic; plans/oracle.py states it in SQL)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gidlake.operators.assembly import Landing
from gidlake.operators.skew import first_per_key
from gidlake.settings import PortalSettings
from gidlake.sources.readers import company_from_relationship, url_index as to_url_index

SETTINGS = PortalSettings()
RUN_TS = "2025-01-31 12:00:00"


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read from the files once, so later reads start no inference job."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("country"),
                                                 F.col("n_nationkey").alias("country_ord"))


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part with its key as gid, number and text."""
    return table(spark, sf_dir, "part").withColumns(
        {"n": F.col("p_partkey"), "gid": F.col("p_partkey").cast("string")})


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier with its nation and region. Nations, a short list, come as one map, so a join with suppliers is planned by their own size: Spark
    takes that of a join for the product of its sides."""
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    by_key = nation.filter("n_nationkey is not null").groupBy("n_nationkey").agg(F.collect_list(F.struct(*nation.columns)).alias("nations"))
    known = by_key.agg(F.map_from_entries(F.collect_list(F.struct("n_nationkey", "nations")))).scalar()
    supplier = table(spark, sf_dir, "supplier")
    return supplier.select("*", F.explode(F.try_element_at(known, F.col("s_nationkey"))).alias("nation")).select(*supplier.columns, "nation.*")


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Project feed rows; a gid comes once per supplier of its line items."""
    pairs = (table(spark, sf_dir, "lineitem").filter("l_partkey % 17 <> 0")
             .select("l_partkey", "l_suppkey").distinct())
    # Rows of a part lie together from here on, so what takes one row for each gid shuffles no more than that. The pairs are small and the
    # rows made of them are not, so partitions are not merged by the size of the pairs.
    pairs = pairs.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "l_partkey")
    rows = (pairs.join(suppliers(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey"))
            .join(parts(spark, sf_dir), F.col("l_partkey") == F.col("n")))
    located = "n % 9 <> 0"
    return rows.select(
        F.col("n_name").alias("country"), F.col("n_nationkey").alias("country_ord"),
        F.col("s_suppkey").alias("row_ord"), "gid", F.col("p_name").alias("project_name"),
        F.expr("case when n % 13 = 0 then null when n % 11 = 0 then r_name "
               "else concat(n_name, ', ', r_name) end").alias("location"),
        F.struct(F.when(F.expr(located), F.array(
            F.expr("(n * 37 % 36000) / 100.0D - 180"), F.expr("(n * 53 % 18000) / 100.0D - 90")))
            .alias("coordinates")).alias("centroid"),
        F.expr("case when n % 5 = 0 then '' when n % 5 = 1 then null else p_brand end")
        .alias("mineral_district_camp"),
        F.expr("concat('District ', p_size)").alias("mineral_district"),
        F.expr("concat(p_size * 1000, '.500000000000')").alias("area_m2"),
        F.col("p_type").alias("stage"), F.expr("replace(p_name, ' ', ',')").alias("commodities"),
        F.expr("case when n % 3 = 0 then null else s_name end").alias("operator"),
        F.col("s_acctbal").alias("marketcap"), F.col("p_retailprice").alias("outstandingshares"),
        F.col("p_size").alias("project_size"))


def edge_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items standing for relationship edges, with gid, kind and position."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate",
        "l_returnflag", "l_linestatus")
    return (items.filter("l_partkey % 10 <> 0 and not (l_returnflag = 'N' and l_partkey % 7 = 0)").select(
        "*", F.col("l_partkey").cast("string").alias("gid"),
        F.expr("case l_returnflag when 'N' then 'jv' when 'A' then 'nsr' else 'option' end").alias("kind"),
        F.expr("struct(case l_returnflag when 'N' then 0 when 'A' then 1 else 2 end as kind_ord, l_orderkey, "
               "l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_shipdate)").alias("ord")))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = edge_rows(spark, sf_dir).join(suppliers(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey"))
    empty = F.lit(None).cast("string")
    company = company_from_relationship(
        F.col("s_suppkey"), F.col("s_name"), F.expr("concat('T', s_suppkey)"),
        F.expr("case when s_nationkey % 2 = 0 then 'EVEN' else 'ODD' end"), empty, empty, F.col("n_name"), empty,
        F.expr("concat('Industry ', s_suppkey % 7)"), F.col("r_name"))
    is_option = F.col("kind") == "option"
    return rows.select(
        "gid", "ord", F.col("s_suppkey").cast("string").alias("company_id"), F.col("s_name").alias("company_name"),
        F.col("kind").alias("relationship_type"),
        F.expr("case when kind = 'option' or l_quantity < 3 then null else l_quantity * 2 end").alias("percentage"),
        F.expr("l_orderkey * 10 + l_linenumber").alias("ownership_id"),
        F.when(is_option, F.col("s_suppkey")).alias("optionee_id"),
        F.when(is_option, F.expr("concat('status ', l_linestatus)")).alias("comments"),
        company.alias("company_details"), F.lit("relationships").alias("data_source"))


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records scraped before; every second gid has two."""
    twice = F.explode(F.expr("case when n % 8 = 0 then sequence(0, 1) else array(0) end")).alias("rec_ord")
    return parts(spark, sf_dir).filter("n % 4 = 0").select("*", twice).select(
        "gid", "rec_ord",
        F.expr("case when rec_ord = 1 then 'second' when n % 20 = 0 then null "
               "else concat('Page ', p_name) end").alias("project_name"),
        F.expr("case when n % 100 = 0 then '' else cast(n % 100 as string) end").alias("company_id"),
        F.expr("case when n % 16 = 0 then null else concat('Company ', n % 100) end").alias("company_name"),
        F.expr("case when n % 12 = 0 then null else concat('Operator ', n % 50) end").alias("operator"),
        F.col("p_type").alias("stage"), F.col("p_brand").alias("commodities"))


def url_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ID, URL) rows; row_ord is their load order."""
    known = parts(spark, sf_dir).filter("n % 3 = 0 or n % 17 = 0").select(
        F.col("n").alias("ID"), F.concat(F.lit(SETTINGS.project_prefix), "gid").alias("URL"),
        F.lit(0).cast("bigint").alias("row_ord"))
    pages = table(spark, sf_dir, "pages").select(
        (F.col("page_id") + 1000000).alias("ID"), F.col("url").alias("URL"), F.lit(1).cast("bigint").alias("row_ord"))
    return known.unionByName(pages)


def url_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_url_index(url_rows(spark, sf_dir))


def map_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts(spark, sf_dir).filter("n % 2 = 0").select(
        "gid", F.expr("(n * 29 % 18000) / 100.0D - 90").alias("latitude"),
        F.expr("(n * 31 % 36000) / 100.0D - 180").alias("longitude"),
        F.lit(10.0).alias("map_zoom"), F.lit("Leaflet").alias("map_lib"))


def geocode_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cache_key, payload): coordinates of parts and four of the five regions; a null payload is a miss."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    points = (parts(spark, sf_dir).filter("n % 6 <> 0")
              .join(nation, F.col("n") % 25 == F.col("n_nationkey")).select(
        F.expr("format_string('rev:%.8f,%.8f', (n * 53 % 18000) / 100.0D - 90, (n * 37 % 36000) / 100.0D - 180)")
        .alias("cache_key"),
        F.expr("""case when n % 8 = 0 then null else concat(
            '{"lat":"1.5","lon":"2.5","address":{"', case when n % 4 = 1 then 'province' else 'state' end,
            '":"State of ', n_name, '","country":"', n_name, '","postcode":"P', n % 1000,
            '","ISO3166-2-lvl', case when n % 2 = 0 then '4' else '6' end, '":"XX-', n % 25, '"}}') end""")
        .alias("payload"), F.col("n").alias("entry_ord")))
    regions = table(spark, sf_dir, "region").filter("r_regionkey < 4").select(
        F.concat(F.lit("fwd:"), F.lower("r_name")).alias("cache_key"),
        F.expr("""concat('{"lat":"', r_regionkey * 10, '.25","lon":"', r_regionkey * 20, '.75","address":{"region":"',
                  'Region ', r_regionkey, '","country":"', r_name, '","county":"C', r_regionkey, '"}}')""")
        .alias("payload"), F.col("r_regionkey").cast("bigint").alias("entry_ord"))
    entries = points.unionByName(regions)
    return first_per_key(entries, ["cache_key"], F.asc("entry_ord")).select("cache_key", "payload")


def landing(spark: SparkSession, sf_dir: str) -> Landing:
    return Landing(feed(spark, sf_dir), edges(spark, sf_dir), page_records(spark, sf_dir),
                   url_index(spark, sf_dir), map_centers(spark, sf_dir), geocode_cache(spark, sf_dir))


def error_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").filter("event_type = 'error'").select(
        "ts", F.concat(F.lit("k_"), F.get_json_object("props", "$.k")).alias("error_type"))


def relationship_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A response body per line item: one or two edges, null and misshapen lists among them."""
    return edge_rows(spark, sf_dir).select(
        "gid", F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice",
                        "l_shipdate").alias("body_ord"),
        F.expr("""case kind
          when 'jv' then concat('{"jv":[{"id":', l_suppkey, ',"company_name":"Company ', l_suppkey,
            '","percentage":', cast(l_quantity * 2 as int), ',"projectCompanyOwnership":', l_orderkey,
            ',"root_ticker":"T', l_suppkey, '"}],"nsrs":null}')
          when 'nsr' then concat('{"jv":[],"nsrs":["bad",{"id":"', l_suppkey, '","company_name":"Company ', l_suppkey,
            '","percentage":null,"projectCompanyNsr":', l_linenumber, '}]}')
          else concat('{"option":[[{"id":', l_suppkey, ',"company_name":"Company ', l_suppkey,
            '","optionee":', l_suppkey, ',"projectcompanyoptions":', l_orderkey, ',"comments":"first"}],"bad",',
            '[{"company_name":"Partner ', l_linenumber, '","projectcompanyoptions":', l_orderkey, '}]]}')
          end""").alias("body"))


def paged_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts dealt over all cores before their pages are made: the test table is one file, and pages are costly to read."""
    return parts(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism, "gid")


def project_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A project page for every part: title, company links, a property table and its copy, a projects table and text lines.
    Which pieces a page has follows from n. Every seventh part has a table inside a property cell; every tenth holds its tables
    in one property block instead of being property tables themselves."""
    kv_class = """case when n % 10 = 9 then '' else ' class="properties-wrapper-table"' end"""
    wide_class = """case when n % 10 = 9 then '' else ' class="wide properties-wrapper-table"' end"""
    return paged_parts(spark, sf_dir).select("gid", F.concat(
        F.expr("""concat('<html><head><title>x</title></head><body>',
          case when n % 12 = 0 then '' when n % 8 = 0 then concat('<h1 id="project_title"> ', p_name, ' </h1>')
               else concat('<h1>other</h1><h1 id="project-title">', p_name, '</h1>') end)"""),
        F.expr("""concat('<div id="right-sider">',
          case when n % 3 = 1 then concat('<h3 id="company-name"> company  of ', n % 100, '</h3>') else '' end,
          case when n % 5 = 0 then concat('<a id="company-news-btn" href=" /company-profile?gid=', n % 100,
               '&amp;x=1">c</a>') else '' end, '</div>',
          case when n % 5 in (0, 1) then concat('<div id="modal-nav-buttons"><a id="company_profile" href="#" ',
               'data-url="/company-profile?gid=', n % 70, '">p</a></div>') else '' end,
          case when n % 5 = 2 then concat('<p><a href="https://portal.example/company-profile?gid=', n % 60,
               '">q</a></p>') else '' end,
          case when n % 5 = 3 then concat('<iframe id="project-map" src="/map?gid=', n, '&companyId=', n % 50,
               '"></iframe><a data-url="/other/', n, '">o</a>') else '' end)"""),
        F.expr("""case when n % 10 = 9 then '<div class="wide properties-wrapper-table">' else '' end"""),
        F.repeat(F.expr(f"""concat('<table', {kv_class}, '><tr><td>Project Name</td><td>KV ', p_name,
          '</td></tr><tr><td>Operator</td><td>', case when n % 6 = 0 then '-' else concat('Operator ', n % 7) end,
          '</td></tr><tr><td>Main <b>Commodities</b></td><td>',
          case when n % 8 = 0 then '-' else concat('Cu,', n % 9) end, '</td></tr>',
          case when n % 12 = 0 then '<tr><td>Stage<td>Drill' else '' end,
          '<tr><td>Ticker<td>T', n % 11,
          case when n % 8 = 4 then concat('<tr><td>Ownership</td><td><a onclick="go(\\'?gid=', n % 90,
               '\\')">Alpha <b>', n % 7, '</b></a>, <a href="/company-profile?gid=1"> </a>',
               '<a href="/company-profile?gid=', n % 80, '">The Operator ', n % 7, ' Co</a></td></tr>') else '' end,
          case when n % 7 = 3 then concat('<tr><td>Details</td><td><table><tr><td>Stage<td>Inner ', n % 5, '</table></td></tr>') else '' end,
          '</table>')"""), 2),
        F.expr(f"""concat('<table', {wide_class}, '><tr><th>Project</th><th>Project Operator</th>',
          '<th>Commodities</th><th>Stage</th></tr><tr><td>decoy</td><td>x</td><td>Nothing</td><td>None</td></tr>',
          '<tr><td>', upper(p_name), '</td><td>x</td><td>-</td><td>by name</td></tr>',
          case when n % 16 = 0 then concat('<tr><td><a href="/project-profile?gid=', n, '">x</a></td><td>x</td><td>Au, ',
               n % 9, '</td><td>by gid</td></tr>') else '' end, '</table>')"""),
        F.expr("case when n % 10 = 9 then '</div>' else '' end"),
        F.expr("""concat('<div class="main-profile-container"><div>Stage:</div><div>', p_type, ' line</div>',
          '<p>Commodities:<br>', p_brand, ' line</p></div></body></html>')""")).alias("html"))


def company_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The company page of every part, with a projects table that may hold its row once, twice or by gid."""
    return paged_parts(spark, sf_dir).select("gid", F.col("p_name").alias("project_name"), F.expr(
        """concat('<table class="properties-wrapper-table"><tr><th>Project</th><th>Size</th></tr></table>',
          '<table class="properties-wrapper-table"><tr><th>Project</th><th>Type</th><th>Commodities</th>',
          '<th>Stage</th><th>Link</th></tr><tr><td>', p_name, '</td><td>t</td><td>first</td><td>s1</td><td></td></tr>',
          case when n % 16 = 0 then concat('<tr><td>zzz</td><td>t</td><td>Au ', n % 9, '</td><td>gid stage</td>',
               '<td><a href="/project-profile?gid=', n, '&y=2">v</a></td></tr>') else '' end,
          case when n % 8 <> 0 then concat('<tr><td> ', upper(p_name), ' </td><td>t</td><td>last</td><td></td>',
               '<td><a href="/project-profile?gid=999999999999">v</a></td></tr>') else '' end,
          '<tr><td>', p_name, '</td><td>short</td><td>x</td></tr></table>')""").alias("html"))


def page_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map results of pages; every third one failed."""
    return parts(spark, sf_dir).select(
        "gid", F.expr("case when n % 3 = 0 then 'timeout' else 'ok' end").alias("status"),
        F.expr("(n * 53 % 18000) / 100.0D - 90").alias("lat"), F.expr("(n * 37 % 36000) / 100.0D - 180").alias("lng"),
        F.lit(10.0).alias("zoom"), F.lit("Leaflet").alias("lib"))


def feed_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed responses: a one-project list per part, and for every seventh part an error object instead."""
    nation = table(spark, sf_dir, "nation")
    rows = parts(spark, sf_dir).join(nation, F.col("n") % 25 == F.col("n_nationkey"))
    return rows.select(
        F.col("n_name").alias("country"), F.col("n_nationkey").alias("country_ord"),
        F.expr("""case when n % 7 = 0 then '{"error":"none"}' else concat('[{"gid":', n, ',"project_name":"', p_name,
          '","location":"', n_name, '","centroid":{"coordinates":[', n % 180, '.5,', n % 90,
          '.25]},"area_m2":"', p_size, '.000","stage":"', p_type, '","company":"never taken"}]') end""").alias("body"))


def company_link_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company link documents; the id is a number, a text or null, and some have no link."""
    return table(spark, sf_dir, "supplier").select(F.expr("""concat('{"company_id":',
        case s_suppkey % 3 when 0 then cast(s_suppkey as string) when 1 then concat('"', s_suppkey, '"') else 'null' end,
        ',"companyName":"', s_name, '","links":[', case when s_suppkey % 5 = 0 then '' else concat('{"id":', s_suppkey * 2,
        ',"company_id":', s_suppkey, ',"file_title":"t', s_suppkey % 4, '","file_name":null,"file_data":"d",',
        '"date_created":"2025-01-01","more":1}') end, '],"other":true}')""").alias("body"))
