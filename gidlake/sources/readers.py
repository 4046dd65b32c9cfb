"""Readers of landed inputs (S01-S09) and relationship edges from their bodies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from gidlake import schemas
from gidlake.functions.text import blank_to_null
from gidlake.operators.skew import first_per_key
from gidlake.settings import COUNTRIES_WHEN_MISSING, COUNTRIES_WHEN_UNREADABLE
from gidlake.sources.arrays import read_objects


def read_countries(spark: SparkSession, path: str) -> DataFrame:
    """(country, country_ord) from `{"country": [...]}`; the file is a short configuration list."""

    def listed(names: list[str]) -> DataFrame:
        return spark.createDataFrame([(n, i) for i, n in enumerate(names)], "country string, country_ord int")

    try:
        raw = (spark.read.schema("country array<string>, broken string")
               .option("multiLine", True).option("columnNameOfCorruptRecord", "broken").json(path))
        unreadable = raw.select(F.max(F.col("broken").isNotNull() & F.col("country").isNull())).first()[0]
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return listed(COUNTRIES_WHEN_MISSING)
        return listed(COUNTRIES_WHEN_UNREADABLE)
    if unreadable or unreadable is None:
        return listed(COUNTRIES_WHEN_UNREADABLE)
    return raw.select(F.posexplode("country").alias("country_ord", "country")).select("country", "country_ord")


def feed_from_bodies(bodies: DataFrame) -> DataFrame:
    """Landed (country, country_ord, body) responses to feed rows; a body that is no list gives none."""
    is_list = F.ltrim("body").startswith("[")
    rows = F.from_json("body", f"array<struct<{schemas.FEED_DDL.strip()}>>")
    return (bodies.filter(is_list)
            .select("country", "country_ord", F.posexplode(rows).alias("row_ord", "row"))
            .select("country", "country_ord", F.col("row_ord").cast("bigint"), "row.*"))


def read_project_feed(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of (country, country_ord, body), one per country response."""
    return feed_from_bodies(spark.read.schema("country string, country_ord int, body string").json(path))


def read_feed_arrays(spark: SparkSession, path: str, countries: DataFrame) -> DataFrame:
    """Raw country responses, `country=<name>/` folders of files with one JSON array each, however large.

    `countries` has (country, country_ord); a country's row_ord counts on over its files in order of their paths. A response that is no
    array of objects gives no rows.
    """
    rows = read_objects(spark, path, schemas.FEED_DDL).withColumn("country", F.get_json_object("folder", "$.country"))
    sizes = rows.groupBy("country", "file").agg((F.max("row_ord") + 1).alias("n"))
    before = Window.partitionBy("country").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("country", "file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"))
    numbered = rows.join(offsets, ["country", "file"]).withColumn("row_ord", F.col("rows_before") + F.col("row_ord")).drop("rows_before", "file", "folder")
    fields = [c for c in numbered.columns if c not in ("country", "row_ord")]
    return numbered.join(countries.select("country", "country_ord"), "country").select("country", "country_ord", "row_ord", *fields)


def read_relationship_bodies(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of (gid, body); empty and broken bodies count as absent."""
    return usable_bodies(spark.read.schema("gid string, body string").json(path))


def edge_lists(body: Column) -> Column:
    """A body's three edge lists; entries stay JSON text, so one of the wrong shape spoils no other."""
    return F.from_json(body, "jv array<string>, nsrs array<string>, option array<string>")


def usable_bodies(bodies: DataFrame) -> DataFrame:
    """Bodies with any edge list, as `doc`."""
    return bodies.withColumn("doc", edge_lists(F.col("body"))).filter(
        F.coalesce("doc.jv", "doc.nsrs", "doc.option").isNotNull())


def relationship_edges(bodies: DataFrame) -> DataFrame:
    """(gid, body) to one row per edge: jv, then nsrs, then the flattened option lists, in body order.

    A null list is empty, and an entry of the wrong shape is left out.
    """
    nothing = F.array().cast("array<string>")

    def entries(items: Column, opening: str) -> Column:
        return F.filter(F.coalesce(items, nothing), lambda text: text.startswith(opening))

    def typed(items: Column, kind: str) -> Column:
        return F.transform(entries(items, "{"), lambda text: F.struct(
            F.lit(kind).alias("kind"), F.from_json(text, schemas.EDGE_ENTRY_DDL).alias("e")))

    def of_document(doc: Column) -> Column:
        lists = F.transform(entries(doc["option"], "["), lambda text: F.from_json(text, "array<string>"))
        options = F.flatten(F.filter(lists, lambda items: items.isNotNull()))
        return F.concat(typed(doc["jv"], "jv"), typed(doc["nsrs"], "nsr"), typed(options, "option"))

    # Binding the parsed body to a lambda variable keeps it at one parse per body.
    all_edges = F.flatten(F.transform(F.array(edge_lists(F.col("body"))), of_document))
    kept = [c for c in bodies.columns if c != "body"]
    kind, e = F.col("edge.kind"), F.col("edge.e")
    is_option = kind == "option"
    edge_id = (F.when(kind == "jv", e["projectCompanyOwnership"]).when(kind == "nsr", e["projectCompanyNsr"])
               .otherwise(e["projectcompanyoptions"]))
    details = ("id", "company_name", "root_ticker", "exchange", "website", "ceo", "headquarters", "phone", "industry",
               "sector")
    return bodies.select(*kept, F.posexplode(all_edges).alias("ord", "edge")).select(
        *kept, "ord", F.coalesce(e["id"], F.lit("")).alias("company_id"),
        F.coalesce(e["company_name"], F.lit("")).alias("company_name"), kind.alias("relationship_type"),
        F.when(~is_option, e["percentage"]).try_cast("double").alias("percentage"),
        edge_id.try_cast("bigint").alias("ownership_id"),
        F.when(is_option, e["optionee"]).try_cast("bigint").alias("optionee_id"),
        F.when(is_option, e["comments"]).alias("comments"),
        company_from_relationship(*[e[k] for k in details]).alias("company_details"),
        F.lit("relationships").alias("data_source"))


def company_from_relationship(id_: Column, name: Column, ticker: Column, exchange: Column, website: Column,
                              ceo: Column, headquarters: Column, phone: Column, industry: Column,
                              sector: Column) -> Column:
    """Company record of an edge; id and name default to ''."""
    return F.struct(
        F.coalesce(id_.cast("string"), F.lit("")).alias("id"), F.coalesce(name, F.lit("")).alias("name"),
        ticker.alias("ticker"), exchange.alias("exchange"), website.alias("website"), ceo.alias("ceo"),
        headquarters.alias("headquarters"), phone.alias("phone"), industry.alias("industry"),
        sector.alias("sector"), F.lit(None).cast("double").alias("ownership_percentage"),
        F.lit(None).cast("string").alias("relationship_type"), F.lit("relationships").alias("data_source"),
        F.lit(None).cast("timestamp_ntz").alias("fetched_at"),
    )


def id_text(c: Column) -> Column:
    """Ids as text without a decimal tail: 9799 and '9799.0' are both '9799'."""
    whole = F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint")).cast("string")
    return F.coalesce(whole, blank_to_null(F.trim(c.cast("string"))))


def url_index(rows: DataFrame) -> DataFrame:
    """(ID, URL, row_ord) rows to (gid, url, row_ord), rows without an ID left out; `row_ord` is the load order.

    A frame has no order of its own, so the caller names one: any column that sorts, such as read_url_index makes.
    """
    return (rows.select(id_text(F.col("ID")).alias("gid"), F.col("URL").alias("url"), "row_ord")
            .filter(F.col("gid").isNotNull()))


def read_url_index(spark: SparkSession, path: str, file_format: str = "csv") -> DataFrame:
    """CSV with a header, or parquet. The load order is that of file paths, then of rows in a file.

    Ids made while reading grow with the place in a file's block, so (file, block start, id) keeps the rows in order however
    files are packed into tasks.
    """
    if file_format == "csv":
        columns = spark.read.option("header", True).csv(path).columns
        ddl = ", ".join(f"`{c}` string" for c in columns)
        rows = spark.read.option("header", True).schema(ddl).csv(path)
    else:
        rows = spark.read.parquet(path)
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("row"))
    return url_index(rows.select("ID", "URL", place.alias("row_ord")))


def url_map(index: DataFrame) -> DataFrame:
    """J02 build side: the last URL listed for a gid."""
    return first_per_key(index, ["gid"], F.desc("row_ord")).select("gid", F.col("url").alias("project_url"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, html)."""
    return spark.read.parquet(path).select("page_id", "url", "html")


def read_geocode_cache(spark: SparkSession, path: str, layout: str = "parquet") -> DataFrame:
    """(cache_key, payload, is_negative).

    `parquet` and `json_lines` hold one (cache_key, payload) row per entry and split well. `json_map` is the legacy file,
    one `{key: payload}` object in any layout, or one per line: an object is read in one task. Text that is no object stops
    the job.
    """
    if layout == "json_map":
        try:
            lines = spark.read.text(path, wholetext=True)
        except AnalysisException:
            return spark.createDataFrame([], "cache_key string, payload string, is_negative boolean")
        whole = F.from_json("value", "map<string,string>")
        by_line = F.transform(F.filter(F.split("value", "\n"), lambda t: F.trim(t) != ""), lambda t: F.from_json(t, "map<string,string>"))
        wrong = F.raise_error(F.lit("geocode cache file holds no JSON object")).cast("array<map<string,string>>")
        maps = (F.when(F.trim("value") == "", F.array().cast("array<map<string,string>>")).when(whole.isNotNull() & (F.size(by_line) < 2), F.array(whole))
                .when(~F.exists(by_line, lambda m: m.isNull()), by_line).when(whole.isNotNull(), F.array(whole)).otherwise(wrong))
        pairs = lines.select(F.explode(maps).alias("m")).select(F.explode("m").alias("cache_key", "payload"))
        return pairs.withColumn("is_negative", F.col("payload").isNull())
    rows = spark.read.schema("cache_key string, payload string").json(path) if layout == "json_lines" else spark.read.parquet(path)
    return rows.select("cache_key", "payload").withColumn("is_negative", F.col("payload").isNull())


def read_company_links(spark: SparkSession, path: str) -> DataFrame:
    """Company documents with their links exploded; company_id may be a number, a text or null."""
    return company_links(spark.read.text(path).select(F.col("value").alias("body")))


def company_links(docs: DataFrame) -> DataFrame:
    doc = docs.select(F.try_parse_json("body").alias("doc")).filter(F.col("doc").isNotNull())
    links = F.from_json(F.to_json(F.try_variant_get("doc", "$.links", "variant")),
                        f"array<struct<{schemas.LINK_DDL.strip()}>>")
    return doc.select(
        F.try_variant_get("doc", "$.company_id", "string").alias("company_id"),
        F.try_variant_get("doc", "$.companyName", "string").alias("company_name"),
        F.explode_outer(links).alias("link"),
    ).select("company_id", "company_name",
             *[F.col(f"link.{c}").alias(f"link_{c}") for c in
               ("id", "company_id", "file_title", "file_name", "file_data", "date_created")])


def read_company_documents(spark: SparkSession, path: str) -> DataFrame:
    """Exported company documents (JSON lines or one top-level array per file) as typed rows."""
    return spark.read.schema(schemas.COMPANY_DOC_DDL).option("multiLine", False).json(path)


def read_company_array(spark: SparkSession, path: str) -> DataFrame:
    """Exports holding one JSON array a file, however large; many tasks read a file."""
    return read_objects(spark, path, schemas.COMPANY_DOC_DDL).drop("file", "folder", "row_ord")


def unknown_values(project: Column) -> Column:
    """`field: value` of every enumerated field of a project document that holds an unknown value."""
    edges = F.coalesce(project["company_relationships"], F.array().cast(f"array<struct<{schemas.RELATIONSHIP_DDL.strip()}>>"))
    companies = F.concat(F.array(project["primary_company"]), F.coalesce(
        project["stakeholders"], F.array().cast(f"array<struct<{schemas.COMPANY_DDL.strip()}>>")), F.transform(edges, lambda e: e["company_details"]))
    sources = F.concat(F.coalesce(project["data_sources"], F.array().cast("array<string>")), F.transform(edges, lambda e: e["data_source"]),
                       F.transform(companies, lambda c: c["data_source"]))
    types = F.concat(F.transform(edges, lambda e: e["relationship_type"]), F.transform(companies, lambda c: c["relationship_type"]))
    fields = ((F.array(project["processing_stage"]), schemas.PROCESSING_STAGES, "stage"), (sources, schemas.DATA_SOURCES, "data source"),
              (types, schemas.RELATIONSHIP_TYPES, "relationship type"))

    def odd(values: Column, allowed: list[str], name: str) -> Column:
        return F.transform(F.filter(values, lambda v: v.isNotNull() & ~v.isin(allowed)), lambda v: F.concat(F.lit(f"{name}: "), v))

    return F.concat(*(odd(*field) for field in fields))


def read_projects(spark: SparkSession, path: str) -> DataFrame:
    """Exported project documents as typed rows; an unknown value in any enumerated field stops the job."""
    rows = spark.read.schema(schemas.PROJECT_DDL + ", part int, parts int").json(path)
    unknown = unknown_values(F.struct(*rows.columns))
    stop = F.raise_error(F.concat(F.lit("unknown "), F.array_join(unknown, ", "))).cast("boolean")
    return rows.filter(F.when(F.size(unknown) == 0, F.lit(True)).otherwise(stop))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Every run's metrics below a folder."""
    return (spark.read.schema(schemas.METRICS_DDL).option("multiLine", True)
            .option("recursiveFileLookup", True).json(path))
