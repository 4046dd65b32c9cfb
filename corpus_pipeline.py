"""The corpus pipeline: from `documents` to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents. Rows are judged where they are, or joined by a key of their own, so rows
without an id, or of one id, are judged each by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gidlake.llm import decontamination, packing, pii, simhash, toxicity
from gidlake.llm import queries as _queries
from gidlake.llm.common import staged, table

# A stage's own key of its rows.
KEY = "pipeline_row_key"
# Words that a worker remembers while packing; executors hold what earlier stages left as well.
PACKING_WORDS = 250_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier, learned from the labels, does not reject.

    Null and empty texts are scored like texts without known words, repeated rows alike, texts of any length whole. An empty table gives none.
    """
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id (rows without an id come last).

    Null and empty texts are copies of each other. Different texts of one id stay where they are no near-duplicates, exact repeats of a row
    do not. Texts of any length take part whole. An empty table gives none. Rows are written once with a key of their own; only the keys
    of rejected rows are joined with them.
    """
    rows = staged(docs.withColumn(KEY, F.monotonically_increasing_id()), "pipeline-rows")
    found = simhash.simhash_components(rows.select(F.col(KEY).alias("doc_id"), "text"))
    classes = staged(found.select(F.col("doc_id").alias(KEY), "component_id"), "pipeline-classes")
    several = classes.groupBy("component_id").count().filter("count > 1").select("component_id")
    members = staged(classes.join(several, "component_id").join(rows.select(KEY, "doc_id"), KEY), "pipeline-copies")
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", KEY)
    first = staged(members.groupBy("component_id").agg(F.min(order).alias("first")).select("component_id", F.col(f"first.{KEY}").alias("first")), "pipeline-first")
    rejected = staged(members.join(first, "component_id").filter(F.col(KEY) != F.col("first")).select(KEY), "pipeline-rejected")
    return rows.join(rejected, KEY, "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passages beyond the contamination rule.

    Null and empty texts have no words and stay, repeated rows are judged alike, texts of any length whole. An empty table gives none.
    """
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in the text replaced by its kind. Null and empty texts stay as they are, repeated rows too."""
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document's tokens in training sequences. Null and empty texts have the end id alone; repeated rows and rows without an
    id are packed like any other, longer texts in pieces of a sequence."""
    return packing.best_fit_packing(docs, cache_words=PACKING_WORDS)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_contaminated),
          ("personal_data", mask_personal_data), ("packing", pack_sequences)]

# Toxicity and personal data come from trained models, which SQL cannot express; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in a row over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {**_queries.QUERIES, "pipeline": run}
SQL = _queries.SQL
