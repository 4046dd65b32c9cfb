import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
               .config("spark.python.sql.dataFrameDebugging.enabled", "false")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Value of one expression over literal columns."""

    def evaluate(column, **values):
        row = spark.createDataFrame([tuple(values.values()) or (0,)], _ddl(values)) if values else spark.range(1)
        return row.select(column.alias("v")).first()["v"]

    return evaluate


def _ddl(values):
    kinds = {str: "string", int: "bigint", float: "double", bool: "boolean", type(None): "string"}
    return ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items())
