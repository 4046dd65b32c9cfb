import pytest

from gidlake.llm import common

DOC = "doc_id long, text string, lang string, source string, n_chars long, label string, spans string, score string, curve string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents rows from (doc_id, text), with further columns whose names clash with inner ones."""

    def make(rows):
        return spark.createDataFrame([(d, t, None, "s", len(t or ""), "x", "y", None, "z") for d, t in rows], DOC)

    return make


@pytest.fixture(scope="session")
def sf(spark):
    return lambda name: common.table(spark, "/root/testdata/sf0.001", name)


# Null and empty texts, white space only, repeated rows, a null id, ids repeated with other texts, marks, a very long text.
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "A b c. A b c."), (5, "A b c. A b c."), (6, "other"), (6, "another"), (None, "no id"),
       (7, "é \U0001d4b3 ñandú\x00x"), (8, "word " * 30000), (9, "x" * 150000), (-3, "negative")]
