"""The stages against plain versions of their decisions, and the queries against SQL."""

import duckdb
import pytest

import corpus_pipeline as pipeline
from gidlake.llm import decontamination, pii, queries, simhash, toxicity
from gidlake.llm.common import staged, table
from tests.llm.conftest import ODD

SF_DIR = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_the_clean(spark):
    docs = table(spark, SF_DIR, "documents")
    for (name, stage), _ in zip(pipeline.STAGES[:-1], range(9), strict=False):
        before = docs.collect()
        after = staged(stage(spark, docs, SF_DIR), "test-stage")
        assert after.dtypes == docs.dtypes, name
        kept = {r.doc_id for r in after.collect()}
        if name == "toxicity":
            wanted = {r.doc_id for r in toxicity.score(docs, table(spark, SF_DIR, "labels")).filter("predicted = 0").collect()}
        elif name == "near_duplicates":
            wanted = {r.component_id for r in simhash.simhash_components(docs).collect()}
        elif name == "decontamination":
            wanted = {r.doc_id for r in decontamination.contamination(docs, table(spark, SF_DIR, "benchmark")).filter("not contaminated").collect()}
        else:
            wanted = {r.doc_id for r in before}
            assert not any(pii.base_spans(r.text) for r in after.collect())
            assert all(a.n_chars == len(a.text) for a in after.collect())
        assert kept == wanted, name
        docs = after
    packed = pipeline.run(spark, SF_DIR)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def test_odd_documents_go_through(spark, docs_of):
    docs = docs_of(ODD).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in pipeline.STAGES:
        docs = staged(stage(spark, docs, SF_DIR), "test-odd")
    assert docs.count() > 0
    docs = docs_of([]).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in pipeline.STAGES:
        docs = staged(stage(spark, docs, SF_DIR), "test-none")
    assert docs.count() == 0


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def test_rows_of_one_id_and_of_none_are_judged_by_themselves(spark, docs_of):
    larger = "/root/testdata/sf0.01"  # the smallest table has no document that is judged toxic
    docs = table(spark, larger, "documents")
    scored = toxicity.score(docs, table(spark, larger, "labels"))
    toxic = docs.join(scored.filter("predicted = 1").select("doc_id"), "doc_id").first().text
    clean = [f"text number {i} " + " ".join(f"w{i}x{k}" for k in range(30)) for i in range(4)]
    passage = max((r.text for r in table(spark, larger, "benchmark").collect()), key=len)
    rows = [(7, clean[0]), (7, clean[1]), (7, toxic), (None, toxic), (None, clean[2]), (8, passage), (None, passage), (8, clean[3])]
    real = docs.select(*COLUMNS)

    def after(stage, *more):
        out = stage(spark, real.unionByName(docs_of([*rows, *more]).select(*COLUMNS)), larger)
        wanted = [t for _, t in [*rows, *more]]
        return sorted(((r.doc_id, r.text) for r in out.filter(out.text.isin(wanted)).collect()), key=repr)

    left = after(pipeline.drop_toxic)
    assert not any(t == toxic for _, t in left) and {(7, clean[0]), (7, clean[1]), (None, clean[2]), (8, clean[3])} <= set(left)
    left = after(pipeline.drop_contaminated)
    assert not any(t == passage for _, t in left) and {(7, clean[0]), (7, clean[1]), (None, clean[2]), (8, clean[3])} <= set(left)
    left = after(pipeline.drop_near_duplicates, (7, clean[0]), (3, clean[2]), (None, clean[3]))
    assert [x for x in left if x[1] in clean] == sorted([(7, clean[0]), (7, clean[1]), (3, clean[2]), (8, clean[3])], key=repr)


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} == {name.split("_")[0] for name in pipeline.QUERIES}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "embeddings", "conversations"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    result = duck.execute(queries.SQL[name])
    columns = [d[0] for d in result.description]
    frame = pipeline.QUERIES[name](spark, SF_DIR).select(columns)
    assert sorted(map(tuple, frame.collect()), key=repr) == sorted(result.fetchall(), key=repr)
