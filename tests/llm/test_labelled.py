"""op2 and op8: exactness of the index, held-out accuracy, no use of held-out labels, odd inputs."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gidlake.llm import common, labelled, quality, toxicity
from tests.llm.conftest import ODD


def held(doc_id, folds, which):
    return zlib.crc32(str(doc_id).encode()) % folds == which


@pytest.mark.parametrize("operator, label, folds, which, least", [(toxicity, "toxic", 5, 0, 0.9), (quality, "quality", 4, 2, 0.97)])
def test_held_out_accuracy_and_labels(spark, operator, label, folds, which, least):
    docs, labels = (common.table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    rows = operator.score(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == held(r.doc_id, folds, which) and 0 <= r.score <= 1 for r in rows)
    out = [r for r in rows if r.held_out]
    assert sum(r.predicted == r[label] for r in out) >= least * len(out)
    flipped = labels.withColumn(label, F.when(labelled.remainder(F.col("doc_id"), folds) == which, 1 - F.col(label)).otherwise(F.col(label)))
    few = docs.filter("doc_id < 300")
    assert sorted(operator.score(few, flipped).collect()) == sorted(operator.score(few, labels).collect())


@pytest.mark.parametrize("operator, label", [(toxicity, "toxic"), (quality, "quality")])
def test_odd_inputs(spark, docs_of, operator, label):
    docs = docs_of(ODD)
    labels = spark.createDataFrame([(4, 1, 1), (5, 0, 0), (5, 0, 0), (8, 1, 0), (9, 0, 1), (1, None, None), (99, 1, 1)], "doc_id long, quality int, toxic int")
    for given in (labels, labels.filter("doc_id = 4"), labels.limit(0)):
        rows = operator.score(docs, given).collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert operator.score(docs_of([]), labels).count() == 0


def test_block_max_index_is_exact():
    rng = np.random.default_rng(0)
    vectors = [{int(t): float(w) for t, w in zip(rng.choice(30, 4, replace=False), np.round(rng.random(4), 1), strict=True)} for _ in range(600)]
    index = toxicity.BlockMaxIndex(vectors, list(range(600)), [0] * 600, [1.0] * 600, 30)
    for query in [*vectors[:60], {}, {99: 1.0}]:
        scores = [(-round(sum(w * v.get(t, 0) for t, w in sorted(query.items())), 12), i) for i, v in enumerate(vectors)]
        wanted = [i for s, i in sorted(scores)[:15] if s < 0]
        assert [int(index.ids[p]) for _, p in index.nearest(query, 15)] == wanted


def test_isotonic_pools_violators():
    fitted = labelled.Isotonic(np.array([0.1, 0.2, 0.3, 0.4]), np.array([0, 1, 0, 1]), np.ones(4))
    values = fitted(np.array([0.0, 0.1, 0.25, 0.35, 0.9]))
    assert (np.diff(values) >= 0).all() and values[2] == values[3] == pytest.approx(1.5 / 3)


def test_sample_is_bounded_and_stable(spark, docs_of):
    docs = docs_of([(i, f"t{i}") for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, toxic int")
    a, b = (sorted(labelled.fit_sample(docs, x, "toxic", F.lit(True), 7).select("doc_id", "label").collect()) for x in (labels, labels.orderBy(F.desc("doc_id"))))
    assert a == b and [sum(r.label == k for r in a) for k in (0, 1)] == [7, 7]


def test_quality_votes_are_those_of_all_labelled_vectors():
    """Votes against a plain loop over every labelled vector, in blocks of any size."""
    rng = np.random.default_rng(4)
    texts = [bytes(rng.choice(list(b"abc ABC 12.,\n|#"), size=rng.integers(1, 400)).tolist()) for _ in range(300)] + [b"", b"same text", b"same text"]
    rates = np.array([quality.term_rates(t) for t in texts])
    label = rng.integers(0, 2, len(texts))
    model = quality.Model(rates, label, 0.4)
    placed = model.place(rates)
    for i in (0, 5, 299, 300, 301):
        cosine = sorted(((round(float(placed[i] @ v), 9), j) for j, v in enumerate(model.vectors)), reverse=True)
        last = cosine[quality.NEIGHBOURS - 1][0]
        near = [(c, j) for c, j in cosine if c >= last and c > 0]
        weights = [c**16 * float(model.weight[j]) for c, j in near]
        wanted = sum(w for w, (_, j) in zip(weights, near, strict=True) if label[j]) / sum(weights) if sum(weights) else 0.4
        assert model.votes(placed[i:i + 1])[0] == pytest.approx(wanted, rel=1e-6)
        assert model.votes(placed)[i] == pytest.approx(wanted, rel=1e-6)
    assert np.allclose(model.scores(rates), np.concatenate([model.scores(rates[k:k + 7]) for k in range(0, len(rates), 7)]))


def test_toxic_held_out_recall(spark):
    """Label 1 itself, not accuracy: nine of ten documents carry label 0. Of the 97 held out here 86 are found; the others are junk or ordinary
    text with a label of 1."""
    docs, labels = (common.table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    rows = toxicity.score(docs, labels).join(labels.filter("toxic = 1"), "doc_id").filter("held_out").collect()
    assert len(rows) > 30 and sum(r.predicted for r in rows) >= 0.85 * len(rows)
