"""op10 against exhaustive search: exact where windows cover everything, recall beyond."""

import numpy as np
import pytest

from gidlake.llm import neighbours as nn


def plain(rows, every=50, k=5):
    usable = {i: np.array(v, float) for i, v in rows if i is not None and v and len(v) == 3 and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    ids = np.array(sorted(usable))
    matrix = np.stack([usable[i] for i in ids])
    out = {}
    for q in ids[ids % every == 0].tolist():
        score = nn.cosines(np.repeat(usable[q][None], len(ids), 0), matrix)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != q][:k]
        out[q] = [(n + 1, int(ids[j]), float(score[j])) for n, j in enumerate(order)]
    return out


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def test_ties_copies_and_unusable_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 0.0, 2.0]) for i in range(200)] + [(200 + i, rng.normal(size=3).tolist()) for i in range(150)]
    rows += [(400, None), (450, [0.0, 0.0, 0.0]), (500, [1.0, None, 0.0]), (550, [float("nan"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (600, [2.0, 0.0, 4.0]),
             (650, [1.0, 2.0]), (700, [float("inf"), 1.0, 1.0]), (750, []), (3, [1.0, 0.0, 2.0])]
    table = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<double>, rep int, vec string")
    assert found(nn.nearest_neighbours(table)) == plain(rows)


def test_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    assert nn.nearest_neighbours(spark.createDataFrame([], schema)).count() == 0
    assert nn.nearest_neighbours(spark.createDataFrame([(1, [1.0])], schema)).count() == 0
    assert nn.nearest_neighbours(spark.createDataFrame([(0, [1.0])], schema)).count() == 0
    assert [tuple(r)[:3] for r in nn.nearest_neighbours(spark.createDataFrame([(0, [1.0, 2.0]), (7, [2.0, 1.0])], schema)).collect()] == [(0, 1, 7)]


@pytest.mark.parametrize("window, curves", [(64, 16)])
def test_recall(spark, monkeypatch, window, curves):
    monkeypatch.setattr(nn, "WINDOW", window)
    monkeypatch.setattr(nn, "CURVES", curves)
    rng = np.random.default_rng(2)
    matrix = rng.normal(size=(2000, 16))
    got = found(nn.nearest_neighbours(spark.createDataFrame(list(enumerate(matrix.tolist())), "vec_id long, embedding array<double>")))
    unit = matrix / np.linalg.norm(matrix, axis=1)[:, None]
    hits = 0
    for q, rows in got.items():
        score = unit @ unit[q]
        score[q] = -2
        hits += len(set(np.argsort(-score)[:5].tolist()) & {v for _, v, _ in rows})
    assert len(got) == 40 and hits >= 0.9 * 5 * len(got)


@pytest.mark.parametrize("asked_bytes", [16 << 20, 300])
def test_exact_answers_where_curves_fall_short(spark, monkeypatch, asked_bytes):
    for name, value in {"WINDOW": 2, "CURVES": 1, "ROUNDS": 1, "ASKED_BYTES": asked_bytes, "TILE_QUERIES": 7, "TILE_VECTORS": 100}.items():
        monkeypatch.setattr(nn, name, value, raising=False)
    rows = list(enumerate(np.random.default_rng(3).normal(size=(1500, 3)).tolist()))
    table = nn.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert found(table) == plain(rows)
    assert {r.recall for r in table.select("recall").collect()} == {1.0}


@pytest.mark.parametrize("dimensions, bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_visits_neighbours(dimensions, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions), -1).reshape(-1, dimensions)
    keys = nn.hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()
