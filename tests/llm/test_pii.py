"""op1: base patterns against plain searches, the field's training, decoding and additions."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from gidlake.llm import pii
from tests.llm.conftest import ODD


def plain(text):
    def found(kind, pattern, ok):
        return [(kind, *m.span()) for m in re.finditer(pattern, text) if ok(m.group())]

    def digits(t):
        return re.sub("[^0-9]", "", t)

    return (found("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda t: True)
            + found("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda t: all(int(x) <= 255 for x in t.split(".")))
            + found("card", r"[0-9]([\x20-]?[0-9])+", lambda t: 13 <= len(digits(t)) <= 19 and pii.luhn(digits(t)))
            + found("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: 9 <= len(digits(t)) <= 15))


@pytest.fixture(scope="module")
def model():
    return pii.ChainCRF(pii.seed_table())


def test_base_spans():
    rng = random.Random(1)
    for _ in range(8000):
        text = "".join(rng.choices("a1@.+- ()9é%4\n", k=rng.randint(0, 60)))
        assert pii.base_spans(text) == plain(text), text


def test_luhn():
    assert pii.luhn("4539578763621486") and not pii.luhn("4539578763621487")


def test_long_odd_texts_take_linear_time():
    text = "1" * 200_000 + "a" * 200_000 + "@" * 2000 + ".1" * 100_000
    assert all(e <= len(text) for _, _, e in pii.base_spans(text)) and pii.sequences(text)


def test_field_learns_its_table(model):
    table = pii.seed_table(300, seed=99)
    decoded = model.decode([t for t, _ in table])
    right = sum([pii.LABELS[i] for i in own] == tags for own, (_, tags) in zip(decoded, table, strict=True))
    assert right >= 0.97 * len(table)


def test_viterbi_is_the_best_path(model):
    for tokens in (["(578)", "555-6437"], ["+1", "12.3.4.5", "a@b.de"]):
        score = np.array([model.weights[[model.index[f] for f in own if f in model.index]].sum(0) for own in pii.features(tokens)])

        def total(path, score=score):
            return sum(score[t, s] for t, s in enumerate(path)) + sum(model.moves[a, b] for a, b in itertools.pairwise(path))

        best = max(itertools.product(range(len(pii.LABELS)), repeat=len(tokens)), key=total)
        assert np.isclose(total(model.decode([tokens])[0]), total(best))


@pytest.mark.parametrize("text, added", [("call (578) 555-6437 now", [("phone", 5, 19)]), ("x 578-555-6437.", [("phone", 2, 14)]), ("see 2024-05-01 12:30 and 2.0.", []),
                                         ("id 1234567890123456 of 300.300.1.1", []), ("+1 (632) 555-4827", []), ("", [])])
def test_additions(model, text, added):
    assert pii.find_spans([text], model)[0][1] == added


def test_query_rows(docs_of, sf, model):
    rows = [(r.doc_id, r.text) for r in sf("documents").collect()]
    for row in pii.personal_data(docs_of(rows + ODD), model).collect():
        texts = [t or "" for d, t in rows + ODD if d == row.doc_id]
        base = [plain(t) for t in texts]
        digests = [hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in b).encode()).hexdigest() for b in base]
        assert row.base_sha256 in digests
        own = base[digests.index(row.base_sha256)]
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(x[0] == k for x in own) for k in pii.KINDS]
        assert {f"{k}:{s}:{e}" for k, s, e in own} <= set(row.spans.split(","))


def test_masking(spark, docs_of, model):
    assert pii.masked("a b@c.de +1 (632) 555-4827 x", pii.base_spans("a b@c.de +1 (632) 555-4827 x")) == "a <EMAIL> <PHONE> x"
    docs = docs_of([(1, "a b@c.de"), (2, None), (3, "clean"), (3, "clean")])
    out = {(r.doc_id, r.text, r.n_chars) for r in pii.redact(docs, model).collect()}
    assert out == {(1, "a <EMAIL>", 9), (2, None, 0), (3, "clean", 5)} and pii.redact(docs, model).columns == docs.columns


def test_trained_from_documents_and_empty(docs_of, sf):
    assert pii.personal_data(sf("documents")).count() == sf("documents").count()
    assert pii.personal_data(docs_of([])).count() == 0


def test_many_spans_in_one_text():
    """Added spans are held against base spans in order, so double the text takes about double the time."""
    import time

    spans = [("ip", 20 * i, 20 * i + 9) for i in range(100_000)]
    free = pii._outside(spans)
    assert not free(5, 6) and not free(0, 100) and free(9, 20) and free(2_000_000, 2_000_001) and not free(25, 41)
    assert all(pii._outside([("ip", 0, 50), ("ip", 3, 4)])(a, b) == (a >= 50) for a, b in ((10, 20), (49, 60), (50, 60)))
    begun = time.perf_counter()
    assert sum(free(20 * i + 9, 20 * i + 20) for i in range(100_000)) == 100_000
    assert time.perf_counter() - begun < 5
