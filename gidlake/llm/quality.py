"""op8: text quality by similarity-weighted votes of labelled neighbours in a latent-semantic space."""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gidlake.llm import common, labelled

FOLDS, HELD_OUT, ACCEPT = 4, 2, 0.7
# Bounds of the fitted model: labelled documents of each label, dimensions, neighbours that vote.
EXAMPLES, DIMENSIONS, NEIGHBOURS = 2000, 48, 25
# Documents whose cosine products are held at once.
BLOCK = 256
# Bytes of a text counted at once.
PART = 1 << 20

_GROUPS = [range(97, 123), range(65, 91), range(48, 58), b" \t", b"\n\r\x0b\x0c", range(128, 256), b".,", b"|", b"!?", b"#$%&*^~", b"\"'()[]{}"]
_CLASS = np.full(256, len(_GROUPS), np.int64)
for _number, _group in enumerate(_GROUPS):
    _CLASS[list(_group)] = _number
_N = len(_GROUPS) + 1
# Terms: every trigram of character classes, then words like the one before, words seen before, and lines seen before.
TERMS = _N**3 + 3


def term_rates(text: bytes) -> np.ndarray:
    """How often each term comes in a text, per thousand bytes (words, lines), on a logarithmic scale."""
    rates = np.zeros(TERMS)
    if not text:
        return rates
    for at in range(0, len(text), PART):
        classes = _CLASS[np.frombuffer(text[at:at + PART + 2], np.uint8)]
        rates[:_N**3] += np.bincount(classes[:-2] * _N * _N + classes[1:-1] * _N + classes[2:], minlength=_N**3)
    words, lines = text.split(), text.split(b"\n")
    n = len(words)
    extra = (sum(map(eq, words, words[1:])) / max(n, 1), 1 - len(set(words)) / max(n, 1), 1 - len(set(lines)) / len(lines))
    rates[:_N**3] /= len(text)
    rates[_N**3:] = extra
    return np.log1p(1000 * rates)


class Model:
    """Labelled vectors in the space of the strongest singular directions of the labelled term matrix."""

    def __init__(self, rates: np.ndarray, label: np.ndarray, prior: float):
        self.prior, self.label = prior, label.astype(float)
        self.idf = np.log((1 + len(rates)) / (1 + (rates > 0).sum(0))) + 1
        weighted = self._unit(rates * self.idf)
        values, vectors = np.linalg.eigh(weighted.T @ weighted)
        self.basis = vectors[:, ::-1][:, :DIMENSIONS] if len(rates) else np.zeros((TERMS, 1))
        self.vectors = self._unit(weighted @ self.basis)
        share = np.where(label == 1, prior / max((label == 1).sum(), 1), (1 - prior) / max((label == 0).sum(), 1)) * max(len(label), 1)
        self.weight = share
        self.calibration = None
        if len(label) > 1 and 0 < label.sum() < len(label):
            votes = np.concatenate([self.votes(self.vectors[i:i + BLOCK], np.arange(i, min(i + BLOCK, len(label)))) for i in range(0, len(label), BLOCK)])
            self.calibration = labelled.Isotonic(votes, label, share)

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)

    def place(self, rates: np.ndarray) -> np.ndarray:
        return self._unit(self._unit(rates * self.idf) @ self.basis)

    def votes(self, vectors: np.ndarray, leave: np.ndarray | None = None) -> np.ndarray:
        """Share of label 1 among the nearest labelled vectors, weighted by similarity; ties of the last all vote."""
        cosine = np.round(vectors @ self.vectors.T, 9)
        if leave is not None:
            cosine[np.arange(len(leave)), leave] = -1
        k = min(NEIGHBOURS, cosine.shape[1])
        last = np.partition(cosine, -k, axis=1)[:, -k][:, None]
        weight = np.where((cosine >= last) & (cosine > 0), cosine**16 * self.weight, 0)
        total = weight.sum(1)
        return np.divide(weight @ self.label, total, out=np.full(len(vectors), self.prior), where=total > 0)

    def scores(self, rates: np.ndarray) -> np.ndarray:
        if self.calibration is None:
            return np.full(len(rates), self.prior)
        return self.calibration(self.votes(self.place(rates)))


def _rates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    common.release()
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("rates", pa.binary())])
    for batch in common.slices(batches):
        yield common.record_batch([batch.column("doc_id"), batch.column("label"),
                                   [term_rates(t).astype(np.float32).tobytes() for t in batch.column("text").to_pylist()]], schema)


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> Model:
    """Learn from at most `examples` labelled documents of each label outside the held-out fold.

    The prior is the share of label 1 among all usable labels, and scores are calibrated for it. With labels of one kind
    only, or none, every score is that share, or 0.5 without labels.
    """
    usable = labelled.remainder(F.col("doc_id"), FOLDS) != HELD_OUT
    rows = (labelled.fit_sample(docs, labels, "quality", usable, examples)
            .mapInArrow(_rates, "doc_id long, label int, rates binary").orderBy("doc_id").collect())
    prior = labels.filter(usable & F.col("quality").isin(0, 1)).agg(F.avg("quality")).first()[0]
    rates = np.array([np.frombuffer(r.rates, np.float32) for r in rows], float).reshape(-1, TERMS)
    return Model(rates, np.array([r.label for r in rows], int), 0.5 if prior is None else float(prior))


_SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    common.release()
    for batch in common.slices(batches):
        texts = batch.column("text").to_pylist()
        scores = [model.scores(np.array([term_rates(t) for t in texts[i:i + BLOCK]])) for i in range(0, len(texts), BLOCK)]
        yield common.record_batch([batch.column("doc_id"), np.concatenate(scores)], _SCORED)


def score(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """op8: (doc_id, held_out, score, predicted) of every document, from exact cosines with all labelled vectors.

    A text without terms, such as an empty or null one, has no neighbours and scores what the calibration makes of the
    prior. Repeated rows are scored alike; a null id is not held out. Texts of any length are counted whole, a part at a time; an
    empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs, labels))
    scored = common.id_text(docs).mapInArrow(lambda batches: _score(batches, shared.value), "doc_id long, score double")
    held = F.coalesce(labelled.remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
