"""op2: toxicity by the nearest labelled examples under exact TF-IDF cosine, from a block-max inverted index."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gidlake.llm import common, labelled

FOLDS, HELD_OUT = 5, 0
# Bounds of the fitted model: examples of each label, terms kept, neighbours that vote.
EXAMPLES, VOCABULARY, NEIGHBOURS = 2500, 4096, 15
# A term must go with one label this clearly (chi-squared, one degree of freedom) and be in so many examples.
CHI_SQUARED, LEAST_EXAMPLES = 30.0, 2
# Examples under one maximum of the index.
BLOCK = 64
# Words and queries remembered by one Python worker.
REMEMBERED = 200_000

_WORD = re.compile(r"[^\W\d_]+")
_PREFIXES = (3, 4, 5, 6, 7)


def word_terms(word: str) -> list[str]:
    """A word and its first letters, which stand for inflected forms."""
    return [word, *(f"{word[:n]}*" for n in _PREFIXES if len(word) > n)]


def term_counts(text: bytes) -> Counter:
    counts: Counter = Counter()
    for word, n in Counter(_WORD.findall(text.decode("utf-8", "replace").lower())).items():
        for term in word_terms(word):
            counts[term] += n
    return counts


class BlockMaxIndex:
    """Example vectors by term: postings cut at blocks of examples, with the largest weight of every block.

    A query bounds each block by the maxima of its terms and opens blocks from the highest bound down, until the bound
    falls below the k-th best exact cosine. Ties of the k-th are all seen; the smaller example id wins.
    """

    def __init__(self, vectors: list[dict[int, float]], ids: list[int], label: list[int], weight: list[float], n_terms: int):
        lead = [max(v, key=lambda t: (v[t], -t)) if v else n_terms for v in vectors]
        order = sorted(range(len(ids)), key=lambda i: (lead[i], ids[i]))
        self.ids, self.label, self.weight = (np.array([x[i] for i in order]) for x in (ids, label, weight))
        self.blocks = -(-len(order) // BLOCK)
        postings: dict[int, tuple[list[int], list[float]]] = {}
        for place, i in enumerate(order):
            for term, w in vectors[i].items():
                post = postings.setdefault(term, ([], []))
                post[0].append(place)
                post[1].append(w)
        self.postings = {}
        for term, (places, weights) in postings.items():
            p, w = np.array(places), np.array(weights)
            most = np.zeros(self.blocks)
            np.maximum.at(most, p // BLOCK, w)
            self.postings[term] = (p, w, np.searchsorted(p, np.arange(self.blocks + 1) * BLOCK), most)

    def nearest(self, query: dict[int, float], k: int, leave: int | None = None) -> list[tuple[float, int]]:
        """(cosine, place) of the k nearest examples that share a term, nearest first; `leave` is a place to pass over."""
        own = [(w, self.postings[t]) for t, w in sorted(query.items()) if t in self.postings]
        if not own:
            return []
        bound = sum(w * p[3] for w, p in own)
        best: list[tuple[float, int, int]] = []
        for b in np.argsort(-bound, kind="stable").tolist():
            if bound[b] <= 0 or len(best) >= k and bound[b] < -best[k - 1][0] - 1e-12:
                break
            scores = np.zeros(BLOCK)
            for w, (places, weights, cuts, _) in own:
                part = slice(cuts[b], cuts[b + 1])
                scores[places[part] - b * BLOCK] += w * weights[part]
            best += [(-round(float(scores[i]), 12), int(self.ids[b * BLOCK + i]), b * BLOCK + i)
                     for i in np.flatnonzero(scores > 0).tolist() if b * BLOCK + i != leave]
            best.sort()
            del best[k:]
        return [(-s, place) for s, _, place in best]


class Model:
    """The fitted classifier: terms with their inverse document frequencies, the index, and the calibration of votes."""

    def __init__(self, idf: dict[str, float], examples: list[tuple[int, int, dict[str, int]]], prior: float):
        self.terms = {t: i for i, t in enumerate(sorted(idf))}
        self.idf = [idf[t] for t in sorted(idf)]
        vectors = [self.vector(counts) for _, _, counts in examples]
        ones = sum(label for _, label, _ in examples)
        share = {1: prior / max(ones, 1), 0: (1 - prior) / max(len(examples) - ones, 1)}
        weight = [share[label] * len(examples) for _, label, _ in examples]
        self.prior = prior
        self.index = BlockMaxIndex(vectors, [d for d, _, _ in examples], [y for _, y, _ in examples], weight, len(self.terms))
        by_id = {int(d): p for p, d in enumerate(self.index.ids)}
        votes = np.array([self.vote(self.index.nearest(v, NEIGHBOURS, by_id[d])) for v, (d, _, _) in zip(vectors, examples, strict=True)])
        self.calibration = labelled.Isotonic(votes, np.array([y for _, y, _ in examples]), np.array(weight)) if examples else None

    def vector(self, counts: dict[str, int]) -> dict[int, float]:
        raw = {self.terms[t]: (1 + math.log(n)) * self.idf[self.terms[t]] for t, n in counts.items() if t in self.terms}
        norm = math.sqrt(sum(w * w for _, w in sorted(raw.items())))
        return {t: w / norm for t, w in raw.items()}

    def vote(self, found: list[tuple[float, int]]) -> float:
        """Share of label 1 among the neighbours, each weighing its cosine and its label's share of all labelled rows.

        One more vote of weight 1 - cosine of the nearest goes to the prior; without neighbours that is all.
        """
        near = found[0][0] if found else 0.0
        rest = 1 - near + 1e-9
        mine = [(s * self.index.weight[p], self.index.label[p]) for s, p in found]
        return float((sum(w * y for w, y in mine) + rest * self.prior) / (sum(w for w, _ in mine) + rest))

    def score(self, found: list[tuple[float, int]]) -> float:
        return float(self.calibration(np.array([self.vote(found)]))[0]) if self.calibration else self.prior


def _sample_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    common.release()
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("terms", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
    for batch in common.slices(batches):
        counts = [term_counts(t) for t in batch.column("text").to_pylist()]
        yield common.record_batch([batch.column("doc_id"), batch.column("label"), [list(c) for c in counts], [list(c.values()) for c in counts]], schema)


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, vocabulary: int = VOCABULARY) -> Model:
    """Learn from at most `examples` labelled documents of each label outside the held-out fold.

    Terms are kept by chi-squared of term and label over those examples, the clearest `vocabulary` of them; the prior is the
    share of label 1 among all usable labels. Without any labels the model scores 0, with one label only it scores its share.
    """
    usable = labelled.remainder(F.col("doc_id"), FOLDS) != HELD_OUT
    sample = labelled.fit_sample(docs, labels, "toxic", usable, examples)
    terms = common.staged(sample.mapInArrow(_sample_terms, "doc_id long, label int, terms array<string>, counts array<long>"), "op2-terms")
    n1, n0 = (int(x or 0) for x in terms.agg(F.sum("label"), F.sum(1 - F.col("label"))).first())
    prior = labels.filter(usable & F.col("toxic").isin(0, 1)).agg(F.avg("toxic")).first()[0] or 0.0
    if not n1 or not n0:
        return Model({}, [], float(prior))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    apart = a * (n0 - b) - b * (n1 - a)
    chi = (n1 + n0) * apart * apart / ((a + b) * (n1 + n0 - a - b) * n1 * n0)
    kept = (terms.select("label", F.explode("terms").alias("term")).groupBy("term")
            .agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
            .filter((a + b >= LEAST_EXAMPLES) & (a + b < n1 + n0)).withColumn("chi", chi).filter(F.col("chi") >= CHI_SQUARED)
            .orderBy(F.desc("chi"), "term").limit(vocabulary).collect())
    idf = {r.term: math.log((1 + n1 + n0) / (1 + r.a + r.b)) + 1 for r in kept}
    wanted = F.broadcast(docs.sparkSession.createDataFrame([(t,) for t in idf] or [("",)], "term string"))
    own = (terms.select("doc_id", "label", F.explode(F.arrays_zip("terms", "counts")).alias("z"))
           .select("doc_id", "label", F.col("z.terms").alias("term"), F.col("z.counts").alias("n")).join(wanted, "term")
           .groupBy("doc_id").agg(F.collect_list(F.struct("term", "n")).alias("own")))
    rows = terms.select("doc_id", "label").join(own, "doc_id", "left").collect()
    return Model(idf, [(r.doc_id, r.label, {x.term: x.n for x in r.own or []}) for r in sorted(rows, key=lambda r: r.doc_id)], float(prior))


_SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("evidence", pa.string())])


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch, rows in _scored_batches(batches, model):
        yield common.record_batch([batch.column("doc_id"), [r[0] for r in rows], [r[1] for r in rows]], _SCORED)


def _scored_batches(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[tuple[pa.RecordBatch, list[tuple[float, str]]]]:
    """Batches of rows with a column `text`, and the score and evidence of each row."""
    common.release()
    of_word: dict[str, tuple[int, ...]] = {}
    seen: dict[tuple, tuple[float, str]] = {}
    for batch in common.slices(batches):
        rows = []
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            counts: Counter = Counter()
            for word, n in Counter(_WORD.findall((text or b"").decode("utf-8", "replace").lower())).items():
                own = of_word.get(word)
                if own is None:
                    if len(of_word) >= REMEMBERED:
                        of_word.clear()
                    own = of_word[word] = tuple(t for t in word_terms(word) if t in model.terms)
                for term in own:
                    counts[term] += n
            key = tuple(sorted(counts.items()))
            if key not in seen:
                if len(seen) >= REMEMBERED:
                    seen.clear()
                found = model.index.nearest(model.vector(counts), NEIGHBOURS)
                seen[key] = model.score(found), " ".join(f"{model.index.ids[p]}:{model.index.label[p]}:{s:.4f}" for s, p in found[:3])
            rows.append(seen[key])
        yield batch, rows


def without_toxic(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """docs without the rows that are predicted toxic. Every row is judged where it is, whatever its id; odd rows as in score."""
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows in _scored_batches(batches, shared.value):
            yield batch.filter(pa.array([s < 0.5 for s, _ in rows], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def score(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """op2: (doc_id, held_out, score, predicted, evidence) of every document.

    evidence lists up to three neighbours as id:label:cosine. A text without known terms, such as an empty or null one, has
    no neighbours and gets the score of such examples. Repeated rows are scored alike; a null id is not held out. Texts of any
    length are read whole; an empty table gives no rows, and without labels of both kinds every score is their share of label 1.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs, labels))
    scored = common.id_text(docs).mapInArrow(lambda batches: _score(batches, shared.value), "doc_id long, score double, evidence string")
    held = F.coalesce(labelled.remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")
