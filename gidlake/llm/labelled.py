"""Bounded samples of labelled documents for fitting classifiers, and the calibration of their votes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gidlake.llm import common


def remainder(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def fit_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, per_class: int) -> DataFrame:
    """(doc_id, label, text) of at most `per_class` documents of each label, written once.

    `usable` says which doc_ids may be learned from. The documents are those with the smallest hashes of their ids, so the
    choice does not depend on order or size. An id labelled more than once counts with its largest label, an id with several
    rows with its smallest text. Labels without a document are left out.
    """
    rows = (labels.filter(usable & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
            .withColumn("h", F.xxhash64("doc_id")))
    present = rows.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    present = common.staged(present, "labelled-present")
    # Hashes are spread evenly, so those below this share of their range hold the smallest per_class of a label, but for a
    # chance in billions; then its smallest are ranked among about 1.5 * per_class rows, however many it has.
    sizes = {r.label: r["count"] for r in present.groupBy("label").count().collect()}
    share = F.create_map(*(F.lit(x) for label, n in (sizes or {0: 1}).items() for x in (label, min(1.0, (1.5 * per_class + 100) / n))))[F.col("label")]
    near = present.filter((F.col("h") / 2.0**64 + 0.5) <= share)
    ranked = near.withColumn("n", F.row_number().over(Window.partitionBy("label").orderBy("h", "doc_id")))
    chosen = common.staged(ranked.filter(F.col("n") <= per_class).select("doc_id", "label"), "labelled-ids")
    texts = common.id_text(docs).join(F.broadcast(chosen), "doc_id")
    return common.staged(texts.groupBy("doc_id", "label").agg(F.min("text").alias("text")), "labelled-texts")


class Isotonic:
    """Non-decreasing step function from votes to probabilities, fitted by pooling neighbours that violate the order.

    Each step is smoothed by half a document of either label, so no score is exactly 0 or 1.
    """

    def __init__(self, votes: np.ndarray, label: np.ndarray, weight: np.ndarray):
        steps: list[list[float]] = []
        for v in np.unique(votes):
            own = votes == v
            steps.append([float(v), float((weight * label)[own].sum()), float(weight[own].sum())])
            while len(steps) > 1 and steps[-2][1] * steps[-1][2] >= steps[-1][1] * steps[-2][2]:
                _, ones, total = steps.pop()
                steps[-1] = [steps[-1][0], steps[-1][1] + ones, steps[-1][2] + total]
        self.starts = np.array([s[0] for s in steps])
        self.values = np.array([(s[1] + 0.5) / (s[2] + 1.0) for s in steps])

    def __call__(self, votes: np.ndarray) -> np.ndarray:
        return self.values[np.maximum(np.searchsorted(self.starts, votes, "right") - 1, 0)]
