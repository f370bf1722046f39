"""Bounded labelled samples and calibration for the text classifiers.

Labels come only from rows whose crc32(doc_id as text) mod 3 is not 1.  At
most a fixed number of documents per class, none longer than a fixed length,
reach the driver; scoring covers every whole text.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out

MODULUS, HELD_OUT = 3, 1
MAX_PER_CLASS = {0: 6000, 1: 6000}  # documents of the training sample
MAX_CHARS = 20_000  # of one of them


class Sample(NamedTuple):
    texts: list[str]
    labels: np.ndarray
    calibration: np.ndarray  # kept out of the model, for its calibration
    weights: np.ndarray  # training rows one sampled row stands for


def is_held_out():
    return held_out(F.col("doc_id"), MODULUS, HELD_OUT)


def sample(docs: DataFrame, labels: DataFrame, label: str, max_per_class: dict[int, int] = MAX_PER_CLASS,
           max_chars: int = MAX_CHARS) -> Sample:
    """Of each class the training documents with the smallest id hashes, at most ``max_per_class`` of them."""
    rows = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~is_held_out()
    )
    totals = dict(rows.groupBy("label").count().collect())
    by_hash = lambda df, n: df.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(n)
    chosen = None
    for y, n in max_per_class.items():
        part = by_hash(rows.filter(F.col("label") == y).distinct(), n)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select("doc_id", "text").filter(F.char_length("text") <= max_chars)
    # The chosen ids are at most the sum of the class bounds; one text for each (equal ids: the least text).
    found = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    got = sorted(found.collect(), key=lambda r: (r["doc_id"], r["label"]))
    y = np.array([r["label"] for r in got], np.int64)
    per_class = np.bincount(y, minlength=2)
    weights = np.array([totals.get(int(k), 0) / max(1, per_class[k]) for k in y], float)
    calibration = np.array([zlib.crc32(f"calibration {r['doc_id']}".encode()) % 3 == 0 for r in got], bool)
    return Sample([r["text"] for r in got], y, calibration, weights)


class Calibrator(NamedTuple):
    """Logistic regression on a few standardised figures."""

    centre: np.ndarray
    scale: np.ndarray
    coefficients: np.ndarray  # the constant first

    def __call__(self, figures: np.ndarray) -> np.ndarray:
        z = self.coefficients[0] + (figures - self.centre) / self.scale @ self.coefficients[1:]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def calibrate(figures: np.ndarray, labels: np.ndarray, weights: np.ndarray, ridge: float = 0.1) -> Calibrator:
    """Fit by Newton steps; with one class only, or none, the constant share of label 1 (none: 0.5)."""
    k = figures.shape[1]
    if len(set(labels.tolist())) < 2:
        share = (weights @ labels + 0.5) / (weights.sum() + 1)
        return Calibrator(np.zeros(k), np.ones(k), np.array([np.log(share / (1 - share)), *[0.0] * k]))
    centre, scale = figures.mean(0), figures.std(0) + 1e-9
    x = np.column_stack([np.ones(len(labels)), (figures - centre) / scale])
    weights = weights * len(weights) / weights.sum()
    w = np.zeros(k + 1)
    loss = lambda w: weights @ np.logaddexp(0, (1 - 2 * labels) * (x @ w)) + ridge / 2 * (w @ w)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        gradient = x.T @ (weights * (p - labels)) + ridge * w
        hessian = (x * (weights * p * (1 - p))[:, None]).T @ x + ridge * np.eye(k + 1)
        step = np.linalg.solve(hessian, gradient)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return Calibrator(centre, scale, w)
