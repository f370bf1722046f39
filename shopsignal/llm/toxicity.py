"""Toxicity by class-conditional Kneser-Ney models.

Two models, of toxic and of ordinary text, give the likelihood of every
expression (a lower-cased word), and a text is judged by their log-likelihood
difference per expression: over the whole text, over its three strongest
expressions, and over the strongest one, so that a slur in a long text is not
averaged away.  A logistic calibration on documents that neither model saw
turns these figures into a score.

Counts are Kneser-Ney continuation counts (the number of different words an
expression follows), so a line repeated over and over counts once.  Each model
first gives the expression's stem, then the expression given the stem, both
with absolute discounting; the discounted mass goes to backoff counts that the
two models share.  An expression that is rare in both therefore says no more
than its stem, and one of an unknown stem says nothing.

The models are fitted on a bounded sample (``labels.sample``).  Only
expressions that some model counts above the discount are kept; the others'
value follows from their stem.

Defined cases: a null or empty text, or one without words, has all figures 0
and the score of such a text.  Without labelled rows of both classes the score
is the share of label 1.  Repeated rows score alike.  Only text is an input.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from math import log
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_or_empty
from .labels import Calibrator, calibrate, is_held_out, sample

WORD = re.compile(r"[^\W\d_]+")
STEM = 4  # letters
DISCOUNT = 2.0
THRESHOLD = 0.7
MAX_PER_CLASS = {0: 5000, 1: 2500}


def expressions(text: str) -> list[str]:
    return WORD.findall(text.lower())


class Model(NamedTuple):
    """Log-likelihood differences, toxic less ordinary."""

    words: dict[str, float]
    stems: dict[str, float]
    calibrator: Calibrator

    def figures(self, text: str) -> tuple[float, float, float, float]:
        found = expressions(text)
        if not found:
            return 0.0, 0.0, 0.0, 0.0
        word, stem = self.words.get, self.stems.get
        d = np.array([x if (x := word(w)) is not None else stem(w[:STEM], 0.0) for w in found])
        top = np.sort(np.partition(d, len(d) - 3)[-3:]) if len(d) > 3 else np.sort(d)
        return float(top[-1]), float(top.mean()), float(d.mean()), float(np.log1p(len(d)))

    def score(self, texts: Iterable[str]) -> np.ndarray:
        return self.calibrator(np.array([self.figures(t) for t in texts], float).reshape(-1, 4))


def _differences(texts: list[str], labels: np.ndarray, discount: float) -> tuple[dict[str, float], dict[str, float]]:
    pairs: tuple[set, set] = (set(), set())
    for text, y in zip(texts, labels.tolist()):
        words = expressions(text)
        pairs[y].update(zip(["", *words], words))
    count = [Counter(w for _, w in p) for p in pairs]
    total = [max(1, len(p)) for p in pairs]
    of_stem, freed, freed_in = [Counter(), Counter()], [0.0, 0.0], [Counter(), Counter()]
    for y in (0, 1):
        for w, c in count[y].items():
            of_stem[y][w[:STEM]] += c
            freed_in[y][w[:STEM]] += min(c, discount)
        freed[y] = sum(min(c, discount) for c in of_stem[y].values()) / total[y] or 1.0
    shared, shared_stem = count[0] + count[1], of_stem[0] + of_stem[1]

    def stem(y: int, s: str) -> float:
        return max(of_stem[y][s] - discount, 0) / total[y] + freed[y] * shared_stem[s] / (sum(total) + 1)

    def backoff(y: int, s: str) -> float:
        return freed_in[y][s] / of_stem[y][s] if of_stem[y][s] else 1.0

    known = {s: log(stem(1, s) / stem(0, s)) for s in shared_stem}
    stems = {s: d + log(backoff(1, s) / backoff(0, s)) for s, d in known.items()}
    words = {}
    for w, c in shared.items():
        if max(count[0][w], count[1][w]) > discount:
            s = w[:STEM]
            given = [max(count[y][w] - discount, 0) / max(1, of_stem[y][s]) + backoff(y, s) * c / (shared_stem[s] + 1)
                     for y in (0, 1)]
            words[w] = known[s] + log(given[1] / given[0])
    return words, stems


def train(docs: DataFrame, labels: DataFrame, max_per_class: dict[int, int] = MAX_PER_CLASS,
          discount: float = DISCOUNT) -> Model:
    s = sample(docs, labels, "toxic", max_per_class)
    fit = ~s.calibration
    words, stems = _differences([t for t, f in zip(s.texts, fit) if f], s.labels[fit], discount)
    model = Model(words, stems, calibrate(np.zeros((0, 4)), s.labels[:0], s.weights[:0]))
    rest = np.array([model.figures(t) for t, f in zip(s.texts, fit) if not f], float).reshape(-1, 4)
    return model._replace(calibrator=calibrate(rest, s.labels[~fit], s.weights[~fit]))


def score_column(spark: SparkSession, model: Model, text: Column) -> Column:
    """The score (0 to 1) of a text column."""
    shared = spark.sparkContext.broadcast(model)  # bounded by the training sample

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(texts))

    return run(text_or_empty(text))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = train(docs, labels)
    scored = docs.select("doc_id", is_held_out().alias("held_out"), score_column(spark, model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
