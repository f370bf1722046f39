"""Quality by compression: how much better does text compress after good text than after bad?

Two zstandard dictionaries are built, from labelled good and from labelled bad
texts.  A text is compressed in short chunks against both, each chunk on its
own, so the dictionary (and not what the text repeats of itself) decides.  The
difference of the two sizes per byte, beside the size with the good dictionary
per byte, goes through a logistic calibration fitted on documents that are in
neither dictionary.

The dictionaries come from a bounded sample (``labels.sample``); every whole
text is scored.

Defined cases: a null or empty text has no bytes, both figures are 0, and it
gets the score of such a text.  Without labelled rows of both classes the score
is the share of label 1.  Repeated rows score alike.  Only text is an input.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_or_empty
from .labels import Calibrator, calibrate, is_held_out, sample

LEVEL = 3
CHUNK = 512  # bytes compressed at a time
PIECE = 2048  # bytes of a dictionary sample
DICTIONARY = 1 << 16
MAX_SAMPLES = 8000  # pieces a dictionary is built from
THRESHOLD = 0.5
MAX_PER_CLASS = {0: 4000, 1: 4000}


def dictionary(texts: list[str]) -> bytes:
    """A zstandard dictionary of the texts; too few to train one: their last bytes, as plain content."""
    pieces = [raw[i:i + PIECE] for t in texts if (raw := t.encode()) for i in range(0, len(raw), PIECE)]
    pieces = pieces[:: -(-len(pieces) // MAX_SAMPLES)] if pieces else []  # evenly from all texts
    try:
        return zstandard.train_dictionary(DICTIONARY, pieces, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICTIONARY:]


class Model:
    def __init__(self, good: bytes, bad: bytes, calibrator: Calibrator):
        self.good, self.bad, self.calibrator = good, bad, calibrator
        self._compressors = None

    def __getstate__(self):
        return self.__dict__ | {"_compressors": None}

    def _compress(self):
        if self._compressors is None:
            def compressor(content: bytes):
                words = zstandard.ZstdCompressionDict(content) if content else None
                if words:
                    words.precompute_compress(level=LEVEL)
                return zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_content_size=False,
                                                write_dict_id=False, write_checksum=False).compress

            self._compressors = compressor(self.good), compressor(self.bad)
        return self._compressors

    def figures(self, text: str) -> tuple[float, float]:
        raw = text.encode()
        if not raw:
            return 0.0, 0.0
        good, bad = self._compress()
        chunks = [raw[i:i + CHUNK] for i in range(0, len(raw), CHUNK)]
        a, b = sum(len(good(c)) for c in chunks), sum(len(bad(c)) for c in chunks)
        return (b - a) / len(raw), a / len(raw)

    def score(self, texts: Iterable[str]) -> np.ndarray:
        return self.calibrator(np.array([self.figures(t) for t in texts], float).reshape(-1, 2))


def train(docs: DataFrame, labels: DataFrame, max_per_class: dict[int, int] = MAX_PER_CLASS) -> Model:
    s = sample(docs, labels, "quality", max_per_class)
    fit = ~s.calibration
    good, bad = (dictionary([t for t, f, y in zip(s.texts, fit, s.labels) if f and y == k]) for k in (1, 0))
    model = Model(good, bad, calibrate(np.zeros((0, 2)), s.labels[:0], s.weights[:0]))
    rest = np.array([model.figures(t) for t, f in zip(s.texts, fit) if not f], float).reshape(-1, 2)
    model.calibrator = calibrate(rest, s.labels[~fit], s.weights[~fit])
    return model


def score_column(spark: SparkSession, model: Model, text: Column) -> Column:
    """The score (0 to 1, good is high) of a text column."""
    shared = spark.sparkContext.broadcast(model)  # two dictionaries of at most DICTIONARY bytes

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(texts))

    return run(text_or_empty(text))


def keep_good(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with exactly the columns of ``docs``."""
    return docs.filter(score_column(docs.sparkSession, model, F.col(f"`{text}`")) >= threshold)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = train(docs, labels)
    scored = docs.select("doc_id", is_held_out().alias("held_out"), score_column(spark, model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
