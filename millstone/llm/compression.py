"""Operator 7: quality by zstandard dictionaries of good and bad text.

Two dictionaries are built from labelled texts, one of each class.  A text is
compressed in pieces of ``PIECE`` bytes (so a dictionary counts from the first
to the last) with either; the difference of the compressed sizes over their
sum is calibrated to the probability of class 1 by a logistic fit.

Training reads at most ``TRAIN_PER_CLASS`` labelled texts per class (smallest
hash of the id), on the driver; two thirds build the dictionaries, one third
calibrates, weighted to the class frequencies of all labelled rows.  Every text
is scored whole, in the tasks.

Defined cases: NULL and empty texts have difference 0; a NULL doc_id has a NULL
``held_out`` (it is in no fold) and is scored; repeated rows are each scored, very
long texts whole, piece by piece; NULL labels are not labels; conflicting labels of an id each count; without labels of both
classes the score is the share of the one class (0 without any); empty
documents give no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millstone.llm.common import table
from millstone.llm.subwords import _sigmoid, fold, labelled_sample, logistic

PIECE = 1024
DICT_BYTES = 1 << 16
LEVEL = 3
TRAIN_PER_CLASS = 1500
CUT = 0.5


@dataclass
class QualityModel:
    good: bytes
    bad: bytes
    mean: float
    sd: float
    coef: np.ndarray
    constant: float | None = None


def _pieces(text: bytes) -> list[bytes]:
    return [text[i: i + PIECE] for i in range(0, len(text), PIECE)]


def build_dictionary(texts: list[bytes], size: int = DICT_BYTES) -> bytes:
    """Dictionary of a class; too little text is its own dictionary."""
    samples = [p for t in texts for p in _pieces(t) if len(p) >= 8]
    try:
        return zstandard.train_dictionary(size, samples, k=200, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


class Compressors:
    """Compressed sizes of a text with either dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        self.with_dict = []
        for d in (good, bad):
            kept = zstandard.ZstdCompressionDict(d)
            kept.precompute_compress(level=LEVEL)
            self.with_dict.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=kept, write_content_size=False))

    def difference(self, text: bytes) -> float:
        """Normalised difference of the two sizes; 0 for an empty text."""
        if not text:
            return 0.0
        pieces = _pieces(text)
        good, bad = (sum(len(c.compress(p)) for p in pieces) for c in self.with_dict)
        return (bad - good) / (bad + good)


def _design(x: np.ndarray, mean: float, sd: float) -> np.ndarray:
    z = np.clip((x - mean) / sd, -6, 6)
    return np.column_stack([np.ones(len(z)), z])


def fit_quality(texts: list[str], y: np.ndarray, share: float) -> QualityModel:
    y = np.asarray(y)
    if len(set(y.tolist())) < 2:
        return QualityModel(b"", b"", 0.0, 1.0, np.zeros(2), constant=share)
    raw = [t.encode() for t in texts]
    back = np.arange(len(y)) % 3 == 2
    good, bad = (build_dictionary([raw[i] for i in np.flatnonzero(~back & (y == c))]) for c in (1, 0))
    c = Compressors(good, bad)
    x, yb = np.array([c.difference(raw[i]) for i in np.flatnonzero(back)]), y[back]
    weight = np.where(yb == 1, share / max(yb.mean(), 1e-9), (1 - share) / max(1 - yb.mean(), 1e-9))
    mean, sd = float(x.mean()), float(x.std()) + 1e-9
    return QualityModel(good, bad, mean, sd, logistic(_design(x, mean, sd), yb, weight, 0.1))


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """All columns of ``docs`` plus ``_score`` (double)."""
    if model.constant is not None:
        return docs.withColumn("_score", F.lit(float(model.constant)))
    cols = docs.columns
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), F.col("text").alias("t"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        c = Compressors(m.good, m.bad)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array([c.difference(t or b"") for t in batch.column(1).cast(pa.large_binary()).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_sigmoid(_design(x, m.mean, m.sd) @ m.coef))], names=["row", "_score"])

    return src.mapInArrow(run, src.select("row").schema.add("_score", "double")).select("row.*", "_score")


def train_quality(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_PER_CLASS) -> QualityModel:
    """Model from the labelled rows outside the held-out fold (crc32 % 3 = 1)."""
    return fit_quality(*labelled_sample(docs, labels.where(fold("doc_id", 3) != 1), "quality", per_class))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, train_quality(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), F.col("_score").alias("score"),
                         (F.col("_score") >= CUT).cast("int").alias("predicted"))
