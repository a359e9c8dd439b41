"""Quality classifier: a conditional random field over lines, summed up to documents."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import crf
from . import textkernel as tk
from .language_id import remainder
from .shared import without

#: Labelled documents that the model is fitted on, about.
SAMPLE = 2000


@dataclass
class Model:
    field: crf.Field
    slope: float
    base: float

    def shares(self, texts: pa.Array) -> np.ndarray:
        """For each text the mean probability that a line is good, weighted by the lines' lengths."""
        x, weight, first = crf.line_features(texts)
        bad, _, _ = self.field.marginals(x, first, expect=False)
        return np.add.reduceat(weight * (1 - bad), first[:-1]) / np.add.reduceat(weight, first[:-1])

    def scores(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.base + self.slope * self.shares(texts), -500, 500)))


def _logistic(s: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and base of P(y = 1) given s: Newton steps on the penalised likelihood."""
    x, b = np.stack([s, np.ones_like(s)], axis=1), np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        b = b - np.linalg.solve(h, x.T @ (p - y) + 1e-2 * b)
    return float(b[0]), float(b[1])


def fit(texts: list[str], quality: np.ndarray, refine: int = 2) -> Model:
    """Fits the field to documents of known quality; the labels of lines are not known.

    First all lines of a document have its label. Then a line of a bad document that the field
    finds good is taken as good (but for the worst line of each), and the field is fitted again.
    Good and bad documents weigh the same in all. With one kind of document only, or none, every
    score is that kind's, or one half.
    """
    column = pa.array(texts, pa.large_string())
    if len(texts) == 0 or quality.min() == quality.max():
        at = 0.0 if len(texts) == 0 else (4.0 if quality[0] else -4.0)
        return Model(crf.Field(np.zeros(crf.WIDTH), np.zeros((2, 2))), 0.0, at)
    x, _, first = crf.line_features(column)
    is_bad = quality == 0
    of = np.repeat(np.arange(len(texts)), np.diff(first))
    bad = is_bad[of].astype(np.float64)
    weight = np.where(is_bad, len(texts) / (2 * is_bad.sum()), len(texts) / (2 * (~is_bad).sum()))
    field = crf.train(x, first, bad, weight)
    for _ in range(refine):
        p, _, _ = field.marginals(x, first)
        worst = np.maximum.reduceat(p, first[:-1])
        bad = (is_bad[of] & ((p >= 0.5) | (p >= worst[of]))).astype(np.float64)
        field = crf.train(x, first, bad, weight, field, 30)
    model = Model(field, 0.0, 0.0)
    model.slope, model.base = _logistic(model.shares(column), quality.astype(np.float64))
    del x, field
    tk.lean()
    return model


def training_sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Texts and labels of about `most` labelled documents that are not held out, chosen by a hash of the id.

    Labels are counted first, so the share drawn keeps the sample, and the list of ids that is
    broadcast, at about `most` rows whatever the size of the corpus. An id with both labels counts
    as bad; labels without a quality are left out.
    """
    spark = docs.sparkSession
    own = labels.where("doc_id is not null and quality is not null").where(remainder("doc_id") != 1).groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    n = own.count()
    draw = F.pmod(F.xxhash64(F.lit(19), "doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    ids = [(r.doc_id, r.quality) for r in own.where(draw < min(1.0, most / max(1, n))).collect()]
    if not ids:
        return [], np.zeros(0, dtype=int)
    chosen = spark.createDataFrame(ids, "_id long, _quality int")
    rows = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text")).join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).groupBy("_id", "_quality").agg(F.min("_text").alias("_text")).collect()
    rows.sort(key=lambda r: r["_id"])
    return [r["_text"] for r in rows], np.array([r["_quality"] for r in rows], dtype=int)


def score_quality(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """All columns of docs, with held_out, score and predicted, in one pass without a shuffle.

    Every line of a document is labelled good or bad by a linear-chain conditional random field over
    features of the line and its neighbours; forward-backward marginals, weighted by the lines'
    lengths, make the document's share of good text, and a logistic fit turns that into score, the
    probability of label 1. predicted is 1 from 0.5 up. The model is fitted on the driver on a
    bounded sample (`training_sample`) and sent with the tasks.

    Null and empty texts are one empty line and have a score, too. Texts of any length are scored
    whole, about `textkernel.PART_BYTES` at a time. A null doc_id is neither held out nor learned
    from. Repeated rows get the same score, and an empty table gives an empty one. A column of docs
    that is named like a result, in whatever case, is replaced.
    """
    model = fit(*training_sample(docs, labels, most))
    own = without(docs, "held_out", "score", "predicted")

    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tk.lean()
        for batch in texts:
            whole = pa.record_batch([batch.cast(pa.large_string())], names=["text"])
            yield pa.array(np.concatenate([np.zeros(0), *[model.scores(part.column(0).fill_null("")) for part in tk.parts(whole, 0)]]), pa.float64())

    # only texts go to Python; not deterministic, so that a filter on the score doesn't have it made twice
    scored = F.arrow_udf(score, "double").asNondeterministic()
    rows = docs.select(*own, F.coalesce(remainder("doc_id") == 1, F.lit(False)).alias("held_out"), scored(F.col("text").cast("string")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
