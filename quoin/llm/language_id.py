"""Language ID: the family first, then one-versus-one linear support vector machines within it."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as tk

#: Hashed letter trigrams.
BITS = 12
#: Most documents that the model is fitted on, for each language and in all.
SAMPLE_PER_LANGUAGE, SAMPLE = 400, 4000


def trigrams(texts: list[str]) -> np.ndarray:
    """Rows of unit length: square roots of hashed byte-trigram counts of each whole lower-case text."""
    data, offsets = tk.buffer(pa.array([f" {t.lower()} " for t in texts], pa.large_string()))
    out = np.zeros((len(texts), 1 << BITS), dtype=np.float32)
    if len(data) > 2:
        data = np.where(data < 33, np.uint8(32), data).astype(np.uint32)
        code = (data[:-2] << 16 | data[1:-1] << 8 | data[2:]) * np.uint32(0x9E3779B1) >> np.uint32(32 - BITS)
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            out[i] = np.bincount(code[a : max(a, b - 2)], minlength=1 << BITS)
    np.sqrt(out, out=out)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def svm(x: np.ndarray, positive: np.ndarray, reach: float = 50.0, steps: int = 150) -> np.ndarray:
    """Weights and bias of a linear support vector machine: squared hinge loss, accelerated gradient steps."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)]).astype(np.float64)
    y = np.where(positive, 1.0, -1.0)
    c = reach * np.where(positive, 0.5 / max(1, positive.sum()), 0.5 / max(1, (~positive).sum()))
    w = v = np.zeros(x.shape[1])
    rate = 1.0 / (1.0 + 4.0 * c.sum())
    for k in range(steps):
        slack = np.maximum(0.0, 1.0 - y * (x @ v))
        to = v - rate * (v - 2.0 * x.T @ (c * y * slack))
        w, v = to, to + (k / (k + 3.0)) * (to - w)
    return w


@dataclass
class Model:
    families: list[list[str]]
    family: np.ndarray  # one row of weights for each family, the bias last
    pairs: dict[tuple[str, str], np.ndarray]

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        x = trigrams(texts)
        x1 = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)])
        names, scores = [""] * len(texts), np.zeros(len(texts))
        sure = lambda margin: 1.0 / (1.0 + np.exp(-4.0 * np.clip(margin, -50, 50)))
        margins = x1 @ self.family.T
        chosen = margins.argmax(axis=1)
        rest = margins.copy()
        rest[np.arange(len(x)), chosen] = -np.inf
        first = sure((margins.max(axis=1) - rest.max(axis=1)) / 2) if len(self.families) > 1 else np.ones(len(x))
        for f, members in enumerate(self.families):
            mine = np.flatnonzero(chosen == f)
            if not len(mine):
                continue
            votes, sums = np.zeros((len(mine), len(members))), np.zeros((len(mine), len(members)))
            least = np.full((len(mine), len(members)), np.inf)
            for (a, b), w in self.pairs.items():
                if a in members:
                    i, j = members.index(a), members.index(b)
                    m = x1[mine] @ w
                    votes[:, i] += m >= 0
                    votes[:, j] += m < 0
                    sums[:, i] += m
                    sums[:, j] -= m
                    least[:, i] = np.minimum(least[:, i], m)
                    least[:, j] = np.minimum(least[:, j], -m)
            best = (votes + 1e-3 * np.tanh(sums)).argmax(axis=1)  # equal votes: the larger sum of margins
            scores[mine] = first[mine] * np.where(np.isinf(least[np.arange(len(mine)), best]), 1.0, sure(least[np.arange(len(mine)), best]))
            for k, b in zip(mine.tolist(), best.tolist()):
                names[k] = members[b]
        return names, np.clip(scores, 0.0, 1.0).tolist()


def families(centres: np.ndarray, names: list[str], n: int) -> list[list[str]]:
    """Groups of languages with like trigrams: the two groups whose least like members are most alike are joined until n are left."""
    groups = [[i] for i in range(len(names))]
    like = centres @ centres.T
    while len(groups) > n:
        _, a, b = max((min(like[i, j] for i in groups[a] for j in groups[b]), -a, -b) for a in range(len(groups)) for b in range(a + 1, len(groups)))
        groups[-a] += groups.pop(-b)
    return [sorted(names[i] for i in g) for g in groups]


def fit(x: np.ndarray, langs: list[str]) -> Model | None:
    """The model of rows of trigrams and their languages; None without any."""
    names = sorted(set(langs))
    if not names:
        return None
    y = np.array(langs)
    centres = np.array([x[y == n].mean(axis=0) for n in names])
    centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
    groups = families(centres, names, max(1, math.isqrt(len(names))))
    family = np.array([svm(x, np.isin(y, g)) if len(groups) > 1 else np.zeros(x.shape[1] + 1) for g in groups]).astype(np.float32)
    pairs = {}
    for g in groups:
        for i, a in enumerate(g):
            for b in g[i + 1 :]:
                some = np.flatnonzero((y == a) | (y == b))
                pairs[a, b] = svm(x[some], y[some] == a).astype(np.float32)
    return Model(groups, family, pairs)


def remainder(doc_id):
    """crc32 of the id as text, modulo 3; null for a null id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))


def training_sample(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, most: int = SAMPLE) -> tuple[np.ndarray, list[str]]:
    """Trigrams and languages to learn from: about per_language for each language, `most` in all, chosen by a hash of the row.

    Only documents that are not held out, with a text that has a letter and a language. The driver
    holds a count for each language, as the model has weights for each, and the sample's trigrams,
    6 bytes for each that occurs, whatever the lengths of its texts.
    """
    known = docs.select("doc_id", F.col("text").cast("string"), "lang").where(F.col("lang").isNotNull() & (remainder("doc_id") != 1))
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return np.zeros((0, 1 << BITS), dtype=np.float32), []
    each = max(2, min(per_language, most // len(counts)))
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, each / n))])
    draw = F.pmod(F.xxhash64(F.lit(17), "doc_id", "text"), F.lit(1 << 20)) / F.lit(float(1 << 20))

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in tk.parts(batch, 0, rows=256)):
            x = trigrams(part.column(0).to_pylist())
            held = [np.flatnonzero(row) for row in x]
            yield pa.record_batch([part.column(1), pa.array([h.astype("<u2").tobytes() for h in held], pa.binary()), pa.array([row[h].astype("<f4").tobytes() for row, h in zip(x, held)], pa.binary())], names=["lang", "at", "x"])

    chosen = known.where(F.col("text").rlike(r"\p{L}") & (draw < F.element_at(share, F.col("lang")))).select("text", F.col("lang").cast("string"))
    rows = sorted(chosen.mapInArrow(sparse, "lang string, at binary, x binary").collect(), key=lambda r: (r["lang"], bytes(r["at"]), bytes(r["x"])))
    x = np.zeros((len(rows), 1 << BITS), dtype=np.float32)
    for row, r in zip(x, rows):
        row[np.frombuffer(r["at"], "<u2")] = np.frombuffer(r["x"], "<f4")
    return x, [r["lang"] for r in rows]


def language_id(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, most: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row of docs, in one pass without a shuffle.

    The model is fitted on the driver on a bounded sample (see `training_sample`); languages fall
    into about the square root of their number of families, by the likeness of their trigrams. A
    linear machine for each family picks the family; pairwise machines vote within it. score is
    the family's confidence times that of the closest pair.

    Texts that are null, empty or without a letter are `und` with score 0, as is every text where
    no language could be learned. A null doc_id is neither held out nor learned from; a null lang
    is not learned from. Texts of any length are read whole. Equal votes go to the larger sum of
    margins, then to the language that is first by name. Repeated rows get the same prediction, and an
    empty table gives an empty one. Other columns, of whatever name, are ignored.
    """
    model = fit(*training_sample(docs, per_language, most))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tk.lean()
        for part in (part for batch in batches for part in tk.parts(batch, 1, rows=256)):
            texts = [t or "" for t in part.column(1).to_pylist()]
            names, scores = ["und"] * len(texts), [0.0] * len(texts)
            full = [i for i, t in enumerate(texts) if any(map(str.isalpha, t))]
            if model and full:
                for i, name, score in zip(full, *model.predict([texts[i] for i in full])):
                    names[i], scores[i] = name, score
            yield pa.record_batch([part.column(0), part.column(2), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    held = F.coalesce(remainder("doc_id") == 1, F.lit(False)).alias("held_out")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), held).mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")
