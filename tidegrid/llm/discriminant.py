"""A quality classifier: regularised quadratic discriminant over transformed document statistics.

Every text gives a fixed vector of statistics (shares, logarithms).  Per class, count, sum and sum of outer products are aggregated over all
labelled training rows: a few hundred numbers, whatever the number of rows.  The class covariance is shrunk towards the pooled one,
and that towards its diagonal; its Cholesky factor is computed once, and a score is the logistic of the difference of the two
log densities (squared Mahalanobis distances through the cached factors) plus the log prior odds.

Defined cases: null and empty texts have the statistics of a text without words and are scored like others; rows without a label do
not train; a document labelled twice counts twice if the labels differ, else once; without training rows of a class the score is the
share of class 1 (0.5 without any); null ids are scored; an empty table gives an empty table; other columns do not matter.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm import textbatch as tb
from tidegrid.llm.frames import col
from tidegrid.session import stage

FOLDS = 5
SHRINK_TO_POOLED, SHRINK_TO_DIAGONAL, FLOOR = 0.2, 0.1, 1e-3
THRESHOLD = 0.3


def _flags(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in characters]] = True
    return out


_SYMBOL = _flags("#*$%&|<>")
_STRAY = _flags("!?=~^_{}[]\\@+")
_POINT = _flags(".,;:")
_UPPER = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _flags("0123456789")
_LINE = _flags("\n")
_WIDE = np.arange(256) >= 0xC0
_CHAR = (np.arange(256) & 0xC0) != 0x80

STATISTICS = (
    "words", "word_length", "symbols", "stray", "points", "upper", "digits", "wide", "line_length", "bare_words",
    "same_as_before", "distinct", "repeated_runs", "long_words",
)


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(np.float64)


def _distinct(keys: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """Distinct keys per text."""
    own = keys ^ tb.mix(owner.astype(np.uint64) + np.uint64(1))
    _, at = np.unique(own, return_index=True)
    return np.bincount(owner[at], minlength=texts).astype(np.float64)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``STATISTICS`` per text."""
    w = tb.words(data, offsets)
    n = w.counts().astype(np.float64)
    words, texts = np.maximum(n, 1.0), len(n)
    spaces = _per_text(tb._SPACE[data], offsets)
    chars = np.maximum(_per_text(_CHAR[data], offsets) - spaces, 0.0)
    letters = np.maximum(chars, 1.0)
    lengths = w.ends - w.starts
    owner = w.text_of()

    def share(flags: np.ndarray) -> np.ndarray:
        return np.sqrt(_per_text(flags[data], offsets) / letters)

    def of_words(flags: np.ndarray) -> np.ndarray:
        return np.sqrt(np.bincount(owner[flags], minlength=texts) / words)

    bare = np.zeros(len(lengths), bool)
    if len(lengths):
        bare = (lengths == 1) & (_SYMBOL | _STRAY | _POINT)[w.data[w.starts]]
    same = np.append(False, (w.hashes[1:] == w.hashes[:-1]) & (owner[1:] == owner[:-1]))[: len(owner)]
    at = tb.run_starts(w.first, 3)
    runs = tb.runs(w.hashes, 3)[at] if len(at) else np.empty(0, np.uint64)
    run_owner = owner[at] if len(at) else np.empty(0, np.int64)
    n_runs = np.bincount(run_owner, minlength=texts)
    columns = [
        np.log1p(n),
        np.log1p(chars / words),
        share(_SYMBOL),
        share(_STRAY),
        share(_POINT),
        share(_UPPER),
        share(_DIGIT),
        share(_WIDE),
        np.log1p(n / (_per_text(_LINE[data], offsets) + 1.0)),
        of_words(bare),
        of_words(same),
        np.log1p(_distinct(w.hashes, owner, texts)) / np.log1p(words + 1.0),
        np.sqrt(1.0 - _distinct(runs, run_owner, texts) / np.maximum(n_runs, 1) * (n_runs > 0) - (n_runs == 0)),
        of_words(lengths > 24),
    ]
    return np.stack(columns, axis=1)


class Model(NamedTuple):
    """Everything a score needs; classes 0 and 1."""

    prior: tuple[float, float]
    center: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, np.ndarray] | None
    factors: tuple[np.ndarray, np.ndarray] | None
    log_determinants: tuple[float, float] | None


def fit(n: np.ndarray, total: np.ndarray, outer: np.ndarray, shrink: float = SHRINK_TO_POOLED, flatten: float = SHRINK_TO_DIAGONAL) -> Model:
    """From per-class counts (2,), sums (2, d) and sums of outer products (2, d, d)."""
    everything = n.sum()
    prior = (float(n[0] / everything), float(n[1] / everything)) if everything else (0.5, 0.5)
    d = total.shape[1]
    if n.min() < 2:
        return Model(prior, np.zeros(d), np.ones(d), None, None, None)
    center = total.sum(axis=0) / everything
    spread = np.diag(outer.sum(axis=0)) / everything - center**2
    scale = np.sqrt(np.maximum(spread, 1e-12))
    means = [(total[c] / n[c] - center) / scale for c in (0, 1)]
    within = []
    for c in (0, 1):
        raw = outer[c] / n[c] - np.outer(total[c], total[c]) / n[c] ** 2
        within.append(raw / np.outer(scale, scale))
    pooled = (n[0] * within[0] + n[1] * within[1]) / everything
    goal = (1 - flatten) * pooled + flatten * np.diag(np.diag(pooled))
    factors, dets = [], []
    for c in (0, 1):
        factor = np.linalg.cholesky((1 - shrink) * within[c] + shrink * goal + FLOOR * np.eye(d))
        factors.append(np.linalg.inv(factor))
        dets.append(2.0 * float(np.log(np.diag(factor)).sum()))
    return Model(prior, center, scale, tuple(means), tuple(factors), tuple(dets))


def score(model: Model, x: np.ndarray) -> np.ndarray:
    """The probability of class 1 for rows of statistics."""
    if model.means is None:
        return np.full(len(x), model.prior[1])
    z = (x - model.center) / model.scale
    density = []
    for c in (0, 1):
        away = (z - model.means[c]) @ model.factors[c].T
        density.append(np.log(model.prior[c]) - 0.5 * (model.log_determinants[c] + (away**2).sum(axis=1)))
    return 1.0 / (1.0 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, stats`` per row."""

    def describe(batches):
        for batch in batches:
            for row, to, data, offsets in tb.chunks(batch.column(1)):
                stats = statistics(data, offsets)
                flat = pa.array(stats.reshape(-1), pa.float64())
                ends = pa.array(np.arange(len(stats) + 1, dtype=np.int32) * stats.shape[1])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, to - row), pa.ListArray.from_arrays(ends, flat)], names=["doc_id", "stats"])

    light = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text"))
    return light.mapInArrow(describe, "doc_id long, stats array<double>")


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), len(STATISTICS))


def train(stats: DataFrame, labels: DataFrame, **shrinkage) -> Model:
    """Fit on all rows of ``labels`` (``doc_id, label``); only sums reach the driver."""
    size = len(STATISTICS)

    def sums(batches):
        held = np.zeros((2, 1 + size + size * size))
        for batch in batches:
            x, y = _matrix(batch.column(1)), batch.column(0).to_numpy()
            for c in (0, 1):
                own = x[y == c]
                held[c] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).reshape(-1)])
        n = held.shape[1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([0, 1], n).astype(np.int32)), pa.array(np.tile(np.arange(n), 2).astype(np.int32)), pa.array(held.reshape(-1))], names=["label", "place", "value"]
        )

    known = labels.filter("doc_id IS NOT NULL AND label IN (0, 1)").select("doc_id", F.col("label").cast("int").alias("label")).distinct()
    rows = stats.join(known, "doc_id").select("label", "stats").mapInArrow(sums, "label int, place int, value double")
    moments = np.zeros((2, 1 + size + size * size))
    for label, place, value in rows.groupBy("label", "place").agg(F.sum("value")).collect():  # 2 * (1 + d + d * d) numbers
        moments[label, place] = value
    return fit(moments[:, 0], moments[:, 1 : 1 + size], moments[:, 1 + size :].reshape(2, size, size), **shrinkage)


def scored(stats: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted``."""

    def run(batches):
        for batch in batches:
            s = score(model, _matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return stats.mapInArrow(run, "doc_id long, score double, predicted int")


def fold(id_column: Column, folds: int = FOLDS) -> Column:
    """crc32 of the id as text, modulo; a null id counts as an empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % folds


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", folds: int = FOLDS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; trained on the labelled rows outside fold 0."""
    stats = stage(described(docs, id_col, text_col), "discriminant-stats")
    marked = labels.select(col(id_col).cast("long").alias("doc_id"), col(label_col).alias("label"))
    model = train(stats, marked.filter(fold(F.col("doc_id"), folds) != 0))
    return scored(stats, model).withColumn("held_out", fold(F.col("doc_id"), folds) == 0).select("doc_id", "held_out", "score", "predicted")
