"""A toxicity classifier: bags of subword embeddings averaged into a linear softmax, embeddings and softmax trained jointly.

A word (a run without white space, A-Z lower-cased, punctuation at both ends taken off) is the mean of the embeddings of itself and of
its character 3- to 5-grams with marked ends, hashed into ``BUCKETS`` rows; so a misspelling never seen in training shares most of its
vectors with the word it comes from.  A passage is the mean of about ``PASSAGE`` consecutive words, and a linear softmax over it gives
the log odds that it is from a text of class 1.  Averaging a whole text at once would drown a few insults in thousands of words, so a
text's evidence is the mean, over its passages, of what each exceeds even odds by (at most ``MOST``), and a logistic curve of one
variable, fitted on texts that the embeddings were not trained on, turns it into a probability.

Training is full-batch Adam on the cross-entropy of the passages, in one Spark task, on a bounded sample of the labelled rows: at most
``TRAIN_ROWS`` documents and ``TRAIN_BYTES`` bytes, whole texts, the smallest hashes of their ids.  Buckets of fewer than ``MIN_TEXTS``
training texts stay at zero.  The model that scores is one number per bucket, what it adds to the difference of the two classes, and three more:
a fixed size.  Every text is scored whole.

Defined cases: null and empty texts, and texts of punctuation, have no passage and no evidence; rows without a label do not train; a
document labelled twice counts twice if the labels differ, else once; repeated rows train once; without training rows of both
classes the score is the share of class 1 (0.5 without any); null ids are scored but do not train; an empty table gives an empty
table; other columns do not matter.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm import textbatch as tb
from tidegrid.llm.discriminant import fold
from tidegrid.llm.frames import col

FOLDS, THRESHOLD = 5, 0.5
BUCKETS, DIMENSIONS, PASSAGE = 1 << 18, 8, 8
SHORTEST, LONGEST = 3, 5
TRAIN_ROWS, TRAIN_BYTES, MIN_TEXTS = 4096, 16 << 20, 10
EPOCHS, RATE, SCALE, DECAY, SEED = 30, 0.05, 16.0, 2e-5, 7
MOST, NEAR_ZERO, HELD_BACK = 6.0, 0.02, 4
_U = np.uint64

_PLAIN = np.ones(256, bool)  # bytes that are not ASCII punctuation, control or white space
_PLAIN[:0x30] = _PLAIN[0x3A:0x41] = _PLAIN[0x5B:0x61] = _PLAIN[0x7B:0x80] = False
_HEAD = (np.arange(256) & 0xC0) != 0x80
_BYTE = tb.constants(256, 41)
_STEP = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Bags(NamedTuple):
    """Passages of some texts as words, and the distinct words as buckets."""

    word: np.ndarray  # of every word of the texts: its number among the distinct words
    passage_first: np.ndarray  # the word at which each passage begins (one more entry)
    text_first: np.ndarray  # the passage at which each text begins (one more entry)
    bucket: np.ndarray  # buckets of all distinct words end to end
    bucket_first: np.ndarray  # where each distinct word's buckets begin (one more entry)


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its count, end to end."""
    total = int(counts.sum())
    first = np.cumsum(counts) - counts
    return np.repeat(starts - first, counts) + np.arange(total)


def subwords(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words ``data[starts[i]:ends[i]]``, end to end, and where each word's begin.

    Every word stands between ``<`` and ``>``; its n-grams are counted in code points, and the marked word itself is one more.
    """
    lengths = ends - starts
    marked = np.full(int((lengths + 2).sum()), ord("<"), np.uint8)
    first = np.concatenate([[0], np.cumsum(lengths + 2)])
    marked[first[1:] - 1] = ord(">")
    marked[_ranges(first[:-1] + 1, lengths)] = data[_ranges(starts, lengths)]
    heads = np.flatnonzero(_HEAD[marked])
    heads_end = np.append(heads, len(marked))
    char_first = np.searchsorted(heads, first)
    total = np.zeros(len(marked) + 1, _U)
    np.cumsum(_BYTE[marked] * tb.powers(_STEP, len(marked)), out=total[1:])
    back = tb.powers(_INVERSE, len(marked) + 1)

    def hashed(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return tb.mix((total[end] - total[begin]) * back[begin] + (end - begin).astype(_U)) % _U(BUCKETS)

    chars = np.diff(char_first)
    parts = [(np.arange(len(starts)), hashed(first[:-1], first[1:]))]
    for n in range(SHORTEST, LONGEST + 1):
        grams = np.maximum(chars - n + 1, 0)
        at = _ranges(char_first[:-1], grams)
        # a gram that is the whole marked word is that word
        parts.append((np.repeat(np.arange(len(starts)), grams), hashed(heads_end[at], heads_end[at + n])))
    owner = np.concatenate([p[0] for p in parts])
    bucket = np.concatenate([p[1] for p in parts]).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    return bucket[order], np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(starts)))])


def bags(data: np.ndarray, offsets: np.ndarray) -> Bags:
    """Words, passages and buckets of the texts ``data[offsets[i]:offsets[i + 1]]``."""
    w = tb.words(data, offsets, lower=True)
    plain = np.flatnonzero(_PLAIN[w.data])
    low, high = np.searchsorted(plain, w.starts), np.searchsorted(plain, w.ends)
    kept = high > low  # a word of punctuation alone is none
    starts, ends, owner = plain[low[kept]], plain[high[kept] - 1] + 1, w.text_of()[kept]
    total = np.zeros(len(w.data) + 1, _U)
    np.cumsum(_BYTE[w.data] * tb.powers(_STEP, len(w.data)), out=total[1:])
    key = tb.mix((total[ends] - total[starts]) * tb.powers(_INVERSE, len(w.data) + 1)[starts] + (ends - starts).astype(_U))
    _, one, word = np.unique(key, return_index=True, return_inverse=True)
    bucket, bucket_first = subwords(w.data, starts[one], ends[one])
    n = np.bincount(owner, minlength=len(offsets) - 1)
    passages = np.where(n > 0, np.maximum(n // PASSAGE, 1), 0)
    text_first = np.concatenate([[0], np.cumsum(passages)])
    within = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    passage = text_first[owner] + within * passages[owner] // np.maximum(n[owner], 1)
    return Bags(word, np.searchsorted(passage, np.arange(text_first[-1] + 1)), text_first, bucket, bucket_first)


def _means(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Means of the runs of ``values`` that begin at ``first``; no run is empty."""
    if len(first) < 2:
        return values[:0]
    counts = np.diff(first).astype(values.dtype)
    return np.add.reduceat(values, first[:-1], axis=0) / counts.reshape(-1, *[1] * (values.ndim - 1))


class Model(NamedTuple):
    """What each bucket and the bias add to the log odds of a passage, and the curve from evidence to log odds of a text; ``table`` is
    None where nothing could be learnt."""

    table: np.ndarray | None
    bias: float
    slope: float
    level: float


def evidence(model: Model, b: Bags) -> np.ndarray:
    """Of every text: the mean over its passages of what their log odds exceed 0 by."""
    n = np.diff(b.text_first)
    if model.table is None or len(b.word) == 0:
        return np.zeros(len(n))
    of_word = _means(model.table[b.bucket].astype(np.float64), b.bucket_first)
    of_passage = np.clip(model.bias + _means(of_word[b.word], b.passage_first), 0.0, MOST)
    return np.bincount(np.repeat(np.arange(len(n)), n), of_passage, len(n)) / np.maximum(n, 1)


def score(model: Model, b: Bags) -> np.ndarray:
    """The probability of class 1 of every text."""
    return 1.0 / (1.0 + np.exp(-np.clip(model.level + model.slope * np.log(evidence(model, b) + NEAR_ZERO), -700, 700)))


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and level of a logistic regression on one variable, by Newton steps with a little ridge."""
    design, beta = np.stack([x, np.ones_like(x)], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (p - y) + 0.1 * beta
        curvature = design.T @ (design * (p * (1 - p))[:, None]) + 0.1 * np.eye(2)
        step = np.linalg.solve(curvature, gradient)
        beta -= np.clip(step, -2.0, 2.0)
    return float(beta[0]), float(beta[1])


def _part(b: Bags, texts: np.ndarray) -> Bags:
    """The given texts of ``b``, words and buckets numbered as before."""
    size = np.diff(b.text_first)[texts]
    passages = _ranges(b.text_first[texts], size)
    length = np.diff(b.passage_first)[passages]
    word = b.word[_ranges(b.passage_first[passages], length)]
    return Bags(word, np.concatenate([[0], np.cumsum(length)]), np.concatenate([[0], np.cumsum(size)]), b.bucket, b.bucket_first)


def _frequent(b: Bags) -> np.ndarray:
    """Which buckets occur in at least ``MIN_TEXTS`` texts."""
    kinds = len(b.bucket_first) - 1
    text_of = np.repeat(np.repeat(np.arange(len(b.text_first) - 1), np.diff(b.text_first)), np.diff(b.passage_first))
    pairs = np.unique(text_of * np.int64(kinds) + b.word)
    word, text = pairs % kinds, pairs // kinds
    count = np.diff(b.bucket_first)[word]
    bucket = b.bucket[_ranges(b.bucket_first[word], count)]
    met = np.unique(np.repeat(text, count) * np.int64(BUCKETS) + bucket) % BUCKETS
    return np.bincount(met, minlength=BUCKETS) >= MIN_TEXTS


def fit(b: Bags, labels: np.ndarray, epochs: int = EPOCHS) -> Model:
    """Embeddings and softmax on three texts of four, the curve on the fourth; the same input gives the same model."""
    y = np.asarray(labels, np.float64)
    if len(y) == 0 or y.min() == y.max() or len(b.word) == 0:
        share = float(y.mean()) if len(y) else 0.5
        odds = float(np.log(max(share, 1e-9)) - np.log(max(1 - share, 1e-9)))
        return Model(None, 0.0, 0.0, odds)
    back = np.random.default_rng(SEED).permutation(len(y)) % HELD_BACK == 0
    if min(np.bincount(y[back].astype(int), minlength=2).min(), np.bincount(y[~back].astype(int), minlength=2).min()) < 3:
        back[:] = False  # too few to hold any back
    table, bias = _embed(_part(b, np.flatnonzero(~back)), y[~back], epochs)
    model = Model(table, bias, 0.0, 0.0)
    checked = back if back.any() else ~back
    slope, level = _curve(np.log(evidence(model, b)[checked] + NEAR_ZERO), y[checked])
    return model._replace(slope=slope, level=level)


def _embed(b: Bags, y: np.ndarray, epochs: int) -> tuple[np.ndarray, float]:
    """What each bucket and the bias add to the log odds of a passage."""
    used = np.flatnonzero(_frequent(b))
    number = np.full(BUCKETS, len(used))
    number[used] = np.arange(len(used))
    bucket = number[b.bucket]  # the rare ones share the last row, which stays zero
    share = min(max(float(np.repeat(y, np.diff(b.text_first)).mean()), 1e-6), 1 - 1e-6)
    rng = np.random.default_rng(SEED)
    params = {
        "embedding": rng.normal(0, 0.1, (len(used) + 1, DIMENSIONS)).astype(np.float32),
        "softmax": rng.normal(0, 0.1, (DIMENSIONS, 2)).astype(np.float32),
        "bias": np.log([1 - share, share]).astype(np.float32),
    }
    first_moment = {k: np.zeros_like(v) for k, v in params.items()}
    second_moment = {k: np.zeros_like(v) for k, v in params.items()}
    params["embedding"][-1] = 0
    of_text = np.repeat(y, np.diff(b.text_first))
    goal = np.stack([1 - of_text, of_text], axis=1)
    size = np.diff(b.passage_first).astype(np.float32)
    by_word = np.argsort(b.word, kind="stable")
    own, word_heads = np.unique(b.word[by_word], return_index=True)
    passage_of = np.repeat(np.arange(len(size)), np.diff(b.passage_first))[by_word]
    by_bucket = np.argsort(bucket, kind="stable")
    met, bucket_heads = np.unique(bucket[by_bucket], return_index=True)
    word_of = np.repeat(np.arange(len(b.bucket_first) - 1), np.diff(b.bucket_first))
    subword_share = (1.0 / np.diff(b.bucket_first)).astype(np.float32)
    for epoch in range(1, epochs + 1):
        of_word = _means(params["embedding"][bucket], b.bucket_first)
        passage = _means(of_word[b.word], b.passage_first)
        logits = SCALE * passage @ params["softmax"] + params["bias"]
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=1, keepdims=True)
        error = ((p - goal) / len(goal)).astype(np.float32)
        to_passage = SCALE * (error / size[:, None]) @ params["softmax"].T
        to_word = np.zeros_like(of_word)
        to_word[own] = np.add.reduceat(to_passage[passage_of], word_heads, axis=0)
        to_word *= subword_share[:, None]
        to_bucket = DECAY * params["embedding"]
        to_bucket[met] += np.add.reduceat(to_word[word_of[by_bucket]], bucket_heads, axis=0)
        to_bucket[-1] = 0
        grads = {
            "embedding": to_bucket,
            "softmax": SCALE * passage.T @ error,
            "bias": error.sum(axis=0),
        }
        for name, grad in grads.items():
            first_moment[name] += 0.1 * (grad - first_moment[name])
            second_moment[name] += 0.01 * (grad**2 - second_moment[name])
            step = first_moment[name] / (1 - 0.9**epoch) / (np.sqrt(second_moment[name] / (1 - 0.99**epoch)) + 1e-8)
            params[name] -= RATE * step.astype(np.float32)
    table = np.zeros(BUCKETS, np.float32)
    table[used] = params["embedding"][:-1] @ ((params["softmax"][:, 1] - params["softmax"][:, 0]) * SCALE)
    return table, float(params["bias"][1] - params["bias"][0])


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``label, text`` of the labelled documents that train: whole texts, at most ``TRAIN_ROWS`` and ``TRAIN_BYTES``."""
    known = labels.filter("doc_id IS NOT NULL AND label IN (0, 1)").distinct()
    order = ["place", "doc_id", "label"]
    picked = known.withColumn("place", F.xxhash64("doc_id", F.lit(SEED))).orderBy(*order).limit(TRAIN_ROWS)
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.octet_length("text").cast("long").alias("bytes"))
    sizes = texts.join(F.broadcast(picked), "doc_id").distinct().orderBy(*order, "text_hash").limit(TRAIN_ROWS)
    total, rows = 0, []
    for r in sizes.collect():  # at most TRAIN_ROWS rows, no texts
        total += r["bytes"]
        if total > TRAIN_BYTES:
            break
        rows.append((r["doc_id"], r["text_hash"], r["label"], len(rows)))
    chosen = docs.sparkSession.createDataFrame(rows, "doc_id long, text_hash long, label int, number int")
    return (
        docs.join(F.broadcast(chosen), (F.xxhash64("text") == F.col("text_hash")) & (docs["doc_id"] == chosen["doc_id"]))
        .select("number", "label", "text")
        .dropDuplicates(["number"])
    )


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, label``), in one task; the model, of fixed size, reaches the driver."""

    def learn(batches):
        rows = sorted((r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)), key=lambda r: r[0])
        data, offsets = tb.utf8(pa.array([r[2] for r in rows], pa.string()))
        model = fit(bags(data, offsets), np.array([r[1] for r in rows]))
        table = None if model.table is None else tb.pack(model.table)
        yield pa.RecordBatch.from_pydict({"table": [table], "bias": [model.bias], "slope": [model.slope], "level": [model.level]})

    rows = _sample(docs, labels).coalesce(1).mapInArrow(learn, "table binary, bias double, slope double, level double").collect()
    if not rows:
        return Model(None, 0.0, 0.0, 0.0)
    (row,) = rows
    table = None if row["table"] is None else np.frombuffer(bytes(row["table"]), np.float32)
    return Model(table, row["bias"], row["slope"], row["level"])


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` for every row of ``docs`` (``doc_id, text``)."""

    def run(batches):
        for batch in batches:
            for row, to, data, offsets in tb.chunks(batch.column(1)):
                s = score(model, bags(data, offsets))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, to - row), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"]
                )

    return docs.mapInArrow(run, "doc_id long, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = FOLDS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; trained on labelled rows outside fold 0."""
    light = docs.select(col(id_col).cast("long").alias("doc_id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    marked = labels.select(col(id_col).cast("long").alias("doc_id"), col(label_col).cast("int").alias("label"))
    model = train(light, marked.filter(fold(F.col("doc_id"), folds) != 0))
    return scored(light, model).withColumn("held_out", fold(F.col("doc_id"), folds) == 0).select("doc_id", "held_out", "score", "predicted")
