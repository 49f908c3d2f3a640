"""Packing documents into sequences along a space-filling curve.

Each document's byte pairs are hashed into a vector of counts, its direction is projected to a few dimensions by fixed random
signs, and the quantised point's place on a Hilbert curve is the document's key.  Documents are range-sorted by that key and laid end to
end; the line is cut every ``length`` ids, so neighbours on the curve share sequences and no sequence but the last could be
short.  The rest is cut into powers of two, which need no padding.

Positions on the line are a distributed prefix sum: each range partition numbers its own ids, the partitions' totals (one row per partition)
are folded, and pieces follow from position and total.  Texts are tokenised once.

Defined cases: a null or empty text is the end id alone; repeated rows are documents of their own; null ids are kept; an empty
table gives an empty table; a long text is cut into as many pieces as it needs; other columns do not matter.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm import textbatch as tb
from tidegrid.llm.frames import checked_broadcast, col
from tidegrid.llm.tokens import encoder
from tidegrid.session import stage

LENGTH = 2048
END_ID = 1
SLOTS, DIMENSIONS, BITS = 1024, 4, 12
_OUT_ROWS = 256


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of integer points (n, d) with coordinates below 2**bits."""
    x = points.astype(np.int64).copy()
    n, d = x.shape
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(d):
            high = (x[:, i] & q) != 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(high, low, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(n, np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[:, d - 1] & q, q - 1, 0)
        q >>= 1
    x ^= turn[:, None]
    key = np.zeros(n, np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[:, i] >> bit) & 1)
    return key


def _projection(seed: int = 7) -> np.ndarray:
    draws = tb.constants(SLOTS * DIMENSIONS, seed) >> np.uint64(33)
    return np.where(draws & np.uint64(1), 1.0, -1.0).reshape(SLOTS, DIMENSIONS).astype(np.float32)


def curve_keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Keys of texts: counts of hashed byte pairs, their direction projected and quantised by its normal share."""
    pair = data[:-1].astype(np.int64) * 40503 + data[1:].astype(np.int64) * 30011
    slot = ((pair >> 4) ^ pair) & (SLOTS - 1)
    counts = np.zeros((len(offsets) - 1, SLOTS), np.float32)
    for row, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        if b - a > 1:
            counts[row] = np.bincount(slot[a : b - 1], minlength=SLOTS)
    np.sqrt(counts, out=counts)
    counts /= np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-9)
    spots = counts @ _projection()
    normal = 0.5 * (1.0 + np.vectorize(math.erf, otypes=[np.float64])(spots / math.sqrt(2.0)))
    return hilbert_keys(np.minimum((normal * (1 << BITS)).astype(np.int64), (1 << BITS) - 1), BITS)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, curve`` per document."""

    def place(batches):
        for batch in batches:
            for row, to, data, offsets in tb.chunks(batch.column(1)):
                part = batch.slice(row, to - row)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(curve_keys(data, offsets), pa.int64())], names=["doc_id", "text", "curve"])

    light = docs.select(col(id_col).cast("long").alias("doc_id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    return light.mapInArrow(place, "doc_id long, text string, curve long")


def cut(begin: int, size: int, total: int, length: int) -> list[tuple[int, int, int, int]]:
    """(start in the document, length, sequence, offset in it) of the pieces of ids ``begin .. begin + size`` of the line."""
    out, at, full = [], begin, total // length
    while at < begin + size:
        if at < full * length:
            sequence, first = at // length, at // length * length
            last = first + length
        else:  # the rest: powers of two, the largest first
            sequence, first, rest = full, full * length, total - full * length
            while True:
                step = 1 << (rest.bit_length() - 1)
                if at < first + step:
                    break
                sequence, first, rest = sequence + 1, first + step, rest - step
            last = first + step
        stop = min(last, begin + size)
        out.append((at - begin, stop - at, sequence, at - first))
        at = stop
    return out


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


def pack(docs: DataFrame, vocabulary: str, length: int = LENGTH, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece; ``ids`` are the piece's ids."""
    # the cheap keys are computed twice (Spark samples them for the ranges), the token ids once, behind the shuffle
    ranged = keyed(docs, id_col, text_col).repartitionByRange("curve", "doc_id").sortWithinPartitions("curve", "doc_id", "text")

    def laid(batches):
        run, part, at = encoder(vocabulary), TaskContext.get().partitionId(), 0
        for batch in batches:
            for row in range(0, batch.num_rows, _OUT_ROWS):
                some = batch.slice(row, _OUT_ROWS)
                own = [np.append(ids, np.uint32(end_id)).astype("<u4") for ids in run(some.column(1).to_pylist())]
                sizes = np.array([len(x) for x in own], np.int64)
                ends = at + np.cumsum(sizes)
                at = int(ends[-1])
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(sizes), pa.array([x.tobytes() for x in own], pa.binary()), pa.array([part] * len(own), pa.int32()), pa.array(ends - sizes)],
                    names=["doc_id", "doc_tokens", "ids", "part", "at"],
                )

    line = stage(ranged.mapInArrow(laid, "doc_id long, doc_tokens long, ids binary, part int, at long"), "pack-line")
    totals = line.groupBy("part").agg(F.sum("doc_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bases = stage(totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"), F.sum("n").over(whole).alias("total")), "pack-bases")
    placed = line.join(checked_broadcast(bases), "part").select("doc_id", "doc_tokens", (F.col("base") + F.col("at")).alias("begin"), "total", "ids")

    def cut_up(batches):
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
        kinds = [pa.int64()] * 7 + [pa.binary()]
        for batch in batches:
            for at in range(0, batch.num_rows, _OUT_ROWS):
                rows = []
                for doc, size, begin, total, ids in zip(*(c.to_pylist() for c in batch.slice(at, _OUT_ROWS).columns), strict=True):
                    for start, n, sequence, offset in cut(begin, size, total, length):
                        own = ids[4 * start : 4 * (start + n)]
                        rows.append((doc, start, n, zlib.crc32(own), size, sequence, offset, own))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return placed.mapInArrow(cut_up, PIECE)
