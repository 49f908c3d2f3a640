"""Documents dealt into tiles, and questions about fingerprints asked from tile to bucket and back.

A tile is a hash part of the documents that one task holds; a bucket is a range of fingerprints.  A tile sends each of its distinct
fingerprints once, packed as arrays, whatever the number of its documents that have it; so a fingerprint that every document has reaches
its bucket once per tile, and the answer goes back once per tile.  No step needs the list of documents of a fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm import textbatch as tb
from tidegrid.llm.frames import col

NO_ID = np.iinfo(np.int64).max


def parts(df: DataFrame, per_partition: int) -> int:
    """Tiles or buckets: a multiple of the session's shuffle partitions, which are sized to the input."""
    return per_partition * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def tiled(docs: DataFrame, id_col: str, text_col: str, tiles: int) -> DataFrame:
    """``doc_id, text, tile``; a null id counts as larger than every id, a null text as empty."""
    light = docs.select(F.coalesce(col(id_col).cast("long"), F.lit(int(NO_ID))).alias("doc_id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    return light.withColumn("tile", F.pmod(F.xxhash64("doc_id", "text"), F.lit(tiles)).cast("int"))


def unique_min(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the smallest id of each, and whether it has several ids."""
    if len(keys) == 0:
        return keys, ids, np.empty(0, bool)
    order = np.argsort(keys, kind="stable")
    keys, ids = keys[order], ids[order]
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    low = np.minimum.reduceat(ids, heads)
    return keys[heads], low, np.maximum.reduceat(ids, heads) != low


def bucket_slices(sorted_keys: np.ndarray, buckets: int) -> Iterable[tuple[int, int, int]]:
    """(bucket, from, to) of the non-empty runs of sorted fingerprints."""
    if len(sorted_keys) == 0:
        return
    bucket = ((sorted_keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    heads = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    for begin, end in zip(heads, np.append(heads[1:], len(bucket)), strict=True):
        yield int(bucket[begin]), int(begin), int(end)


def sent(tile: int, buckets: int, sorted_keys: np.ndarray, *values: np.ndarray) -> list[tuple]:
    """Rows (bucket, tile, keys, values ...) of packed arrays."""
    return [(b, tile, tb.pack(sorted_keys[i:j]), *(tb.pack(v[i:j]) for v in values)) for b, i, j in bucket_slices(sorted_keys, buckets)]


def table(rows: Sequence[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def unpacked(column, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All packed arrays of a column end to end, and how many values each row holds."""
    values = column.to_pylist()
    size = np.dtype(dtype).itemsize
    return np.frombuffer(b"".join(values), dtype), np.array([len(v) // size for v in values], np.int64)


def found(keys: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    """Which keys are in a sorted set."""
    if len(sorted_set) == 0:
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_set, keys), len(sorted_set) - 1)
    return sorted_set[at] == keys
