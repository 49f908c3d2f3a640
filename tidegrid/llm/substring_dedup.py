"""Repeated passages by difference-cover anchors.

A passage of at least ``window`` words that a document shares with one of smaller id is removed from it.  Fingerprints are
taken of runs of ``window - period + 1`` words only where their position modulo ``period`` is in a difference cover: a set
whose differences give every residue.  Whatever the two positions of a shared passage, both have a cover position at the same distance from its
start below ``period``, so they share an anchor; with period 31 that is 6 of 31 positions.  Anchors that no other document has
end the search there.  Around shared anchors the match is extended to whole windows: only windows that hold one are fingerprinted, and a word goes
if one of its windows is also in a document of smaller id.

Both questions (is this anchor elsewhere, is this window in a smaller document) go from tiles of documents to buckets of fingerprints and back
(``tiles_of_text``); the three passes over the tiles share one shuffle of the texts.  Equality of windows is equality of two 64-bit
fingerprints (anchor and window).

Defined cases: null and empty texts have no words; a null id counts as larger than every id; rows of one id never remove
from each other; a passage repeated only inside one document stays; repeated rows give equal rows; an empty table gives an
empty table; other columns do not matter.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm import textbatch as tb
from tidegrid.llm import tiles_of_text as tt

WINDOW, PERIOD = 50, 31

_ASK = pa.schema([("bucket", pa.int32()), ("tile", pa.int32()), ("keys", pa.binary()), ("low", pa.binary()), ("several", pa.binary())])
_TELL = pa.schema([("tile", pa.int32()), ("keys", pa.binary())])
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])
_DDL = {
    "ask": "bucket int, tile int, keys binary, low binary, several binary",
    "tell": "tile int, keys binary",
    "result": "doc_id long, n_words long, n_removed long, kept_text string",
}


@lru_cache(maxsize=16)
def difference_cover(period: int) -> tuple[int, ...]:
    """The first smallest set with 0 and 1 whose differences give every residue of a small ``period``."""
    for size in range(1, period + 1):
        for rest in combinations(range(2, period), max(size - 2, 0)):
            cover = (0, 1, *rest)[:size]
            if len({(a - b) % period for a in cover for b in cover}) == period:
                return cover
    return (0,)


def _anchors(w: tb.Words, window: int, period: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of the anchors, and their fingerprints."""
    length = window - period + 1
    at = tb.run_starts(w.first, length)
    marked = np.zeros(period, bool)
    marked[list(difference_cover(period))] = True
    place = at - np.repeat(w.first[:-1], w.counts())[at]
    at = at[marked[place % period]]
    return at, tb.runs(w.hashes, length)[at]


def _texts(documents: pa.Table):
    """(words, doc ids) of a tile, some texts at a time."""
    ids = documents.column("doc_id").to_numpy()
    for row, to, data, offsets in tb.chunks(documents.column("text"), 4 * tb.CHUNK_BYTES):
        yield tb.words(data, offsets), ids[row:to]


def _asked(keys: list[np.ndarray], ids: list[np.ndarray], tile: int, buckets: int) -> pa.Table:
    all_keys = np.concatenate(keys) if keys else np.empty(0, np.uint64)
    all_ids = np.concatenate(ids) if ids else np.empty(0, np.int64)
    distinct, low, several = tt.unique_min(all_keys, all_ids)
    return tt.table(tt.sent(tile, buckets, distinct, low, several), _ASK)


def _tile_of(documents: pa.Table) -> int:
    return documents.column("tile")[0].as_py()


def _told(asked: pa.Table, wanted) -> pa.Table:
    """Send back to each tile the keys that ``wanted(keys, low, several, heads, group)`` marks."""
    keys, sizes = tt.unpacked(asked.column("keys"), np.uint64)
    low, _ = tt.unpacked(asked.column("low"), np.int64)
    several, _ = tt.unpacked(asked.column("several"), bool)
    order = np.argsort(keys, kind="stable")
    heads = np.append(True, keys[order][1:] != keys[order][:-1])
    yes = np.empty(len(keys), bool)
    yes[order] = wanted(low[order], several[order], np.flatnonzero(heads), np.cumsum(heads) - 1)
    rows, at = [], 0
    for tile, size in zip(asked.column("tile").to_pylist(), sizes, strict=True):
        own = keys[at : at + size][yes[at : at + size]]
        if len(own):
            rows.append((tile, tb.pack(own)))
        at += size
    return tt.table(rows, _TELL)


def _shared(asked: pa.Table) -> pa.Table:
    """Anchors that at least two documents have."""

    def wanted(low, several, heads, group):
        one = np.minimum.reduceat(low, heads) == np.maximum.reduceat(low, heads)
        return (~one | np.logical_or.reduceat(several, heads))[group]

    return _told(asked, wanted)


def _earlier(asked: pa.Table) -> pa.Table:
    """Windows that a document smaller than the tile's smallest has."""
    return _told(asked, lambda low, several, heads, group: low > np.minimum.reduceat(low, heads)[group])


def _answers(told: pa.Table) -> np.ndarray:
    return np.sort(tt.unpacked(told.column("keys"), np.uint64)[0])


def _ask_anchors(window: int, period: int, buckets: int):
    def ask(documents: pa.Table) -> pa.Table:
        keys, ids = [], []
        for w, own in _texts(documents):
            at, anchors = _anchors(w, window, period)
            keys.append(anchors)
            ids.append(own[w.text_of()[at]])
        return _asked(keys, ids, _tile_of(documents), buckets)

    return ask


def _ask_windows(window: int, period: int, buckets: int):
    def ask(documents: pa.Table, told: pa.Table) -> pa.Table:
        shared = _answers(told)
        keys, ids = [], []
        if len(shared) == 0 or documents.num_rows == 0:
            return tt.table([], _ASK)
        for w, own in _texts(documents):
            at, anchors = _anchors(w, window, period)
            hit = np.zeros(len(w.hashes) + period + 1, np.int64)
            hit[at[tt.found(anchors, shared)]] = 1
            upto = np.append(0, np.cumsum(hit))
            starts = tb.run_starts(w.first, window)
            starts = starts[upto[starts + period] > upto[starts]]
            keys.append(tb.runs(w.hashes, window)[starts])
            ids.append(own[w.text_of()[starts]])
        return _asked(keys, ids, _tile_of(documents), buckets)

    return ask


def _remove(window: int):
    def remove(documents: pa.Table, told: pa.Table) -> pa.Table:
        if documents.num_rows == 0:
            return tt.table([], _RESULT)
        earlier = _answers(told)
        found = []
        for w, own in _texts(documents):
            starts = tb.run_starts(w.first, window)
            found.append((tb.runs(w.hashes, window)[starts], own[w.text_of()[starts]]))
        distinct, low, _ = tt.unique_min(np.concatenate([k for k, _ in found]), np.concatenate([i for _, i in found]))
        low[tt.found(distinct, earlier)] = np.iinfo(np.int64).min
        rows = []
        for (w, own), (keys, ids) in zip(_texts(documents), found, strict=True):
            starts = tb.run_starts(w.first, window)
            starts = starts[ids > low[np.searchsorted(distinct, keys)]] if len(starts) else starts
            edge = np.zeros(len(w.hashes) + 1, np.int64)
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + window, -1)
            gone = np.cumsum(edge)[:-1] > 0
            for text, doc in enumerate(own):
                a, b = w.first[text], w.first[text + 1]
                words = w.data[w.starts[a] : w.ends[b - 1]].tobytes().split() if b > a else []
                out = gone[a:b]
                n = int(out.sum())
                if n:
                    words = [word for word, drop in zip(words, out, strict=True) if not drop]
                rows.append((int(doc), int(b - a), n, b" ".join(words).decode()))
        return tt.table(rows, _RESULT)

    return remove


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, period: int = PERIOD) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` per document; the kept words are joined by one space."""
    tiles = buckets = tt.parts(docs, 2)
    texts = tt.tiled(docs, id_col, text_col, tiles)
    asked = texts.groupBy("tile").applyInArrow(_ask_anchors(window, period, buckets), _DDL["ask"])
    shared = asked.groupBy("bucket").applyInArrow(_shared, _DDL["tell"])
    windows = texts.groupBy("tile").cogroup(shared.groupBy("tile")).applyInArrow(_ask_windows(window, period, buckets), _DDL["ask"])
    earlier = windows.groupBy("bucket").applyInArrow(_earlier, _DDL["tell"])
    out = texts.groupBy("tile").cogroup(earlier.groupBy("tile")).applyInArrow(_remove(window), _DDL["result"])
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(int(tt.NO_ID))))
