"""Ranked lexical search: exact inner products of sparse vectors, found best-first through ball trees.

A document is the sparse vector of its term impacts, an item the sum over its distinct terms.  Only terms of the items can add to a score, so
vectors hold those.  Documents are dealt into trees of at most ``TREE_DOCS`` documents as they lie in the table, without a shuffle.
A tree splits its documents between two that lie far apart, down to leaves of ``LEAF_DOCS``; every node keeps the centroid of its documents and, for
each group of terms, the radius around it.  The centroid's product with the item plus, for every group, the root of the number of
its terms in the item times the radius bounds the score of every document below (Cauchy-Schwarz in each group, hence in the
sum).  Terms of one item alone form a group of their own, terms shared by items are groups by themselves (``GROUPS`` at most, by remainder), so a
ball's radius counts only what the item can see of it.  An item opens nodes best-first and stops at the first whose bound is
below the item's tenth best score so far.  Bounds are computed in doubles and raised by more than their rounding error; leaves are
scored in 64-bit integers, so the result is exact, ties included.

Statistics (documents with a term, terms in all, documents of each term) cover the whole table.  Items are taken in blocks of at most
``BLOCK_TERMS`` terms (or one item), so what a task is sent is bounded; each task returns at most ten documents an item, merged by
salted groups.

Defined cases: null texts have no term; items without terms or without a document of positive score return nothing; every row of the items is
an item of its own, also with equal or null ids; every row of the documents is a document; equal scores stand by ascending id, null
last; empty tables give an empty table; other columns do not matter.  Terms are told apart by 64-bit fingerprints.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm import textbatch as tb
from tidegrid.llm.frames import col
from tidegrid.session import stage

TOP = 10
TREE_DOCS, TREE_ENTRIES, LEAF_DOCS, GROUPS = 2048, 1 << 20, 8, 1024
BLOCK_ITEMS, BLOCK_TERMS, SALTS = 1024, 1 << 16, 32
NO_ID = np.iinfo(np.int64).max
MARGIN = 1e-9  # far above the rounding error of any sum here, relative to the sizes added

SEPARATORS = np.ones(256, bool)  # all bytes but ASCII letters, digits and those of other code points
for _low, _high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    SEPARATORS[_low:_high] = False


def counted_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, fingerprint and count of each distinct term of each text, by text and fingerprint; and all terms of each text."""
    w = tb.words(data, offsets, lower=True, separators=SEPARATORS)
    text = w.text_of()
    order = np.lexsort((w.hashes, text))
    text, key = text[order], w.hashes[order]
    heads = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (key[1:] != key[:-1]))[: len(text)])
    return text[heads], key[heads], np.diff(np.append(heads, len(text))), w.counts()


class Block(NamedTuple):
    """Some items: their terms' fingerprints in order, and each item's terms by number."""

    rows: np.ndarray  # row numbers of the items
    terms: np.ndarray
    item_terms: list[np.ndarray]

    def groups(self) -> np.ndarray:
        """Of every term: terms that one item has alone share a group, every other term is one."""
        items = np.concatenate([np.full(len(t), i) for i, t in enumerate(self.item_terms)] or [np.empty(0, int)])
        used = np.concatenate(self.item_terms or [np.empty(0, np.int64)])
        times = np.bincount(used, minlength=len(self.terms))
        group = np.zeros(len(self.terms), np.int64)
        group[used] = items
        shared = times > 1
        group[shared] = len(self.item_terms) + np.arange(int(shared.sum()))
        return group % GROUPS


def blocks(items: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, Iterator[Block]]:
    """``row, item_id`` of all items, staged, and their blocks; one block at a time is on the driver."""

    def terms(batches):
        for batch in batches:
            for row, to, data, offsets in tb.chunks(batch.column(1)):
                text, key, _, _ = counted_terms(data, offsets)
                first = np.searchsorted(text, np.arange(to - row + 1))
                packed = [tb.pack(key[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, to - row), pa.array(packed, pa.binary()), pa.array(np.diff(first))], names=["item_id", "terms", "n_terms"]
                )

    light = items.select(col(id_col).cast("long").alias("item_id"), col(text_col).alias("text"))
    rows = light.mapInArrow(terms, "item_id long, terms binary, n_terms long").filter("n_terms > 0")
    numbered = stage(rows.withColumn("row", F.monotonically_increasing_id()), "ball-items")

    def cut() -> Iterator[Block]:
        held, size = [], 0
        for r in numbered.select("row", "terms", "n_terms").toLocalIterator():
            if held and (len(held) == BLOCK_ITEMS or size + r["n_terms"] > BLOCK_TERMS):
                yield _block(held)
                held, size = [], 0
            held.append((r["row"], np.frombuffer(bytes(r["terms"]), np.uint64)))
            size += r["n_terms"]
        if held:
            yield _block(held)

    return numbered.select("row", "item_id"), cut()


def _block(rows: list[tuple[int, np.ndarray]]) -> Block:
    terms = np.unique(np.concatenate([t for _, t in rows]))
    return Block(np.array([r for r, _ in rows], np.int64), terms, [np.searchsorted(terms, t) for _, t in rows])


def vectors(docs: DataFrame, block: Block, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n, terms, counts`` of every document: all its terms, and the numbers and counts of those of the block."""
    known = block.terms

    def run(batches):
        for batch in batches:
            for row, to, data, offsets in tb.chunks(batch.column(1)):
                text, key, count, n = counted_terms(data, offsets)
                at = np.minimum(np.searchsorted(known, key), len(known) - 1)
                kept = known[at] == key
                first = np.searchsorted(text[kept], np.arange(to - row + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, to - row),
                        pa.array(n.astype(np.int64)),
                        pa.ListArray.from_arrays(first, pa.array(at[kept].astype(np.int32))),
                        pa.ListArray.from_arrays(first, pa.array(count[kept].astype(np.int64))),
                    ],
                    names=["doc_id", "n", "terms", "counts"],
                )

    light = docs.select(F.coalesce(col(id_col).cast("long"), F.lit(int(NO_ID))).alias("doc_id"), col(text_col).alias("text"))
    return light.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<long>")


class Corpus(NamedTuple):
    """What a score needs of all documents."""

    documents: int  # with a term
    length: int
    weights: np.ndarray  # of the block's terms


def measured(vecs: DataFrame, terms: int) -> Corpus:
    """Counts over all documents; per task one number a term, added up by term."""

    def holders(batches):
        held = np.zeros(terms, np.int64)
        for batch in batches:
            held += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=terms)
        own = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(held[own])], names=["term", "df"])

    (total,) = vecs.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).collect()
    df = np.zeros(terms)
    for term, value in vecs.select("terms").mapInArrow(holders, "term long, df long").groupBy("term").agg(F.sum("df")).collect():  # one row a term
        df[term] = value
    weights = np.floor(1000.0 * np.log((2 * total[0] + 2) / (2 * df + 1))).astype(np.int64)
    return Corpus(total[0], total[1], weights)


def impacts(corpus: Corpus, n: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """What each entry of a vector adds to the score of an item that has its term; ``n`` per entry."""
    m = 100 - 90 + (90 * n * corpus.documents) // max(corpus.length, 1)
    return corpus.weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 8 * m))


class Tree(NamedTuple):
    """Documents in the order of the leaves; node 0 is the root and a node's children come after it."""

    ids: np.ndarray
    first: np.ndarray  # entries of each document (one more)
    terms: np.ndarray
    values: np.ndarray
    low: np.ndarray  # documents below each node
    high: np.ndarray
    left: np.ndarray  # children of each node, -1 at leaves
    right: np.ndarray
    center_first: np.ndarray  # by term: nodes whose centroid has it, and the value there
    center_node: np.ndarray
    center_value: np.ndarray
    radius: np.ndarray  # by node and group


def _runs(first: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Positions of the entries of the documents ``own``, end to end."""
    count = first[own + 1] - first[own]
    begin = np.cumsum(count) - count
    return np.repeat(first[own] - begin, count) + np.arange(int(count.sum()))


def _split(own: np.ndarray, first: np.ndarray, terms: np.ndarray, values: np.ndarray, norms: np.ndarray, size: int) -> np.ndarray:
    """The documents ordered from near one of two far ones to near the other."""
    entries = _runs(first, own)
    owner = np.repeat(np.arange(len(own)), first[own + 1] - first[own])
    t, v = terms[entries], values[entries]

    def products(document: int) -> np.ndarray:
        dense = np.zeros(size)
        span = slice(first[document], first[document + 1])
        dense[terms[span]] = values[span]
        return np.bincount(owner, dense[t] * v, len(own))

    one = own[np.argmax(norms[own] - 2 * products(own[0]))]
    to_one = products(one)
    other = own[np.argmax(norms[own] - 2 * to_one)]
    return own[np.argsort(products(other) - to_one, kind="stable")]


def grow(ids: np.ndarray, first: np.ndarray, terms: np.ndarray, values: np.ndarray, group: np.ndarray) -> Tree:
    """A ball tree over at least one document; ``values`` are the integer impacts."""
    size, width = len(group), int(group.max()) + 1 if len(group) else 1
    real = values.astype(np.float64)
    owner = np.repeat(np.arange(len(ids)), np.diff(first))
    norms = np.bincount(owner, real**2, len(ids))
    order = np.arange(len(ids))
    low, high, left, right = [0], [len(ids)], [-1], [-1]
    todo = [0]
    while todo:
        node = todo.pop()
        a, b = low[node], high[node]
        if b - a <= LEAF_DOCS:
            continue
        order[a:b] = _split(order[a:b], first, terms, real, norms, size)
        middle = (a + b) // 2
        left[node], right[node] = len(low), len(low) + 1
        todo += [len(low), len(low) + 1]
        low += [a, middle]
        high += [middle, b]
        left += [-1, -1]
        right += [-1, -1]
    count = np.diff(first)[order]
    entries = _runs(first, order)
    first = np.concatenate([[0], np.cumsum(count)])
    terms, values, real = terms[entries], values[entries], real[entries]
    doc = np.repeat(np.arange(len(ids)), count)
    nodes = len(low)
    radius = np.zeros((nodes, width))
    center_term, center_node, center_value = [], [], []
    for node in range(nodes):
        a, b = first[low[node]], first[high[node]]
        documents = high[node] - low[node]
        total = np.bincount(terms[a:b], real[a:b], size)
        own = np.flatnonzero(total)
        mean = total[own] / documents
        dense = total / documents
        # squared distances by document and group: what the entries differ by, and the centroid where a document has no entry
        cell = (doc[a:b] - low[node]) * width + group[terms[a:b]]
        there = dense[terms[a:b]]
        away = np.bincount(cell, (real[a:b] - there) ** 2 - there**2, documents * width).reshape(documents, width)
        base = np.bincount(group[own], mean**2, width)
        scale = np.bincount(cell, real[a:b] ** 2 + there**2, documents * width).reshape(documents, width) + base
        radius[node] = np.sqrt(np.maximum((away + base + MARGIN * scale).max(axis=0), 0.0))
        center_term.append(own)
        center_node.append(np.full(len(own), node))
        center_value.append(mean)
    center_term, center_node, center_value = (np.concatenate(x) for x in (center_term, center_node, center_value))
    by_term = np.argsort(center_term, kind="stable")
    center_first = np.searchsorted(center_term[by_term], np.arange(size + 1))
    return Tree(
        ids[order], first, terms, values, np.array(low), np.array(high), np.array(left), np.array(right), center_first, center_node[by_term],
        center_value[by_term], radius,
    )


def bounds(tree: Tree, group: np.ndarray, query: np.ndarray) -> np.ndarray:
    """At least the score of every document below each node."""
    at = _runs(tree.center_first, query)
    middle = np.bincount(tree.center_node[at], tree.center_value[at], len(tree.low))
    own, times = np.unique(group[query], return_counts=True)
    out = middle + tree.radius[:, own] @ np.sqrt(times)
    return out + out * MARGIN + 1e-6


def search(tree: Tree, group: np.ndarray, query: np.ndarray, best: list[tuple[int, int]], top: int = TOP, opened: list[int] | None = None) -> None:
    """Put the best documents of a tree into ``best``, a heap of at most ``top`` (score, -id); ``opened`` counts scored documents."""
    wanted = np.zeros(len(group), bool)
    wanted[query] = True
    bound = bounds(tree, group, query)
    heap = [(-bound[0], 0)]
    while heap:
        above, node = heapq.heappop(heap)
        need = best[0][0] if len(best) == top else 1
        if -above < need:  # a bound equal to the last score may hide a smaller id
            return
        if tree.left[node] >= 0:
            for child in (tree.left[node], tree.right[node]):
                # what bounds the parent bounds the child
                ahead = max(-bound[child], above)
                if -ahead >= need:
                    heapq.heappush(heap, (ahead, child))
            continue
        a, b = tree.low[node], tree.high[node]
        begin, end = tree.first[a], tree.first[b]
        total = np.concatenate([[0], np.cumsum(np.where(wanted[tree.terms[begin:end]], tree.values[begin:end], 0))])
        scores = np.diff(total[tree.first[a : b + 1] - begin])
        if opened is not None:
            opened.append(int(b - a))
        for i in np.flatnonzero(scores >= need).tolist():
            entry = (int(scores[i]), -int(tree.ids[a + i]))
            if len(best) < top:
                heapq.heappush(best, entry)
            elif entry > best[0]:
                heapq.heapreplace(best, entry)


def found(vecs: DataFrame, block: Block, corpus: Corpus, top: int) -> DataFrame:
    """``row, doc_id, score``: at most ``top`` documents of every item from every task."""
    group = block.groups()

    def run(batches):
        best: list[list[tuple[int, int]]] = [[] for _ in block.rows]
        held, size = [], 0

        def flush():
            ids, n, counted, terms, counts = (np.concatenate(x) for x in zip(*held, strict=True))
            first = np.concatenate([[0], np.cumsum(counted)])
            tree = grow(ids, first, terms, impacts(corpus, np.repeat(n, counted), terms, counts), group)
            for query, own in zip(block.item_terms, best, strict=True):
                search(tree, group, query, own, top)

        for batch in batches:
            lists, at = batch.column(2), 0
            ids, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            terms = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            counts = batch.column(3).flatten().to_numpy(zero_copy_only=False)
            first = np.concatenate([[0], ends]).astype(np.int64)
            while at < len(ids):
                room = int(np.searchsorted(first, first[at] + TREE_ENTRIES - size, side="right")) - 1
                to = min(len(ids), at + TREE_DOCS - sum(len(h[0]) for h in held), max(room, at if held else at + 1))
                if to > at:
                    span = slice(first[at], first[to])
                    held.append((ids[at:to], n[at:to], np.diff(first[at : to + 1]), terms[span], counts[span]))
                    size += int(first[to] - first[at])
                at = max(to, at)
                if at < len(ids):
                    flush()
                    held, size = [], 0
        if held:
            flush()
        rows = [(r, -i, s) for r, own in zip(block.rows.tolist(), best, strict=True) for s, i in own]
        for part in range(0, len(rows), 4096):
            columns = zip(*rows[part : part + 4096], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["row", "doc_id", "score"])

    return vecs.filter("size(terms) > 0").mapInArrow(run, "row long, doc_id long, score long")


def rank(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``top`` documents of highest positive score."""
    spark = docs.sparkSession
    names, parts = blocks(items, item_col, item_text)
    results = None
    for block in parts:
        vecs = stage(vectors(docs, block, id_col, text_col), "ball-vectors")
        # one number a document of a task, salted: a block's results are few, whatever the number of tasks
        some = found(vecs, block, measured(vecs, len(block.terms)), top).withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
        few = Window.partitionBy("row", "salt").orderBy(F.desc("score"), "doc_id")
        out = stage(some.withColumn("place", F.row_number().over(few)).filter(F.col("place") <= top).select("row", "doc_id", "score"), "ball-found")
        results = out if results is None else results.unionByName(out)
    if results is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "doc_id")
    ranked = results.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(names, "row").select("item_id", "rank", F.nullif("doc_id", F.lit(int(NO_ID))).alias("doc_id"), "score")
