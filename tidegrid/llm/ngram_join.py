"""Near duplicates: an exact Jaccard join of word-shingle sets with partition-and-enumerate signatures.

Sets are cut into size bands.  Within a band (and between a band and the next) a pair that is similar enough differs in at most k
features.  The feature domain is cut into groups of partitions; with k differences, some group has at most ``misses`` partitions that
differ, so the two sets agree on a whole subset of that group's partitions.  Every subset of the right size is enumerated per
group, and its content is a signature: similar sets share one.

Three refinements keep this exact and bounded:

* A signature without features says nothing and is not sent, as long as a set keeps enough usable groups for the argument above; a
  set that does not (tiny ones, by bad luck) sends those too.
* A signature that many sets have (a passage found everywhere) does not make all pairs.  A set with more usable groups than k plus
  its common signatures shares a rare signature with every similar set, so rare signatures suffice for it.  Only sets that are *not* so
  covered meet again, where common signatures tie them together into clusters and components are still apart. A cluster of one block is
  compared sketch by sketch. A larger one (pages of one template) is enumerated once more, with its domain cut so finely that each
  feature is a partition of its own: features that many of the cluster have are common again, and the rest of two similar sets meets unless
  common features alone could make them similar. Only sets of which that is true are compared block by block, each pair of blocks in a
  task of its own, and only pairs that may link are written.
* Candidates are thinned by parity sketches (bit j is the parity of the features hashed to j; sketches of similar sets differ in at most k
  bits), then verified on the whole sets.

Signatures travel as packed arrays from partitions of documents to buckets of signatures; equal sets are sent once per batch.  The result
is exact up to equality of 64-bit fingerprints of shingles.

Defined cases: a document without words has an empty set and links with nothing; one with fewer words than a shingle has its whole sequence as
one feature; rows of one id are one document; a null id is a document of its own (rows without id and with one text are one) that
never gives its name to a component with ids; an empty table gives an empty table; other columns do not matter.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm import textbatch as tb
from tidegrid.llm import tiles_of_text as tt
from tidegrid.llm.components import components
from tidegrid.llm.frames import checked_broadcast, col
from tidegrid.session import stage
from tidegrid.tiles import lookup

SHINGLE = 5
#: two sets link when ``UNION_PARTS * intersection >= SHARED_PARTS * union``
SHARED_PARTS, UNION_PARTS = 3, 4
COMMON = 16
BLOCK = 1024
FEW_PAIRS = 20_000
_FLUSH = 1 << 20
NULL_IDS = 1 << 62


# ---- bands and signatures -------------------------------------------------------------------------------------------


class Scheme(NamedTuple):
    """How one instance (a band, or a band with the next) cuts the domain."""

    groups: int
    parts: int
    misses: int


def most_partner(n: np.ndarray) -> np.ndarray:
    """The largest set that can be similar to one of size n."""
    return n * UNION_PARTS // SHARED_PARTS


def most_different(total: np.ndarray) -> np.ndarray:
    """The most differing features of a similar pair whose sizes add up to ``total``."""
    return total * (UNION_PARTS - SHARED_PARTS) // (UNION_PARTS + SHARED_PARTS)


@lru_cache(maxsize=1)
def bands() -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest size of each band: a band is 16/9 wide, so similar sets are at most one band apart."""
    low, high = [1], []
    while low[-1] < 1 << 40:
        high.append(max(low[-1], low[-1] * 16 // 9))
        low.append(high[-1] + 1)
    return np.array(low[:-1], np.int64), np.array(high, np.int64)


def scheme(largest: int) -> Scheme:
    """Where similar sets are equal, the whole set; 2 of 3 partitions for short texts, where signatures must be selective; single
    partitions for long texts, which have many."""
    if most_different(np.int64(2 * largest)) == 0:
        return Scheme(1, 1, 0)
    if largest <= 300:
        return Scheme(largest * 22 // 100 + 2, 3, 1)
    return Scheme(largest * 40 // 100 + 2, 1, 0)


@lru_cache(maxsize=1)
def schemes() -> np.ndarray:
    """Rows (groups, parts, misses) by instance: 2i is band i alone, 2i + 1 band i with the next."""
    low, high = bands()
    out = []
    for i in range(len(low)):
        out.append(scheme(int(high[i])))
        reach = int(min(high[min(i + 1, len(high) - 1)], most_partner(high[i])))
        out.append(scheme(reach))
    return np.array(out, np.int64)


class Sets(NamedTuple):
    """Feature sets of some texts: sorted distinct fingerprints end to end, sizes, and where each set begins."""

    features: np.ndarray
    sizes: np.ndarray
    first: np.ndarray


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> Sets:
    w = tb.words(data, offsets, lower=True)
    counts = w.counts()
    all_runs = tb.runs(w.hashes, shingle)
    pieces = []
    for text in range(len(counts)):
        a, n = w.first[text], counts[text]
        if n >= shingle:
            pieces.append(np.sort(all_runs[a : a + n - shingle + 1]))
        elif n:
            pieces.append(tb.mix(tb.runs(w.hashes[a : a + n], int(n)) + np.uint64(n)))
        else:
            pieces.append(np.empty(0, np.uint64))
    lengths = np.array([len(p) for p in pieces], np.int64)
    features = np.concatenate(pieces) if pieces else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    new = np.append(True, (features[1:] != features[:-1]) | (owner[1:] != owner[:-1]))[: len(features)]
    sizes = np.bincount(owner[new], minlength=len(lengths)).astype(np.int64)
    return Sets(features[new], sizes, np.append(0, np.cumsum(sizes)))


def instances(sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For the own band, the one with the next and the one with the previous: (which sets take part, instance, k)."""
    low, high = bands()
    band = np.searchsorted(high, np.maximum(sizes, 1))
    partner = most_partner(sizes)
    some = sizes > 0
    after, before = np.minimum(band + 1, len(low) - 1), np.maximum(band - 1, 0)
    own = (some, 2 * band, most_different(sizes + np.minimum(partner, high[band])))
    up = (some & (partner >= low[after]) & (after > band), 2 * band + 1, most_different(sizes + np.minimum(partner, high[after])))
    least = -(-sizes * SHARED_PARTS // UNION_PARTS)
    down = (some & (band > 0) & (least <= high[before]), 2 * band - 1, most_different(sizes + np.minimum(sizes, high[before])))
    return [own, up, down]


def signatures(sets: Sets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set number, signature, slack per set and kind).

    The two lowest bits of a signature are its instance modulo 4, which tells a set's three instances apart.  The slack of a set in
    an instance is its usable groups less those that k differences can spoil: with fewer common signatures than that, it shares
    a rare one with every similar set.
    """
    slack = np.zeros((len(sets.sizes), 3), np.int64)
    owners, marks = [], []
    for kind, (takes, instance, k) in enumerate(instances(sets.sizes)):
        for plan in {tuple(row) for row in schemes()[np.unique(instance[takes])][:, 1:]}:
            parts, misses = int(plan[0]), int(plan[1])
            mine = takes & (schemes()[np.maximum(instance, 0), 1] == parts)
            own, mark, spare = _enumerate(sets, mine, instance, k, parts, misses)
            owners.append(own)
            marks.append(mark)
            slack[mine, kind] = spare
    if not owners:
        return np.empty(0, np.int64), np.empty(0, np.uint64), slack
    return np.concatenate(owners), np.concatenate(marks), slack


def _enumerate(sets: Sets, mine: np.ndarray, instance: np.ndarray, k: np.ndarray, parts: int, misses: int):
    chosen = np.flatnonzero(mine)
    sizes, groups = sets.sizes[chosen], schemes()[instance[chosen], 0]
    cells = groups * parts
    base = np.append(0, np.cumsum(cells))
    local = np.repeat(np.arange(len(chosen)), sizes)
    features = sets.features[mine[np.repeat(np.arange(len(mine)), sets.sizes)]]
    # features are sorted, so taking partitions by the upper bits keeps them in order
    part = ((features >> np.uint64(32)) * cells[local].astype(np.uint64)) >> np.uint64(32)
    place = base[local] + part.astype(np.int64)
    content = np.zeros(base[-1], np.uint64)
    if len(features):
        heads = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        content[place[heads]] = np.add.reduceat(tb.mix(features), heads)
    filled = np.zeros(base[-1], bool)
    filled[place] = True
    content = content.reshape(-1, parts)
    full = filled.reshape(-1, parts)
    owner = np.repeat(np.arange(len(chosen)), groups)
    group = np.arange(len(owner)) - np.repeat(base[:-1] // parts, groups)
    keep = parts - misses
    usable = (~full).sum(axis=1) < keep
    spare = np.bincount(owner[usable], minlength=len(chosen)) - k[chosen] // (misses + 1)
    bare = spare <= 0
    spare[bare] = 0
    kind = instance[chosen][owner].astype(np.uint64)
    out_owner, out_mark = [], []
    for number, subset in enumerate(combinations(range(parts), keep)):
        total = np.zeros(len(owner), np.uint64)
        some = np.zeros(len(owner), bool)
        for factor, j in zip(tb.constants(parts, 41)[list(subset)], subset, strict=True):
            total += content[:, j] * factor
            some |= full[:, j]
        send = some | bare[owner]
        seed = (kind * np.uint64(4099) + group.astype(np.uint64)) * np.uint64(8) + np.uint64(number)
        mark = tb.mix(total[send] + tb.mix(seed[send]))
        out_owner.append(chosen[owner[send]])
        out_mark.append((mark & ~np.uint64(3)) | (kind[send] & np.uint64(3)))
    return np.concatenate(out_owner), np.concatenate(out_mark), spare


# ---- sketches and verification --------------------------------------------------------------------------------------


def parity_bits(n: int) -> int:
    """Bits of the sketch of a set of n features: the power of two from twice its size on."""
    return max(64, 1 << (2 * n - 1).bit_length())


def parity_sketch(features: np.ndarray) -> bytes:
    bits = parity_bits(len(features))
    odd = np.bincount((features & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _folded(sketch: bytes, size: int) -> int:
    value, bits = int.from_bytes(sketch, "little"), 8 * len(sketch)
    while bits > 8 * size:
        bits //= 2
        value = (value >> bits) ^ (value & ((1 << bits) - 1))
    return value


def sketches_allow(n_a: int, n_b: int, a: bytes, b: bytes) -> bool:
    """False only if the sets cannot be similar."""
    if UNION_PARTS * min(n_a, n_b) < SHARED_PARTS * max(n_a, n_b):
        return False
    size = min(len(a), len(b))
    return (_folded(a, size) ^ _folded(b, size)).bit_count() <= int(most_different(np.int64(n_a + n_b)))


def _compare_blocks(table: pa.Table) -> pa.Table:
    """Pairs of nodes of two blocks (or of one), in different components, that ``sketches_allow``."""
    order = pa.compute.sort_indices(table, [("node", "ascending")])
    table = table.take(order)
    node, own, group, n = (table.column(c).to_numpy() for c in ("node", "own", "c_node", "n"))
    low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
    sketch = table.column("sketch").to_pylist()
    width = np.array([len(x) for x in sketch], np.int64)

    def sketches(rows: np.ndarray, size: int) -> np.ndarray:
        whole = np.frombuffer(b"".join(sketch[i] for i in rows), np.uint64).reshape(len(rows), -1, size // 8)
        return np.bitwise_xor.reduce(whole, axis=1)

    found = []
    for w_a in np.unique(width[own == low]):
        a_rows = np.flatnonzero((own == low) & (width == w_a))
        for w_b in np.unique(width[own == high]):
            b_rows = np.flatnonzero((own == high) & (width == w_b))
            size = int(min(w_a, w_b))
            if 4 * size < max(w_a, w_b):  # such sizes cannot be similar
                continue
            right = sketches(b_rows, size)
            for at in range(0, len(a_rows), 64):
                some = a_rows[at : at + 64]
                apart = np.bitwise_count(sketches(some, size)[:, None, :] ^ right[None, :, :]).sum(axis=2, dtype=np.int64)
                n_a, n_b = n[some][:, None], n[b_rows][None, :]
                yes = (apart <= most_different(n_a + n_b)) & (UNION_PARTS * np.minimum(n_a, n_b) >= SHARED_PARTS * np.maximum(n_a, n_b))
                yes &= group[some][:, None] != group[b_rows][None, :]
                i, j = np.nonzero(yes)
                found.append(np.stack([node[some[i]], node[b_rows[j]]], axis=1))
    pairs = np.concatenate(found) if found else np.empty((0, 2), np.int64)
    if low == high:
        pairs = pairs[pairs[:, 0] < pairs[:, 1]]
    return pa.table({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return UNION_PARTS * shared >= SHARED_PARTS * (len(a) + len(b) - shared) and shared > 0


# ---- the join -------------------------------------------------------------------------------------------------------


def _node(id_col: str, text: Column) -> Column:
    own = F.lit(NULL_IDS) + F.pmod(F.xxhash64(text), F.lit(NULL_IDS))
    return F.coalesce(col(id_col).cast("long"), own)


def _light(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(col(text_col), F.lit(""))
    return docs.select(_node(id_col, text).alias("node"), text.alias("text"))


_SETS = pa.schema(
    [("node", pa.int64()), ("n", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("own", pa.int32()), ("up", pa.int32()), ("down", pa.int32()), ("sketch", pa.binary())]
)
_SETS_DDL = "node long, n long, f1 long, f2 long, own int, up int, down int, sketch binary"
_SENT = pa.schema([("bucket", pa.int32()), ("marks", pa.binary()), ("nodes", pa.binary())])
_SENT_DDL = "bucket int, marks binary, nodes binary"
_FINEST = pa.schema([("cluster", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("merged", pa.int64()), ("marks", pa.binary())])
_FINEST_DDL = "cluster long, node long, n long, merged long, marks binary"
_MET = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("mark", pa.int64())])
_MET_DDL = "a long, b long, mark long"


def _fingerprints(sets: Sets) -> tuple[np.ndarray, np.ndarray]:
    """128 bits per set."""
    total = np.zeros((2, len(sets.features) + 1), np.uint64)
    np.cumsum(tb.mix(sets.features + np.uint64(1)), out=total[0, 1:])
    np.cumsum(tb.mix(sets.features ^ np.uint64(0xA5A5A5A5A5A5A5A5)), out=total[1, 1:])
    return tuple((t[sets.first[1:]] - t[sets.first[:-1]]).view(np.int64) for t in total)


def _describe(shingle: int):
    def describe(batches):
        for batch in batches:
            nodes = batch.column(0).to_numpy()
            for row, to, data, offsets in tb.chunks(batch.column(1)):
                sets = shingle_sets(data, offsets, shingle)
                f1, f2 = _fingerprints(sets)
                _, _, slack = signatures(sets)
                drawn = [parity_sketch(sets.features[a:b]) for a, b in zip(sets.first[:-1], sets.first[1:], strict=True)]
                columns = [nodes[row:to], sets.sizes, f1, f2, *(slack[:, j].astype(np.int32) for j in range(3))]
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), pa.array(drawn, pa.binary())], schema=_SETS)

    return describe


def _sent(marks: list[np.ndarray], nodes: list[np.ndarray], buckets: int, common: int) -> list[pa.RecordBatch]:
    """Packed (bucket, marks, nodes) rows.

    Of a signature that is common within a batch already, its bucket gets just enough nodes to see that; the others go, with the whole
    signature, to a bucket below zero, which any task may take.  So a signature that every document has does not gather them in
    one task.
    """

    def rows_of(mark, node, bucket, wide):
        order = np.lexsort((node, bucket))
        mark, node, bucket = mark[order], node[order], bucket[order]
        heads = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        packed = mark.view(np.int64) if wide else mark.astype(np.uint32)
        return [(int(bucket[i]), tb.pack(packed[i:j]), _pack_nodes(node[i:j])) for i, j in zip(heads, np.append(heads[1:], len(bucket)), strict=True)]

    mark, node = np.concatenate(marks), np.concatenate(nodes)
    bucket = (((mark >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
    order = np.lexsort((node, mark))
    mark, node, bucket = mark[order], node[order], bucket[order]
    heads = np.flatnonzero(np.append(True, mark[1:] != mark[:-1]))
    counts = np.diff(np.append(heads, len(mark)))
    spare = np.arange(len(mark)) - np.repeat(heads, counts) > common
    rows = rows_of(mark[~spare], node[~spare], bucket[~spare], False)
    if spare.any():
        wide = (bucket[spare].astype(np.uint64) << np.uint64(32)) | (mark[spare] & np.uint64(0xFFFFFFFF))
        aside = -1 - (node[spare] % buckets)
        rows += rows_of(wide, node[spare], aside, True)
    return tt.table(rows, _SENT).to_batches()


def _send(shingle: int, buckets: int, common: int):
    """The signatures of all sets; of equal sets in a batch only the smallest node's are sent."""

    def send(batches):
        marks, nodes, held, seen = [], [], 0, {}
        for batch in batches:
            own = batch.column(0).to_numpy()
            for row, to, data, offsets in tb.chunks(batch.column(1)):
                sets = shingle_sets(data, offsets, shingle)
                f1, f2 = _fingerprints(sets)
                fresh = np.zeros(len(sets.sizes), bool)
                for i in np.argsort(own[row:to], kind="stable"):
                    key = (f1[i], f2[i])
                    if key not in seen:
                        seen[key] = None
                        fresh[i] = True
                owner, mark, _ = signatures(_only(sets, fresh))
                marks.append(mark)
                nodes.append(own[row:to][fresh][owner])
                held += len(mark)
                if held >= _FLUSH:
                    yield from _sent(marks, nodes, buckets, common)
                    marks, nodes, held, seen = [], [], 0, {}
        if held:
            yield from _sent(marks, nodes, buckets, common)

    return send


def _finest(shingle: int):
    """(cluster, node, n, merged, marks): each feature as a signature of its cluster; ``merged``: by how much the distinct marks may be fewer
    than the features, since 32 bits of a mark and its bucket travel."""

    def finest(batches):
        for batch in batches:
            for row, to, data, offsets in tb.chunks(batch.column(1)):
                cluster = batch.column(2).slice(row, to - row)
                sets = shingle_sets(data, offsets, shingle)
                owner = np.repeat(np.arange(len(sets.sizes)), sets.sizes)
                marks = tb.mix(sets.features + tb.mix(cluster.to_numpy().view(np.uint64))[owner])
                low = marks & np.uint64(0xFFFFFFFF)
                order = np.lexsort((low, owner))
                again = (low[order][1:] == low[order][:-1]) & (owner[1:] == owner[:-1])
                merged = np.bincount(owner[1:][again], minlength=len(sets.sizes)).astype(np.int64)
                packed = pa.array([tb.pack(marks[a:b]) for a, b in zip(sets.first[:-1], sets.first[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([cluster, batch.column(0).slice(row, to - row), pa.array(sets.sizes), pa.array(merged), packed], schema=_FINEST)

    return finest


def _send_finest(buckets: int, common: int):
    def send(batches):
        marks, nodes, held = [], [], 0
        for batch in batches:
            for node, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                marks.append(np.frombuffer(packed, np.uint64))
                nodes.append(np.full(len(marks[-1]), node, np.int64))
                held += len(marks[-1])
                if held >= _FLUSH:
                    yield from _sent(marks, nodes, buckets, common)
                    marks, nodes, held = [], [], 0
        if held:
            yield from _sent(marks, nodes, buckets, common)

    return send


def _only(sets: Sets, wanted: np.ndarray) -> Sets:
    sizes = sets.sizes[wanted]
    return Sets(sets.features[np.repeat(wanted, sets.sizes)], sizes, np.append(0, np.cumsum(sizes)))


def _pack_nodes(nodes: np.ndarray) -> bytes:
    """Ascending node ids: first id, width of the steps, steps in as few bytes as they need."""
    steps = np.diff(nodes)
    kind = np.min_scalar_type(int(steps.max())) if len(steps) else np.dtype(np.uint8)
    return np.array([nodes[0], kind.itemsize], np.int64).tobytes() + steps.astype(kind).tobytes()


def _unpack_nodes(packed: bytes) -> np.ndarray:
    first, width = np.frombuffer(packed, np.int64, 2)
    return np.cumsum(np.append(first, np.frombuffer(packed, f"<u{width}", offset=16).astype(np.int64)))


def _meet(common: int):
    """Pairs of nodes over rare signatures; (node, node, mark) rows of the common ones."""

    def meet(sent: pa.Table) -> pa.Table:
        bucket = sent.column("bucket")[0].as_py()
        kind = np.uint32 if bucket >= 0 else np.int64
        mark = np.concatenate([np.frombuffer(m, kind) for m in sent.column("marks").to_pylist()])
        node = np.concatenate([_unpack_nodes(n) for n in sent.column("nodes").to_pylist()])
        if bucket < 0:  # of common signatures, beyond what their own bucket needs
            return pa.Table.from_arrays([pa.array(node), pa.array(node), pa.array(mark)], schema=_MET)
        order = np.lexsort((node, mark))
        mark, node = mark[order], node[order]
        new = np.append(True, (mark[1:] != mark[:-1]) | (node[1:] != node[:-1]))
        mark, node = mark[new], node[new]
        heads = np.flatnonzero(np.append(True, mark[1:] != mark[:-1]))
        counts = np.diff(np.append(heads, len(mark)))
        count = np.repeat(counts, counts)
        pairs = []
        for step in range(1, common):
            hit = np.flatnonzero((mark[step:] == mark[:-step]) & (count[step:] <= common))
            if len(hit):
                pairs.append(np.stack([node[hit], node[hit + step]], axis=1))
        found = np.unique(np.concatenate(pairs), axis=0) if pairs else np.empty((0, 2), np.int64)
        often = count > common
        wide = (np.int64(bucket) << 32) | mark[often].astype(np.int64)
        return pa.Table.from_arrays(
            [
                pa.array(np.concatenate([found[:, 0], node[often]])),
                pa.array(np.concatenate([found[:, 1], node[often]])),
                pa.array(np.concatenate([np.full(len(found), -1, np.int64), wide])),
            ],
            schema=_MET,
        )

    return meet


def _allow(batches):
    for batch in batches:
        n_a, n_b, a, b = (batch.column(j).to_pylist() for j in range(2, 6))
        yes = [sketches_allow(*x) for x in zip(n_a, n_b, a, b, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(yes, pa.bool_()))


def _verify(batches):
    for batch in batches:
        a, b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        yes = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(a, b, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(yes, pa.bool_()))


def _features(shingle: int):
    def features(batches):
        for batch in batches:
            for row, to, data, offsets in tb.chunks(batch.column(1)):
                sets = shingle_sets(data, offsets, shingle)
                packed = [tb.pack(sets.features[a:b]) for a, b in zip(sets.first[:-1], sets.first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, to - row), pa.array(packed, pa.binary())], names=["node", "features"])

    return features


class _Join:
    """The tables of one run of the join; each is staged in the shared folder."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, shingle: int, common: int, block: int):
        self.light, self.shingle, self.common, self.block = _light(docs, id_col, text_col), shingle, common, block
        self.sets = stage(self.light.mapInArrow(_describe(shingle), _SETS_DDL), "join-sets")
        sized = self.sets.filter("n > 0")
        # equal sets are one: a star around the smallest node
        groups = sized.groupBy("f1", "f2", "n").agg(F.min("node").alias("first"), F.max("node").alias("last"))
        groups = groups.filter("first < last").select("f1", "f2", "n", "first")
        copies = lookup(sized.select("node", "f1", "f2", "n"), groups, ["f1", "f2", "n"], salt_by=["node"], how="inner")
        self.copies = stage(copies.filter("node > first").select("node", "first").distinct(), "join-copies")
        several = sized.select("node", "f1", "f2").distinct().groupBy("node").count().filter("count > 1").select("node")
        self.moved = stage(self.copies.join(several, "node", "left_anti"), "join-moved")
        self.sketches = stage(sized.select("node", "n", "sketch").distinct(), "join-sketches")
        self.component = stage(components(self.copies, "node", "first"), "join-components")

    def representative(self, nodes: DataFrame, name: str) -> DataFrame:
        """Replace column ``name`` by the smallest node with an equal set."""
        moved = self.moved.select(F.col("node").alias("_from"), F.col("first").alias("_to"))
        joined = nodes.join(moved, F.col(name) == F.col("_from"), "left")
        return joined.withColumn(name, F.coalesce("_to", name)).drop("_from", "_to")

    def possible(self, pairs: DataFrame) -> DataFrame:
        """Distinct pairs whose sketches allow a link."""
        pairs = self.representative(self.representative(pairs, "a"), "b").filter("a <> b")
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = stage(pairs, "join-pairs")
        ids = stage(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "join-ids")
        sketch = self.sketches.join(checked_broadcast(ids), "node", "left_semi")
        a, b = (sketch.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}")) for x in "ab")
        both = pairs.join(a, "a").join(b, "b").select("a", "b", "n_a", "n_b", "s_a", "s_b")
        return stage(both.mapInArrow(_allow, "a long, b long").distinct(), "join-possible")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Of staged pairs, those that link."""
        ids = stage(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "join-ids")
        texts = self.light.join(checked_broadcast(ids), "node", "left_semi")
        sets = stage(texts.mapInArrow(_features(self.shingle), "node long, features binary").distinct(), "join-features")
        a, b = (sets.select(F.col("node").alias(x), F.col("features").alias(f"f_{x}")) for x in "ab")
        both = pairs.join(a, "a").join(b, "b").select("a", "b", "f_a", "f_b")
        return stage(both.mapInArrow(_verify, "a long, b long").distinct(), "join-links")

    def named(self, pairs: DataFrame, *columns: str) -> DataFrame:
        """Add ``c_<column>``: the component so far of each of these node columns."""
        for x in columns:
            known = self.component.select(F.col("node").alias(f"_{x}"), F.col("component").alias(f"_c{x}"))
            pairs = pairs.join(known, F.col(x) == F.col(f"_{x}"), "left").withColumn(f"c_{x}", F.coalesce(f"_c{x}", x)).drop(f"_{x}", f"_c{x}")
        return pairs

    def connect(self, links: DataFrame) -> None:
        """Merge components along new links; only the components themselves are walked."""
        if links.count() == 0:
            return
        between = stage(self.named(links, "a", "b").filter("c_a <> c_b").select("c_a", "c_b").distinct(), "join-between")
        merged = components(between, "c_a", "c_b").select(F.col("node").alias("_old"), F.col("component").alias("_new"))
        nodes = self.component.unionByName(merged.select(F.col("_old").alias("node"), F.col("_old").alias("component"))).distinct()
        self.component = stage(nodes.join(merged, F.col("component") == F.col("_old"), "left").select("node", F.coalesce("_new", "component").alias("component")), "join-components")

    def settle(self, pairs: DataFrame) -> None:
        """Verify candidates: one per document first, then what is still apart; a few are verified at once."""
        possible = self.possible(pairs)
        n = possible.count()
        if n == 0:
            return
        if n <= FEW_PAIRS:
            self.connect(self.verified(possible))
            return
        one = stage(possible.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "join-first")
        self.connect(self.verified(one))
        rest = self.named(possible.join(one, ["a", "b"], "left_anti"), "a", "b").filter("c_a <> c_b").select("a", "b")
        rest = stage(rest, "join-rest")
        if rest.count():
            self.connect(self.verified(rest))

    def run(self) -> DataFrame:
        buckets = tt.parts(self.light, 2)
        sent = self.light.mapInArrow(_send(self.shingle, buckets, self.common), _SENT_DDL)
        met = stage(sent.groupBy("bucket").applyInArrow(_meet(self.common), _MET_DDL), "join-met")
        pairs = met.filter("mark < 0").select("a", "b")
        often = met.filter("mark >= 0").select("mark", F.col("a").alias("node"))
        # a first hub per common signature, over an eighth of them: links large groups early, decides nothing
        hub = often.filter("mark & 28 = 0").groupBy("mark").agg(F.min("node").alias("a"))
        early = often.join(hub, "mark").select("a", F.col("node").alias("b")).filter("a <> b").distinct()
        self.settle(pairs.unionByName(early))
        self.meet_again(often)
        return self.result()

    def uncovered(self, often: DataFrame) -> DataFrame:
        """Rows (mark, node) of common signatures, for nodes that rare signatures do not cover in that instance."""
        low, high = bands()
        edges = F.array(*[F.lit(int(h)).cast("long") for h in high])
        band = F.size(F.filter(edges, lambda h: h < F.col("n")))
        counts = often.groupBy("node", (F.col("mark").bitwiseAND(3)).alias("kind")).agg(F.count(F.lit(1)).alias("often"))
        facts = self.sets.select("node", "own", "up", "down", band.alias("band"))
        code = F.pmod(F.col("kind") - 2 * F.col("band"), F.lit(4))
        slack = F.when(code == 0, F.col("own")).when(code == 1, F.col("up")).otherwise(F.col("down"))
        short = counts.join(facts, "node").filter(F.col("often") >= slack).select("node", "kind").distinct()
        marked = often.withColumn("kind", F.col("mark").bitwiseAND(3))
        return marked.join(short, ["node", "kind"], "left_semi").select("mark", "node")

    def meet_again(self, often: DataFrame) -> None:
        """Uncovered nodes against each other, across components of a cluster.

        A cluster is what common signatures tie together, so it holds every pair that shares one.
        """
        rows = stage(self.named(self.representative(self.uncovered(often), "node").distinct(), "node"), "join-uncovered")
        facts = rows.groupBy("mark").agg(F.min("c_node").alias("hub"), F.max("c_node").alias("y"))
        split = stage(facts.filter("hub < y").select("mark", "hub"), "join-split")
        # components, not nodes, are tied: a large group that is connected already is one end of a tie
        apart = stage(rows.join(checked_broadcast(split), "mark").select("hub", "node", "c_node").distinct(), "join-apart")
        tied = stage(components(apart.select("hub", "c_node").distinct(), "hub", "c_node"), "join-clusters")
        if tied.count() == 0:
            return
        known = tied.select(F.col("node").alias("c_node"), F.col("component").alias("cluster"))
        clusters = apart.select("node", "c_node").distinct().join(checked_broadcast(known), "c_node").select("cluster", "node", "c_node")
        clusters = stage(clusters, "join-clustered")
        large = stage(clusters.groupBy("cluster").count().filter(F.col("count") > self.block).select("cluster"), "join-large")
        left = clusters.join(checked_broadcast(large), "cluster", "left_anti").withColumn("narrow", F.lit(True))
        if large.count():
            left = left.unionByName(self.enumerated_again(clusters.join(checked_broadcast(large), "cluster", "left_semi")))
        self.settle(self.in_blocks(stage(left, "join-left")))

    def enumerated_again(self, clusters: DataFrame) -> DataFrame:
        """Settle the pairs of large clusters that share a feature few others of the cluster have; the nodes that may have further links.

        A missed pair shares only common features, so those of either set are as many as the pair must share: three quarters of the set
        at least, and six sevenths if it is the smaller one (``narrow``).  Pairs without a narrow set need no comparison.
        """
        nodes = stage(clusters.select("node", "cluster"), "join-again")
        texts = self.light.join(checked_broadcast(nodes), "node").select("node", "text", "cluster")
        finest = stage(texts.mapInArrow(_finest(self.shingle), _FINEST_DDL), "join-finest")
        buckets = tt.parts(self.light, 2)
        sent = finest.select("node", "marks").mapInArrow(_send_finest(buckets, self.common), _SENT_DDL)
        met = stage(sent.groupBy("bucket").applyInArrow(_meet(self.common), _MET_DDL), "join-met-again")
        apart = self.named(met.filter("mark < 0").select("a", "b").distinct(), "a", "b").filter("c_a <> c_b")
        self.settle(apart.select("a", "b"))
        often = met.filter("mark >= 0").groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("often"))
        may = F.col("often") + F.col("merged")
        short = finest.join(often, "node").filter(UNION_PARTS * may >= SHARED_PARTS * F.col("n"))
        short = short.groupBy("cluster", "node").agg(F.max((SHARED_PARTS + UNION_PARTS) * may >= 2 * SHARED_PARTS * F.col("n")).alias("narrow"))
        short = stage(self.named(short, "node"), "join-short")
        facts = short.groupBy("cluster").agg(F.min("c_node").alias("x"), F.max("c_node").alias("y"), F.max("narrow").alias("some"))
        open_ = stage(facts.filter("x < y AND some").select("cluster"), "join-open")
        return short.join(checked_broadcast(open_), "cluster", "left_semi").select("cluster", "node", "c_node", "narrow")

    def in_blocks(self, clusters: DataFrame) -> DataFrame:
        """Pairs of staged (cluster, node, c_node, narrow) rows with a narrow node that their sketches allow: blocks of narrow nodes against
        all blocks, two blocks a task."""
        narrow = F.count_if("narrow")
        sizes = clusters.groupBy("cluster").agg(
            F.ceil(narrow / self.block).cast("int").alias("first"), F.ceil((F.count(F.lit(1)) - narrow) / self.block).cast("int").alias("more")
        )
        placed = clusters.join(checked_broadcast(stage(sizes, "join-blocks")), "cluster").filter("first > 0")
        hashed = F.xxhash64("node")
        own = F.when(F.col("narrow"), F.pmod(hashed, F.col("first"))).otherwise(F.col("first") + F.pmod(hashed, F.greatest("more", F.lit(1))))
        last = F.col("first") - 1 + F.when(F.col("narrow"), F.col("more")).otherwise(0)
        dealt = placed.withColumn("own", own.cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), last.cast("int"))))
        dealt = dealt.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")}).join(self.sketches, "node")
        dealt = dealt.select("cluster", "low", "high", "own", "node", "c_node", "n", "sketch")
        return dealt.groupBy("cluster", "low", "high").applyInArrow(_compare_blocks, "a long, b long")

    def result(self) -> DataFrame:
        named = F.col("c_node")
        return self.named(self.sets, "node").select(
            F.when(F.col("node") < NULL_IDS, F.col("node")).alias("doc_id"),
            F.col("n").alias("n_shingles"),
            F.when(named < NULL_IDS, named).alias("component_id"),
            "node",
            named.alias("component"),
        )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, common: int = COMMON, block: int = BLOCK
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, node, component``.

    ``common``: from how many sets on a signature counts as common; ``block``: uncovered sets per block, and per cluster that is not
    enumerated again.  Both change the work, not
    the result.
    """
    return _Join(docs, id_col, text_col, shingle, common, block).run()


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its component (rows of one id stay or go together)."""
    marked = near_duplicates(docs, id_col, text_col)
    dropped = stage(marked.filter("component < node").select(F.col("node").alias("_dropped_node")).distinct(), "join-dropped")
    node = _node(id_col, F.coalesce(col(text_col), F.lit("")))
    return docs.join(checked_broadcast(dropped), node == F.col("_dropped_node"), "left_anti")
