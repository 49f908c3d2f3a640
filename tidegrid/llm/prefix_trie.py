"""A trie of conversation prefixes, encoded by balanced parentheses shard by shard.

A conversation is a path of turn fingerprints (role and text).  Equal paths are counted first, so a conversation that a third of all users had is
one row.  Distinct paths are dealt by range, and a task takes them in order, shard by shard (``SHARD_PATHS`` paths or
``SHARD_TURNS`` turns).  A shard's trie is a sequence of parentheses, a node an opening one and what it holds: excess is the running
difference, and blocks of ``BLOCK`` parentheses with their least excess, under a tree of minima, let ``findclose`` skip to where a subtree ends.
Between a node's parentheses, the rank of the pairs ``()`` counts leaves, and cumulative arrays over the opening ones give members and saved tokens.

Neighbouring shards share the nodes of their outermost paths only.  A shard returns every other node complete, and its first and
last path as spines: paths that carry, at each depth, what was found below.  Spines are paths again, two a shard, so the next round puts
them through the same code, until one shard is left, which completes all its nodes.  A node right below a spine node gets its parent's
number by a join with the spine nodes, which are counted before they are broadcast.

Defined cases: null roles and texts are empty; turns stand by number, null first, then by fingerprint (equal rows are turns like others); rows
without a conversation id are no conversation and are left out; an empty table has no node, not even a root; other columns do not
matter.  Turns are told apart by 64-bit fingerprints, nodes of different shards by 128-bit ones.  A conversation must fit in one row
as 20 bytes a turn; its texts need not.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.frames import checked_broadcast, col
from tidegrid.session import stage

SHARD_PATHS, SHARD_TURNS, FEWEST, BLOCK, IDS = 8192, 1 << 18, 8, 64, 4096
NO_ENDS = hashlib.sha256(b"").digest()
PATH = "path array<long>, chars array<long>, members array<long>, low array<long>, children array<long>, leaves array<long>, saved array<long>, ends array<binary>"
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, node_ends binary"
NO_ID = np.iinfo(np.int64).max


# ---- conversations and paths -----------------------------------------------------------------------------------------


def turns(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turns``: each conversation's turns in order, as (fingerprint, code points of the text)."""
    role, text = F.coalesce(col(role_col), F.lit("")), F.coalesce(col(text_col), F.lit(""))
    light = rows.select(
        col(conv_col).cast("long").alias("conv_id"),
        F.struct(col(turn_col).cast("long").alias("turn"), F.xxhash64(role, text).alias("print"), F.char_length(text).cast("long").alias("chars")).alias("t"),
    ).filter("conv_id IS NOT NULL")
    return light.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["print"], t["chars"])).alias("turns"))


def with_heads(convs: DataFrame, base: Column, shared: Column, most: int) -> DataFrame:
    """``convs`` with their first ``shared`` (at most ``most``) turns replaced by those that conversation ``base`` has."""
    heads = convs.select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    own = convs.withColumn("base", base).withColumn("shared", shared)
    kept = F.slice("turns", F.col("shared") + 1, F.greatest(F.size("turns"), F.lit(1)))
    head = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.col("shared"))
    return own.join(heads, "base", "left").select("conv_id", F.concat(head, kept).alias("turns"))


def _digest(batches):
    """SHA-256 of the texts of each key end to end; rows come by key and place."""
    key, state = None, None
    for batch in batches:
        out = []
        for k, chunk in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if k != key:
                if state is not None:
                    out.append((key, state.digest()))
                key, state = k, hashlib.sha256()
                state.update(chunk.encode())
            else:
                state.update(b"," + chunk.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out, strict=True)], names=["key", "ends"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.digest()], pa.binary())], names=["key", "ends"])


def paths(convs: DataFrame) -> DataFrame:
    """Distinct paths of ``convs`` (``conv_id, turns``) in the columns of ``PATH``.

    The ids that end at a path are joined in pieces of ``IDS`` numbers each and digested in order, piece by piece.
    """
    prints, chars = F.transform("turns", lambda t: t["print"]), F.transform("turns", lambda t: t["chars"])
    key = F.unhex(F.md5(F.concat_ws(",", prints.cast("array<string>"), F.lit("/"), chars.cast("array<string>"))))
    keyed = stage(convs.select("conv_id", prints.alias("path"), chars.alias("chars"), key.alias("key")), "trie-paths")
    pieces = keyed.groupBy("key", F.floor(F.col("conv_id") / IDS).alias("place")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("piece")
    )
    ordered = pieces.repartition("key").sortWithinPartitions("key", "place").select("key", "piece")
    ends = ordered.mapInArrow(_digest, "key binary, ends binary")
    counted = keyed.groupBy("key", "path", "chars").agg(F.count("*").alias("n"), F.min("conv_id").alias("low"))
    size = F.size("path")

    def at_end(value: Column, other: Column) -> Column:
        return F.concat(F.array_repeat(other, size), F.array(value))

    none = at_end(F.lit(0).cast("long"), F.lit(0).cast("long"))
    return counted.join(ends, "key").select(
        "path", "chars", at_end(F.col("n"), F.lit(0).cast("long")).alias("members"), at_end(F.col("low"), F.lit(int(NO_ID))).alias("low"),
        none.alias("children"), none.alias("leaves"), none.alias("saved"), at_end(F.col("ends"), F.lit(None).cast("binary")).alias("ends"),
    )


# ---- one shard -------------------------------------------------------------------------------------------------------


class Parentheses:
    """A balanced sequence (True opens) with least excesses of blocks, and of pairs of blocks, pairs of those, and so on."""

    def __init__(self, opens: np.ndarray):
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1))
        room = -(-max(len(opens), 1) // BLOCK) * BLOCK
        self.padded = np.full(room, np.iinfo(np.int64).max)
        self.padded[: len(opens)] = self.excess
        self.levels = [self.padded.reshape(-1, BLOCK).min(axis=1)]
        while len(self.levels[-1]) > 1:
            last = self.levels[-1]
            if len(last) % 2:
                last = np.append(last, np.iinfo(np.int64).max)
            self.levels.append(last.reshape(-1, 2).min(axis=1))
        self.leaf_rank = np.concatenate([[0], np.cumsum(opens[:-1] & ~opens[1:])]) if len(opens) else np.zeros(1, np.int64)

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """The closing parenthesis of each opening one: the first place behind it with less excess."""
        goal = self.excess[at] - 1
        block = at // BLOCK
        out = np.full(len(at), -1)
        todo = np.arange(len(at))
        self._within(todo, block, at, goal, out)
        todo = np.flatnonzero(out < 0)
        # up while no block to the right under the same parent reaches the goal, then down to the first that does
        node, level = block[todo], np.zeros(len(todo), np.int64)
        rising = np.ones(len(todo), bool)
        for height, minima in enumerate(self.levels):
            here = np.flatnonzero(rising)
            is_left = (node[here] % 2 == 0) & (node[here] + 1 < len(minima))
            reach = np.zeros(len(here), bool)
            reach[is_left] = minima[node[here][is_left] + 1] <= goal[todo[here[is_left]]]
            found = here[reach]
            node[found] += 1
            level[found] = height
            rising[found] = False
            node[here[~reach]] //= 2
        for height in range(len(self.levels) - 1, 0, -1):
            here = np.flatnonzero(level == height)
            left = node[here] * 2
            node[here] = left + (self.levels[height - 1][left] > goal[todo[here]])
            level[here] = height - 1
        self._within(todo, node, np.full(len(todo), -1), goal[todo], out)
        return out

    def _within(self, rows: np.ndarray, block: np.ndarray, behind: np.ndarray, goal: np.ndarray, out: np.ndarray) -> None:
        for part in range(0, len(rows), 4096):
            some = slice(part, part + 4096)
            place = block[some, None] * BLOCK + np.arange(BLOCK)
            hit = (self.padded[place] <= goal[some, None]) & (place > behind[some, None])
            has = hit.any(axis=1)
            out[rows[some][has]] = place[has, hit[has].argmax(axis=1)]

    def leaves(self, opened: np.ndarray, closed: np.ndarray) -> np.ndarray:
        """Pairs ``()`` from each opening to its closing parenthesis."""
        return self.leaf_rank[closed] - self.leaf_rank[opened]


class Path(NamedTuple):
    """A row in the columns of ``PATH``; all but ``path`` and ``chars`` have one entry more, the root's."""

    path: np.ndarray
    chars: np.ndarray
    members: np.ndarray
    low: np.ndarray
    children: np.ndarray
    leaves: np.ndarray
    saved: np.ndarray
    ends: list


class Shard(NamedTuple):
    """The nodes of some paths in preorder, node 0 the root: what the rows bring to each node, and what its subtree has."""

    depth: np.ndarray
    parent: np.ndarray
    own: dict  # members, low, children, leaves, saved
    ends: list
    convs: np.ndarray
    low: np.ndarray
    children: np.ndarray
    leaves: np.ndarray
    saved: np.ndarray
    first_path: np.ndarray  # nodes of the first path from the root on
    last_path: np.ndarray


def shared_turns(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def _least(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Least value of each non-empty range, from minima over powers of two."""
    out, length = np.empty(len(begin), values.dtype), end - begin
    power = np.frexp(length.astype(np.float64))[1] - 1
    table = values
    for k in range(int(power.max()) + 1 if len(power) else 0):
        here = power == k
        out[here] = np.minimum(table[begin[here]], table[end[here] - (1 << k)])
        table = np.minimum(table[: -(1 << k)], table[1 << k :]) if len(table) > 1 << k else table
    return out


def encode(rows: list[Path]) -> Shard:
    """The trie of sorted distinct paths.  Subtree figures of the outermost paths' nodes count this shard only."""
    common = [0] + [shared_turns(a.path, b.path) for a, b in zip(rows[:-1], rows[1:], strict=True)]
    sizes = np.array([len(r.path) for r in rows])
    n = int((sizes - common).sum()) + 1
    depth, chars, parent = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, -1, np.int64)
    opens = np.zeros(2 * n, bool)
    members, children, leaves, saved = (np.zeros(n, np.int64) for _ in range(4))
    low = np.full(n, NO_ID)
    ends: list = [None] * n
    spine, at, place, first_path = np.zeros(int(sizes.max()) + 1, np.int64), 0, 0, None
    for i, row in enumerate(rows):
        keep = common[i] + 1 if i else 0  # nodes kept of the path before
        if i:
            place += len(rows[i - 1].path) + 1 - keep  # their closing parentheses
        more = len(row.path) + 1 - keep
        spine[keep : keep + more] = np.arange(at, at + more)
        depth[at : at + more] = np.arange(keep, keep + more)
        if more:
            parent[at : at + more] = np.concatenate([[spine[keep - 1] if keep else -1], np.arange(at, at + more - 1)])
            chars[at : at + more] = row.chars[keep - 1 :] if keep else np.concatenate([[0], row.chars])
        opens[place : place + more] = True
        place += more
        at += more
        nodes = spine[: len(row.path) + 1]
        for target, source in ((members, row.members), (children, row.children), (leaves, row.leaves), (saved, row.saved)):
            target[nodes] += source
        low[nodes] = np.minimum(low[nodes], row.low)
        for d, digest in enumerate(row.ends):
            if digest is not None:
                ends[nodes[d]] = digest
        if i == 0:
            first_path = nodes.copy()
    last_path = spine[: len(rows[-1].path) + 1].copy()
    sequence = Parentheses(opens)
    opened, here = np.flatnonzero(opens), np.arange(n)
    closed = sequence.findclose(opened)
    last = np.cumsum(opens)[closed]  # nodes opened up to the closing parenthesis

    def below(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[last] - total[here]

    own_children = np.bincount(parent[1:], minlength=n)
    done = (own_children == 0) & (children > 0)  # a pair here, but its children were completed in an earlier round
    n_leaves = sequence.leaves(opened, closed) - below(done.astype(np.int64)) + below(leaves)
    convs = below(members)
    n_saved = below(saved) + below((convs - 1) * chars)
    own = {"members": members, "low": low, "children": children, "leaves": leaves, "saved": saved}
    return Shard(depth, parent, own, ends, convs, _least(low, here, last), children + own_children, n_leaves, n_saved, first_path, last_path)


def _next_key(above: bytes, turn: int, chars: int) -> bytes:
    return hashlib.blake2b(above + turn.to_bytes(8, "little", signed=True) + chars.to_bytes(8, "little"), digest_size=16).digest()


def keys(rows: list[Path]) -> list[bytes]:
    """A 128-bit fingerprint of every node of sorted paths, in preorder."""
    spine, out = [hashlib.blake2b(b"", digest_size=16).digest()], []
    for i, row in enumerate(rows):
        keep = shared_turns(rows[i - 1].path, row.path) if i else 0
        del spine[keep + 1 :]
        for turn, chars in zip(row.path[keep:].tolist(), row.chars[keep:].tolist(), strict=True):
            spine.append(_next_key(spine[-1], turn, chars))
        out += spine[keep + 1 if i else 0 :]
    return out


NODE_COLUMNS = pa.schema(
    [("key", pa.binary()), ("parent_key", pa.binary())]
    + [(name, pa.int64()) for name in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("node_ends", pa.binary())]
)
PATH_COLUMNS = pa.schema([(name, pa.list_(pa.int64())) for name in Path._fields[:-1]] + [("ends", pa.list_(pa.binary()))])
BOTH = f"key binary, parent_key binary, {NODE}, {PATH}"


def finished(rows: list[Path], whole: bool, keyed: bool) -> tuple[pa.Table, list[Path]]:
    """The complete nodes of a shard, and its spines.

    The trie is ``whole`` if no other shard has any of its nodes.  ``key`` is set where rows of earlier rounds may ask for it (``keyed``), and
    ``parent_key`` where the parent is not complete yet.
    """
    s = encode(rows)
    outer = np.zeros(len(s.depth), bool)
    known: dict[int, bytes] = {}
    if not whole:
        outer[s.first_path] = outer[s.last_path] = True
        for row, nodes in ((rows[0], s.first_path), (rows[-1], s.last_path)):
            known.update(zip(nodes.tolist(), keys([row]), strict=True))
    node = np.flatnonzero(~outer)
    up = s.parent[node]
    inside = (up >= 0) & ~outer[up]
    all_keys = keys(rows) if keyed else None
    table = pa.Table.from_arrays(
        [
            pa.array([all_keys[i] for i in node.tolist()] if keyed else [None] * len(node), pa.binary()),
            pa.array([known.get(u) if not i else None for u, i in zip(up.tolist(), inside.tolist(), strict=True)], pa.binary()),
            pa.array(s.low[node]),
            pa.array(s.depth[node]),
            pa.array(s.low[up], mask=~inside),
            pa.array(s.convs[node]),
            pa.array(s.children[node]),
            pa.array(s.leaves[node]),
            pa.array(s.saved[node]),
            pa.array([s.ends[i] or NO_ENDS for i in node.tolist()], pa.binary()),
        ],
        schema=NODE_COLUMNS,
    )
    return table, [] if whole else spines(s, rows[0], rows[-1], outer)


def spines(s: Shard, first: Path, last: Path, outer: np.ndarray) -> list[Path]:
    """The outermost paths with what each node has of its own and what hangs off it; what both share goes with the first."""
    hanging = np.flatnonzero(~outer & np.append(False, outer[s.parent[1:]]))
    up = s.parent[hanging]
    held = {name: values.copy() for name, values in s.own.items()}
    for name, values in (("members", s.convs), ("children", np.ones_like(s.convs)), ("leaves", s.leaves), ("saved", s.saved)):
        np.add.at(held[name], up, values[hanging])
    np.minimum.at(held["low"], up, s.low[hanging])

    def path(row: Path, nodes: np.ndarray, skip: int) -> Path:
        values = {name: v[nodes] for name, v in held.items()}
        for name, v in values.items():
            v[:skip] = NO_ID if name == "low" else 0
        return Path(row.path, row.chars, **values, ends=[None] * skip + [s.ends[i] for i in nodes[skip:].tolist()])

    out = [path(first, s.first_path, 0)]
    both = min(len(s.first_path), len(s.last_path))
    skip = int((s.first_path[:both] == s.last_path[:both]).sum())
    if skip < len(s.last_path):
        out.append(path(last, s.last_path, skip))
    return out


# ---- rounds ----------------------------------------------------------------------------------------------------------


def _read(batch: pa.RecordBatch):
    """The rows of a batch as paths."""
    parts = []
    for column in batch.columns[:-1]:
        ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))[:-1]
        parts.append(np.split(column.flatten().to_numpy(zero_copy_only=False), ends))
    return [Path(*row) for row in zip(*parts, batch.columns[-1].to_pylist(), strict=True)] if len(batch) else []


def _rows(nodes: pa.Table, paths: list[Path]):
    """Batches of ``BOTH``: nodes, then paths."""
    nothing = pa.Table.from_arrays([pa.nulls(len(nodes), f.type) for f in PATH_COLUMNS], schema=PATH_COLUMNS)
    both = pa.schema(list(NODE_COLUMNS) + list(PATH_COLUMNS))
    yield from pa.Table.from_arrays([*nodes.columns, *nothing.columns], schema=both).to_batches(4096)
    if paths:
        held = [pa.array([p[i] for p in paths], f.type) for i, f in enumerate(PATH_COLUMNS)]
        yield pa.RecordBatch.from_arrays([*(pa.nulls(len(paths), f.type) for f in NODE_COLUMNS), *held], schema=both)


def _round(sorted_paths: DataFrame, whole: bool, keyed: bool, shard_paths: int, shard_turns: int) -> DataFrame:
    """One pass over paths in order: rows of ``BOTH``."""

    def run(batches):
        held: list[Path] = []
        size = 0
        for batch in batches:
            for row in _read(batch):
                if not whole and len(held) >= FEWEST and (len(held) >= shard_paths or size + len(row.path) > shard_turns):
                    yield from _rows(*finished(held, whole, keyed))
                    held, size = [], 0
                held.append(row)
                size += len(row.path)
        if held:
            yield from _rows(*finished(held, whole, keyed))

    return sorted_paths.select(*Path._fields).mapInArrow(run, BOTH)


def trie(convs: DataFrame, shard_paths: int = SHARD_PATHS, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """A row per node of the trie of ``convs`` (``conv_id, turns``): the columns of ``NODE``, with ``ends_sha256`` in hex.

    Shards have at least ``FEWEST`` paths, whatever their length, so that every round leaves fewer spines than it got paths.
    """
    spark = convs.sparkSession
    todo, nodes, number = stage(paths(convs), "trie-distinct"), None, 1
    while True:
        n, total = todo.agg(F.count("*"), F.coalesce(F.sum(F.size("path").cast("long")), F.lit(0))).first()
        whole = n <= shard_paths and (total <= shard_turns or n <= FEWEST)
        if whole:
            ordered = todo.repartition(1).sortWithinPartitions("path", "chars")
        else:
            needed = max(-(-n // shard_paths), min(-(-total // shard_turns), n // FEWEST))
            spread = min(int(spark.conf.get("spark.sql.shuffle.partitions")), n // 512) if number == 1 else 1
            ordered = todo.repartitionByRange(max(needed, spread), "path", "chars").sortWithinPartitions("path", "chars")
        both = stage(_round(ordered, whole, number > 1, shard_paths, shard_turns), f"trie-round-{number}")
        mine = both.filter("path IS NULL").select("key", "parent_key", *(c.split()[0] for c in NODE.split(", ")[:-1]), "node_ends")
        nodes = mine if nodes is None else nodes.unionByName(mine)
        if whole:
            break
        todo, number = both.filter("path IS NOT NULL").select(*Path._fields), number + 1
    complete = nodes.filter("parent_key IS NULL")
    if number > 1:
        above = stage(nodes.filter("key IS NOT NULL").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above")), "trie-spines")
        asked = nodes.filter("parent_key IS NOT NULL").join(checked_broadcast(above), "parent_key")
        complete = complete.unionByName(asked.withColumn("parent_conv_id", F.col("above")).select(*complete.columns))
    return complete.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.lower(F.hex("node_ends")).alias("ends_sha256")
    )


def conversations(rows: DataFrame, shard_paths: int = SHARD_PATHS, shard_turns: int = SHARD_TURNS, **columns: str) -> DataFrame:
    """The trie of conversations as they are."""
    return trie(stage(turns(rows, **columns), "trie-turns"), shard_paths, shard_turns)


def rebuilt(rows: DataFrame, every: int = 100, most: int = 5, **columns: str) -> DataFrame:
    """The trie of conversations whose first turns (crc32 of the id modulo ``most`` + 1) come from the conversation at their hundred."""
    convs = stage(turns(rows, **columns), "trie-turns")
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    return trie(with_heads(convs, F.col("conv_id") - F.col("conv_id") % every, shared, most))
