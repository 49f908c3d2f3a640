"""Ordered work without one-task-per-device.

A window partitioned by device alone puts a device that owns a third of all rows into a single task.  Here the
history of a device is cut into *tiles* of fixed time width, every window is partitioned by ``(device, tile)``, and what
a tile must know about its neighbours reaches it in one of two exact ways:

* **halo** - for frames of bounded length (lags, rolling sums, short-gap interpolation) the rows near a tile border are
  also copied into the neighbouring tile and dropped again afterwards; one shuffle, replication ``1 + halo / width``;
* **carry** - for unbounded state (last value seen, running counts) a per-tile summary is pre-aggregated map-side, folded
  along the tiles of each device (one row per device and tile, so its size depends on the covered time span, not on the
  number of rows) and joined back.

Results do not depend on the tile width; the tests compare narrow and wide tiles.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidegrid.functions import timegrid as tg
from tidegrid.session import stage

KEYS = ("pump_serial",)
TILE = "_tile"
CORE = "_core"


def tile_of(ts: Column, seconds: int) -> Column:
    return tg.int_div(tg.micros(ts), seconds * tg.MICROS)


def _halo(df: DataFrame, ts: str, seconds: int, before: int, after: int) -> DataFrame:
    low = tile_of(tg.shift(F.col(ts), -after), seconds)
    high = tile_of(tg.shift(F.col(ts), before), seconds)
    return df.withColumn(TILE, F.explode(F.sequence(low, high))).withColumn(
        CORE, F.col(TILE) == tile_of(F.col(ts), seconds)
    )


def with_halo(
    df: DataFrame,
    build: Callable[[DataFrame, WindowSpec], DataFrame],
    *,
    seconds: int,
    before: int = 0,
    after: int = 0,
    by: Sequence[str] = KEYS,
    order: Sequence[str] = ("ts",),
) -> DataFrame:
    """Run ``build(rows, window)`` per tile with ``before``/``after`` seconds of neighbouring rows visible.

    ``build`` must keep all rows and the helper columns; frames may look at most that far.
    """
    rows = spread(_halo(df, order[0], seconds, before, after), by)
    window = Window.partitionBy(*by, TILE).orderBy(*order)
    return build(rows, window).filter(F.col(CORE)).drop(TILE, CORE)


def with_row_halo(
    df: DataFrame,
    build: Callable[[DataFrame, WindowSpec], DataFrame],
    *,
    seconds: int,
    before: int = 0,
    after: int = 0,
    by: Sequence[str] = KEYS,
    order: Sequence[str] = ("ts",),
    rows_per_tile: int = 100_000,
) -> DataFrame:
    """``with_halo`` for rows without a regular spacing: the halo is counted in rows.

    Rows are numbered first (see ``row_numbers``) and the tiles are blocks of row numbers, equal in size however dense
    the data is.
    """
    numbered = row_numbers(df, seconds=seconds, by=by, order=order, number="_rn")
    position = F.col("_rn") - 1
    first = int_tile(F.greatest(position - after, F.lit(0)), rows_per_tile)
    rows = numbered.withColumn(TILE, F.explode(F.sequence(first, int_tile(position + before, rows_per_tile))))
    rows = rows.withColumn(CORE, F.col(TILE) == int_tile(position, rows_per_tile))
    window = Window.partitionBy(*by, TILE).orderBy("_rn")
    return build(rows, window).filter(F.col(CORE)).drop(TILE, CORE, "_rn")


def int_tile(position: Column, size: int) -> Column:
    return tg.int_div(position.cast("bigint"), size)


@dataclass(frozen=True)
class Prev:
    """``values`` of the last eligible row strictly before the tile, as a struct (null when there is none).

    The values are aggregated as plain columns, which keeps the per-tile summary a hash aggregation.
    """

    values: dict[str, Column]
    order: Column
    eligible: Column | None = None

    def struct(self) -> Column:
        packed = F.struct(*[c.alias(n) for n, c in self.values.items()])
        return packed if self.eligible is None else F.when(self.eligible, packed)


@dataclass(frozen=True)
class Next(Prev):
    """``values`` of the first eligible row strictly after the tile."""


@dataclass(frozen=True)
class Running:
    """Sum of ``value`` over all earlier tiles."""

    value: Column


@dataclass(frozen=True)
class Total:
    """``fold`` over all tiles of ``value``, itself an aggregate (``F.min('ts')`` folded by ``F.min``)."""

    value: Column
    fold: Callable[[Column], Column]


def summarise(df: DataFrame, by: Sequence[str], tile: str, items: dict) -> DataFrame:
    """One row per (key, tile): what each tile receives from the other tiles of its key."""
    aggregates, packed = [], {}
    for name, item in items.items():
        if isinstance(item, Prev):
            pick, extreme = (F.min_by, F.min) if isinstance(item, Next) else (F.max_by, F.max)
            order = item.order if item.eligible is None else F.when(item.eligible, item.order)
            aggregates += [pick(c, order).alias(f"{name}__{n}") for n, c in item.values.items()]
            aggregates.append(extreme(order).isNotNull().alias(f"{name}__any"))
            fields = F.struct(*[F.col(f"{name}__{n}").alias(n) for n in item.values])
            packed[name] = F.when(F.col(f"{name}__any"), fields)
        elif isinstance(item, Running):
            aggregates.append(F.sum(item.value).alias(name))
        else:
            aggregates.append(item.value.alias(name))
    per_tile = df.groupBy(*by, tile).agg(*aggregates).withColumns(packed)

    along = Window.partitionBy(*by).orderBy(tile).rowsBetween(Window.unboundedPreceding, -1)
    against = Window.partitionBy(*by).orderBy(F.col(tile).desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    folded = []
    for name, item in items.items():
        if isinstance(item, Prev):
            frame = against if isinstance(item, Next) else along
            folded.append(F.last(name, ignorenulls=True).over(frame).alias(name))
        elif isinstance(item, Running):
            folded.append(F.coalesce(F.sum(name).over(along), F.lit(0)).alias(name))
        else:
            folded.append(item.fold(F.col(name)).over(whole).alias(name))
    return per_tile.select(*by, tile, *folded)


def with_carry(
    df: DataFrame, items: dict, *, by: Sequence[str] = KEYS, tile: str = TILE, build: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Attach the carry columns ``items`` to every row of a frame that already has a tile column.

    ``build`` makes columns over the rows of a tile before the carry joins them, so that rows are sorted without it.

    The summary is the side to hash, never the rows: Spark judges rows by the bytes of the files they come from, and a dense grid, whose
    bytes are few, would be broadcast whole to the one task that has all summaries.
    """
    rows = spread(df, by, tile)
    return (rows if build is None else build(rows)).join(summarise(df, by, tile, items).hint("shuffle_hash"), [*by, tile])


def add_tile(df: DataFrame, seconds: int, ts: str = "ts") -> DataFrame:
    return df.withColumn(TILE, tile_of(F.col(ts), seconds))


def spread(df: DataFrame, by: Sequence[str] = KEYS, tile: str = TILE) -> DataFrame:
    """Partition by (key, tile) with an explicit number of partitions.

    Used right before rows are expanded or sorted: adaptive coalescing judges by the bytes before the expansion, or by those of rows that
    compress tenfold, and would pack thousands of tiles into one task.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *by, tile)


def in_tile(by: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*by, TILE).orderBy(*order)


def nearest(side: str, name: str, by: Sequence[str], order: str = "ts") -> Column:
    """Nearest non-null value of column ``name`` strictly before (``lag``) or after (``lead``) a row within its tile.

    One forward pass over the sorted tile for either side; the Python functions have no IGNORE NULLS, the SQL form has.
    """
    keys = ", ".join(f"`{k}`" for k in [*by, TILE])
    return F.expr(f"{side}(`{name}`, 1) IGNORE NULLS OVER (PARTITION BY {keys} ORDER BY `{order}`)")


def previous_row(
    df: DataFrame,
    cols: Sequence[str],
    *,
    seconds: int,
    by: Sequence[str] = KEYS,
    order: Sequence[str] = ("ts",),
    into: str = "prev",
) -> DataFrame:
    """Struct column ``into`` with ``cols`` of the preceding row of the same key (null on the first row)."""
    tiled = add_tile(df, seconds, order[0])
    item = Prev({c: F.col(c) for c in cols}, F.col(order[0]) if len(order) == 1 else F.struct(*order))
    carried = with_carry(tiled, {"_carry": item}, by=by)
    lagged = F.lag(item.struct()).over(in_tile(by, order))
    return carried.withColumn(into, F.coalesce(lagged, F.col("_carry"))).drop("_carry", TILE)


def row_numbers(
    df: DataFrame,
    *,
    seconds: int,
    by: Sequence[str] = KEYS,
    order: Sequence[str] = ("ts",),
    number: str = "rn",
    count: str | None = None,
) -> DataFrame:
    """1-based position of each row within its key, and optionally the number of rows of the key."""
    tiled = add_tile(df, seconds, order[0])
    items: dict = {"_before": Running(F.lit(1))}
    if count:
        items[count] = Total(F.count(F.lit(1)), F.sum)
    out = with_carry(tiled, items, by=by)
    position = F.row_number().over(in_tile(by, order)) + F.col("_before")
    return out.withColumn(number, position).drop("_before", TILE)


def edge_cols(window: WindowSpec, rows: int) -> dict[str, Column]:
    """``_pos``, the position in the tile, and ``_tail``, whether a row is among the last ``rows`` of it (see ``rows_back``)."""
    return {"_pos": F.row_number().over(window), "_tail": ~F.lead(F.lit(True), rows, False).over(window)}


def rows_back(laid: DataFrame, col: str, into: str, rows: int, *, by: Sequence[str] = KEYS, ts: str = "ts") -> DataFrame:
    """``into`` of rows laid out in tiles: ``col`` of the row ``rows`` earlier in their key, which ``into`` so far has of rows of the same tile.

    Only the first ``rows`` rows of a tile lack it; the rows before them are all among the first or the last ``rows`` of some tile, so
    those edges, a fixed number per tile, are put in order by themselves.
    """
    head = F.col("_pos") <= rows
    back = F.lag(col, rows).over(Window.partitionBy(*by).orderBy(ts, "_pos"))
    edges = laid.filter(head | F.col("_tail")).withColumn(into, back).filter(head)
    return laid.filter(~head).unionByName(edges)


def fill_context(
    df: DataFrame,
    values: dict[str, Column],
    eligible: Column,
    *,
    seconds: int,
    by: Sequence[str] = KEYS,
    ts: str = "ts",
    sides: Sequence[str] = ("prev", "next"),
    also: dict[str, tuple[dict[str, Column], Column]] | None = None,
) -> DataFrame:
    """Nearest eligible row on both sides of each row, at any distance, plus the first and last time of the key.

    Adds structs ``prev`` / ``next`` with ``values`` and the columns ``first_ts`` / ``last_ts``; ``also`` names further structs of
    values from the last row before that is eligible for them, out of the same carry.
    """
    tiled = add_tile(df, seconds, ts)
    order = F.col(ts)
    before, after = Prev(values, order, eligible), Next(values, order, eligible)
    items: dict = {"first_ts": Total(F.min(ts), F.min), "last_ts": Total(F.max(ts), F.max)}
    if "prev" in sides:
        items["_p"] = before
    if "next" in sides:
        items["_n"] = after
    others = {name: Prev(own, order, eligible_too) for name, (own, eligible_too) in (also or {}).items()}
    items |= {f"_{name}_carry": item for name, item in others.items()}
    own = {"_v": before.struct()} | {f"_{name}_own": item.struct() for name, item in others.items()}
    near = {name: nearest("lag", f"_{name}_own", by, ts) for name in others}
    carries = {name: f"_{name}_carry" for name in others}
    for side, function, carry in (("prev", "lag", "_p"), ("next", "lead", "_n")):
        if side in sides:
            near[side], carries[side] = nearest(function, "_v", by, ts), carry
    out = with_carry(tiled, items, by=by, build=lambda rows: rows.withColumns(own).withColumns(near).drop(*own))
    found = {name: F.coalesce(F.col(name), F.col(carry)) for name, carry in carries.items()}
    return out.withColumns(found).drop(*carries.values(), TILE)


def lookup(
    df: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    *,
    salt_by: Sequence[str],
    how: str = "left",
    broadcast_rows: int = 100_000,
    salts: int | None = None,
) -> DataFrame:
    """Join a table with one row per key to many rows of possibly hot keys.

    The table is staged and counted: up to ``broadcast_rows`` rows it is broadcast.  Beyond that the rows of a key are spread over
    salts by a hash of ``salt_by``, and a table row is copied only to the salts its key really has, so a quiet key is hardly
    copied and a hot one is read by many tasks.  ``salts`` defaults to four per shuffle partition.
    """
    staged = stage(table, "lookup")
    if staged.count() <= broadcast_rows:
        return df.join(F.broadcast(staged), list(on), how)
    n = salts or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(n)).cast("int"))
    present = salted.select(*on, "_salt").distinct()
    return salted.join(present.join(staged, list(on)), [*on, "_salt"], how).drop("_salt")


def attach_group(df: DataFrame, stats: DataFrame, group: Sequence[str], *, by: Sequence[str] = KEYS) -> DataFrame:
    """Join per-group results back to tiled rows by ``(key, tile, group)``, so a long group is spread over its tiles."""
    keys = [*by, *group]
    pairs = df.select(*by, TILE, *group).distinct()
    return df.join(pairs.join(stats, keys), [*by, TILE, *group], "left")


def attach_span(
    df: DataFrame,
    spans: DataFrame,
    start: str,
    end: str,
    group: Sequence[str],
    *,
    seconds: int,
    by: Sequence[str] = KEYS,
    ts: str = "ts",
    how: str = "left",
) -> DataFrame:
    """``attach_group`` for groups with known first and last time: the group table is cut into tiles by itself."""
    low, high = tile_of(F.col(start), seconds), tile_of(F.col(end), seconds)
    cut = spans.withColumn(TILE, F.explode(F.sequence(low, high)))
    return add_tile(df, seconds, ts).join(cut, [*by, TILE, *group], how).drop(TILE)
