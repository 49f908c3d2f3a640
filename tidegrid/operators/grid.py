"""Device time grids, bin aggregation and as-of alignment."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid import tiles
from tidegrid.config import MAX_VALID_YEAR, MIN_VALID_YEAR, GridSpec
from tidegrid.functions import timegrid as tg
from tidegrid.functions.quantiles import exact_percentiles
from tidegrid.session import stage
from tidegrid.tiles import KEYS, TILE


def extents(events: DataFrame, spec: GridSpec, streams: Sequence[str] | None = None) -> DataFrame:
    """First and last grid point per device; times outside the valid years are ignored (no valid time, no grid)."""
    rows = events.filter(tg.valid_year(F.col("ts"), MIN_VALID_YEAR, MAX_VALID_YEAR))
    if streams:
        rows = rows.filter(F.col("stream").isin(*streams))
    span = rows.groupBy(*KEYS).agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return span.select(
        *KEYS,
        tg.floor_to(tg.shift(F.col("first_ts"), -spec.pad_seconds), spec.freq_seconds).alias("grid_start"),
        tg.ceil_to(tg.shift(F.col("last_ts"), spec.pad_seconds), spec.freq_seconds).alias("grid_end"),
    )


def _tile_spans(extent: DataFrame, spec: GridSpec) -> DataFrame:
    """One row per (device, tile) with the first and last grid point inside it."""
    size = spec.tile_seconds
    rows = extent.withColumn(
        TILE,
        F.explode(F.sequence(tiles.tile_of(F.col("grid_start"), size), tiles.tile_of(F.col("grid_end"), size))),
    )
    step = F.lit(size * tg.MICROS)
    tile_from = F.timestamp_micros(F.col(TILE) * step)
    tile_to = F.timestamp_micros((F.col(TILE) + 1) * step - F.lit(spec.freq_seconds * tg.MICROS))
    return rows.select(
        *KEYS,
        TILE,
        F.greatest("grid_start", tile_from).alias("tile_from"),
        F.least("grid_end", tile_to).alias("tile_to"),
    )


def _steps(start: str, end: str, spec: GridSpec) -> Column:
    return F.expr(f"sequence({start}, {end}, interval {spec.freq_seconds} seconds)")


def master_grid(extent: DataFrame, spec: GridSpec) -> DataFrame:
    """All grid points between ``grid_start`` and ``grid_end``; tiles are spread over tasks before they are expanded."""
    spans = tiles.spread(_tile_spans(extent, spec))
    return spans.select(*KEYS, F.explode(_steps("tile_from", "tile_to", spec)).alias("ts"))


def bin_last(events: DataFrame, stream: str, spec: GridSpec) -> DataFrame:
    """Last value per bin, by time and sequence number."""
    return _binned(events, stream, spec, F.max_by("value", F.struct("ts", "seq_num")))


def bin_first(events: DataFrame, stream: str, spec: GridSpec) -> DataFrame:
    return _binned(events, stream, spec, F.min_by("value", F.struct("ts", "seq_num")))


def bin_mean(events: DataFrame, stream: str, spec: GridSpec) -> DataFrame:
    return _binned(events, stream, spec, F.avg("value"))


def bin_sum(events: DataFrame, stream: str, spec: GridSpec) -> DataFrame:
    return _binned(events, stream, spec, F.sum("value"))


def bin_median(events: DataFrame, stream: str, spec: GridSpec) -> DataFrame:
    """Exact median per bin, without holding a bin's values in one buffer."""
    rows = _one_stream(events, stream).select(*KEYS, tg.floor_to(F.col("ts"), spec.freq_seconds).alias("ts"), "value")
    return exact_percentiles(rows, [*KEYS, "ts"], "value", {"median": 0.5}).withColumnRenamed("median", "value")


def _one_stream(events: DataFrame, stream: str) -> DataFrame:
    return events.filter((F.col("stream") == stream) & F.col("value").isNotNull())


def _binned(events: DataFrame, stream: str, spec: GridSpec, aggregate: Column) -> DataFrame:
    bin_ts = tg.floor_to(F.col("ts"), spec.freq_seconds).alias("bin_ts")
    grouped = _one_stream(events, stream).withColumn("bin_ts", bin_ts).groupBy(*KEYS, "bin_ts")
    return grouped.agg(aggregate.alias("value")).withColumnRenamed("bin_ts", "ts")


def resample(events: DataFrame, stream: str, spec: GridSpec, how: str) -> DataFrame:
    """A4: one stream resampled with a named aggregate."""
    return {"last": bin_last, "first": bin_first, "mean": bin_mean, "median": bin_median, "sum": bin_sum}[how](
        events, stream, spec
    )


def join_on_grid(grid: DataFrame, streams: dict[str, DataFrame], defaults: dict[str, float] | None = None) -> DataFrame:
    """Left equi-join of resampled streams onto the grid."""
    out = grid
    for name, frame in streams.items():
        out = out.join(frame.withColumnRenamed("value", name), [*KEYS, "ts"], "left")
    for name, default in (defaults or {}).items():
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(default)))
    return out


@dataclass(frozen=True)
class Alignment:
    """How the three streams reach the grid.

    * ``bg_fill``: ``none`` keeps a bin without a reading null (default); ``bounded`` carries a reading for at most
      ``bg_fill_seconds``; ``unbounded`` carries the last reading (as-of) forever.
    * ``bg_agg``: ``last`` / ``mean`` / ``first`` of the bin ``[t, t + freq)``; with ``bg_asof=True`` the value at *t* is
      the last reading at or before *t* instead.
    * ``basal_agg``: ``asof`` (last rate at or before *t*), ``last`` or ``mean`` of the bin, then carried forward; ``weighted`` is the mean over
      the minutes of the bin of the rate held in each (with ``until_last``: up to the minute of the last event).
    * ``basal_fill``: ``carry`` (default, to the end of the grid); ``until_last`` stops at the bin of the last event;
      ``tail_only`` fills nothing between events and carries only past the last one.
    * ``basal_default``: value where no rate is known (``None`` keeps null).
    * ``with_delta`` adds ``delta_bg``, the change from the previous grid point (only without a glucose fill, where it
      follows from neighbouring bins and needs no window over the dense grid).
    """

    bg_agg: str = "last"
    bg_asof: bool = False
    bg_fill: str = "none"
    bg_fill_seconds: int = 1800
    basal_agg: str = "asof"
    basal_fill: str = "carry"
    basal_default: float | None = 0.0
    with_delta: bool = False
    extent_streams: tuple[str, ...] | None = None


def align(
    events: DataFrame,
    spec: GridSpec,
    how: Alignment = Alignment(),
    extent_of: DataFrame | None = None,
    until: str | None = None,
    lean: bool = False,
) -> DataFrame:
    """Wide grid ``(pump_serial, ts, bg, basal_rate, bolus_dose)`` from events unique per (device, time, stream).

    Events outside the valid years neither widen the grid nor enter it.  ``extent_of`` may name events with the same times from
    before a deduplication, so that the extents need not repeat it.  ``until`` names a column for the grid as stretches: a row then
    stands for all grid points of a tile from ``ts`` to there, which have the same values.

    Only sparse rows are shuffled and sorted: events are pre-aggregated to bins, the state to carry is resolved between
    those bins, and the empty grid points are generated last, between one sparse row and the next.

    ``lean`` is for events about as many as grid points, of which bins leave no fewer: they are dealt by tile before they become bins, the
    bins are written once, and the result keeps its tile column, by which it stays dealt.
    """
    freq = spec.freq_seconds
    stream, value = F.col("stream"), F.col("value")
    up = F.lit(False)
    if how.bg_asof:
        up = up | (stream == "cgm")
    if how.basal_agg == "asof":
        up = up | (stream == "basal")
    at = F.when(up, tg.ceil_to(F.col("ts"), freq)).otherwise(tg.floor_to(F.col("ts"), freq))

    spans = _tile_spans(extents(events if extent_of is None else extent_of, spec, how.extent_streams), spec)
    skeleton = spans.select(
        *KEYS,
        F.col("tile_from").alias("bin_ts"),
        F.lit(None).cast("timestamp").alias("ts"),
        F.lit(None).cast("string").alias("stream"),
        F.lit(None).cast("double").alias("value"),
        F.col("tile_to"),
    )
    known = events.filter(value.isNotNull() & tg.valid_year(F.col("ts"), MIN_VALID_YEAR, MAX_VALID_YEAR))
    weighted = how.basal_agg == "weighted"
    rows = (known.filter(stream != "basal") if weighted else known).select(
        *KEYS,
        at.alias("bin_ts"),
        "ts",
        "stream",
        F.col("value").cast("double").alias("value"),
        F.lit(None).cast("timestamp").alias("tile_to"),
    )
    if weighted:
        steps = _rate_steps(known.filter(stream == "basal"), spec).withColumn("stream", F.lit("basal"))
        rows, skeleton = (df.unionByName(steps.limit(0), allowMissingColumns=True) for df in (rows, skeleton))
        rows = rows.unionByName(steps, allowMissingColumns=True)

    def of(name: str, col: Column) -> Column:
        return F.when(stream == name, col)

    def reduce_stream(name: str, agg: str) -> Column:
        if agg == "weighted":
            return F.max(of(name, value))  # one row a bin already
        order = of(name, F.col("ts"))  # a plain time keeps the aggregation hash based
        if agg in ("last", "asof"):
            return F.max_by(value, order)
        if agg == "first":
            return F.min_by(value, order)
        return F.avg(of(name, value))

    binned = rows.unionByName(skeleton)
    if lean:
        binned = tiles.spread(tiles.add_tile(binned, spec.tile_seconds, "bin_ts"))
    bins = (
        binned.groupBy(*KEYS, *([TILE] if lean else []), "bin_ts")
        .agg(
            reduce_stream("cgm", how.bg_agg).alias("bg"),
            (F.max(of("cgm", F.col("ts"))) if how.bg_asof else F.max(of("cgm", F.col("bin_ts")))).alias("bg_src"),
            reduce_stream("basal", how.basal_agg).alias("basal"),
            F.sum(of("bolus", value)).alias("bolus"),
            F.max("tile_to").alias("tile_to"),
            *[F.max(c).alias(c) for c in (RATE_STEPS if weighted else ())],
        )
    )
    bins = stage(bins, "bins", lean=True) if lean else tiles.add_tile(bins, spec.tile_seconds, "bin_ts")
    order = F.col("bin_ts")
    basal_seen = tiles.Prev({"ts": F.col("bin_ts"), "v": F.col("basal")}, order, F.col("basal").isNotNull())
    bg_seen = tiles.Prev({"ts": F.col("bg_src"), "v": F.col("bg")}, order, F.col("bg").isNotNull())
    bin_seen = tiles.Prev({"ts": F.col("bin_ts"), "v": F.col("bg")}, order)
    items: dict = {
        "basal_carry": basal_seen,
        "basal_last": tiles.Total(F.max(F.when(F.col("basal").isNotNull(), F.col("bin_ts"))), F.max),
    }
    if how.bg_fill != "none":
        items["bg_carry"] = bg_seen
    if how.with_delta:
        items["bin_carry"] = bin_seen
    carried = tiles.spread(tiles.with_carry(bins, items))

    w = tiles.in_tile(KEYS, ["bin_ts"])
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole_tile = Window.partitionBy(*KEYS, TILE)
    tile_from = F.min(F.when(F.col("tile_to").isNotNull(), F.col("bin_ts"))).over(whole_tile)
    tile_to = F.max("tile_to").over(whole_tile)
    next_bin = tg.shift(F.lead("bin_ts").over(w), -freq)
    sparse = carried.select(
        *KEYS,
        *([TILE] if lean else []),
        "bin_ts",
        F.greatest("bin_ts", tile_from).alias("run_from"),
        F.least(F.coalesce(next_bin, tile_to), tile_to).alias("run_to"),
        "bg",
        "bolus",
        "basal_last",
        F.coalesce(F.last(basal_seen.struct(), ignorenulls=True).over(upto), F.col("basal_carry")).alias("basal_now"),
        *(
            [F.coalesce(F.last(bg_seen.struct(), ignorenulls=True).over(upto), F.col("bg_carry")).alias("bg_now")]
            if how.bg_fill != "none"
            else []
        ),
        tile_to.isNotNull().alias("on_grid"),
        *(
            [F.coalesce(F.last(basal_seen.struct(), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.col("basal_carry")).alias("basal_before")]
            + [F.col(c) for c in ("basal", *RATE_STEPS)]
            if weighted
            else []
        ),
        *(
            [F.coalesce(F.lag(bin_seen.struct()).over(w), F.col("bin_carry")).alias("bin_before")]
            if how.with_delta
            else []
        ),
    )
    # With a grid taken from some streams only, events outside it have no grid point of their own.
    if weighted:
        # minutes of the bin before its first change, at the rate that came in; those held at its last one, cut at the last event of all
        lead = F.when(F.col("basal_before").isNotNull(), tg.bins_between(F.col("first_minute"), F.col("bin_ts"), 60)).otherwise(0)
        over = F.when(F.col("bin_ts") == F.col("basal_last"), F.col("last_minutes") - 1).otherwise(0)
        area = F.col("area") + lead * F.coalesce(F.col("basal_before.v"), F.lit(0.0)) - over * F.col("basal")
        sparse = sparse.withColumn("own_mean", area / (F.col("minutes") + lead - over))
    inside = sparse.filter(F.col("on_grid") & (F.col("run_to") >= F.col("run_from")))
    if until:
        # a run is its first point, which alone has values of its own, and the others, in two where a bounded fill ends
        second, fill_end = tg.shift(F.col("run_from"), freq), F.col("run_to")
        if how.bg_fill == "bounded":
            fill_end = F.greatest("run_from", F.least("run_to", F.coalesce(tg.floor_to(tg.shift(F.col("bg_now.ts"), how.bg_fill_seconds), freq), "run_to")))
        bounds = ((F.col("run_from"), F.col("run_from")), (second, fill_end), (tg.shift(fill_end, freq), F.col("run_to")))
        parts = F.array(*[F.struct(first.alias("ts"), last.alias(until)) for first, last in bounds])
        dense = inside.select("*", F.explode(parts).alias("_part")).drop("ts").select("*", "_part.*").filter(F.col("ts") <= F.col(until))
    else:
        dense = inside.withColumn("ts", F.explode(_steps("run_from", "run_to", spec)))
    own = F.col("ts") == F.col("bin_ts")

    basal = F.col("basal_now.v")
    if weighted:
        basal = F.coalesce(F.when(own, F.col("own_mean")), basal)
    if how.basal_fill == "until_last":
        basal = F.when(F.col("ts") <= F.col("basal_last"), basal)
    elif how.basal_fill == "tail_only":
        basal = F.when((F.col("ts") == F.col("basal_now.ts")) | (F.col("ts") > F.col("basal_last")), basal)
    if how.basal_default is not None:
        basal = F.coalesce(basal, F.lit(how.basal_default))

    if how.bg_fill == "none":
        bg = F.when(own, F.col("bg"))
    elif how.bg_fill == "unbounded":
        bg = F.col("bg_now.v")
    else:
        age = tg.micros(F.col("ts")) - tg.micros(F.col("bg_now.ts"))
        bg = F.when(age <= how.bg_fill_seconds * tg.MICROS, F.col("bg_now.v"))
    return dense.select(
        *KEYS,
        "ts",
        *([TILE] if lean else []),
        *([until] if until else []),
        bg.alias("bg"),
        basal.alias("basal_rate"),
        F.coalesce(F.when(own, F.col("bolus")), F.lit(0.0)).alias("bolus_dose"),
        *(
            [
                F.when(
                    own & (F.col("bin_before.ts") == tg.shift(F.col("ts"), -freq)), F.col("bg") - F.col("bin_before.v")
                ).alias("delta_bg")
            ]
            if how.with_delta
            else []
        ),
    )


RATE_STEPS = ("area", "minutes", "first_minute", "last_minutes")


def _rate_steps(events: DataFrame, spec: GridSpec) -> DataFrame:
    """Per device and bin with a change of rate: the last rate, the area and minutes from the first change to the end of the bin, the
    minute of the first change, and the minutes the last rate holds.

    A rate holds from its minute (rounded up) on; of several in a minute the last counts.
    """
    minute, freq = 60, spec.freq_seconds
    changes = events.groupBy(*KEYS, tg.ceil_to(F.col("ts"), minute).alias("_m")).agg(F.max_by("value", "ts").cast("double").alias("_rate"))
    changes = changes.withColumn("bin_ts", tg.floor_to(F.col("_m"), freq))
    following = F.lead("_m").over(Window.partitionBy(*KEYS, "bin_ts").orderBy("_m"))
    held = tg.bins_between(F.coalesce(following, tg.shift(F.col("bin_ts"), freq)), F.col("_m"), minute)
    return (
        changes.withColumn("_held", held.cast("double"))
        .groupBy(*KEYS, "bin_ts")
        .agg(
            F.max_by("_rate", "_m").alias("value"),
            F.max("_m").alias("ts"),
            F.sum(F.col("_rate") * F.col("_held")).alias("area"),
            F.sum("_held").alias("minutes"),
            F.min("_m").alias("first_minute"),
            F.max_by("_held", "_m").alias("last_minutes"),
        )
    )


def asof(events: DataFrame, stream: str, spec: GridSpec, tolerance_seconds: int | None = None) -> DataFrame:
    """At every grid point the last value of one stream at or before it, optionally no older than a limit."""
    fill = "unbounded" if tolerance_seconds is None else "bounded"
    one = events.withColumn("stream", F.when(F.col("stream") == stream, "cgm").otherwise("other"))
    how = Alignment(bg_asof=True, bg_fill=fill, bg_fill_seconds=tolerance_seconds or 0)
    return align(one, spec, how).select(*KEYS, "ts", F.col("bg").alias("value"))


def basal_time_weighted(events: DataFrame, spec: GridSpec, how: str = "mean") -> DataFrame:
    """The rate carried over whole minutes, then mean (or last) of each bin, up to the minute of the last rate.

    A step integral: bins with a change of rate get their area from the steps inside and the rate that comes in; the bins between are
    made last, in place, from one sparse row to the next (``align``).
    """
    rates = _one_stream(events, "basal")
    if how == "last":  # by minutes, of which the last event decides
        rates = rates.groupBy(*KEYS, "stream", tg.ceil_to(F.col("ts"), 60).alias("_m")).agg(F.max_by("value", "ts").alias("value")).withColumnRenamed("_m", "ts")
    how_to = Alignment(basal_agg="weighted" if how == "mean" else "last", basal_fill="until_last", basal_default=None)
    out = align(rates, replace(spec, pad_seconds=0), how_to)
    return out.filter(F.col("basal_rate").isNotNull()).select(*KEYS, "ts", F.col("basal_rate").alias("value"))
