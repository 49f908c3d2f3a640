"""Null runs and the five different fills.

They look alike and are kept apart on purpose: W7 and W8 interpolate short bounded gaps, W9 copies at the edges, W10 is
the limited fill chain, W11 carries without limit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidegrid import tiles
from tidegrid.config import GapRules, GridSpec
from tidegrid.functions import timegrid as tg
from tidegrid.operators.features import clip_cols
from tidegrid.tiles import KEYS


def _values(col: str) -> dict[str, Column]:
    return {"ts": F.col("ts"), "v": F.col(col)}


def _seen(col: str) -> Column:
    return F.when(F.col(col).isNotNull(), F.struct(*[c.alias(n) for n, c in _values(col).items()]))


def null_runs(grid: DataFrame, spec: GridSpec, col: str = "bg", include_open_end: bool = True) -> DataFrame:
    """One row per maximal null run with its first and last time, length and which sides are bounded.

    A run is named by its border: the last reading before it, which every row of the run knows through the carry.
    """
    step = spec.freq_seconds
    ctx = tiles.fill_context(grid.select(*KEYS, "ts", col), _values(col), F.col(col).isNotNull(), seconds=spec.tile_seconds)
    runs = (
        ctx.filter(F.col(col).isNull())
        .groupBy(*KEYS, F.col("prev.ts").alias("before_ts"))
        .agg(
            F.min("ts").alias("run_start"),
            F.max("ts").alias("run_end"),
            F.count(F.lit(1)).alias("run_len"),
            F.first("next.ts").alias("after_ts"),
        )
    )
    if not include_open_end:
        runs = runs.filter(F.col("after_ts").isNotNull())
    return runs.select(
        *KEYS,
        "run_start",
        "run_end",
        "run_len",
        F.col("before_ts").isNotNull().alias("bounded_left"),
        F.col("after_ts").isNotNull().alias("bounded_right"),
        (F.col("run_len") * F.lit(step / 60.0)).alias("run_minutes"),
    )


def with_neighbours(rows: DataFrame, by: Sequence[str] = KEYS, col: str = "bg") -> DataFrame:
    """Readings around each row inside its tile (``_prev``, ``_next``) and the first and last time of the tile.

    With a halo of ``limit + 1`` rows on both sides, a distance up to ``limit`` bins is exact, and a tile that ends closer
    than that to a row ends there because the series does.
    """
    whole = Window.partitionBy(*by, tiles.TILE)
    seen = rows.withColumn("_v", _seen(col))
    near = {"_prev": tiles.nearest("lag", "_v", by), "_next": tiles.nearest("lead", "_v", by)}
    return seen.withColumns(near).withColumns({"_t0": F.min("ts").over(whole), "_t1": F.max("ts").over(whole)}).drop("_v")


NEIGHBOURS = ("_prev", "_next", "_t0", "_t1")


def short_gap_cols(spec: GridSpec, limit: int, col: str = "bg") -> dict[str, Column]:
    """Columns over rows with neighbours.

    ``_fill`` is the straight line between the bounding readings where the gap has at most ``limit`` bins, ``_run_len`` the
    length of the gap as far as the tile shows it, ``_hard`` marks gaps longer than the limit.
    """
    step, ts = spec.freq_seconds, F.col("ts")
    left = F.coalesce(tg.bins_between(ts, F.col("_prev.ts"), step) - 1, tg.bins_between(ts, F.col("_t0"), step))
    right = F.coalesce(tg.bins_between(F.col("_next.ts"), ts, step) - 1, tg.bins_between(F.col("_t1"), ts, step))
    length = left + right + 1
    t0, t1 = tg.micros(F.col("_prev.ts")), tg.micros(F.col("_next.ts"))
    line = F.col("_prev.v") + (F.col("_next.v") - F.col("_prev.v")) * ((tg.micros(ts) - t0) / (t1 - t0))
    absent = F.col(col).isNull()
    bounded = F.col("_prev").isNotNull() & F.col("_next").isNotNull()
    return {
        "_fill": F.when(absent & bounded & (length <= limit), line),
        "_run_len": F.when(absent, length).otherwise(F.lit(0)),
        "_hard": absent & (length > limit),
    }


def impute_short_gaps(
    grid: DataFrame, spec: GridSpec, rules: GapRules = GapRules(), clip: tuple[float, float] = (20.0, 600.0)
) -> DataFrame:
    """Linear inside short bounded gaps; ``mask_bg`` marks bins without reading, ``mask_label`` those still empty."""
    limit = rules.max_impute_bins

    def build(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return with_neighbours(rows).withColumn("_fill", short_gap_cols(spec, limit)["_fill"]).drop(*NEIGHBOURS)

    reach = (limit + 1) * spec.freq_seconds
    filled = tiles.with_halo(grid, build, seconds=spec.tile_seconds, before=reach, after=reach)
    value = F.coalesce("bg", "_fill")
    clipped = F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(clip[1])), F.lit(clip[0])))
    return filled.withColumns({"mask_bg": F.col("bg").isNull(), "mask_label": value.isNull(), "bg": clipped}).drop("_fill")


def impute_with_flags(
    grid: DataFrame, spec: GridSpec, rules: GapRules = GapRules(), clip: tuple[float, float] = (20.0, 600.0)
) -> DataFrame:
    """The same fill with ``bg_was_imputed``, ``bg_impute_run_len``, ``bg_hard_gap`` and ``bg_clip_flag``.

    A gap is hard by its length alone; a short gap at the edge is neither imputed nor hard.
    """
    limit = rules.max_impute_bins

    def build(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return with_neighbours(rows).withColumns(short_gap_cols(spec, limit)).drop(*NEIGHBOURS)

    reach = (limit + 1) * spec.freq_seconds
    out = tiles.with_halo(grid, build, seconds=spec.tile_seconds, before=reach, after=reach)
    imputed = F.col("_fill").isNotNull()
    out = out.withColumns(
        {
            "bg_was_imputed": imputed.cast("int"),
            "bg_impute_run_len": F.when(imputed, F.col("_run_len")).otherwise(F.lit(0)).cast("int"),
            "bg_hard_gap": F.col("_hard").cast("int"),
            "bg": F.coalesce("bg", "_fill"),
        }
    ).drop("_fill", "_run_len", "_hard")
    return out.withColumns(clip_cols("bg", *clip, flag="bg_clip_flag"))


def edge_fill(grid: DataFrame, spec: GridSpec, rules: GapRules = GapRules()) -> DataFrame:
    """A leading or trailing null run of at most three bins takes the nearest value."""
    limit, step = rules.max_edge_bins, spec.freq_seconds

    def build(rows: DataFrame, w: WindowSpec) -> DataFrame:
        absent = F.col("bg").isNull()
        lead_len = tg.bins_between(F.col("_next.ts"), F.col("_t0"), step)
        tail_len = tg.bins_between(F.col("_t1"), F.col("_prev.ts"), step)
        leading = absent & F.col("_prev").isNull() & (lead_len <= limit)
        trailing = absent & F.col("_next").isNull() & (tail_len <= limit)
        edge = {
            "_edge": F.when(leading, F.col("_next.v")).when(trailing, F.col("_prev.v")),
            "_edge_len": F.when(leading, lead_len).when(trailing, tail_len),
        }
        return with_neighbours(rows).withColumns(edge).drop(*NEIGHBOURS)

    reach = (limit + 1) * spec.freq_seconds
    out = tiles.with_halo(grid, build, seconds=spec.tile_seconds, before=reach, after=reach)
    filled = F.col("_edge").isNotNull()
    was, length = F.lit(0), F.lit(0)
    if "bg_was_imputed" in grid.columns:
        was, length = F.col("bg_was_imputed"), F.col("bg_impute_run_len")
    return out.withColumns(
        {
            "bg": F.coalesce("bg", "_edge"),
            "bg_was_imputed": F.when(filled, F.lit(1)).otherwise(was),
            "bg_impute_run_len": F.when(filled, F.col("_edge_len").cast("int")).otherwise(length),
        }
    ).drop("_edge", "_edge_len")


def fill_chain(grid: DataFrame, spec: GridSpec, carry_limit: int = 6, line_limit: int = 24, until: str | None = None) -> DataFrame:
    """Carry at most 6 bins, then a line limited to 24 bins from both ends, then basal carried without limit.

    The line starts where the carry stopped; at the leading and trailing edge it is the nearest value.
    ``cgm_gap_filled`` is 1 for a value whose previous row is still empty after the fill (or does not exist).

    ``until`` names the column of a grid that comes as stretches (``grid.align``), of which only those of one point have a reading: so
    the readings around a stretch are those around each of its points, and points are made last.
    """
    step = spec.freq_seconds
    rate = {"basal": (_values("basal_rate"), F.col("basal_rate").isNotNull())}
    ctx = tiles.fill_context(grid, _values("bg"), F.col("bg").isNotNull(), seconds=spec.tile_seconds, also=rate)
    if until:
        points = F.explode(F.expr(f"sequence(ts, {until}, interval {step} seconds)"))
        ctx = ctx.withColumn("_at", points).withColumn("ts", F.col("_at")).drop("_at", until)
    ts, bg = F.col("ts"), F.col("bg")
    from_left = tg.bins_between(ts, F.col("prev.ts"), step)
    to_right = tg.bins_between(F.col("next.ts"), ts, step)

    def reached(left: Column, right: Column) -> Column:
        """Whether an empty bin at these distances from its readings gets a value."""
        past = left - carry_limit
        from_front = F.coalesce(past <= line_limit, F.lit(False))
        from_back = F.coalesce(right <= line_limit, F.lit(False))
        return from_front | from_back

    past = from_left - carry_limit
    line = F.col("prev.v") + (F.col("next.v") - F.col("prev.v")) * (past / (past + to_right))
    value = (
        F.when(F.col("prev").isNull(), F.col("next.v"))
        .when((from_left <= carry_limit) | F.col("next").isNull(), F.col("prev.v"))
        .otherwise(line)
    )
    filled = F.when(bg.isNotNull(), bg).when(reached(from_left, to_right), value)
    before_is_reading = F.coalesce(from_left == 1, F.lit(False))
    before_has_value = before_is_reading | reached(from_left - 1, F.when(bg.isNotNull(), F.lit(1)).otherwise(to_right + 1))
    opens = filled.isNotNull() & ((ts == F.col("first_ts")) | ~before_has_value)
    carried = F.coalesce("basal_rate", F.col("basal.v"))
    out = ctx.withColumns({"cgm_gap_filled": opens.cast("int"), "bg": filled, "basal_rate": carried})
    return out.drop("prev", "next", "first_ts", "last_ts", "basal")


def forward_fill(grid: DataFrame, spec: GridSpec, col: str, then_back: bool = False, default: float | None = None) -> DataFrame:
    """Last value without limit, optionally the first following value for leading nulls, optionally a constant."""
    sides = ("prev", "next") if then_back else ("prev",)
    ctx = tiles.fill_context(grid, _values(col), F.col(col).isNotNull(), seconds=spec.tile_seconds, sides=sides)
    parts = [F.col(col), F.col("prev.v")]
    if then_back:
        parts.append(F.col("next.v"))
    if default is not None:
        parts.append(F.lit(default))
    return ctx.withColumn(col, F.coalesce(*parts)).drop("prev", "next", "first_ts", "last_ts")
