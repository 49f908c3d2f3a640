"""Ordered features on a grid (W1-W5, W18, W19) and scalar ones.

The functions named ``*_cols`` return Columns over a given window, so a longer job can compute many features in one
tile layout; the others are the stand-alone operators.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidegrid import tiles
from tidegrid.config import GridSpec
from tidegrid.functions import timegrid as tg

IOB_DECAY = 0.0144
IOB_ROWS = 72


def delta_col(w: WindowSpec, col: str, rows: int = 1, default: float | None = None) -> Column:
    diff = F.col(col) - F.lag(col, rows).over(w)
    return diff if default is None else F.coalesce(diff, F.lit(default))


def slope_col(w: WindowSpec, col: str, rows: int, freq_seconds: int) -> Column:
    """Change per minute over ``rows`` rows; 0 unless both ends are present."""
    minutes = rows * freq_seconds / 60.0
    return F.coalesce((F.col(col) - F.lag(col, rows).over(w)) / F.lit(minutes), F.lit(0.0))


def minutes_since_col(w: WindowSpec, col: str, cap: int) -> Column:
    """Minutes since the last row with ``col > 0``, capped, and ``cap`` when there is none."""
    seen = F.last(F.when(F.col(col) > 0, F.col("ts")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return F.coalesce(F.least(tg.minutes_between(F.col("ts"), seen), F.lit(float(cap))), F.lit(float(cap)))


def lag_cols(w: WindowSpec, col: str = "bg") -> dict[str, Column]:
    lags = {f"{col}_lag_{k}": F.lag(col, k).over(w) for k in (1, 2, 6, 12)}
    return lags | {f"{col}_diff_{k}": delta_col(w, col, k) for k in (1, 3, 6)}


def rolling_cols(w: WindowSpec, basal: str = "basal_rate", bolus: str = "bolus_dose") -> dict[str, Column]:
    def trailing(k: int) -> WindowSpec:
        return w.rowsBetween(-(k - 1), 0)

    means = {f"basal_mean_{k}": F.avg(basal).over(trailing(k)) for k in (6, 12)}
    return means | {f"bolus_sum_{k}": F.sum(bolus).over(trailing(k)) for k in (6, 12, 24)}


def with_insulin_on_board(rows: DataFrame, w: WindowSpec, name: str, bolus: str = "bolus_dose") -> DataFrame:
    """Decayed sum of the last 72 rows, age 1 for the current row: ``sum(x_i * e^(-k * age_i))``, by two plain sums over those rows.

    Rows are counted in blocks of 72 and a dose is weighed by its place in the block, so no weight exceeds e^(72 k) however long the tile.  A
    frame reaches over two blocks at most: one sum has the doses of even blocks, the other those of odd ones.
    """
    place = F.row_number().over(w) - 1
    at, odd = F.col("_place") % IOB_ROWS, F.floor(F.col("_place") / IOB_ROWS) % 2 == 1
    weighed = F.coalesce(bolus, F.lit(0.0)) * F.exp(F.lit(IOB_DECAY) * at)
    rows = rows.withColumn("_place", place).withColumns({"_odd": F.when(odd, weighed).otherwise(0.0), "_even": F.when(odd, 0.0).otherwise(weighed)})
    frame = w.rowsBetween(-(IOB_ROWS - 1), 0)
    rows = rows.withColumns({"_odd": F.sum("_odd").over(frame), "_even": F.sum("_even").over(frame)})
    own, before = F.when(odd, F.col("_odd")).otherwise(F.col("_even")), F.when(odd, F.col("_even")).otherwise(F.col("_odd"))
    age = F.lit(-IOB_DECAY) * (at + 1)
    board = own * F.exp(age) + before * F.exp(age - F.lit(IOB_DECAY * IOB_ROWS))
    return rows.withColumn(name, board).drop("_place", "_odd", "_even")


def clip_cols(col: str, low: float, high: float, flag: str) -> dict[str, Column]:
    """Value forced into the range, and 1 where a non-null value was outside it."""
    value = F.col(col)
    outside = F.coalesce((value < low) | (value > high), F.lit(False))
    clipped = F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(high)), F.lit(low)))
    return {col: clipped, flag: outside.cast("int")}


def missing_col(col: str) -> Column:
    return F.col(col).isNull().cast("int")


def _on_tiles(grid: DataFrame, spec: GridSpec, rows: int, make) -> DataFrame:
    return tiles.with_halo(
        grid, lambda d, w: d.withColumns(make(w)), seconds=spec.tile_seconds, before=rows * spec.freq_seconds
    )


def add_delta(grid: DataFrame, spec: GridSpec, col: str, name: str, default: float | None = None) -> DataFrame:
    return _on_tiles(grid, spec, 1, lambda w: {name: delta_col(w, col, 1, default)})


def add_lags(grid: DataFrame, spec: GridSpec, col: str = "bg") -> DataFrame:
    return _on_tiles(grid, spec, 12, lambda w: lag_cols(w, col))


def add_rolling(grid: DataFrame, spec: GridSpec) -> DataFrame:
    return _on_tiles(grid, spec, 23, rolling_cols)


def add_minutes_since_bolus(grid: DataFrame, spec: GridSpec, cap: int = 1440) -> DataFrame:
    rows = math.ceil(cap * 60 / spec.freq_seconds)
    return _on_tiles(grid, spec, rows, lambda w: {"time_since_last_bolus": minutes_since_col(w, "bolus_dose", cap)})


def add_slopes(grid: DataFrame, spec: GridSpec) -> DataFrame:
    return _on_tiles(
        grid,
        spec,
        6,
        lambda w: {
            "bg_slope_15min": slope_col(w, "bg", 3, spec.freq_seconds),
            "bg_slope_30min": slope_col(w, "bg", 6, spec.freq_seconds),
        },
    )


def add_insulin_on_board(grid: DataFrame, spec: GridSpec) -> DataFrame:
    build = lambda rows, w: with_insulin_on_board(rows, w, "iob")
    return tiles.with_halo(grid, build, seconds=spec.tile_seconds, before=IOB_ROWS * spec.freq_seconds)


def add_trend(grid: DataFrame, spec: GridSpec) -> DataFrame:
    return _on_tiles(grid, spec, 6, lambda w: {"bg_trend": delta_col(w, "bg", 6, 0.0)})


def event_grid(grid: DataFrame, spec: GridSpec, clip: tuple[float, float] = (20.0, 600.0)) -> DataFrame:
    """The nine standard columns: clipped glucose and its change, basal, bolus, time of day and the two flags.

    The change is taken before clipping and the first row has none.
    """

    out = grid
    if "delta_bg" not in grid.columns:
        out = add_delta(grid, spec, "bg", "delta_bg")
    flags = {"bg_missing_flag": missing_col("bg")} | clip_cols("bg", *clip, flag="bg_clip_flag")
    out = out.withColumns(flags | tg.time_of_day(F.col("ts")))
    return out.select(
        *tiles.KEYS, "ts", "bg", "delta_bg", "basal_rate", "bolus_dose", "sin_time", "cos_time", "bg_clip_flag", "bg_missing_flag"
    )
