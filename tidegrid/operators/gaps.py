"""Gaps between observed times, segments, spacing and rate checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid import tiles
from tidegrid.config import RAW_TILE_SECONDS, GapRules
from tidegrid.functions import timegrid as tg
from tidegrid.functions.quantiles import exact_percentiles
from tidegrid.session import stage
from tidegrid.tiles import KEYS, TILE


def observed_times(df: DataFrame, before: str | None = None) -> DataFrame:
    """Each time of a device once, without a sort.

    ``before`` names a column with the time of the row before, where rows have it already; it is kept, for ``steps``.
    """
    if before is None:
        return df.select(*KEYS, "ts").distinct()
    return df.filter(F.col(before).isNull() | (F.col("ts") != F.col(before))).select(*KEYS, "ts", before)


def steps(times: DataFrame, tile_seconds: int = RAW_TILE_SECONDS, before: str | None = None) -> DataFrame:
    """Every time with the time before it and the distance in seconds (null on the first row of a device)."""
    if before is None:
        out = tiles.previous_row(times, ["ts"], seconds=tile_seconds).withColumn("prev_ts", F.col("prev.ts")).drop("prev")
    else:
        out = times.withColumnRenamed(before, "prev_ts")
    return out.withColumn("step_seconds", tg.seconds_between(F.col("ts"), F.col("prev_ts")))


def find_gaps(times: DataFrame, longer_than_seconds: float, tile_seconds: int = RAW_TILE_SECONDS) -> DataFrame:
    """One row per distance strictly longer than the limit."""
    found = steps(times, tile_seconds).filter(F.col("step_seconds") > longer_than_seconds)
    return found.select(
        *KEYS,
        F.col("prev_ts").alias("gap_start"),
        F.col("ts").alias("gap_end"),
        (F.col("step_seconds") / 60.0).alias("gap_minutes"),
    )


def gap_summary(times: DataFrame, longer_than_seconds: float, tile_seconds: int = RAW_TILE_SECONDS) -> DataFrame:
    """Count, total, longest, mean and median gap per device; devices without a gap have count 0."""
    found = find_gaps(times, longer_than_seconds, tile_seconds)
    # gaps of equal length are counted once; totals and median share that one aggregation
    counted = found.groupBy(*KEYS, "gap_minutes").agg(F.count(F.lit(1)).alias("n"))
    totals = counted.groupBy(*KEYS).agg(
        F.sum("n").alias("n_gaps"),
        F.sum(F.col("gap_minutes") * F.col("n")).alias("total_gap_minutes"),
        F.max("gap_minutes").alias("max_gap_minutes"),
    )
    medians = exact_percentiles(counted, KEYS, "gap_minutes", {"median_gap_minutes": 0.5}, weight="n")
    devices = times.select(*KEYS).distinct()
    out = devices.join(totals, list(KEYS), "left").join(medians, list(KEYS), "left")
    out = out.fillna(0, ["n_gaps"]).fillna(0.0, ["total_gap_minutes"])
    mean = F.try_divide(F.col("total_gap_minutes"), F.when(F.col("n_gaps") > 0, F.col("n_gaps")).cast("double"))
    return out.withColumn("mean_gap_minutes", mean)


def with_segments(
    rows: DataFrame, rules: GapRules = GapRules(), tile_seconds: int = RAW_TILE_SECONDS, first: int = 1, start: str | None = None
) -> DataFrame:
    """``segment_id`` counted from ``first``: a new segment starts after a gap longer than the limit; ``start`` names a column for its start.

    One carry: a tile is summed up by its first and last time, the number of openings inside and the last of them.  Two such summaries
    side by side give that of both, since whether the second opens a segment follows from the last time of one and the first of
    the other; so one fold along the tiles yields number and start of the segment that every tile comes in with.  Rows with a tile column
    have been put into tiles, and are dealt by them, already.
    """
    tiled = rows if TILE in rows.columns else tiles.add_tile(rows, tile_seconds)
    inside = tiles.in_tile(KEYS, ["ts"])
    gap = tg.seconds_between(F.col("ts"), F.lag("ts").over(inside))
    flagged = tiled.withColumn("_opens", F.coalesce(gap > rules.max_gap_seconds, F.lit(False)).cast("int"))
    opened = F.when(F.col("_opens") == 1, F.col("ts"))
    per_tile = flagged.groupBy(*KEYS, TILE).agg(
        F.min("ts").alias("_first"), F.max("ts").alias("_last"), F.sum("_opens").alias("_inner"), F.max(opened).alias("_opened")
    )
    along = Window.partitionBy(*KEYS).orderBy(TILE)
    before = F.lag("_last").over(along)
    # the first row of a device opens its first segment, which is not counted
    cross = before.isNull() | (tg.seconds_between(F.col("_first"), before) > rules.max_gap_seconds)
    seen = per_tile.withColumns({"_enters": cross, "_cross": (cross & before.isNotNull()).cast("int")})
    newest = F.coalesce("_opened", F.when(F.col("_enters"), F.col("_first")))
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    carried = seen.select(
        *KEYS, TILE,
        (F.coalesce(F.sum(F.col("_inner") + F.col("_cross")).over(earlier), F.lit(0)) + F.col("_cross")).alias("_base"),
        F.when(F.col("_enters"), F.col("_first")).otherwise(F.last(newest, ignorenulls=True).over(earlier)).alias("_from"),
    )
    upto = inside.rangeBetween(Window.unboundedPreceding, Window.currentRow)  # rows of one time are of one segment
    columns = {"segment_id": F.col("_base") + F.sum("_opens").over(upto) + F.lit(first)}
    if start:
        columns[start] = F.coalesce(F.max(opened).over(upto), F.col("_from"))
    return flagged.join(carried, [*KEYS, TILE]).withColumns(columns).drop("_opens", "_base", "_from", TILE)


def segment_table(rows: DataFrame, rules: GapRules = GapRules(), keep_short: bool = False) -> DataFrame:
    """One row per segment; segments with fewer rows than the minimum are dropped."""
    table = rows.groupBy(*KEYS, "segment_id").agg(
        F.min("ts").alias("segment_start"), F.max("ts").alias("segment_end"), F.count(F.lit(1)).alias("n_rows")
    )
    return table if keep_short else table.filter(F.col("n_rows") >= rules.min_segment_bins)


def segment_summary(segments: DataFrame) -> DataFrame:
    return segments.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n_segments"),
        F.sum("n_rows").alias("total_rows"),
        F.avg("n_rows").alias("avg_rows"),
        F.max("n_rows").alias("max_rows"),
        F.min("n_rows").alias("min_rows"),
    )


def keep_long_segments(rows: DataFrame, rules: GapRules = GapRules(), tile_seconds: int = RAW_TILE_SECONDS) -> DataFrame:
    """Rows of the kept segments only; the lengths travel per (segment, tile), so one long segment is no hot key.

    The rows are read twice, for the lengths and beside them, so they are written once.
    """
    rows = stage(rows, "segments")
    table = segment_table(rows, rules).withColumnRenamed("n_rows", "segment_rows")
    return tiles.attach_span(rows, table, "segment_start", "segment_end", ["segment_id"], seconds=tile_seconds, how="inner").drop(
        "segment_start", "segment_end"
    )


def spacing_report(times: DataFrame, minutes: float = 5.0, slack: float = 0.5, tile_seconds: int = RAW_TILE_SECONDS) -> DataFrame:
    """Steps outside ``minutes +/- slack`` per device."""
    rows = steps(times, tile_seconds)
    ok = (F.col("step_seconds") / 60.0).between(minutes - slack, minutes + slack)
    return rows.groupBy(*KEYS).agg(
        F.count("step_seconds").alias("n_steps"), F.count_if(~ok).alias("n_irregular")
    ).withColumn("uniform", F.col("n_irregular") == 0)


def rate_report(
    readings: DataFrame,
    low_minutes: float = 4.0,
    high_minutes: float = 16.0,
    limit: float = 10.0,
    tile_seconds: int = RAW_TILE_SECONDS,
    before: tuple[str, str] | None = None,
) -> DataFrame:
    """Change per minute between consecutive readings 4 to 16 minutes apart.

    ``before`` names the columns with time and value of the reading before, where rows have them already.
    """
    rows = readings.filter(F.col("bg").isNotNull())
    if before is None:
        rows, before = tiles.previous_row(rows, ["ts", "bg"], seconds=tile_seconds), ("prev.ts", "prev.bg")
    minutes = tg.minutes_between(F.col("ts"), F.col(before[0]))
    rate = F.when(minutes.between(low_minutes, high_minutes), F.abs((F.col("bg") - F.col(before[1])) / minutes))
    return rows.select(*KEYS, rate.alias("rate")).groupBy(*KEYS).agg(
        F.count("rate").alias("n_rates"),
        F.count_if(F.col("rate") > limit).alias("n_extreme"),
        F.max("rate").alias("max_rate"),
    )


def sensor_windows(readings: DataFrame, size: int = 144, tile_seconds: int = RAW_TILE_SECONDS, numbered: bool = False) -> DataFrame:
    """Consecutive blocks of ``size`` non-null readings; a block is kept while its start is below ``n - size``.

    ``numbered`` readings have their number ``rn`` and that of all readings, ``n_values``, already.
    """
    present = readings.filter(F.col("bg").isNotNull())
    numbered = present if numbered else tiles.row_numbers(present, seconds=tile_seconds, number="rn", count="n_values")
    bucket = tg.int_div(F.col("rn") - 1, size)
    kept = numbered.withColumn("block", bucket).filter(F.col("block") * size < F.col("n_values") - size)
    return kept.groupBy(*KEYS, "block").agg(
        F.avg("bg").alias("block_mean"),
        F.stddev_samp("bg").alias("block_std"),
        (F.max("bg") - F.min("bg")).alias("block_range"),
    )


def sensor_trend(
    readings: DataFrame, size: int = 144, min_blocks: int = 3, drift: float = 5.0, fade: float = -2.0,
    tile_seconds: int = RAW_TILE_SECONDS, numbered: bool = False,
) -> DataFrame:
    """Slope of block means and of block deviations over the block number."""
    trend = sensor_windows(readings, size, tile_seconds, numbered).groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n_blocks"),
        F.regr_slope("block_mean", "block").alias("mean_slope"),
        F.regr_slope("block_std", "block").alias("std_slope"),
    )
    return trend.filter(F.col("n_blocks") >= min_blocks).withColumns(
        {
            "drift_detected": F.abs("mean_slope") > drift,
            "degradation_detected": F.coalesce(F.col("std_slope") < fade, F.lit(False)),
        }
    )
