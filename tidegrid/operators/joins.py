"""Interval, overlap, anti, semi and dimension joins and range generators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidegrid import tiles
from tidegrid.config import GridSpec
from tidegrid.functions import timegrid as tg
from tidegrid.session import stage
from tidegrid.tiles import KEYS


def response_after_dose(
    grid: DataFrame, spec: GridSpec, min_dose: float = 2.0, hours: float = 4.0, min_rows: int = 12, dosed: str | None = None
) -> DataFrame:
    """Lowest reading in (dose, dose + 4 h] per significant dose, as a range frame instead of a join.

    A frame is scanned anew for every row, so rows that no dose reaches go before it; those behind a dose all stay.  Where rows have the
    time of the last such dose up to them already (column ``dosed``), the others are not even shuffled.
    """
    reach = int(hours * 3600)
    if dosed is not None:
        grid = grid.filter(F.unix_seconds("ts") - F.unix_seconds(dosed) <= reach)

    def build(rows: DataFrame, w: WindowSpec) -> DataFrame:
        by_second = Window.partitionBy(*KEYS, tiles.TILE).orderBy("_sec")
        rows = rows.withColumn("_sec", F.unix_seconds("ts"))
        dose = F.last(F.when(F.col("bolus_dose") >= min_dose, F.col("_sec")), ignorenulls=True)
        rows = rows.withColumn("_dose", dose.over(by_second.rowsBetween(Window.unboundedPreceding, 0)))
        rows = rows.filter(F.col("_sec") - F.col("_dose") <= reach).drop("_dose")
        frame = by_second.rangeBetween(1, reach)
        return rows.withColumns({"min_bg": F.min("bg").over(frame), "n_after": F.count(F.lit(1)).over(frame)})

    out = tiles.with_halo(grid, build, seconds=spec.tile_seconds, after=reach)
    doses = out.filter((F.col("bolus_dose") >= min_dose) & (F.col("n_after") >= min_rows))
    return doses.select(*KEYS, "ts", "bolus_dose", F.col("bg").alias("pre_bg"), "min_bg", (F.col("bg") - F.col("min_bg")).alias("drop_bg"))


def overlapping(batches: DataFrame, start: Column, end: Column) -> DataFrame:
    """Batches that share a time with one range."""
    return batches.filter(~((F.col("end_ts") < start) | (F.col("start_ts") > end)))


def overlap_cells(
    left: DataFrame, right: DataFrame, on: Sequence[str] = KEYS, rows_per_cell: int = 512, tile_seconds: int = 86400
) -> tuple[DataFrame, DataFrame]:
    """Both sides of an overlap join, dealt to keys (``on``, ``_cell``, ``_part``) such that every pair meets under exactly one.

    The starts of both sides are numbered in order of time; ``rows_per_cell`` consecutive ones form a cell, so cells are equally
    full wherever the ranges lie.  A pair belongs to the cell of the later start.  Part 0 of a cell has its starts.  A range still open when
    a later cell begins is carried there: the carried ranges of a side are dealt into further parts of about ``rows_per_cell``, each with the
    starts of the other side.  So no key grows with the number of ranges that are open at once.
    """
    sides = {
        "l": stage(left.filter("l_start <= l_end").withColumn("_id", F.monotonically_increasing_id()), "overlap-left"),
        "r": stage(right.filter("r_start <= r_end").withColumn("_id", F.monotonically_increasing_id()), "overlap-right"),
    }
    ranges = [df.select(*on, F.lit(s).alias("_side"), "_id", F.col(f"{s}_start").alias("_s"), F.col(f"{s}_end").alias("_e")) for s, df in sides.items()]
    point = F.explode(F.array(F.struct(F.col("_s").alias("at"), F.lit(0).alias("ends")), F.struct(F.col("_e").alias("at"), F.lit(1).alias("ends"))))
    points = ranges[0].unionByName(ranges[1]).select(*on, "_side", "_id", point.alias("_p")).select(*on, "_side", "_id", "_p.*")
    # how many starts lie up to each start and up to each end (starts first among equal times)
    started = F.when(F.col("ends") == 0, 1).otherwise(0)
    carried = tiles.with_carry(tiles.add_tile(points, tile_seconds, "at"), {"_before": tiles.Running(started)}, by=on)
    upto = tiles.in_tile(on, ["at", "ends", "_side", "_id"]).rowsBetween(Window.unboundedPreceding, 0)
    cell = tg.int_div(F.sum(started).over(upto) + F.col("_before") - 1, rows_per_cell)
    # the number of an end is at least that of its own start, so least and greatest are the cells of start and end
    spans = carried.withColumn("_at", cell).groupBy(*on, "_side", "_id").agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"))
    spans = stage(spans, "overlap-spans")
    later = spans.filter("_last > _first").withColumn("_cell", F.explode(F.sequence(F.col("_first") + 1, F.col("_last"))))
    parts = later.groupBy(*on, "_cell").pivot("_side", ["l", "r"]).count().select(
        *on, "_cell", *[F.coalesce(F.ceil(F.col(s) / rows_per_cell), F.lit(0)).cast("int").alias(f"_{s}") for s in sides]
    )
    parts = stage(parts, "overlap-parts")
    out = []
    for side, other, own_part in (("l", "r", 1), ("r", "l", 2)):
        # parts of the ranges that this side carries are 2 j + own_part, those of the other side 2 j + 3 - own_part
        mine = spans.filter(F.col("_side") == side)
        starts = mine.withColumnRenamed("_first", "_cell").join(parts, [*on, "_cell"], "left")
        others = F.transform(F.sequence(F.lit(0), F.coalesce(F.col(f"_{other}"), F.lit(0))), lambda j: F.when(j > 0, 2 * j + 1 - own_part).otherwise(0))
        started_rows = starts.select("_id", "_cell", F.explode(others).alias("_part"))
        open_rows = later.filter(F.col("_side") == side).join(parts, [*on, "_cell"])
        open_rows = open_rows.select("_id", "_cell", (2 * F.pmod(F.xxhash64("_id"), F.col(f"_{side}")) + own_part).cast("int").alias("_part"))
        out.append(sides[side].join(started_rows.unionByName(open_rows), "_id").drop("_id"))
    return out[0], out[1]


def overlap_join(left: DataFrame, right: DataFrame, on: Sequence[str] = KEYS, rows_per_cell: int = 512, tile_seconds: int = 86400) -> DataFrame:
    """J7 for many ranges: pairs of ``left`` (``l_start``, ``l_end``) and ``right`` (``r_start``, ``r_end``) that share a time.

    A sweep over cells of equally many starts (``overlap_cells``).  Ranges without a start or end, or ending before they start, share no time.
    """
    l, r = overlap_cells(left, right, on, rows_per_cell, tile_seconds)
    hit = (F.col("l_start") <= F.col("r_end")) & (F.col("r_start") <= F.col("l_end"))
    return l.join(r, [*on, "_cell", "_part"]).filter(hit).drop("_cell", "_part")


def not_yet_done(planned: DataFrame, done: DataFrame, on: Sequence[str]) -> DataFrame:
    """J8 / U4."""
    return planned.join(done.select(*on), list(on), "left_anti")


def only_known(rows: DataFrame, accepted: DataFrame, on: Sequence[str]) -> DataFrame:
    """J12."""
    return rows.join(accepted.select(*on), list(on), "left_semi")


def dimension(rows: DataFrame, table: DataFrame, on: Sequence[str], spread_by: Sequence[str], how: str = "left") -> DataFrame:
    """Many rows of possibly hot keys to a dimension; rows without a match are kept."""
    return tiles.lookup(rows, table, on, salt_by=spread_by, how=how)


def date_chunks(spans: DataFrame, days: int) -> DataFrame:
    """Contiguous chunks of ``days`` between ``first_day`` and ``last_day`` of each row, numbered from 0."""
    starts = F.expr(f"CASE WHEN first_day < last_day THEN sequence(first_day, date_sub(last_day, 1), interval {days} days) END")
    rows = spans.select(*spans.columns, F.posexplode(starts).alias("chunk", "chunk_start"))
    return rows.withColumn("chunk_end", F.least(F.date_add("chunk_start", days), F.col("last_day")))


def overlapping_ranges(rows: DataFrame, starts: DataFrame, days: int = 30, step: int = 15, ts: str = "ts") -> DataFrame:
    """Put each row into the 30-day ranges that step by 15 days from the first day of its device.

    A row belongs to range ``k`` and, while inside, to earlier ones: a short array, no join against ranges.
    """
    joined = tiles.lookup(rows, starts.select(*KEYS, "first_day"), KEYS, salt_by=[ts], how="inner")
    elapsed = F.greatest(F.datediff(F.col(ts), F.col("first_day")), F.lit(0))  # grid padding may start a day early
    last = F.floor(elapsed / step).cast("int")
    first = F.greatest(F.floor((elapsed - days) / step).cast("int") + 1, F.lit(0))
    out = joined.withColumn("range_id", F.explode(F.sequence(first, last)))
    start = F.date_add("first_day", F.col("range_id") * step)
    return out.withColumns({"range_start": start, "range_label": F.date_format(start, "yyyy_MM")}).drop("first_day")


def batch_schedule(spans: DataFrame, frequency: str = "monthly", custom_days: int = 30, gap_days: int = 1) -> DataFrame:
    """D3: batches of 30 / 90 / custom days; the next batch starts ``gap_days`` after the end of the one before."""
    days = {"monthly": 30, "quarterly": 90}.get(frequency, custom_days)
    starts = F.expr(
        f"CASE WHEN first_day < last_day THEN sequence(first_day, date_sub(last_day, 1), interval {days + gap_days} days) END"
    )
    rows = spans.select(*spans.columns, F.posexplode(starts).alias("batch", "batch_start"))
    rows = rows.withColumn("batch_end", F.least(F.date_add("batch_start", days), F.col("last_day")))
    job_id = F.concat_ws(
        "_", F.col("pump_serial").cast("string"), F.date_format("batch_start", "yyyyMMdd"), F.date_format("batch_end", "yyyyMMdd")
    )
    return rows.withColumn("job_id", job_id)
