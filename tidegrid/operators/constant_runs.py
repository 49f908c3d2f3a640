"""Runs of the placeholder value 100: detection, classification, repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid import tiles
from tidegrid.config import PLACEHOLDER_BG, GridSpec
from tidegrid.functions import timegrid as tg
from tidegrid.session import stage
from tidegrid.tiles import KEYS, TILE

REACH = 6  # bins looked at on both sides of a run
BASAL_STEP = 0.05
MIN_RUN = 2
BUCKET_BINS = 64  # width of the time buckets in which runs and rows meet


def _is_placeholder() -> Column:
    return F.coalesce(F.col("bg") == PLACEHOLDER_BG, F.lit(False))


def _marked(grid: DataFrame, spec: GridSpec) -> DataFrame:
    """Adds ``run_start`` of the maximal run of each placeholder row, and ``_step_from``, the time of the rate before a
    basal step (the last known one, also across missing rates).  Both come from one carry."""
    other = tiles.Prev({"ts": F.col("ts")}, F.col("ts"), ~_is_placeholder())
    basal = tiles.Prev({"ts": F.col("ts"), "v": F.col("basal_rate")}, F.col("ts"), F.col("basal_rate").isNotNull())
    first = tiles.Total(F.min("ts"), F.min)
    tiled = tiles.add_tile(grid, spec.tile_seconds)
    carried = tiles.with_carry(tiled, {"_oc": other, "_bc": basal, "_first": first})
    near = carried.withColumns({"_o": other.struct(), "_b": basal.struct()})
    near = near.withColumns(
        {
            "_o": F.coalesce(tiles.nearest("lag", "_o", KEYS), F.col("_oc")),
            "_b": F.coalesce(tiles.nearest("lag", "_b", KEYS), F.col("_bc")),
        }
    )
    start = F.coalesce(tg.shift(F.col("_o.ts"), spec.freq_seconds), F.col("_first"))
    moved = F.abs(F.col("basal_rate") - F.col("_b.v")) > BASAL_STEP
    return near.withColumns(
        {"run_start": F.when(_is_placeholder(), start), "_step_from": F.when(moved, F.col("_b.ts"))}
    ).drop("_o", "_b", "_oc", "_bc", "_first", TILE)


def placeholder_runs(grid: DataFrame, spec: GridSpec) -> DataFrame:
    """One row per run of at least two placeholder values with its evidence, verdict and confidence."""
    return _runs(_marked(grid.select(*KEYS, "ts", "bg", "basal_rate", "bolus_dose"), spec), spec)


def _runs(marked: DataFrame, spec: GridSpec) -> DataFrame:
    """Runs with the evidence found within six bins around them.

    Runs are few; they meet the rows near them in short time buckets, so nothing is computed for the other rows and the
    number of pairs per bucket stays small.
    """
    runs = (
        marked.filter(F.col("run_start").isNotNull())
        .groupBy(*KEYS, "run_start")
        .agg(F.max("ts").alias("run_end"), F.count(F.lit(1)).alias("run_len"))
        .filter(F.col("run_len") >= MIN_RUN)
    )
    reach, bucket = REACH * spec.freq_seconds, BUCKET_BINS * spec.freq_seconds
    around = runs.withColumns({"_lo": tg.shift(F.col("run_start"), -reach), "_hi": tg.shift(F.col("run_end"), reach)})
    cut = around.withColumn(
        "_k", F.explode(F.sequence(tiles.tile_of(F.col("_lo"), bucket), tiles.tile_of(F.col("_hi"), bucket)))
    )
    rows = marked.select(*KEYS, "ts", "bg", "bolus_dose", "_step_from", tiles.tile_of(F.col("ts"), bucket).alias("_k"))
    near = rows.join(cut, [*KEYS, "_k"]).filter(F.col("ts").between(F.col("_lo"), F.col("_hi")))
    # a basal step counts if it starts no earlier than six bins before the run
    active = F.coalesce(F.col("bolus_dose") > 0, F.lit(False)) | F.coalesce(F.col("_step_from") >= F.col("_lo"), F.lit(False))
    reading = F.col("bg").isNotNull() & ~_is_placeholder()
    before, after = reading & (F.col("ts") < F.col("run_start")), reading & (F.col("ts") > F.col("run_end"))
    found = near.groupBy(*KEYS, "run_start").agg(
        F.max("run_end").alias("run_end"),
        F.max("run_len").alias("run_len"),
        F.max(active).alias("has_insulin_activity"),
        F.min_by("bg", F.when(before, F.col("ts"))).alias("_before"),
        F.min_by("bg", F.when(after, F.col("ts"))).alias("_after"),
    )
    return _judge(found)


def _judge(runs: DataFrame) -> DataFrame:
    n, quiet = F.col("run_len"), ~F.col("has_insulin_activity")
    gradient = F.coalesce(F.abs(F.col("_after") - F.col("_before")) / (n + 2), F.lit(0.0))
    runs = runs.withColumn("transition_gradient", gradient).drop("_before", "_after")
    g = F.col("transition_gradient")
    zero = F.lit(0.0)
    confidence = (
        F.when(n >= 6, F.least(F.lit(0.4), n / 20.0)).otherwise(zero)
        + F.lit(0.3)
        + F.when(quiet & (n >= 4), F.lit(0.2)).otherwise(zero)
        + F.when(g > 3, F.least(F.lit(1.0), g / 6.0) * 0.1).otherwise(zero)
    )
    # rounded, because the threshold 0.6 is reached by sums of floats
    runs = runs.withColumns(
        {
            "is_synthetic": (n >= 6) | ((n >= 4) & quiet) | (g > 3),
            "confidence": F.round(F.least(confidence, F.lit(1.0)), 9),
        }
    )
    return runs.withColumn("replaced", F.col("is_synthetic") & (F.col("confidence") >= 0.6))


def repair_placeholders(grid: DataFrame, spec: GridSpec) -> DataFrame:
    """Null the replaced runs and flag every run row.

    The verdicts travel back per (device, tile, run), so a very long run does not meet in one task.
    """
    marked = stage(_marked(grid, spec), "marked")  # read for the runs, for their surroundings and for the result
    runs = _runs(marked, spec).select(*KEYS, "run_start", "run_end", "run_len", "replaced")
    runs = runs.withColumn("_first", F.col("run_start"))
    rows = tiles.attach_span(
        marked.drop("_step_from"), runs, "_first", "run_end", ["run_start"], seconds=spec.tile_seconds
    ).drop("_first", "run_end")
    in_run = F.col("run_len").isNotNull()
    replaced = F.coalesce(F.col("replaced"), F.lit(False))
    return rows.withColumns(
        {
            "bg": F.when(~replaced, F.col("bg")),
            "bg_flagged_fake_100": replaced.cast("int"),
            "bg_100_run_len": F.when(replaced, F.col("run_len")).otherwise(F.lit(0)),
            "bg_replaced_from_fake": replaced.cast("int"),
            "bg_100_real": (in_run & ~replaced & (F.col("run_len") == 2)).cast("int"),
        }
    ).drop("run_start", "run_len", "replaced")


def repair_stats(repaired: DataFrame, before: DataFrame) -> DataFrame:
    """Counts per device of placeholder values, replaced ones and accepted pairs."""
    original = before.groupBy(*KEYS).agg(F.count_if(_is_placeholder()).alias("n_placeholder"), F.count(F.lit(1)).alias("n_rows"))
    after = repaired.groupBy(*KEYS).agg(
        F.sum("bg_replaced_from_fake").alias("n_replaced"), F.sum("bg_100_real").alias("n_real")
    )
    return original.join(after, list(KEYS))
