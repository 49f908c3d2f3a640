"""Scoring of batches that may hold placeholder data, and the checks on whole files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.config import GridSpec, Ranges
from tidegrid.operators import summary
from tidegrid.operators.summary import share
from tidegrid.tiles import KEYS

ISSUES = ("dominant_value", "narrow_range", "low_variance", "few_values", "range_exceeded", "exact_100")


def _steps(value: Column, *ladder: tuple[Column, float]) -> Column:
    """First matching penalty of a ladder, else 0."""
    out = None
    for test, amount in ladder:
        out = F.when(test, F.lit(amount)) if out is None else out.when(test, F.lit(amount))
    return out.otherwise(F.lit(0.0))


def score_batches(rows: DataFrame, by: Sequence[str] = KEYS, col: str = "bg") -> DataFrame:
    """V1: six tests, a confidence between 0 and 1 and a verdict per batch.  All rows count, nulls included."""
    v = F.col(col)
    base = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.var_samp(v).alias("variance"),
        F.min(v).alias("min_value"),
        F.max(v).alias("max_value"),
        (share(v.between(95, 105)) * 100).alias("narrow_pct"),
        (share(v == 100) * 100).alias("exact_100_pct"),
    )
    profile = summary.value_profile(rows, col, by).select(*by, "n_distinct", "top_value", (F.col("top_share") * 100).alias("dominant_pct"))
    joined = base.join(profile, list(by))

    def holds(test: Column) -> Column:
        return F.coalesce(test, F.lit(False))

    variance = F.col("variance")
    tests = {
        "dominant_value": F.col("dominant_pct") > 25,
        "narrow_range": F.col("narrow_pct") > 40,
        "low_variance": variance < 200,
        "few_values": F.col("n_distinct") < 50,
        "range_exceeded": (F.col("min_value") < 20) | (F.col("max_value") > 600),
        "exact_100": F.col("exact_100_pct") > 20,
    }
    joined = joined.withColumns({f"issue_{name}": holds(test).cast("int") for name, test in tests.items()})
    joined = joined.withColumn("n_issues", reduce(lambda a, b: a + b, [F.col(f"issue_{n}") for n in ISSUES]))
    diversity = F.col("n_distinct") / F.col("n_rows")
    dominant, narrow = F.col("dominant_pct"), F.col("narrow_pct")
    raw = (
        F.lit(1.0)
        - F.lit(0.15) * F.col("n_issues")
        - _steps(dominant, (dominant > 30, 0.4), (dominant > 20, 0.2))
        - _steps(variance, (variance < 100, 0.3), (variance < 200, 0.15))
        - _steps(narrow, (narrow > 50, 0.25), (narrow > 40, 0.1))
        - _steps(diversity, (diversity < 0.02, 0.2))
        + _steps(variance, ((variance > 500) & (diversity > 0.05), 0.1))
    )
    empty = F.col("n_distinct") == 0
    confidence = F.when(empty, F.lit(0.0)).otherwise(F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw)), 9))
    joined = joined.withColumn("confidence", confidence)
    return joined.withColumn("is_valid", (F.col("confidence") >= 0.5) & (F.col("n_issues") <= 2) & ~empty)


def batch_report(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """V2: files, valid and invalid ones, mean confidence of the valid."""
    return scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.count_if("is_valid").alias("n_valid"),
        F.count_if(~F.col("is_valid")).alias("n_invalid"),
        F.avg(F.when(F.col("is_valid"), F.col("confidence"))).alias("mean_confidence"),
    )


REQUIRED_COLUMNS = ("ts", "bg", "basal_rate", "bolus_dose")


def monthly_validity(
    rows: DataFrame,
    by: Sequence[str] = ("pump_serial", "month"),
    min_rows: int = 100,
    min_days: int = 20,
    required: Sequence[str] = (),
) -> DataFrame:
    """The required columns, enough rows, more than one distinct reading, at least 80 % of readings in 50-400, at least 20 days.

    With ``required`` the result names the ``missing_columns``; a dataset that lacks one is invalid, also where it is the time or
    the reading itself.
    """
    if required:
        missing = [c for c in required if c not in rows.columns]
        lacking = {c: F.lit(None).cast("timestamp" if c == "ts" else "double") for c in ("ts", "bg") if c not in rows.columns}
        found = monthly_validity(rows.withColumns(lacking), by, min_rows, min_days)
        out = found.withColumn("missing_columns", F.lit(", ".join(missing)))
        return out.withColumn("is_valid", F.coalesce("is_valid", F.lit(False)) & F.lit(not missing))
    base = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("bg").alias("n_readings"),
        F.avg(F.col("bg").between(50, 400).cast("int")).alias("realistic_share"),
        F.floor((F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / F.lit(86400e6)).alias("span_days"),
    )
    distinct = summary.value_profile(rows, "bg", by).select(*by, "n_distinct")
    ok = (
        (F.col("n_rows") >= min_rows)
        & (F.col("n_distinct") > 1)
        & F.coalesce(F.col("realistic_share") >= 0.8, F.lit(False))
        & (F.col("span_days") >= min_days)
    )
    joined = base.join(distinct, list(by), "left").fillna(0, ["n_distinct"])
    return joined.withColumn("is_valid", ok)


def availability(rows: DataFrame) -> DataFrame:
    """Per device and year whether readings vary and at least five are realistic."""
    yearly = rows.withColumn("year", F.year("ts"))
    base = yearly.groupBy(*KEYS, "year").agg(
        F.count("bg").alias("n_readings"), F.count_if(F.col("bg").between(50, 400)).alias("n_realistic")
    )
    distinct = summary.value_profile(yearly, "bg", (*KEYS, "year")).select(*KEYS, "year", "n_distinct")
    joined = base.join(distinct, [*KEYS, "year"])
    return joined.withColumn("has_data", (F.col("n_distinct") > 1) & (F.col("n_realistic") >= 5))


def earliest_year(available: DataFrame) -> DataFrame:
    return available.groupBy(*KEYS).agg(F.min(F.when(F.col("has_data"), F.col("year"))).alias("first_year"))


def invalid_batches(grid: DataFrame, by: Sequence[str] = KEYS, threshold: float = 1.0) -> DataFrame:
    """Share of rows without reading, basal and bolus; a batch at or over the threshold would be removed."""
    empty = F.col("bg").isNull() & (F.col("basal_rate") == 0) & (F.col("bolus_dose") == 0)
    scored = grid.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), share(empty).alias("invalid_share"))
    return scored.withColumn("remove", F.col("invalid_share") >= threshold)


def clean_copy(grid: DataFrame, verdicts: DataFrame, by: Sequence[str] = KEYS) -> DataFrame:
    """The rows of kept batches.  The verdicts are one row per batch; nothing is deleted."""
    return grid.join(verdicts.filter("remove").select(*by), list(by), "left_anti")


def format_checks(rows: DataFrame, by: Sequence[str] = KEYS, ranges: Ranges = Ranges()) -> DataFrame:
    """Flags agree with the values, clipped values lie on the bounds, few exact 100s, range."""
    bg = F.col("bg")
    low, high = ranges.bg_clip
    out = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        (share(bg == 100) * 100).alias("exact_100_pct"),
        F.count_if(bg.isNull() != (F.col("bg_missing_flag") == 1)).alias("flag_mismatches"),
        F.count_if((bg < low) | (bg > high)).alias("range_violations"),
        F.count_if((F.col("bg_clip_flag") == 1) & ~bg.isin(low, high)).alias("clip_mismatches"),
    )
    passed = (
        (F.col("exact_100_pct") < 5) & (F.col("flag_mismatches") == 0) & (F.col("range_violations") == 0) & (F.col("clip_mismatches") == 0)
    )
    return out.withColumn("passed", passed)


def file_rules(rows: DataFrame, runs: DataFrame, by: Sequence[str] = KEYS) -> DataFrame:
    """Missing share, days, coverage, duplicates, basal and bolus range, long runs of 100 (``runs`` from W14)."""
    times = rows.groupBy(*by, "ts").agg(F.count(F.lit(1)).alias("_n")).groupBy(*by).agg(F.sum(F.col("_n") - 1).alias("n_duplicates"))
    base = rows.groupBy(*by).agg(
        (share(F.col("bg").isNull()) * 100).alias("missing_pct"),
        ((F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / F.lit(86400e6)).alias("span_days"),
        F.count_if(~F.col("basal_rate").between(0, 8)).alias("basal_violations"),
        F.count_if(~F.col("bolus_dose").between(0, 25)).alias("bolus_violations"),
    )
    long_runs = runs.filter(F.col("run_len") > 10).groupBy(*by).agg(F.count(F.lit(1)).alias("long_runs"))
    joined = base.join(times, list(by)).join(long_runs, list(by), "left").fillna(0, ["long_runs"])
    ok = (
        (F.col("missing_pct") < 30)
        & (F.col("span_days") >= 7)
        & (F.col("n_duplicates") == 0)
        & (F.col("basal_violations") == 0)
        & (F.col("bolus_violations") == 0)
        & (F.col("long_runs") == 0)
    )
    return joined.withColumn("coverage_ok", F.lit(100.0) - F.col("missing_pct") > 70).withColumn("passed", ok)
