"""Grouped statistics.

Everything is one map-side combined aggregation per key; where a second look at the rows is needed (z-scores, fences) the
per-key figures go back through a salted lookup.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidegrid import tiles
from tidegrid.config import RAW_TILE_SECONDS, GridSpec
from tidegrid.functions import timegrid as tg
from tidegrid.functions.quantiles import exact_percentiles
from tidegrid.operators import gaps
from tidegrid.tiles import KEYS


def share(condition: Column) -> Column:
    """Share of all rows (nulls count as not met) with the condition."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("int"))


def device_summary(rows: DataFrame) -> DataFrame:
    """Figures of each device, rounded to 2 digits (by way of 9, so that summation order cannot decide a half)."""

    def two(x: Column) -> Column:
        return F.round(F.round(x, 9), 2)

    return rows.groupBy(*KEYS).agg(
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.count(F.lit(1)).alias("n_rows"),
        two(F.avg("bg")).alias("bg_mean"),
        two(F.stddev_samp("bg")).alias("bg_std"),
        two(F.avg("basal_rate")).alias("basal_mean"),
        two(F.stddev_samp("basal_rate")).alias("basal_std"),
        two(F.sum("bolus_dose")).alias("bolus_sum"),
    )


def coverage(grid: DataFrame, by: Sequence[str] = KEYS) -> DataFrame:
    """A9."""
    span = (tg.micros(F.max("ts")) - tg.micros(F.min("ts"))) / F.lit(3600.0 * tg.MICROS)
    return grid.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_intervals"),
        (share(F.col("bg").isNotNull()) * 100).alias("bg_coverage_pct"),
        (share(F.col("basal_rate") > 0) * 100).alias("basal_coverage_pct"),
        F.count_if(F.col("bolus_dose") > 0).alias("bolus_events"),
        span.alias("span_hours"),
    )


def weighted_coverage(sequences: DataFrame, by: Sequence[str] = KEYS) -> DataFrame:
    """A10: coverage of sequences weighted by their length."""
    return sequences.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_sequences"),
        F.sum("n_rows").alias("total_rows"),
        F.try_divide(F.sum(F.col("bg_coverage") * F.col("n_rows")), F.sum("n_rows").cast("double")).alias("avg_bg_coverage"),
    )


def describe(rows: DataFrame, col: str, by: Sequence[str] = KEYS) -> DataFrame:
    """A11."""
    base = rows.groupBy(*by).agg(
        F.count(col).alias("count"),
        F.avg(col).alias("mean"),
        F.stddev_samp(col).alias("std"),
        F.min(col).alias("min"),
        F.max(col).alias("max"),
    )
    quartiles = exact_percentiles(rows, by, col, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return base.join(quartiles, list(by), "left")


def value_profile(rows: DataFrame, col: str, by: Sequence[str] = KEYS) -> DataFrame:
    """Most frequent value (smallest on ties), its share of all rows, and the number of distinct values."""
    counted = rows.groupBy(*by, F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    # the smallest value of each count first: plain columns all the way, so both aggregations hash
    by_count = counted.groupBy(*by, "_n").agg(F.min("_v").alias("_least"), F.count("_v").alias("_kinds"), F.sum("_n").alias("_rows"))
    held = F.when(F.col("_least").isNotNull(), F.col("_n"))
    return by_count.groupBy(*by).agg(
        F.sum("_rows").alias("n_rows"),
        F.sum("_kinds").alias("n_distinct"),
        F.max_by("_least", held).alias("top_value"),
        F.max(held).alias("top_count"),
    ).withColumn("top_share", F.col("top_count") / F.col("n_rows"))


SKETCH_BITS = 12  # 4,096 registers: a standard error of about 1.6 %


def distinct_sketches(rows: DataFrame, col: str, by: Sequence[str], bits: int = SKETCH_BITS) -> DataFrame:
    """A13, V12, V13 by approximation: a mergeable sketch of the distinct values per group (for example device and month), to be stored."""
    return rows.groupBy(*by).agg(F.hll_sketch_agg(F.col(col).cast("string"), bits).alias("sketch"), F.count(col).alias("n_values"))


def distinct_estimates(sketches: DataFrame, by: Sequence[str] = KEYS) -> DataFrame:
    """Sketches merged to coarser groups, without reading the rows again: ``n_values`` and the estimated ``n_distinct``."""
    merged = sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("_s"), F.sum("n_values").alias("n_values"))
    return merged.select(*by, "n_values", F.hll_sketch_estimate("_s").alias("n_distinct"))


def band_shares(rows: DataFrame, col: str = "bg", by: Sequence[str] = KEYS) -> DataFrame:
    """Shares of all rows in 95-105, exactly 100, and share of readings in 50-400."""
    v = F.col(col)
    return rows.groupBy(*by).agg(
        share(v.between(95, 105)).alias("narrow_share"),
        share(v == 100).alias("exact_100_share"),
        F.avg(v.between(50, 400).cast("int")).alias("realistic_share"),
    )


def anomaly_counts(
    rows: DataFrame, col: str = "bg", by: Sequence[str] = KEYS, z_limit: float = 3.0, fence: float = 2.5, spread_by: Sequence[str] = ("ts",)
) -> DataFrame:
    """Values beyond 3 population deviations or beyond the quartile fence; the larger count is the result."""
    present = rows.filter(F.col(col).isNotNull())
    moments = present.groupBy(*by).agg(F.count(F.lit(1)).alias("n_values"), F.avg(col).alias("_m"), F.stddev_pop(col).alias("_s"))
    quartiles = exact_percentiles(present, by, col, {"_q1": 0.25, "_q3": 0.75})
    joined = tiles.lookup(present, moments.join(quartiles, list(by)), by, salt_by=spread_by, how="inner")
    v, width = F.col(col), F.col("_q3") - F.col("_q1")
    z = F.abs(v - F.col("_m")) / F.when(F.col("_s") > 0, F.col("_s"))
    outside = (v < F.col("_q1") - fence * width) | (v > F.col("_q3") + fence * width)
    counted = joined.groupBy(*by).agg(
        F.first("n_values").alias("n_values"),
        F.count_if(z > z_limit).alias("z_anomalies"),
        F.count_if(outside).alias("iqr_anomalies"),
    )
    worst = F.greatest("z_anomalies", "iqr_anomalies")
    return counted.withColumns({"anomalies": worst, "anomaly_pct": worst / F.col("n_values") * 100})


def dose_correlation(grid: DataFrame, spec: GridSpec, lag_rows: int = 6, regular: bool = True, dose: str | None = None) -> DataFrame:
    """Correlation of glucose with the dose ``lag_rows`` rows earlier (a negative number looks ahead).

    ``regular=False`` is for rows that are not a complete grid; ``dose`` names a column with that dose, where rows have it already.
    """
    reach = abs(lag_rows) * (spec.freq_seconds if regular else 1)
    halo = tiles.with_halo if regular else tiles.with_row_halo

    def build(rows: DataFrame, w: WindowSpec) -> DataFrame:
        moved = F.lag("bolus_dose", lag_rows).over(w) if lag_rows >= 0 else F.lead("bolus_dose", -lag_rows).over(w)
        return rows.withColumn("_dose", moved)

    if dose is not None:
        moved = grid.withColumn("_dose", F.col(dose))
    else:
        moved = halo(
            grid, build, seconds=spec.tile_seconds, before=reach if lag_rows > 0 else 0, after=reach if lag_rows < 0 else 0
        )
    # both sides of a pair must be present; a constant side gives no correlation
    x, y = F.when(F.col("_dose").isNotNull(), F.col("bg")), F.when(F.col("bg").isNotNull(), F.col("_dose"))
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return moved.groupBy(*KEYS).agg(F.try_divide(F.covar_pop(x, y), F.when(spread > 0, spread)).alias("correlation"))


def trend(rows: DataFrame, y: str, x: str, by: Sequence[str] = KEYS) -> DataFrame:
    """A17."""
    return rows.groupBy(*by).agg(F.regr_slope(y, x).alias("slope"), F.count(F.lit(1)).alias("n"))


def basic_statistics(rows: DataFrame, col: str = "bg", by: Sequence[str] = KEYS) -> DataFrame:
    """Mean, deviation, coefficient of variation and their status."""
    base = rows.groupBy(*by).agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"))
    base = base.filter(F.col("mean").isNotNull())
    cv = F.when(F.col("mean") > 0, F.col("std") / F.col("mean") * 100).otherwise(F.lit(0.0))
    return base.withColumn("cv", cv).withColumns(
        {
            "mean_status": F.when((F.col("mean") < 80) | (F.col("mean") > 200), "WARN").otherwise("PASS"),
            "cv_status": F.when((F.col("cv") > 50) | (F.col("cv") < 5), "WARN").otherwise("PASS"),
        }
    )


def _spread(col: str, prefix: str) -> list[Column]:
    return [
        F.avg(col).alias(f"{prefix}_mean"),
        F.stddev_pop(col).alias(f"{prefix}_std"),
        F.min(col).alias(f"{prefix}_min"),
        F.max(col).alias(f"{prefix}_max"),
    ]


def _with_medians(frame: DataFrame, rows: DataFrame, medians: dict[str, str]) -> DataFrame:
    """Global medians of several columns, in one pass, joined to a one-row frame."""
    pairs = ", ".join(f"'{name}', CAST({col} AS DOUBLE)" for name, col in medians.items())
    long = rows.select(F.expr(f"stack({len(medians)}, {pairs}) AS (_name, _value)"))
    found = exact_percentiles(long, ["_name"], "_value", {"_median": 0.5})
    wide = found.groupBy().agg(*[F.max(F.when(F.col("_name") == n, F.col("_median"))).alias(n) for n in medians])
    return frame.withColumn("_k", F.lit(1)).join(wide.withColumn("_k", F.lit(1)), "_k").drop("_k")


def cross_device_stats(scores: DataFrame) -> DataFrame:
    """Spread of ``score`` and ``completeness`` over devices (population deviation)."""
    base = scores.agg(F.count(F.lit(1)).alias("n_devices"), *_spread("score", "score"), *_spread("completeness", "completeness"))
    return _with_medians(base, scores, {"score_median": "score", "completeness_median": "completeness"})


def split_summary(rows: DataFrame, by: Sequence[str] = KEYS) -> DataFrame:
    """Per subset records, share of the device, first and last time, mean coverage."""
    per = rows.groupBy(*by, "subset").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("ts").alias("start_ts"),
        F.max("ts").alias("end_ts"),
        F.avg(F.col("bg").isNotNull().cast("int")).alias("bg_coverage"),
    )
    total = per.groupBy(*by).agg(F.sum("n_rows").alias("_n"))
    return per.join(total, list(by)).withColumn("pct", F.col("n_rows") / F.col("_n") * 100).drop("_n")


def split_members(table: DataFrame, by: Sequence[str] = KEYS) -> DataFrame:
    """The members of each subset, one row each with their position in time.

    ``table`` has one row per sequence: ``subset``, ``segment_id``, ``segment_start``, ``n_rows``.
    """
    within = Window.partitionBy(*by, "subset").orderBy("segment_start", "segment_id")
    return table.select(*by, "subset", F.row_number().over(within).alias("position"), "segment_id", "segment_start", "n_rows")


def job_performance(jobs: DataFrame) -> DataFrame:
    """Duration and throughput over all jobs."""
    positive = F.when(F.col("throughput_records_per_second") > 0, F.col("throughput_records_per_second"))
    rows = jobs.withColumn("_t", positive)
    base = rows.agg(
        F.count(F.lit(1)).alias("n_jobs"),
        *_spread("total_duration_seconds", "duration"),
        F.avg("_t").alias("throughput_mean"),
        F.stddev_pop("_t").alias("throughput_std"),
    )
    return _with_medians(base, rows, {"duration_median": "total_duration_seconds", "throughput_median": "_t"})


def job_types(jobs: DataFrame) -> DataFrame:
    timed = jobs.filter(F.col("total_duration_seconds") != 0)
    return timed.groupBy("job_type").agg(
        F.count(F.lit(1)).alias("job_count"),
        F.avg("total_duration_seconds").alias("mean_duration"),
        F.sum("total_duration_seconds").alias("total_duration"),
    )


def job_quality(jobs: DataFrame) -> DataFrame:
    """Scores and issues of completed jobs."""
    done = jobs.filter(F.col("final_status") == "completed")
    rows = done.withColumns(
        {
            "_s": F.when(F.col("validation_score") > 0, F.col("validation_score")),
            "_c": F.when(F.col("data_completeness_pct") > 0, F.col("data_completeness_pct")),
        }
    )
    critical, warnings = F.col("critical_issues"), F.col("warnings")
    base = rows.agg(
        *_spread("_s", "score"),
        F.avg("_c").alias("completeness_mean"),
        F.min("_c").alias("completeness_min"),
        F.max("_c").alias("completeness_max"),
        F.sum(critical).cast("bigint").alias("total_critical_issues"),
        F.sum(warnings).cast("bigint").alias("total_warnings"),
        F.count_if(critical > 0).alias("jobs_with_critical_issues"),
        F.count_if(warnings > 0).alias("jobs_with_warnings"),
        F.count_if((critical == 0) & (warnings == 0)).alias("clean_jobs"),
    )
    return _with_medians(base, rows, {"score_median": "_s", "completeness_median": "_c"})


def session_status(jobs: DataFrame) -> DataFrame:
    """Totals of a run and its status."""
    failed, done = F.count_if(F.col("final_status") == "failed"), F.count_if(F.col("final_status") == "completed")
    return jobs.agg(
        F.count(F.lit(1)).alias("total_jobs"),
        done.alias("completed_jobs"),
        failed.alias("failed_jobs"),
        F.sum("total_records").cast("bigint").alias("total_records"),
        (F.sum("data_size_mb") / 1024).alias("total_data_gb"),
        F.min("start_time").alias("earliest_ts"),
        F.max("start_time").alias("latest_ts"),
        F.count_distinct(*KEYS).alias("total_devices"),
        F.when(failed == 0, "completed").when(done > 0, "partial_success").otherwise("failed").alias("session_status"),
    )


def batch_summary(jobs: DataFrame, by: Sequence[str] = KEYS) -> DataFrame:
    """Jobs by status, records and megabytes of the completed ones."""
    status = F.col("final_status")
    return jobs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_jobs"),
        F.count_if(status == "completed").alias("completed_jobs"),
        F.count_if(status == "failed").alias("failed_jobs"),
        F.count_if(~status.isin("completed", "failed")).alias("pending_jobs"),
        F.coalesce(F.sum(F.when(status == "completed", F.col("total_records"))), F.lit(0)).cast("bigint").alias("total_records"),
        F.coalesce(F.sum(F.when(status == "completed", F.col("data_size_mb"))), F.lit(0.0)).alias("total_mb"),
    )


def sync_status(sync: DataFrame, files: DataFrame, failed_ranges: DataFrame) -> DataFrame:
    """Last sync, records, failed ranges and number of files per device; files and ranges come as rows."""
    counted = files.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_files"))
    failed = failed_ranges.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_failed_ranges"))
    joined = sync.join(counted, list(KEYS), "left").join(failed, list(KEYS), "left")
    return joined.fillna(0, ["n_files", "n_failed_ranges"]).select(
        *KEYS, "last_successful_sync", "total_records", "n_failed_ranges", "n_files"
    )


def sync_rollup(files: DataFrame) -> DataFrame:
    """Files, records and success per device."""
    return files.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("n_records").cast("bigint").alias("n_records"), F.bool_and("ok").alias("success")
    )


def sync_overall(files: DataFrame) -> DataFrame:
    """A24 over all devices."""
    per = sync_rollup(files)
    return per.agg(
        F.count(F.lit(1)).alias("n_devices"),
        F.coalesce(F.sum("n_files"), F.lit(0)).cast("bigint").alias("n_files"),
        F.coalesce(F.sum("n_records"), F.lit(0)).cast("bigint").alias("n_records"),
        F.count_if("success").alias("n_successful"),
        F.coalesce(F.bool_and("success"), F.lit(False)).alias("success"),
    )


def completeness(times: DataFrame, freq_seconds: int = 300, gap_minutes: float = 60.0, tile_seconds: int = RAW_TILE_SECONDS) -> DataFrame:
    """Rows against expected rows, large gaps, longest step."""
    rows = gaps.steps(times, tile_seconds)
    span = tg.micros(F.max("ts")) - tg.micros(F.min("ts"))
    out = rows.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("actual_rows"),
        tg.int_div(span, freq_seconds * tg.MICROS).alias("expected_rows"),
        F.count_if(F.col("step_seconds") > gap_minutes * 60).alias("large_gaps"),
        F.coalesce(F.max("step_seconds"), F.lit(0.0)).alias("max_gap_seconds"),
    )
    ratio = F.coalesce(F.try_divide(F.col("actual_rows").cast("double"), F.col("expected_rows")), F.lit(0.0))
    return out.withColumn("completeness_ratio", ratio)


def range_report(grid: DataFrame, by: Sequence[str] = KEYS) -> DataFrame:
    """Per signal the values outside its range, with expected and actual range."""
    # Expected range of each signal.
    long = grid.select(
        *by,
        F.expr("stack(3, 'glucose', bg, 40D, 600D, 'basal', basal_rate, 0D, 10D, 'bolus', bolus_dose, 0D, 50D) AS (signal, v, lo, hi)"),
    ).filter(F.col("v").isNotNull())
    return long.groupBy(*by, "signal").agg(
        F.count(F.lit(1)).alias("n_values"),
        F.count_if((F.col("v") < F.col("lo")) | (F.col("v") > F.col("hi"))).alias("n_violations"),
        F.first("lo").alias("expected_min"),
        F.first("hi").alias("expected_max"),
        F.min("v").alias("actual_min"),
        F.max("v").alias("actual_max"),
    ).withColumn("violation_pct", F.col("n_violations") / F.col("n_values") * 100)


def forecast_error(predictions: DataFrame, by: Sequence[str] = ("model_id",), short: int = 6, long: int = 12) -> DataFrame:
    """Mean absolute and root mean square error, and the mean absolute error of the first 6 and 12 steps."""
    off = F.col("y_pred") - F.col("y_true")
    return predictions.groupBy(*by).agg(
        F.avg(F.abs(off)).alias("mae"),
        F.sqrt(F.avg(off * off)).alias("rmse"),
        F.avg(F.when(F.col("step") <= short, F.abs(off))).alias("mae_short"),
        F.avg(F.when(F.col("step") <= long, F.abs(off))).alias("mae_long"),
    )


def ensemble(predictions: DataFrame, low: float = 20.0, high: float = 600.0) -> DataFrame:
    """Mean and sample deviation over models per window and step, after clamping each forecast."""
    clamped = predictions.withColumn("y_pred", F.greatest(F.least(F.col("y_pred"), F.lit(high)), F.lit(low)))
    return clamped.groupBy("pump_serial", "window_id", "step").agg(
        F.avg("y_pred").alias("y_mean"), F.stddev_samp("y_pred").alias("y_std"), F.count(F.lit(1)).alias("n_models")
    )


def ranking(scores: DataFrame) -> DataFrame:
    """Best and worst device by score; ties go to the smaller (best) and larger (worst) serial."""
    best = F.struct("score", -F.col("pump_serial"))
    return scores.agg(
        F.max_by("pump_serial", best).alias("best_device"),
        F.max("score").alias("best_score"),
        F.min_by("pump_serial", best).alias("worst_device"),
        F.min("score").alias("worst_score"),
    )


def basal_patterns(grid: DataFrame, tile_seconds: int) -> DataFrame:
    """W25."""
    rows = tiles.previous_row(grid.select(*KEYS, "ts", "basal_rate"), ["basal_rate"], seconds=tile_seconds)
    v, jump = F.col("basal_rate"), F.abs(F.col("basal_rate") - F.col("prev.basal_rate"))
    return rows.groupBy(*KEYS).agg(
        F.count_if(v > 5).alias("high_values"),
        F.count_if(v.isin(21.0, 10.0)).alias("suspicious_values"),
        F.count_if(v == 0).alias("zero_values"),
        F.count_if(jump > 2).alias("large_changes"),
        F.max(jump).alias("max_change"),
    )


def glucose_patterns(grid: DataFrame, tile_seconds: int) -> DataFrame:
    """The largest change is reported only where some change exceeds 50."""
    rows = tiles.previous_row(grid.select(*KEYS, "ts", "bg"), ["bg"], seconds=tile_seconds)
    v, jump = F.col("bg"), F.abs(F.col("bg") - F.col("prev.bg"))
    return rows.groupBy(*KEYS).agg(
        F.count_if(v < 70).alias("low_values"),
        F.count_if(v > 300).alias("high_values"),
        F.count_if(v > 400).alias("very_high_values"),
        F.count_if(jump > 50).alias("rapid_changes"),
        F.coalesce(F.max(F.when(jump > 50, jump)), F.lit(0.0)).alias("max_rate_of_change"),
    )
