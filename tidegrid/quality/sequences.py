"""Checks and records of training sequences (V3, V6, V17, V18) and the run report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid import tiles
from tidegrid.config import GridSpec, Ranges
from tidegrid.functions import timegrid as tg
from tidegrid.operators import constant_runs, gaps, summary
from tidegrid.operators.summary import share
from tidegrid.tiles import KEYS

SEGMENT = ("pump_serial", "segment_id")


def sequence_checks(
    rows: DataFrame, spec: GridSpec, ranges: Ranges = Ranges(), min_rows: int = 12, max_hours: float | None = None
) -> DataFrame:
    """V3 per sequence: length, optional longest duration, spacing, three ranges, masked nulls.  Run before scaling."""
    stepped = tiles.previous_row(rows, ["ts"], seconds=spec.tile_seconds, by=SEGMENT)
    minutes = tg.minutes_between(F.col("ts"), F.col("prev.ts"))
    expected = spec.freq_seconds / 60.0
    bg, basal, bolus = F.col("bg"), F.col("basal_rate"), F.col("bolus_dose")
    low, high = ranges.bg_clip
    base = stepped.groupBy(*SEGMENT).agg(
        F.min("ts").alias("segment_start"),
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(bg.isNotNull().cast("int")).alias("bg_coverage"),
        F.count_if(~minutes.between(expected - 0.5, expected + 0.5)).alias("n_irregular"),
        F.count_if((bg < low) | (bg > high)).alias("n_bg_range"),
        F.count_if((basal < 0) | (basal > ranges.basal_max)).alias("n_basal_range"),
        F.count_if((bolus < 0) | (bolus > ranges.bolus_max)).alias("n_bolus_range"),
        F.count_if(bg.isNull() & ~F.col("mask_bg")).alias("n_unmasked"),
    )
    issues = (F.col("n_rows") < min_rows).cast("int")
    if max_hours is not None:
        issues = issues + (F.col("n_rows") * spec.freq_seconds / 3600.0 > max_hours * 1.1).cast("int")
    for name in ("n_irregular", "n_bg_range", "n_basal_range", "n_bolus_range", "n_unmasked"):
        issues = issues + (F.col(name) > 0).cast("int")
    return base.withColumn("n_issues", issues).withColumn("passed", F.col("n_issues") == 0)


def sequence_report(checked: DataFrame, by: Sequence[str] = KEYS) -> DataFrame:
    """V3 per device: pass rate, coverage weighted by length, readiness and recommendation."""
    ok = F.col("passed")
    out = checked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_sequences"),
        F.count_if(ok).alias("passed_sequences"),
        F.sum("n_rows").alias("total_rows"),
        F.coalesce(F.sum(F.when(ok, F.col("n_rows"))), F.lit(0)).alias("passed_rows"),
        F.coalesce(
            F.try_divide(F.sum(F.when(ok, F.col("bg_coverage") * F.col("n_rows"))), F.sum(F.when(ok, F.col("n_rows"))).cast("double")),
            F.lit(0.0),
        ).alias("avg_bg_coverage"),
        F.sum("n_issues").alias("n_issues"),
    )
    c = F.col
    verdict = (
        F.when((c("passed_sequences") == 0) | (c("avg_bg_coverage") < 0.3), "REJECT")
        .when(c("n_issues") > c("passed_sequences") * 2, "CAUTION")
        .when((c("avg_bg_coverage") > 0.7) & (c("n_issues") < c("passed_sequences")), "EXCELLENT")
        .when(c("avg_bg_coverage") > 0.5, "GOOD")
        .otherwise("FAIR")
    )
    return out.withColumns(
        {
            "pass_rate": c("passed_sequences") / c("total_sequences"),
            "recommendation": verdict,
            "ready": (c("passed_sequences") > 0) & (c("avg_bg_coverage") > 0.5),
        }
    )


def placeholder_analysis(grid: DataFrame, spec: GridSpec) -> DataFrame:
    """V6: how many of the exact 100s lie in runs judged synthetic."""
    values = grid.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("bg") == 100).alias("n_100"))
    runs = constant_runs.placeholder_runs(grid, spec).groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.count_if("is_synthetic").alias("synthetic_runs"),
        F.sum(F.when(F.col("is_synthetic"), F.col("run_len")).otherwise(0)).alias("synthetic_100"),
        F.sum(F.when(~F.col("is_synthetic"), F.col("run_len")).otherwise(0)).alias("legitimate_100"),
    )
    joined = values.join(runs, list(KEYS), "left").fillna(0, ["n_runs", "synthetic_runs", "synthetic_100", "legitimate_100"])
    pct = F.col("synthetic_100") / F.greatest(F.col("n_100"), F.lit(1)) * 100
    return joined.withColumn("synthetic_pct", pct).withColumn(
        "recommendation", F.when(F.col("synthetic_100") > 0, "repair").otherwise("none")
    )


def sequence_quality(rows: DataFrame, by: Sequence[str] = SEGMENT) -> DataFrame:
    """Completeness, quality score, readiness and recommendation, rounded to 3 digits."""
    base = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        share(~F.col("mask_bg")).alias("_bg"),
        share(F.col("basal_rate").isNotNull()).alias("_basal"),
        share(F.col("bolus_dose") > 0).alias("_bolus"),
    )
    bg, basal, bolus = F.col("_bg"), F.col("_basal"), F.col("_bolus")
    base = base.withColumn("_q", F.round(bg * 0.6 + basal * 0.3 + F.least(bolus * 5, F.lit(0.1)), 9))
    q = F.col("_q")
    label = (
        F.when((q > 0.8) & (bg > 0.7), "EXCELLENT").when((q > 0.6) & (bg > 0.5), "GOOD").when((q > 0.4) & (bg > 0.3), "FAIR").otherwise("POOR")
    )
    return base.select(
        *by,
        "n_rows",
        F.round(q, 3).alias("quality_score"),
        F.round(bg, 3).alias("bg_completeness"),
        F.round(basal, 3).alias("basal_completeness"),
        F.round(bolus, 3).alias("bolus_activity"),
        ((F.col("n_rows") >= 12) & (bg > 0.3) & (basal > 0.8)).alias("tensor_ready"),
        label.alias("training_recommendation"),
    )


def sequence_metadata(rows: DataFrame, spec: GridSpec, by: Sequence[str] = SEGMENT) -> DataFrame:
    """The record written beside each sequence."""
    figures = rows.groupBy(*by).agg(
        F.min("ts").alias("start_time"),
        F.max("ts").alias("end_time"),
        F.count(F.lit(1)).alias("length_intervals"),
        F.avg(F.col("bg").isNotNull().cast("int")).alias("bg_coverage"),
        F.count_if(F.col("mask_bg") & ~F.col("mask_label")).alias("bins_imputed"),
        F.count_if("mask_label").alias("bins_masked"),
        F.min("bg").alias("bg_min"),
        F.max("bg").alias("bg_max"),
        F.min("basal_rate").alias("basal_min"),
        F.max("basal_rate").alias("basal_max"),
        F.sum("bolus_dose").alias("bolus_total"),
    )
    quality = sequence_quality(rows, by).drop("n_rows")
    joined = figures.join(quality, list(by))
    return joined.withColumns(
        {
            "duration_hours": F.col("length_intervals") * F.lit(spec.freq_seconds / 3600.0),
            "sequence_id": F.format_string("%s_seq_%03d", F.col(by[0]).cast("string"), F.col(by[-1]).cast("int")),
        }
    )


METADATA_PARTS = {
    "sequence_info": ["sequence_id", *SEGMENT],
    "temporal_info": ["start_time", "end_time", "length_intervals", "duration_hours"],
    "data_quality": ["bg_coverage", "bins_imputed", "bins_masked", "quality_score", "bg_completeness", "basal_completeness", "bolus_activity"],
    "value_ranges": ["bg_min", "bg_max", "basal_min", "basal_max", "bolus_total"],
    "validation_ready": ["tensor_ready", "training_recommendation"],
}


def metadata_json(metadata: DataFrame, by: Sequence[str] = SEGMENT) -> DataFrame:
    """V18 as one nested JSON text per sequence."""
    parts = METADATA_PARTS | {"sequence_info": ["sequence_id", *by]}
    nested = F.struct(*[F.struct(*names).alias(part) for part, names in parts.items()])
    return metadata.select(*by, F.to_json(nested, {"ignoreNullFields": "false"}).alias("metadata"))


def run_report(jobs: DataFrame, completeness: DataFrame, ranges: DataFrame) -> DataFrame:
    """Batches, records, gaps and violations per device with a status."""
    batches = summary.batch_summary(jobs).select(*KEYS, "completed_jobs", "failed_jobs", "total_records")
    violations = ranges.groupBy(*KEYS).agg(F.sum("n_violations").alias("n_violations"))
    joined = batches.join(completeness.select(*KEYS, "large_gaps", "completeness_ratio"), list(KEYS), "left").join(
        violations, list(KEYS), "left"
    )
    done, failed = F.col("completed_jobs"), F.col("failed_jobs")
    rate = F.coalesce(F.try_divide(done * 100.0, done + failed), F.lit(0.0))
    status = F.when((failed == 0) & (done > 0), "SUCCESS").when(done > 0, "PARTIAL_SUCCESS").otherwise("FAILURE")
    return joined.withColumns({"success_rate": rate, "status": status})
