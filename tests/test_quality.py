from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import GRID, at
from pyspark.sql import functions as F

from tidegrid.config import GridSpec
from tidegrid.operators import gaps, joins, summary
from tidegrid.quality import checks, placeholder, sequences
from tidegrid.session import stage

SPEC = GridSpec(pad_seconds=0, tile_bins=100)


def batch(spark, values):
    return spark.createDataFrame([(1, None if v is None else float(v)) for v in values], "pump_serial long, bg double")


def score(spark, values):
    return placeholder.score_batches(batch(spark, values)).collect()[0]


def test_placeholder_scores(spark):
    spread = [40.0 + 2 * i for i in range(200)]
    good = score(spark, spread)
    assert (good.n_issues, good.confidence, good.is_valid) == (0, 1.0, True)
    constant = score(spark, [100.0] * 300)
    assert (constant.n_issues, constant.confidence, constant.is_valid) == (5, 0.0, False)
    assert not score(spark, [None] * 20).is_valid and score(spark, [None] * 20).confidence == 0.0
    below = score(spark, [300.0] * 24 + spread[:76])
    above = score(spark, [300.0] * 26 + spread[:74])
    assert (below.issue_dominant_value, above.issue_dominant_value) == (0, 1)


def test_nulls_count_in_the_denominator(spark):
    found = score(spark, [100.0] * 30 + [None] * 70 + [200.0 + i for i in range(60)])
    assert found.dominant_pct == pytest.approx(100 * 30 / 160) and found.issue_dominant_value == 0


def test_batch_report(spark):
    scored = placeholder.score_batches(
        batch(spark, [40.0 + 2 * i for i in range(200)]).unionByName(batch(spark, [100.0] * 50).withColumn("pump_serial", F.lit(2).cast("long")))
    )
    row = placeholder.batch_report(scored).collect()[0]
    assert (row.n_files, row.n_valid, row.n_invalid, row.mean_confidence) == (2, 1, 1, 1.0)


def test_value_profile_tie_goes_to_the_smallest(spark):
    row = summary.value_profile(batch(spark, [3, 3, 1, 1, 2, None, None, None]), "bg").collect()[0]
    assert (row.top_value, row.top_count, row.n_distinct, row.n_rows) == (1.0, 2, 3, 8)


def check_map(frame, level="comprehensive"):
    metrics = checks.dataset_metrics(frame, SPEC, level, dt.datetime(2025, 1, 1))
    found = checks.checks_from_metrics(metrics, level)
    report = checks.validation_report(found, metrics).collect()[0]
    return {r.check_name: (r.status, r.severity) for r in found.collect()}, report


def test_checks_on_a_clean_series(grid):
    bg = [120.0 + 20 * ((i % 12) - 6) / 6 for i in range(400)]
    found, report = check_map(grid(bg))
    assert {s for s, _ in found.values()} == {"PASS"}
    assert (report.overall_status, report.overall_score, report.temporal_score) == ("PASS", 100.0, 100.0)
    assert report.continuity_score == pytest.approx((70 + 20) / 2)


def test_checks_find_faults(grid):
    bg = [None] * 100 + [700.0] * 200
    found, report = check_map(grid(bg, basal=[12.0] * 300, bolus=[1.0] * 300), "standard")
    assert found["completeness_cgm"] == ("FAIL", "HIGH")
    assert found["completeness_bolus"] == ("WARN", "MEDIUM")
    assert found["range_cgm_extreme"] == ("FAIL", "HIGH")
    assert found["range_basal"] == ("FAIL", "HIGH")
    assert found["stats_cgm_mean"] == ("WARN", "MEDIUM") and found["stats_cgm_variability"] == ("WARN", "MEDIUM")
    assert "anomalies_statistical" not in found
    assert report.overall_status == "FAILURE" and report.overall_score == 0.0


def test_level_basic_has_no_temporal_checks(grid):
    found, _ = check_map(grid([120.0] * 20), "basic")
    assert not any(name.startswith(("temporal", "continuity", "stats")) for name in found)


def test_old_times_are_critical(grid, spark):
    old = spark.createDataFrame([(1, dt.datetime(1970, 1, 2), 100.0, 1.0, 0.0)], grid([1.0]).schema)
    found, report = check_map(grid([100.0] * 20).unionByName(old), "standard")
    assert found["temporal_epoch"] == ("FAIL", "CRITICAL") and report.overall_status == "CRITICAL_FAILURE"
    assert report.temporal_score == 70.0


def masked(frame, segment=1):
    return frame.withColumns({"segment_id": F.lit(segment), "mask_bg": F.col("bg").isNull(), "mask_label": F.col("bg").isNull()})


def test_sequence_checks(grid):
    good = masked(grid([100.0] * 12))
    short = masked(grid([100.0] * 11, start=10000), 2)
    unmasked = masked(grid([None] + [100.0] * 11, start=20000), 3).withColumn("mask_bg", F.lit(False))
    low = masked(grid([5.0] * 12, start=30000), 4)
    rows = good.unionByName(short).unionByName(unmasked).unionByName(low)
    found = {r.segment_id: (r.n_issues, r.passed) for r in sequences.sequence_checks(rows, SPEC).collect()}
    assert found == {1: (0, True), 2: (1, False), 3: (1, False), 4: (1, False)}
    report = sequences.sequence_report(sequences.sequence_checks(rows, SPEC)).collect()[0]
    assert (report.passed_sequences, report.pass_rate, report.recommendation) == (1, 0.25, "CAUTION")


def test_sequence_quality_ladder(grid):
    rows = masked(grid([100.0] * 16 + [None] * 4))
    row = sequences.sequence_quality(rows).collect()[0]
    assert (row.quality_score, row.bg_completeness, row.tensor_ready, row.training_recommendation) == (0.78, 0.8, True, "GOOD")


def test_metadata_json_matches_its_table(grid, spark):
    table = sequences.sequence_metadata(masked(grid([100.0, None, 140.0])), SPEC)
    text = sequences.metadata_json(table)
    schema = "struct<data_quality:struct<bins_masked:long,bg_coverage:double>,value_ranges:struct<bg_min:double,bg_max:double>>"
    row = text.select(F.from_json("metadata", schema).alias("m")).collect()[0].m
    assert (row.data_quality.bins_masked, row.value_ranges.bg_min, row.value_ranges.bg_max) == (1, 100.0, 140.0)
    assert row.data_quality.bg_coverage == pytest.approx(2 / 3)


def test_invalid_batches_and_clean_copy(grid):
    empty = grid([None] * 4, basal=[0.0] * 4)
    good = grid([None, 100.0], basal=[0.0, 0.0], device=2)
    rows = empty.unionByName(good)
    verdicts = placeholder.invalid_batches(rows)
    assert {r.pump_serial: r.remove for r in verdicts.collect()} == {1: True, 2: False}
    assert placeholder.clean_copy(rows, verdicts).select("pump_serial").distinct().collect()[0][0] == 2


def test_forecast_error(spark):
    rows = [("m", s, 100.0 + s, 100.0) for s in range(1, 14)]
    frame = spark.createDataFrame(rows, "model_id string, step int, y_pred double, y_true double")
    out = summary.forecast_error(frame).collect()[0]
    assert (out.mae, out.mae_short, out.mae_long) == (7.0, 3.5, 6.5)


def test_job_statistics(spark):
    rows = [(i, 1, "a", at(i), float(i), 10, 1.0, float(i), 50.0, 50.0, 0, 0, "completed") for i in (1, 2, 6)]
    names = (
        "job_id long, pump_serial long, job_type string, start_time timestamp, total_duration_seconds double, total_records long, data_size_mb double, "
        "throughput_records_per_second double, data_completeness_pct double, validation_score double, critical_issues long, warnings long, final_status string"
    )
    jobs = spark.createDataFrame(rows, names)
    row = summary.job_performance(jobs).collect()[0]
    assert (row.duration_median, row.duration_mean) == (2.0, 3.0)
    assert row.duration_std == pytest.approx((14 / 3) ** 0.5)  # population
    assert summary.session_status(jobs).collect()[0].session_status == "completed"


def test_registered_checks_see_every_point_of_the_grid(spark, tmp_path):
    """Neither rows with a rate alone nor empty ones are left out: 11 hours of one device, padded by an hour on both sides where the grid is."""
    from tidegrid import catalog

    times = [("click", 0, 50.0), ("view", 60, 50.0), ("click", 300, 50.0), ("purchase", 600, 40.0)]
    rows = [(k, at(m), 7, kind, v) for k, (kind, m, v) in enumerate(times)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").write.parquet(str(tmp_path / "events.parquet"))
    run = {name: catalog.queries()[name](spark, str(tmp_path)).collect() for name in ("v04_quality_check", "v05_suggestions", "v07_dataset_checks", "v08_validation_report", "v10_quality_report", "q14_resequenced_and_split")}
    assert [r.n_rows for r in run["v04_quality_check"]] == [13] and [r.n_rows for r in run["v10_quality_report"]] == [13]
    assert "12 missing BG values" in run["v05_suggestions"][0].suggestions
    assert {r.check_name: r.value for r in run["v07_dataset_checks"]}["schema"] == 121
    assert [r.n_rows for r in run["v08_validation_report"]] == [121]
    assert [r.n_rows for r in run["q14_resequenced_and_split"]] == [13]


@pytest.mark.parametrize("tile_bins", [4, 30])
def test_checks_share_one_layout_of_the_rows(spark, tile_bins):
    rnd = random.Random(tile_bins)
    rows = []
    for device in (1, 2, 3):
        minutes = sorted(rnd.sample(range(0, 12_000, 5), 500 if device < 3 else 4))
        rows += [(device, at(m), None if rnd.random() < 0.3 else rnd.uniform(60, 250), 1.0, rnd.choice([0.0, 0.0, 1.0, 3.0])) for m in minutes]
    rows += [(r[0], r[1], None, None, None) for r in rows[::50]]  # a time that comes twice
    rows += [(4, None, 100.0, 1.0, 0.0), (None, at(0), 100.0, 1.0, 0.0)]
    frame, spec = spark.createDataFrame(rows, GRID), GridSpec(pad_seconds=0, tile_bins=tile_bins)
    laid = stage(checks.with_history(frame, spec), "test-history")
    assert laid.count() == len(rows) - 2

    # rows with equal times have no order among them, so only what does not depend on it is held against plain lists
    steps = gaps.steps(gaps.observed_times(laid, "_before"), spec.tile_seconds, "_before")
    assert sorted(steps.collect(), key=str) == sorted(gaps.steps(gaps.observed_times(frame), spec.tile_seconds).collect(), key=str)
    for device in (1, 2, 3):
        mine = sorted(r for r in rows[:1004] if r[0] == device)
        reads = [r for r in mine if r[2] is not None]
        got = sorted((r for r in laid.filter(f"pump_serial = {device} AND bg IS NOT NULL").collect()), key=lambda r: r.ts)
        assert [(r._read_ts, r._read_bg) for r in got] == [(None, None)] + [(r[1], r[2]) for r in reads[:-1]]
        assert [(r.rn, r.n_values) for r in got] == [(k + 1, len(reads)) for k in range(len(reads))]
        assert [r._dosed for r in got] == [max((d[1] for d in mine if d[4] >= 2 and d[1] <= r.ts), default=None) for r in got]


@pytest.mark.parametrize("tile_bins", [4, 30])
def test_metrics_equal_those_of_every_check_by_itself(spark, tile_bins):
    rnd = random.Random(tile_bins)
    minutes = sorted(rnd.sample(range(0, 12_000, 5), 800))
    rows = [(m % 2, at(m), None if rnd.random() < 0.1 else rnd.uniform(60, 250), 1.0, rnd.choice([0.0, 0.0, 1.0, 3.0])) for m in minutes]
    frame, spec = spark.createDataFrame(rows, GRID), GridSpec(pad_seconds=0, tile_bins=tile_bins)
    apart = gaps.rate_report(frame).join(summary.dose_correlation(frame, spec, regular=False), "pump_serial", "left")
    apart = apart.join(gaps.sensor_trend(frame), "pump_serial", "left")
    drops = joins.response_after_dose(frame, spec).groupBy("pump_serial").agg(F.avg("drop_bg").alias("avg_drop"))
    names = ["n_rates", "n_extreme", "max_rate", "correlation", "avg_drop", "mean_slope", "std_slope"]
    expected = {r.pump_serial: r for r in apart.join(drops, "pump_serial", "left").collect()}
    found = checks.dataset_metrics(frame, spec, "comprehensive", dt.datetime(2025, 1, 1)).collect()
    assert len(found) == len(expected) == 2 and any(r.avg_drop is not None for r in found)
    for row in found:
        assert [row[n] for n in names] == pytest.approx([expected[row.pump_serial][n] for n in names])


def test_the_checks_sort_the_rows_once(grid, spark, tmp_path):
    grid([100.0 + k % 50 for k in range(400)], bolus=[3.0 if k % 40 == 0 else 0.0 for k in range(400)]).write.parquet(str(tmp_path / "filled"))
    metrics = checks.dataset_metrics(spark.read.parquet(str(tmp_path / "filled")), SPEC, "comprehensive", dt.datetime(2025, 1, 1))
    plan = metrics._jdf.queryExecution().optimizedPlan().toString()
    # by itself every check dealt and sorted all rows in tiles; now only those behind a dose are dealt again
    assert plan.count("RepartitionByExpression") == 1
