from __future__ import annotations

import itertools
import random
import time

import pytest
from conftest import EVENTS, at, one_column, ordered
from pyspark.sql import functions as F

from tidegrid.config import GridSpec
from tidegrid.operators import constant_runs, gaps
from tidegrid.plans import dataflows

SPEC = GridSpec(pad_seconds=0, tile_bins=25)


def test_run_classification(spark):
    """Verdicts by run length, insulin activity and gradient."""
    rows = [(i, n, quiet, g) for i, (n, quiet, g) in enumerate(itertools.product((2, 3, 4, 5, 6, 20), (True, False), (0.0, 3.5, 6.0)))]
    frame = spark.createDataFrame(
        [(i, n, not quiet, 100.0, 100.0 + g * (n + 2)) for i, n, quiet, g in rows],
        "i int, run_len long, has_insulin_activity boolean, _before double, _after double",
    )
    found = {r.i: r for r in constant_runs._judge(frame).collect()}
    for i, n, quiet, g in rows:
        expected = n >= 6 or (n in (4, 5) and quiet and g >= 6)
        assert found[i].replaced == expected, (n, quiet, g)
        assert found[i].is_synthetic == (n >= 6 or (n >= 4 and quiet) or g > 3)


def test_repair_flags(grid):
    bg = [150.0] + [100.0] * 6 + [160.0] + [100.0] * 2 + [170.0, 100.0, 180.0]
    out = constant_runs.repair_placeholders(grid(bg), SPEC)
    assert one_column(out, "bg") == [150.0] + [None] * 6 + [160.0, 100.0, 100.0, 170.0, 100.0, 180.0]
    assert one_column(out, "bg_100_run_len") == [0] + [6] * 6 + [0] * 6
    assert one_column(out, "bg_100_real") == [0] * 8 + [1, 1, 0, 0, 0]


def test_insulin_activity_reach(grid):
    """A dose six bins after the run counts, seven bins does not; a basal step needs both ends in reach."""
    run = [120.0] * 8 + [100.0] * 4 + [130.0] * 10
    end = 11
    for distance, active in ((6, True), (7, False)):
        bolus = [0.0] * len(run)
        bolus[end + distance] = 1.0
        found = constant_runs.placeholder_runs(grid(run, bolus=bolus), SPEC).collect()
        assert [r.has_insulin_activity for r in found] == [active]
    for change, active in ((2, False), (3, True), (17, True), (18, False)):
        basal = [1.0] * change + [2.0] * (len(run) - change)
        found = constant_runs.placeholder_runs(grid(run, basal=basal), SPEC).collect()
        assert [r.has_insulin_activity for r in found] == [active], change


def test_gradient_takes_farthest_before_and_nearest_after(grid):
    bg = [210.0, None, 150.0, 100.0, 100.0, None, 180.0, 90.0]
    found = constant_runs.placeholder_runs(grid(bg), SPEC).collect()
    assert found[0].transition_gradient == pytest.approx(abs(180.0 - 210.0) / 4)


def test_run_longer_than_a_tile(grid):
    out = constant_runs.placeholder_runs(grid([100.0] * 120), SPEC).collect()
    assert [(r.run_len, r.replaced) for r in out] == [(120, True)]


def times(spark, minutes, device=1):
    return spark.createDataFrame([(device, at(m)) for m in minutes], "pump_serial long, ts timestamp")


def test_gap_of_exactly_fifteen_hours(spark):
    exact = times(spark, [0, 900])
    longer = times(spark, [0, 900 + 1 / 60])
    assert gaps.find_gaps(exact, 54000).count() == 0
    assert gaps.find_gaps(longer, 54000).count() == 1
    assert one_column(gaps.with_segments(exact), "segment_id") == [1, 1]
    assert one_column(gaps.with_segments(longer), "segment_id") == [1, 2]


def test_segments_and_their_starts_by_brute_force(spark):
    rnd = random.Random(4)
    minutes = {d: [0.0] for d in (1, 2, 3)}
    for d, own in minutes.items():
        for _ in range(60):
            own.append(own[-1] + rnd.choice([0, 1, 300, 900, 900.5, 4000]))
    frame = times(spark, minutes[1]).union(times(spark, minutes[2], 2)).union(times(spark, minutes[3], 3))
    expected = []
    for d, own in minutes.items():
        number, start = 1, own[0]
        for i, m in enumerate(own):
            if i and m - own[i - 1] > 900:
                number, start = number + 1, m
            expected.append((d, at(m), number, at(start)))
    for width in (3600, 40000, 10**7):
        out = gaps.with_segments(frame, tile_seconds=width, start="segment_start")
        assert sorted((r.pump_serial, r.ts, r.segment_id, r.segment_start) for r in out.collect()) == sorted(expected)
    plan = gaps.with_segments(frame)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and plan.count("LogicalRDD") + plan.count("LocalRelation") <= 6  # three unions, read by the rows and by the tiles


def test_short_segments_are_dropped(spark):
    minutes = [5 * i for i in range(11)] + [2000 + 5 * i for i in range(12)]
    segmented = gaps.with_segments(times(spark, minutes), tile_seconds=1800)
    assert [(r.segment_id, r.n_rows) for r in gaps.segment_table(segmented).collect()] == [(2, 12)]
    assert gaps.keep_long_segments(segmented, tile_seconds=1800).count() == 12


def test_gap_summary(spark):
    out = gaps.gap_summary(times(spark, [0, 5, 125, 130, 430]).union(times(spark, [0, 5], 2)), 600).orderBy("pump_serial").collect()
    assert (out[0].n_gaps, out[0].max_gap_minutes, out[0].mean_gap_minutes, out[0].median_gap_minutes) == (2, 300.0, 210.0, 210.0)
    assert (out[1].n_gaps, out[1].total_gap_minutes, out[1].max_gap_minutes) == (0, 0.0, None)


@pytest.mark.parametrize("extra, blocks", [(0, 2), (1, 3)])
def test_sensor_blocks_drop_the_tail(grid, extra, blocks):
    n = 144 * 3 + extra
    values = [100.0 + 6.0 * (i // 144) for i in range(n)]
    assert gaps.sensor_windows(grid(values), tile_seconds=3600 * 4).count() == blocks
    trend = gaps.sensor_trend(grid(values), tile_seconds=3600 * 4).collect()
    if blocks < 3:
        assert trend == []
    else:
        assert trend[0].mean_slope == pytest.approx(6.0) and trend[0].drift_detected


def test_rate_window(spark):
    rows = spark.createDataFrame(
        [(1, at(0), 100.0), (1, at(4), 150.0), (1, at(7.9), 100.0), (1, at(12), None), (1, at(23.9), 300.0), (1, at(40), 900.0)],
        "pump_serial long, ts timestamp, bg double",
    )
    out = gaps.rate_report(rows).collect()[0]
    assert (out.n_rates, out.n_extreme) == (2, 2)
    assert out.max_rate == pytest.approx(12.5)


def test_segments_on_grid(events):
    """Rows inside a long gap belong to no segment, and no window crosses it."""
    rows = [(1, 5 * i, "cgm", 100 + i) for i in range(14)] + [(1, 1200 + 5 * i, "cgm", 200 + i) for i in range(13)]
    rows += [(1, 5000, "cgm", 90)]
    frame = events(rows)
    out = dataflows.raw_sequences(frame, GridSpec(tile_bins=40), repair=False)
    sizes = {r.segment_id: r["count"] for r in out.groupBy("segment_id").count().collect()}
    assert sizes == {1: 14, 2: 13}
    first = out.filter(F.col("segment_id") == 2).orderBy("ts").collect()[0]
    assert (first.basal_delta, first.bg_slope_15min, first.bg) == (0.0, 0.0, 200.0)
    assert ordered(out.filter("mask_label"), "ts") == []


@pytest.mark.parametrize("tile_bins", [7, 40])
def test_lean_sequences_are_the_same(spark, tile_bins):
    """Points of several tiles, gaps longer than a segment allows, repeated events, events without device, time or value, years out of range."""
    rnd = random.Random(tile_bins)
    rows = []
    for device in (1, 2, None):
        minutes = rnd.sample(range(0, 6000, 5), 300) + rnd.sample(range(9000, 9400), 60)
        rows += [(device, at(m), k, rnd.choice(["cgm", "cgm", "basal", "bolus"]), rnd.choice([None, 0.5, 80.0, 120.0])) for k, m in enumerate(minutes)]
    rows += [(d, ts, k + 1000, s, 99.0) for d, ts, k, s, _ in rows[::9]]
    rows += [(1, None, 1, "cgm", 90.0), (2, None, 2, "basal", None), (3, None, 1, "cgm", 90.0), (2, at(-60 * 24 * 365 * 20), 3, "cgm", 90.0)]
    frame = spark.createDataFrame(rows, EVENTS)
    spec = GridSpec(tile_bins=tile_bins)
    plain, lean = (dataflows.raw_sequences(frame, spec, repair=False, lean=lean) for lean in (False, True))
    assert sorted(plain.columns) == sorted(lean.columns)
    found = sorted(map(str, lean.select(*plain.columns).collect()))
    assert len(found) > 1000 and found == sorted(map(str, plain.collect()))


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(k).getName() for k in range(files.size())) if name.startswith("shuffle_")}


def test_resequencing_leaves_no_shuffles_behind(spark, grid):
    """A dense grid is shuffled by every step; each step's files go when its rows are written."""
    merged = grid([100.0 + k % 9 for k in range(400)]).union(grid([None, 90.0] * 200, device=2)).repartition(4)
    before = shuffle_files(spark)
    rows, table = dataflows.resequenced(merged, SPEC)
    left, until = shuffle_files(spark) - before, time.time() + 20
    while left and time.time() < until:  # files go in the background
        time.sleep(0.5)
        left = shuffle_files(spark) - before
    assert not left
    assert [(r.pump_serial, r.n_rows) for r in table.orderBy("pump_serial").collect()] == [(1, 400), (2, 400)] and rows.count() == 800
