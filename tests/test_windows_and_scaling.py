from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pytest
from conftest import one_column
from pyspark.sql import functions as F

from tidegrid import tiles
from tidegrid.config import GridSpec, SplitRules, WindowSpecParams
from tidegrid.functions.quantiles import exact_percentiles, in_buckets
from tidegrid.operators import features, grid as gr, windows
from tidegrid.plans import dataflows

SPEC = GridSpec(pad_seconds=0, tile_bins=30)


def test_exact_percentiles_match_numpy(spark):
    rnd = random.Random(1)
    data = {1: [rnd.gauss(0, 50) for _ in range(301)], 2: [5.0] * 40, 3: [1.0, 2.0], 4: [7.0], 5: [rnd.choice([1.0, 2.0, 9.0]) for _ in range(100)]}
    rows = [(k, v) for k, values in data.items() for v in values] + [(6, None), (1, None)]
    frame = spark.createDataFrame(rows, "k long, v double")
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.75, "e": 1.0}
    for buckets, busy in ((3, 0), (256, 0), (256, 50), (256, 10**6)):
        out = {r.k: r for r in exact_percentiles(frame, ["k"], "v", probs, buckets, busy=busy).collect()}
        assert set(out) == set(data)
        for k, values in data.items():
            for name, p in probs.items():
                assert out[k][name] == pytest.approx(np.percentile(values, p * 100)), (k, name)


def test_an_outlier_does_not_fill_a_bucket(spark):
    values = spark.range(100_000).select(F.lit(1).alias("k"), (F.col("id") / 1e5).alias("_v")).union(spark.sql("SELECT 1, 1e9D"))
    sizes = in_buckets(values.withColumn("_n", F.lit(1)), ["k"]).groupBy("_bucket").count().collect()
    assert max(r["count"] for r in sizes) < 0.02 * 100_000 and sum(r["count"] for r in sizes) == 100_001


def test_lookup_copies_by_need_and_splits_a_hot_key(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") < 10_000, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("ts"))
    table = rows.select("k").distinct().withColumn("x", F.col("k") * 2)
    plain = sorted(tuple(r) for r in rows.join(table, "k", "left").collect())
    for limit in (0, 10**6):
        out = tiles.lookup(rows, table, ["k"], salt_by=["ts"], broadcast_rows=limit, salts=64)
        assert sorted(tuple(r) for r in out.collect()) == plain
    salted = rows.withColumn("s", F.pmod(F.xxhash64("ts"), F.lit(64)))
    hot = [r["count"] for r in salted.filter("k = 0").groupBy("s").count().collect()]
    assert len(hot) == 64 and max(hot) < 2 * 10_000 / 64
    assert salted.filter("k <> 0").select("k", "s").distinct().count() == 20_000  # a quiet key is not copied


@pytest.mark.parametrize("tile_bins", [16, 2016, 1_000_000])
def test_insulin_on_board_does_not_depend_on_the_tile(grid, tile_bins):
    doses = [1.0 if k % 40 == 3 else 0.0 for k in range(200)]
    out = one_column(features.add_insulin_on_board(grid([100.0] * 200, bolus=doses), GridSpec(pad_seconds=0, tile_bins=tile_bins)), "iob")
    expected = [sum(doses[j] * math.exp(-0.0144 * (i - j + 1)) for j in range(max(0, i - 71), i + 1)) for i in range(200)]
    assert out == pytest.approx(expected)


def test_split_sizes(grid):
    rows = grid([100.0] * 90)
    sizes = lambda rules: [
        one_column(windows.chronological_split(rows, rules, tile_seconds=3600), "subset").count(s) for s in ("train", "validate", "test")
    ]
    assert sizes(SplitRules()) == [63, 13, 14]
    assert sizes(SplitRules(truncate_double=True)) == [int(90 * 0.7), int(90 * 0.85) - int(90 * 0.7), 90 - int(90 * 0.85)]
    labels = one_column(windows.chronological_split(rows, tile_seconds=3600), "subset")
    assert labels == sorted(labels, key=["train", "validate", "test"].index)


def test_windows_stay_inside_segments_and_respect_nulls(grid):
    bg = [float(i) for i in range(40)]
    bg[5] = None
    rows = grid(bg).withColumn("segment_id", (F.row_number().over(windows.tiles.Window.orderBy("ts")) > 20).cast("int"))
    params = WindowSpecParams(lookback=8, horizon=2, stride=1, max_null_share=0.10)
    out = windows.sliding_windows(rows, GridSpec(tile_bins=12), ["bg"], params=params).collect()
    starts = {0: [], 1: []}
    for r in out:
        index = int(r.bg[0]) if r.bg[0] is not None else 5
        starts[r.segment_id].append(index)
        assert r.target == [r.bg[-1] + 1, r.bg[-1] + 2]
    # one null in eight cells is more than ten percent, and a null target drops a window too
    assert sorted(starts[0]) == [6, 7, 8, 9, 10]
    assert sorted(starts[1]) == list(range(20, 31))


def test_windows_with_a_hole_are_dropped(grid):
    """Bins 10 and 11 are missing; windows start at every third bin of the time axis, whatever is missing."""
    rows = grid([float(i) for i in range(40)]).withColumn("segment_id", F.lit(1))
    holed = rows.filter(~F.col("bg").isin(10.0, 11.0))
    for tile_bins in (7, 12, 2016):
        out = windows.sliding_windows(holed, GridSpec(tile_bins=tile_bins), ["bg"], params=WindowSpecParams(4, 1, 3)).collect()
        assert sorted((r.bg, r.target) for r in out) == [
            ([float(i + k) for k in range(4)], [float(i + 4)]) for i in range(0, 36, 3) if not {10, 11} & set(range(i, i + 5))
        ]


def test_no_row_holds_a_window_and_the_array_it_is_from(grid):
    rows = grid([1.0] * 300).withColumn("segment_id", F.lit(1))
    out = windows.sliding_windows(rows, GridSpec(tile_bins=200), ["bg"], params=WindowSpecParams(8, 2, 1))
    assert out.count() == 291
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "inline" in plan and plan.count("Generate explode") == 2  # halo copies, parts of picked starts


@pytest.mark.parametrize("how", [
    gr.Alignment(bg_fill="bounded", bg_fill_seconds=1500, basal_fill="until_last", basal_default=None), gr.Alignment(bg_asof=True, bg_fill="unbounded"),
])
def test_stretches_of_equal_rows_give_the_grid_and_its_windows(spark, how):
    """A grid as stretches has the rows of the grid, and its windows are those of the rows, whatever the tiles."""
    rnd, start = random.Random(3), dt.datetime(2024, 3, 1)
    times = {d: sorted(rnd.sample(range(3000), 25)) for d in (1, 2)}
    rows = [(d, start + dt.timedelta(minutes=m), i, rnd.choice(["cgm", "basal", "bolus"]), float(rnd.randint(1, 90))) for d in times for i, m in enumerate(times[d])]
    events = spark.createDataFrame(rows, "pump_serial long, ts timestamp, seq_num long, stream string, value double")
    spec, params = GridSpec(pad_seconds=0, tile_bins=40), WindowSpecParams(6, 2, 3, max_null_share=0.2)
    plain, runs = gr.align(events, spec, how), gr.align(events, spec, how, until="until")
    points = runs.withColumn("ts", F.explode(F.expr("sequence(ts, until, interval 300 seconds)"))).drop("until")
    assert runs.count() < plain.count() / 4
    assert sorted(map(repr, points.collect())) == sorted(map(repr, plain.collect()))
    one = lambda df, s, **more: sorted(map(repr, windows.sliding_windows(df.withColumn("segment_id", F.lit(1)), s, ["bolus_dose", "bg"], "basal_rate", params, **more).collect()))
    found = one(runs, spec, until="until")
    assert found == one(plain, GridSpec(pad_seconds=0, tile_bins=2016))
    assert how.bg_fill != "unbounded" or found


def test_latest_window_needs_enough_rows(grid):
    rows = grid([1.0, 2.0, 3.0, 4.0]).unionByName(grid([9.0, 9.0], device=2))
    out = windows.latest_window(rows, SPEC, ["bg"], lookback=3).collect()
    assert [(r.pump_serial, r.bg) for r in out] == [(1, [2.0, 3.0, 4.0])]


def test_scalers(grid):
    rows = grid([10.0, 20.0, None, 30.0], basal=[2.0] * 4)
    z = windows.zscore(rows, ["bg", "basal_rate"])
    assert one_column(z, "bg") == [pytest.approx(-1.0), pytest.approx(0.0), None, pytest.approx(1.0)]
    assert one_column(z, "basal_rate") == [0.0] * 4
    assert one_column(windows.minmax(rows, ["bg"]), "bg") == [0.0, 0.5, None, 1.0]
    empty = windows.zscore(grid([None, None]), ["bg"])
    assert one_column(empty, "bg") == [None, None]


def test_robust_scaler_is_fitted_on_train_only(grid):
    train, test = grid([10.0, 20.0, 30.0, 40.0, None], basal=[3.0] * 5), grid([1000.0, None])
    params = windows.robust_params(train, ["bg", "basal_rate"])
    found = {r.feature: (r.center, r.scale) for r in params.collect()}
    assert found == {"bg": (25.0, 15.0), "basal_rate": (3.0, 1.0)}
    assert one_column(windows.robust_scale(test, params, ["bg", "basal_rate"]), "bg") == [65.0, pytest.approx(-25 / 15)]


def test_training_windows_use_train_statistics(grid):
    rows = grid([float(i) for i in range(100)]).withColumn("segment_id", F.lit(1))
    out = dataflows.training_windows(rows, SPEC, ["bg"], WindowSpecParams(5, 1, 1)).collect()
    values = [float(i) for i in range(70)]
    center, scale = np.median(values), np.percentile(values, 75) - np.percentile(values, 25)
    first = min((r for r in out if r.subset == "test"), key=lambda r: r.window_start)
    assert first.bg[0] == pytest.approx((85 - center) / scale)
    assert {s: sum(r.subset == s for r in out) for s in ("train", "validate", "test")} == {"train": 65, "validate": 10, "test": 10}


def test_insulin_on_board(grid):
    doses = [0.0] * 100
    doses[3], doses[50] = 4.0, 2.0
    out = one_column(features.add_insulin_on_board(grid([100.0] * 100, bolus=doses), SPEC), "iob")
    for i in range(100):
        expected = sum(doses[j] * np.exp(-0.0144 * (i - j + 1)) for j in range(max(0, i - 71), i + 1))
        assert out[i] == pytest.approx(expected)


def test_minutes_since_bolus(grid):
    doses = [0.0, 1.0] + [0.0] * 30
    out = features.add_minutes_since_bolus(grid([100.0] * 32, bolus=doses), SPEC, cap=60)
    assert one_column(out, "time_since_last_bolus") == [60.0] + [float(min(60, 5 * i)) for i in range(31)]


def test_insulin_on_board_over_blocks_needs_no_arrays(grid):
    """Frames that reach over a border of 72 rows; no list of doses per row."""
    doses = [float(i * 7 % 5) for i in range(300)]
    found = features.add_insulin_on_board(grid([100.0] * 300, bolus=doses), SPEC)
    expected = [sum(doses[j] * math.exp(-0.0144 * (i - j + 1)) for j in range(max(0, i - 71), i + 1)) for i in range(300)]
    assert one_column(found, "iob") == pytest.approx(expected, abs=1e-9)
    assert "collect_list" not in found._jdf.queryExecution().executedPlan().toString()
