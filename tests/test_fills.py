"""The five fills against plain Python, and their traps."""

from __future__ import annotations

import random

import pytest
from conftest import EVENTS, at, one_column, ordered

from tidegrid.config import GridSpec
from tidegrid.operators import events as ev, grid as gr, runs

SPEC = GridSpec(pad_seconds=0, tile_bins=50)


def series(seed, n=150):
    rnd = random.Random(seed)
    out = []
    while len(out) < n:
        out += [rnd.uniform(50, 300) for _ in range(rnd.randint(1, 4))]
        out += [None] * rnd.choice([1, 3, 4, 12, 13, 35, 49, 60])
    if rnd.random() < 0.5:
        out = out[2:]
    return out[:n]


def neighbours(x, i):
    left = next((j for j in range(i - 1, -1, -1) if x[j] is not None), None)
    right = next((j for j in range(i + 1, len(x)) if x[j] is not None), None)
    return left, right


def short_gap(x, limit=12):
    out = []
    for i, v in enumerate(x):
        left, right = neighbours(x, i)
        if v is None and left is not None and right is not None and right - left - 1 <= limit:
            v = x[left] + (x[right] - x[left]) * (i - left) / (right - left)
        out.append(v)
    return out


def chain(x, carry=6, line=24):
    y = list(x)
    for i in range(len(x)):
        left, _ = neighbours(x, i)
        if x[i] is None and left is not None and i - left <= carry:
            y[i] = x[left]
    z = list(y)
    for i in range(len(y)):
        if y[i] is not None:
            continue
        left, right = neighbours(y, i)
        near = (left is not None and i - left <= line) or (right is not None and right - i <= line)
        if not near:
            continue
        if left is None:
            z[i] = y[right]
        elif right is None:
            z[i] = y[left]
        else:
            z[i] = y[left] + (y[right] - y[left]) * (i - left) / (right - left)
    return z


def close(a, b):
    return all((p is None and q is None) or (p is not None and q is not None and abs(p - q) < 1e-9) for p, q in zip(a, b)) and len(a) == len(b)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_short_gap_interpolation(grid, seed):
    x = series(seed)
    frame = grid(x)
    expected = short_gap(x)
    out = runs.impute_short_gaps(frame, SPEC)
    assert close(one_column(out, "bg"), expected)
    assert one_column(out, "mask_bg") == [v is None for v in x]
    assert one_column(out, "mask_label") == [v is None for v in expected]
    flagged = runs.impute_with_flags(frame, SPEC)
    assert close(one_column(flagged, "bg"), expected)
    lengths = {}
    for i, v in enumerate(x):
        if v is None:
            left, right = neighbours(x, i)
            lengths[i] = (len(x) if right is None else right) - (-1 if left is None else left) - 1
    assert one_column(flagged, "bg_hard_gap") == [int(lengths.get(i, 0) > 12) for i in range(len(x))]
    assert one_column(flagged, "bg_impute_run_len") == [
        lengths[i] if v is None and expected[i] is not None else 0 for i, v in enumerate(x)
    ]


@pytest.mark.parametrize("seed", [4, 5, 6, 7])
def test_fill_chain(grid, seed):
    x = series(seed, 200)
    out = runs.fill_chain(grid(x), SPEC)
    expected = chain(x)
    assert close(one_column(out, "bg"), expected)
    assert one_column(out, "cgm_gap_filled") == [
        int(v is not None and (i == 0 or expected[i - 1] is None)) for i, v in enumerate(expected)
    ]


def test_long_run_stays_partly_empty(grid):
    out = one_column(runs.fill_chain(grid([100.0] + [None] * 60 + [200.0]), SPEC), "bg")
    assert sum(v is None for v in out) == 60 - 6 - 24 - 24


def test_null_runs(grid):
    x = [None, None, 1.0, None, 2.0, None, None, None]
    found = sorted(
        (r.run_len, r.bounded_left, r.bounded_right) for r in runs.null_runs(grid(x), SPEC).collect()
    )
    assert found == [(1, True, True), (2, False, True), (3, True, False)]
    closed = runs.null_runs(grid(x), SPEC, include_open_end=False).collect()
    assert sorted(r.run_len for r in closed) == [1, 2]


def test_edge_fill_stops_at_three(grid):
    assert one_column(runs.edge_fill(grid([None] * 3 + [50.0, 60.0] + [None] * 3), SPEC), "bg") == [50.0] * 4 + [60.0] * 4
    x = [None] * 4 + [50.0, 60.0] + [None] * 4
    assert one_column(runs.edge_fill(grid(x), SPEC), "bg") == x
    flagged = runs.edge_fill(grid([None, 50.0, None, 60.0]), SPEC)
    assert ordered(flagged, "bg", "bg_was_imputed", "bg_impute_run_len") == [(50.0, 1, 1), (50.0, 0, 0), (None, 0, 0), (60.0, 0, 0)]


def test_all_null_and_single_row(grid):
    assert one_column(runs.impute_short_gaps(grid([None] * 5), SPEC), "bg") == [None] * 5
    assert one_column(runs.fill_chain(grid([None] * 5), SPEC), "bg") == [None] * 5
    assert one_column(runs.fill_chain(grid([7.0]), SPEC), "cgm_gap_filled") == [1]
    assert one_column(runs.forward_fill(grid([None, 3.0, None]), SPEC, "bg", then_back=True), "bg") == [3.0, 3.0, 3.0]


def test_asof_is_not_bin_last(events):
    """Two readings 29 minutes apart, off the marks: the last before a point against the last inside a bin."""
    rows = events([(1, 2, "cgm", 110), (1, 31, "cgm", 120)])
    asof = one_column(gr.asof(rows, "cgm", SPEC), "value")
    assert asof == [None, 110.0, 110.0, 110.0, 110.0, 110.0, 110.0, 120.0]
    binned = gr.align(rows, SPEC)
    assert one_column(binned, "bg") == [110.0, None, None, None, None, None, 120.0, None]
    bounded = one_column(gr.asof(rows, "cgm", SPEC, tolerance_seconds=1200), "value")
    assert bounded == [None, 110.0, 110.0, 110.0, 110.0, None, None, 120.0]


def test_basal_fill_modes(events):
    rows = events([(1, 0, "basal", 1), (1, 10, "basal", 2), (1, 25, "cgm", 100)])
    carry = gr.align(rows, SPEC, gr.Alignment(basal_agg="last"))
    assert one_column(carry, "basal_rate") == [1, 1, 2, 2, 2, 2]
    tail = gr.align(rows, SPEC, gr.Alignment(basal_agg="last", basal_fill="tail_only"))
    assert one_column(tail, "basal_rate") == [1, 0, 2, 2, 2, 2]
    until = gr.align(rows, SPEC, gr.Alignment(basal_agg="last", basal_fill="until_last"))
    assert one_column(until, "basal_rate") == [1, 1, 2, 0, 0, 0]


def test_unaligned_boluses_reach_the_grid(events):
    rows = events([(1, 3.2, "cgm", 100), (1, 4.9, "bolus", 2), (1, 4.95, "bolus", 1.5), (1, 13, "cgm", 110)])
    out = gr.align(rows, SPEC, gr.Alignment(extent_streams=("cgm",)))
    assert one_column(out, "bolus_dose") == [3.5, 0, 0, 0]


def test_year_guard_and_cgm_extent(events):
    rows = events([(1, 0, "cgm", 100), (1, 10, "cgm", 100), (1, -20, "basal", 3), (2, 60 * 24 * 366 * 8, "cgm", 9)])
    out = gr.align(rows, SPEC, gr.Alignment(extent_streams=("cgm",)))
    assert ordered(out, "pump_serial", "basal_rate") == [(1, 3.0)] * 3


def test_time_weighted_basal_equals_minute_carry(events):
    """Bins from intervals against a walk over every minute."""
    rnd = random.Random(8)
    changes = sorted((rnd.uniform(0, 400), rnd.uniform(0, 3)) for _ in range(25))
    rows = events([(1, m, "basal", v) for m, v in changes])
    first, last = -(-changes[0][0] // 1), -(-changes[-1][0] // 1)
    per_bin = {}
    for minute in range(int(first), int(last) + 1):
        per_bin.setdefault(minute // 5, []).append([v for m, v in changes if m <= minute][-1])
    for how, pick in (("mean", lambda x: sum(x) / len(x)), ("last", lambda x: x[-1])):
        out = one_column(gr.basal_time_weighted(rows, GridSpec(pad_seconds=0, tile_bins=6), how), "value")
        assert close(out, [pick(per_bin[k]) for k in sorted(per_bin)])


@pytest.mark.parametrize("tile_bins", [3, 50])
def test_fill_chain_of_stretches_equals_that_of_their_points(spark, tile_bins):
    rnd = random.Random(tile_bins)
    rows = [(d, at(rnd.randrange(20_000)), k, rnd.choice(["cgm", "basal", "bolus"]), rnd.uniform(0, 90)) for k in range(60) for d in (1, 2)]
    rows += [(3, at(1_000_000), 0, "bolus", 1.0), (4, at(7), 0, "cgm", 90.0)]
    events, spec = spark.createDataFrame(rows, EVENTS), GridSpec(pad_seconds=0, tile_bins=tile_bins)
    how = gr.Alignment(bg_agg="mean", basal_agg="weighted", basal_fill="until_last", basal_default=None)
    clean = ev.dedup_last(events)
    points = runs.fill_chain(gr.align(clean, spec, how), spec)
    stretches = gr.align(clean, spec, how, until="until")
    out = runs.fill_chain(stretches, spec, until="until")
    assert stretches.count() < points.count() / 5 or tile_bins == 3
    assert out.columns == points.columns and sorted(out.collect()) == sorted(points.collect())
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(sequence") < plan.index("Window")  # points are made after the last sort
