from __future__ import annotations

import datetime as dt
import random

from conftest import at, ordered
from pyspark.sql import functions as F

from tidegrid.config import GridSpec
from tidegrid.functions import timegrid as tg
from tidegrid.operators import events as ev, features, joins


def test_time_chain(spark):
    utc = dt.datetime
    rows = [
        ("own", utc(2024, 1, 1, 1, 1, 1, 600000), None, None, None),
        ("raw", None, utc(2024, 1, 2), None, None),
        ("event", None, None, utc(2024, 1, 3), None),
        ("device", None, None, None, 505000000),
        ("year2000", utc(2000, 1, 1), None, None, None),
        ("none", None, None, None, None),
    ]
    frame = spark.createDataFrame(rows, "k string, a timestamp, b timestamp, c timestamp, raw long")
    out = frame.select("k", ev.event_time([F.col("a"), F.col("b"), F.col("c")], F.col("raw")).alias("t"))
    assert {r.k: r.t for r in out.collect()} == {
        "own": utc(2024, 1, 1, 1, 1, 2),
        "raw": utc(2024, 1, 2),
        "event": utc(2024, 1, 3),
        "device": utc(2024, 1, 1, 21, 46, 40),
        "year2000": None,
        "none": None,
    }


def test_rounding_of_times(spark):
    frame = spark.createDataFrame([(at(2.5),), (at(7.5),), (at(5),), (at(6),)], "ts timestamp")
    out = frame.select(
        tg.floor_to(F.col("ts"), 300).alias("f"), tg.ceil_to(F.col("ts"), 300).alias("c"), tg.round_to(F.col("ts"), 300).alias("r")
    ).collect()
    assert [tuple(r) for r in out] == [
        (at(0), at(5), at(0)),
        (at(5), at(10), at(10)),
        (at(5), at(5), at(5)),
        (at(5), at(10), at(5)),
    ]


def test_device_clock_is_relabelled(spark):
    out = spark.range(1).select(ev.device_time(F.lit(505000000), "America/New_York").alias("t")).collect()
    assert out[0].t == dt.datetime(2024, 1, 2, 2, 46, 40)


def test_categories(spark):
    frame = spark.createDataFrame(
        [("LidCgmDataG7", None), ("LidBasalRateChange", None), ("LidBolusCompleted", None), ("Alarm", None), ("Alarm", 5.0)],
        "name string, commandedRate double",
    )
    out = frame.select(ev.category(F.col("name"), {"commandedRate": F.col("commandedRate")}).alias("s"))
    assert [r.s for r in out.collect()] == ["cgm", "basal", "bolus", "unknown", "basal"]


def test_units(spark):
    frame = spark.createDataFrame([(800.0, 20.0, 0.0)], "a double, b double, c double")
    row = frame.select(
        ev.basal_value(F.col("a"), None, None).alias("milli"),
        ev.basal_value(F.col("a"), None, None, 100.0).alias("hundredths"),
        ev.basal_value(None, None, F.col("b")).alias("rule"),
        ev.bolus_value(delivered_milliunits=F.col("a")).alias("dose"),
        ev.bolus_value(insulin=F.col("c")).alias("no_dose"),
    ).collect()[0]
    assert tuple(row) == (0.8, 8.0, 0.2, 0.8, None)


def test_duplicates(events):
    rows = events([(1, 0, "cgm", v) for v in (10, 20, 30, 40)])
    assert [r.value for r in ev.dedup_last(rows).collect()] == [40.0]
    assert [r.value for r in ev.dedup_first(rows).collect()] == [10.0]
    spread = ev.spread_duplicates(rows, block=2).orderBy("seq_num").collect()
    assert [(r.ts - at(0)).microseconds for r in spread] == [0, 1, 2, 3]


def test_reject_reasons(events, spark):
    rows = events([(1, 0, "cgm", 100), (1, 5, "cgm", 5), (1, 10, "basal", 9), (1, 60 * 24 * 400, "cgm", 100)])
    null = spark.createDataFrame([(1, at(1), 9, "bolus", None)], rows.schema)
    out = ev.with_reject_reason(rows.unionByName(null), at(60)).orderBy("seq_num").collect()
    assert [r.reject_reason for r in out] == [None, "out_of_range", "out_of_range", "invalid_timestamp", "null_value"]


def test_outlier_flags_null_safe(grid):
    out = ev.outlier_flags(grid([None, 500.0, 100.0], basal=[9.0, 1.0, 1.0]))
    assert ordered(out, "bg", "bg_anomaly_flag", "basal_rate", "basal_anomaly_flag") == [
        (None, 0, 8.0, 1),
        (401.0, 1, 1.0, 0),
        (100.0, 0, 1.0, 0),
    ]
    constant = ev.outlier_flags(grid([100.0] * 3))
    assert ordered(constant, "basal_statistical_outlier") == [(0,)] * 3


def test_event_grid_flags(grid):
    spec = GridSpec()
    out = features.event_grid(grid([10.0, None, 700.0]), spec)
    assert ordered(out, "bg", "bg_clip_flag", "bg_missing_flag") == [(20.0, 1, 0), (None, 0, 1), (600.0, 1, 0)]


def test_unpivot(grid):
    out = ev.unpivot_streams(grid([None, 100.0], bolus=[0.0, 2.0]))
    assert sorted((r.stream, r.value) for r in out.collect()) == [("basal", 1.0), ("basal", 1.0), ("bolus", 2.0), ("cgm", 100.0)]


def test_dates(spark):
    frame = spark.createDataFrame([("2024-03-01",), ("2024-03-01T02:03:04Z",), ("2024-03-01T02:03:04.5",), ("x",)], "s string")
    out = [r.t for r in frame.select(ev.parse_date(F.col("s")).alias("t")).collect()]
    assert out == [dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 1, 2, 3, 4), dt.datetime(2024, 3, 1, 2, 3, 4, 500000), None]


def test_activity_and_range(spark):
    now = dt.datetime(2024, 3, 31)
    frame = spark.createDataFrame(
        [(i, dt.datetime(2024, 1, 1), now - dt.timedelta(days=d)) for i, d in enumerate((1, 7, 30, 31))],
        "pump_serial long, first_event timestamp, last_event timestamp",
    )
    out = ev.activity(frame, now).orderBy("pump_serial").collect()
    assert [r.status for r in out] == ["Active (current)", "Recently active", "Inactive (recent)", "Inactive (old)"]
    late = ev.sync_range(frame, 10).orderBy("pump_serial").collect()[0]
    assert late.sync_start == now - dt.timedelta(days=11)


def test_response_after_dose(grid):
    bg = [150.0] + [140.0 - i for i in range(60)]
    out = joins.response_after_dose(grid(bg, bolus=[3.0] + [0.0] * 60), GridSpec(tile_bins=20)).collect()
    assert [(r.pre_bg, r.min_bg, r.drop_bg) for r in out] == [(150.0, 93.0, 57.0)]  # four hours are 48 rows


def test_response_scans_only_rows_behind_a_dose(grid):
    rnd = random.Random(8)
    n, reach = 400, 48
    bg = [None if rnd.random() < 0.3 else rnd.uniform(60, 300) for _ in range(n)]
    bolus = [rnd.choice([2.0, 4.5, 1.0]) if rnd.random() < 0.02 or i in (0, 390, n - 1) else 0.0 for i in range(n)]
    out = joins.response_after_dose(grid(bg, bolus=bolus), GridSpec(tile_bins=70))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("_dose") > plan.count("bolus_dose")  # the filter before the frame
    expected = []
    for i in range(n):
        behind = bg[i + 1 : i + 1 + reach]
        if bolus[i] >= 2 and len(behind) >= 12:
            low = min((v for v in behind if v is not None), default=None)
            expected.append((at(5 * i), bolus[i], bg[i], low))
    assert ordered(out, "ts", "bolus_dose", "pre_bg", "min_bg") == expected


def test_chunks_and_schedule(spark):
    days = spark.createDataFrame([(1, dt.date(2024, 1, 1), dt.date(2024, 1, 20))], "pump_serial long, first_day date, last_day date")
    chunks = joins.date_chunks(days, 7).orderBy("chunk").collect()
    assert [(r.chunk_start.day, r.chunk_end.day) for r in chunks] == [(1, 8), (8, 15), (15, 20)]
    batches = joins.batch_schedule(days, "custom", 7).orderBy("batch").collect()
    assert [(r.batch_start.day, r.batch_end.day) for r in batches] == [(1, 8), (9, 16), (17, 20)]
    assert batches[0].job_id == "1_20240101_20240108"


def test_dedup_keeps_numbered_rows_and_never_loses_a_value(spark):
    rows = [(1, at(0), "cgm", None, 5.0), (1, at(0), "cgm", None, 5.0), (1, at(5), "cgm", 3, 6.0), (1, at(5), "cgm", None, 7.0), (1, at(5), "cgm", 1, 8.0)]
    frame = spark.createDataFrame(rows, "pump_serial long, ts timestamp, stream string, seq_num long, value double")
    assert {(r.ts, r.seq_num, r.value) for r in ev.dedup_last(frame).collect()} == {(at(0), None, 5.0), (at(5), 3, 6.0)}
    assert {(r.ts, r.seq_num, r.value) for r in ev.dedup_first(frame).collect()} == {(at(0), None, 5.0), (at(5), 1, 8.0)}


def ranges_of(spark, rows, side):
    return spark.createDataFrame(rows, f"pump_serial long, {side} long, {side}_start timestamp, {side}_end timestamp")


def test_overlap_join_by_brute_force(spark):
    rnd = random.Random(9)

    def make(n, length):
        rows = []
        for i in range(n):
            start = rnd.choice([rnd.uniform(0, 5000), 100.0, 101.0])
            rows.append((rnd.choice([1, 1, 1, 2]), i, at(start), at(start + rnd.choice([0, 0, 1, rnd.uniform(0, length)]))))
        return rows

    left, right = make(160, 4000), make(140, 300)
    odd = [(1, 998, None, at(5)), (1, 999, at(50), at(40)), (3, 997, at(0), at(1))]
    expected = sorted((a[0], a[1], b[1]) for a in left for b in right if a[0] == b[0] and a[2] <= b[3] and b[2] <= a[3])
    for rows_per_cell in (4, 32, 100_000):
        found = joins.overlap_join(ranges_of(spark, left + odd, "l"), ranges_of(spark, right + odd, "r"), rows_per_cell=rows_per_cell, tile_seconds=36000)
        assert sorted((r.pump_serial, r.l, r.r) for r in found.collect()) == expected + [(3, 997, 997)]


def test_no_key_of_an_overlap_join_is_full(spark):
    """One device with 10^5 ranges, most of them open at once with many others, and a few quiet devices."""
    base = spark.range(100_000).select(
        F.when(F.col("id") % 100 == 0, F.col("id") % 7 + 2).otherwise(1).alias("pump_serial"), F.col("id").alias("n"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.floor(F.col("id") / 50)).alias("s"),
    )
    long = F.timestamp_seconds(F.unix_seconds("s") + F.when(F.col("n") % 10 == 0, 40).otherwise(2))
    left = base.filter("n % 2 = 0").select("pump_serial", F.col("n").alias("l"), F.col("s").alias("l_start"), long.alias("l_end"))
    right = base.filter("n % 2 = 1").select("pump_serial", F.col("n").alias("r"), F.col("s").alias("r_start"), long.alias("r_end"))
    l, r = joins.overlap_cells(left, right)
    keys = ["pump_serial", "_cell", "_part"]
    sizes = [x["count"] for x in l.select(*keys).unionByName(r.select(*keys)).filter("pump_serial = 1").groupBy(*keys).count().collect()]
    assert len(sizes) > 200 and max(sizes) <= 2 * sum(sizes) / len(sizes)
