"""Streams fed file by file give what the batch operators give."""

from __future__ import annotations

import random

import pytest
from conftest import at, ordered
from pyspark.sql import Row, Window
from pyspark.sql import functions as F

from tidegrid.config import GridSpec
from tidegrid.operators import events as ev, grid as gr
from tidegrid.sources.merge_tree import MergeTree
from tidegrid.streaming import jobs, state


def feed(events, tmp_path, parts=3, overlap=False):
    """Random events in time order, written as several files that the stream reads one by one."""
    rnd = random.Random(11)
    rows = []
    for i in range(240):
        kind = rnd.choice(["cgm", "basal", "bolus"])
        rows.append((rnd.randint(1, 3), i * 17.0 + rnd.uniform(0, 16), kind, rnd.uniform(1, 200)))
    frame = events(rows).cache()
    size = len(rows) // parts
    folder = tmp_path / "in"
    for part in range(parts):
        low = part * size - (10 if overlap and part else 0)
        piece = frame.filter((F.col("seq_num") >= low) & (F.col("seq_num") < (part + 1) * size))
        piece.coalesce(1).write.mode("append").parquet(str(folder))
    return frame, str(folder)


def stream_of(spark, frame, folder):
    return jobs.read_files(spark, folder, frame.schema, files_per_batch=1)


def test_restart_adds_only_new_files(spark, events, tmp_path):
    frame, folder = feed(events, tmp_path)
    out = str(tmp_path / "out")
    for _ in range(2):
        jobs.run_to_files(stream_of(spark, frame, folder), out)
    assert spark.read.parquet(f"{out}/data").count() == frame.count()
    frame.limit(5).write.mode("append").parquet(folder)
    jobs.run_to_files(stream_of(spark, frame, folder), out)
    assert spark.read.parquet(f"{out}/data").count() == frame.count() + 5


def test_latest_rows_over_overlapping_batches(spark, events, tmp_path):
    frame, folder = feed(events, tmp_path, overlap=True)
    found = jobs.latest_rows(stream_of(spark, frame, folder), str(tmp_path / "latest"))
    assert ordered(found.select(*frame.columns)) == ordered(ev.dedup_last(frame))


ARRIVALS = {"by_device": "pump_serial", "by_time": "ts", "shuffled": "xxhash64(seq_num)"}


@pytest.fixture(params=[(order, files) for order in ARRIVALS for files in (1, 1000)], ids=lambda p: f"{p[0]}-{p[1]}")
def arrivals(request, spark, events, tmp_path):
    """The same events in five files, dealt in different orders, one file or all files per batch."""
    rnd, (order, files_per_batch) = random.Random(5), request.param
    rows, minute = [], 0.0
    for _ in range(200):
        minute += rnd.choice([1.0, 3.5, 40.0, 900.0, 901.0])
        rows.append((rnd.choice([1, 1, 1, 2, 3]), minute, rnd.choice(["cgm", "basal", "bolus"]), rnd.uniform(1, 200)))
    frame = events(rows).cache()
    folder = str(tmp_path / "in")
    frame.withColumn("k", F.ntile(5).over(Window.orderBy(F.expr(ARRIVALS[order]), "seq_num"))).repartition(5, "k").drop("k").write.parquet(folder)
    return frame, lambda: jobs.read_files(spark, folder, frame.schema, files_per_batch=files_per_batch)


def test_bins_equal_batch(arrivals, tmp_path):
    frame, stream = arrivals
    rows = jobs.binned(stream(), str(tmp_path / "bins")).collect()
    found = {(r.pump_serial, r.ts): r.bg for r in rows if r.bg is not None}
    assert found == {(r.pump_serial, r.ts): r.value for r in gr.bin_last(frame, "cgm", GridSpec()).collect()}
    doses = {(r.pump_serial, r.ts): r.value for r in gr.bin_sum(frame, "bolus", GridSpec()).collect()}
    assert {(r.pump_serial, r.ts): r.bolus_dose for r in rows if r.bolus_dose} == pytest.approx(doses)
    assert sum(r.n_events for r in rows) == frame.count()


def test_sessions_equal_segments(arrivals, tmp_path):
    frame, stream = arrivals
    found = jobs.sessions(stream(), str(tmp_path / "sessions")).collect()
    times, expected = {}, []
    for r in sorted(frame.collect(), key=lambda r: (r.pump_serial, r.ts)):
        times.setdefault(r.pump_serial, []).append(r.ts)
    for device, own in times.items():
        start = 0
        for i in range(1, len(own) + 1):
            if i == len(own) or (own[i] - own[i - 1]).total_seconds() > 15 * 3600:
                expected.append((device, own[start], own[i - 1], i - start))
                start = i
    assert sorted(tuple(r) for r in found) == expected


def test_sliding_counts_every_event_in_its_ranges(arrivals, tmp_path):
    frame, stream = arrivals
    found = jobs.sliding(stream(), str(tmp_path / "sliding"), "2 days", "1 day").collect()
    assert sum(r.n_events for r in found) == 2 * frame.count()


def carried(frame):
    """Rate and minutes since the last dose at every event, in plain loops."""
    rate, dose, expected = {}, {}, {}
    for r in sorted(frame.collect(), key=lambda r: (r.ts, r.seq_num)):
        if r.stream == "basal":
            rate[r.pump_serial] = r.value
        if r.stream == "bolus":
            dose[r.pump_serial] = r.ts
        since = (r.ts - dose[r.pump_serial]).total_seconds() / 60 if r.pump_serial in dose else 1440.0
        expected[r.seq_num] = (rate.get(r.pump_serial, 0.0), pytest.approx(min(since, 1440.0)))
    return expected


def states(found):
    return {r.seq_num: (r.basal_rate, r.time_since_last_bolus) for r in found.collect()}


@pytest.mark.parametrize("arrivals", [("shuffled", 1), ("by_device", 1000)], ids=lambda p: f"{p[0]}-{p[1]}", indirect=True)
def test_carry_state_is_by_time_not_by_arrival(arrivals, tmp_path):
    frame, stream = arrivals
    assert states(jobs.carry_state(stream(), str(tmp_path / "carry"), tile_seconds=86400)) == carried(frame)


def batches_of(spark, events, tmp_path, name, rows):
    frame, folder = events(rows), str(tmp_path / name)
    return frame, folder, lambda: jobs.read_files(spark, folder, frame.schema, files_per_batch=1)


@pytest.mark.parametrize("keep_ms", [None, 1])
def test_late_events_change_only_what_is_behind_them(spark, events, tmp_path, keep_ms):
    """With a lifetime of a millisecond every state has expired when the next batch comes."""
    rows = [(1, 60.0 * i, kind, i + 1.0) for i, kind in enumerate(["basal", "cgm", "cgm", "bolus", "cgm", "basal", "cgm"] * 8)] + [(2, 5.0, "cgm", 1.0)]
    frame, folder, stream = batches_of(spark, events, tmp_path, "late", rows)
    parts = [frame.filter("seq_num % 7 NOT IN (3, 5)"), frame.filter("seq_num % 7 = 5"), frame.filter("seq_num % 7 = 3")]
    table = jobs.CarriedState(spark, str(tmp_path / "table"), 6 * 3600, keep_ms, max_runs=2)
    for i, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(folder)
        table.run(stream())
        upto = parts[0]
        for more in parts[1 : i + 1]:
            upto = upto.unionByName(more)
        assert states(table.read()) == carried(upto)
    if keep_ms is None:
        # the last batch wrote its own events and those up to the next dose of their tile, not the whole history
        written = table.rows.read().filter("batch = 2").count()
        assert parts[2].count() < written < frame.count() // 2


def test_a_restart_reads_only_new_files(spark, events, tmp_path):
    rows = [(1 + i % 2, 30.0 * i, ["basal", "cgm", "bolus"][i % 3], i + 1.0) for i in range(60)]
    frame, folder, stream = batches_of(spark, events, tmp_path, "restart", rows)
    table = jobs.CarriedState(spark, str(tmp_path / "table"), 86400)
    frame.filter("seq_num < 40").coalesce(1).write.parquet(folder)
    table.run(stream())
    version = table.rows.manifest.latest()
    table.run(stream())
    assert table.rows.manifest.latest() == version
    frame.filter("seq_num >= 40").coalesce(1).write.mode("append").parquet(folder)
    table.run(stream())
    assert table.rows.manifest.latest() == version + 1
    assert states(table.read()) == carried(frame)


def test_guard_sends_bad_times_aside(spark, events, tmp_path):
    frame = events([(1, 0, "cgm", 1), (1, 60 * 24 * 60, "cgm", 2)])
    frame.write.parquet(str(tmp_path / "in"))
    data, dead = jobs.guarded(stream_of(spark, frame, str(tmp_path / "in")), str(tmp_path / "guard"), at(0))
    assert [r.value for r in data.collect()] == [1.0] and [r.value for r in dead.collect()] == [2.0]


def newest(rows):
    out = {}
    for key, order, batch, value in rows:
        if key not in out or (order, batch) >= out[key][:2]:
            out[key] = (order, batch, value)
    return {key: value for key, (_, _, value) in out.items()}


def test_merge_tree_keeps_the_newest_and_few_runs(spark, tmp_path):
    rnd = random.Random(2)
    schema = spark.createDataFrame([], "pump_serial long, ts timestamp, seq_num long, value double").schema
    table = MergeTree(spark, str(tmp_path / "tree"), schema, ["pump_serial", "ts"], ["seq_num"], buckets=2, files=2, max_runs=3)
    everything = []
    for batch in range(6):
        # even batches touch every month, odd ones the first only
        rows = [((rnd.randint(1, 4), at(1440.0 * 25 * rnd.randrange(4 if batch % 2 == 0 else 1))), rnd.randint(0, 9), batch, rnd.random()) for _ in range(20)]
        rows = [(k, o, b, v) for k, o, b, v in {(k, o): (k, o, b, v) for k, o, b, v in rows}.values()]
        everything += rows
        frame = spark.createDataFrame([(*k, o, v) for k, o, _, v in rows], schema)
        table.upsert(frame, batch)
        table.upsert(frame.limit(3), batch)  # a batch that comes again
        assert {(r.pump_serial, r.ts): r.value for r in table.read().collect()} == newest(everything)
        entries = table.manifest.read().groupBy("_month", "_bucket").count().collect()
        assert max(r["count"] for r in entries) <= 3
    assert all(len(table._open([tuple(r[c] for c in ("_run", "_month", "_bucket"))]).inputFiles()) <= 2 for r in table.manifest.read().collect())
    assert table.vacuum() > 0
    assert {(r.pump_serial, r.ts): r.value for r in table.read().collect()} == newest(everything)


def test_a_batch_touches_only_its_partitions(spark, tmp_path):
    schema = spark.createDataFrame([], "pump_serial long, ts timestamp, seq_num long, value double").schema
    table = MergeTree(spark, str(tmp_path / "tree"), schema, ["pump_serial", "ts"], ["seq_num"], buckets=1, max_runs=1)
    for batch, day in enumerate([0, 40, 40, 40]):
        table.upsert(spark.createDataFrame([(1, at(1440.0 * day), batch, float(batch))], schema), batch)
    runs = {r["_month"]: r["_run"] for r in table.manifest.read().collect()}
    assert runs["202403"] == "batch-000000000000" and runs["202404"] == "merge-000000000003"
    places = table.places(spark.createDataFrame([(1, at(0))], "pump_serial long, ts timestamp"))
    assert [r.value for r in table.read(places).collect()] == [0.0]


def test_a_batch_that_failed_before_its_manifest_changes_nothing(spark, tmp_path):
    schema = spark.createDataFrame([], "pump_serial long, ts timestamp, seq_num long, value double").schema
    table = MergeTree(spark, str(tmp_path / "tree"), schema, ["pump_serial", "ts"], ["seq_num"], buckets=1)
    table.upsert(spark.createDataFrame([(1, at(0), 1, 1.0)], schema), 0)
    publish, table.manifest.publish = table.manifest.publish, lambda *_: 1 / 0
    late = spark.createDataFrame([(1, at(0), 2, 2.0), (1, at(5), 2, 3.0)], schema)
    with pytest.raises(ZeroDivisionError):
        table.upsert(late, 1)
    assert [r.value for r in table.read().collect()] == [1.0]
    table.manifest.publish = publish
    table.upsert(late, 1)
    assert sorted(r.value for r in table.read().collect()) == [2.0, 3.0]


def test_a_later_batch_beats_an_earlier_merge_of_equal_order(spark, tmp_path):
    schema = spark.createDataFrame([], "pump_serial long, ts timestamp, seq_num long, value double").schema
    table = MergeTree(spark, str(tmp_path / "tree"), schema, ["pump_serial", "ts"], ["seq_num"], buckets=1, max_runs=2)
    for batch in range(5):
        table.upsert(spark.createDataFrame([(1, at(0), 1, float(batch))], schema), batch)
        assert [r.value for r in table.read().collect()] == [float(batch)]


def test_tile_processor_takes_and_gives_rows():
    """A tile gets a handful of rows a batch; as frames they cost far more than the work on them."""

    class Value:
        held = None

        def get(self):
            return self.held

        def update(self, value):
            self.held = value

    processor = state.tile_processor()
    processor.events = Value()
    event = Row("pump_serial", "_tile", "us", "seq_num", "stream", "value")
    first = list(processor.handleInputRows((1, 0), iter([event(1, 0, 50, 2, "basal", 1.5), event(1, 0, 60, 3, "basal", float("nan"))]), None))
    assert [(r.us, r.basal_rate, r.dose_us, r.fresh) for r in first] == [(50, 1.5, None, True), (60, 1.5, None, True), (None, 1.5, None, True)]
    late = list(processor.handleInputRows((1, 0), iter([event(1, 0, 55, 1, "bolus", 2.0)]), None))
    assert [(r.us, r.basal_rate, r.dose_us, r.fresh) for r in late] == [(55, 1.5, 55, False), (60, 1.5, 55, False), (None, 1.5, 55, False)]
