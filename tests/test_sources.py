from __future__ import annotations

import base64
import datetime as dt
import json
import os
import struct

import pytest
from conftest import at, ordered
from pyspark.sql import functions as F

from tidegrid.operators import summary
from tidegrid.plans import dataflows
from tidegrid.sources import csv_files, history_log, published, store


def record(code, seconds, seq, payload, source=2):
    return struct.pack(">HII", (source << 12) | code, seconds, seq) + payload.ljust(16, b"\0")


def field_at(offset, packed):
    return b"\0" * (offset - 10) + packed


def decode(spark, blobs):
    frame = spark.createDataFrame([(7, base64.b64encode(b).decode()) for b in blobs], "pump_serial long, blob string")
    return history_log.fields(history_log.records(frame))


def test_golden_records(spark):
    t = 505000000
    blob = b"".join(
        [
            record(399, t, 1, field_at(10, struct.pack(">b", -12)) + b"\0\0\0" + struct.pack(">H", 120)),
            record(3, t + 1800, 2, field_at(10, struct.pack(">f", 0.85))),
            record(279, t, 3, field_at(16, struct.pack(">H", 800))),
            record(280, t + 900, 4, field_at(12, struct.pack(">H", 77)) + b"\0" * 8 + struct.pack(">H", 3500)),
            record(20, t, 5, field_at(18, struct.pack(">f", 2.25))),
            record(372, t, 6, field_at(10, struct.pack(">h", -300)) + b"\0\0" + struct.pack(">H", 65535)),
            record(9, t, 7, b"x"),
        ]
    )
    rows = decode(spark, [blob, blob[:30]]).collect()
    first = {(r.seq_num, r.field): r for r in rows}
    value = lambda seq, name: first[(seq, name)].value
    assert value(1, "currentglucosedisplayvalue") == 120 and value(1, "rate") == pytest.approx(-1.2)
    assert value(2, "commandedbasalrate") == pytest.approx(struct.unpack(">f", struct.pack(">f", 0.85))[0], abs=0)
    assert value(3, "commandedRate") == 800
    assert (value(4, "deliveredTotal"), value(4, "bolusid")) == (3500, 77)
    assert value(5, "insulindelivered") == 2.25
    assert value(6, "rate") == pytest.approx(-30.0) and value(6, "currentglucosedisplayvalue") == 65535
    assert first[(7, None)].value is None and first[(7, None)].source == 2
    assert first[(1, "rate")].ts == dt.datetime(2024, 1, 1, 21, 46, 40)
    assert sum(r.seq_num == 1 and r.field == "rate" for r in rows) == 2  # the cut blob holds one whole record


def test_signal_units(spark):
    blob = record(279, 0, 1, field_at(16, struct.pack(">H", 800))) + record(280, 0, 2, field_at(22, struct.pack(">H", 3500)))
    decoded = decode(spark, [blob])
    assert {r.stream: r.value for r in history_log.signal_view(decoded).collect()} == {"basal": 0.8, "bolus": 3.5}
    assert {r.stream: r.value for r in history_log.signal_view(decoded, 100.0).collect()}["basal"] == 8.0


@pytest.mark.parametrize("number", [0.0, -0.0, 1.5, -3.25e-5, 3.4e38, 1e-42, float("inf"), float("nan")])
def test_float32(spark, number):
    bits = struct.unpack(">I", struct.pack(">f", number))[0]
    out = spark.range(1).select(history_log.float32(F.lit(bits).cast("bigint")).alias("v")).collect()[0].v
    expected = struct.unpack(">f", struct.pack(">f", number))[0]
    assert out is None if expected != expected or expected in (float("inf"),) else out == expected


def test_csv_with_header_block(spark, tmp_path):
    text = "# pump_serial: 77\n# date_range_utc: 2024-01-01T00:00:00 - 2024-01-02T00:00:00\n# plain line\ntimestamp,bg,delta_bg,basal_rate,bolus_dose,sin_time,cos_time,bg_clip_flag,bg_missing_flag\n"
    text += "2024-03-01 00:00:00,120.5,,1.0,0.0,0.0,1.0,0,0\n2024-03-01 00:05:00,,,1.0,0.0,0.02,1.0,0,1\n"
    (tmp_path / "a.csv").write_text(text)
    rows = csv_files.read_merged(spark, str(tmp_path / "a.csv")).orderBy("timestamp").collect()
    assert [(r.timestamp, r.bg, r.bg_missing_flag) for r in rows] == [(at(0), 120.5, 0), (at(5), None, 1)]
    header = csv_files.read_headers(spark, str(tmp_path / "a.csv")).collect()[0].header
    assert header == {"pump_serial": "77", "date_range_utc": "2024-01-01T00:00:00 - 2024-01-02T00:00:00"}


def stream_folder(tmp_path):
    (tmp_path / "cgmreading_20240301_a.csv").write_text("pump_serial,created_at,sgv,seq_num\n1,2024-03-01 00:00:00,120,1\n1,bad,5,2\n1,2024-03-01 00:05:00,,3\n")
    (tmp_path / "basal_20240301_a.csv").write_text("pump_serial,created_at,value,seq_num\n1,2024-03-01 00:00:00,,4\n")
    (tmp_path / "bolus_20240301_a.csv").write_text("pump_serial,created_at,bolus,seq_num\n1,2024-03-01 00:00:00,2.5,5\n")
    (tmp_path / "bolus_20240401_a.csv").write_text("pump_serial,created_at,bolus,seq_num\n1,2024-04-01 00:00:00,3.5,6\n")
    return str(tmp_path)


def test_stream_files(spark, tmp_path):
    root = stream_folder(tmp_path)
    rows = sorted((r.seq_num, r.stream, r.value) for r in csv_files.read_streams(spark, root).collect())
    assert rows == [(1, "cgm", 120.0), (3, "cgm", None), (4, "basal", 0.0), (5, "bolus", 2.5), (6, "bolus", 3.5)]
    files = csv_files.discover(spark, root)
    assert sorted((r.stream, r.month) for r in csv_files.complete_months(files).collect()) == [
        ("basal", "202403"),
        ("bolus", "202403"),
        ("cgm", "202403"),
    ]
    assert len(csv_files.most_recent(files).collect()) == 3


def test_columns_by_header_name_and_device_by_path(spark, tmp_path):
    for serial in (7, 8):
        (tmp_path / f"pump_{serial}").mkdir()
    (tmp_path / "pump_7" / "cgmreading_20240301_a.csv").write_text("# made: x\nsgv,created_at\n120,2024-03-01 00:00:00+00:00\n,2024-03-01 02:05:00.250+02:00\n5,never\n")
    (tmp_path / "pump_8" / "cgmreading_20240301_a.csv").write_text('"created_at","sgv","note"\n2024-03-01T00:10:00Z,130,"a,b"\n')
    (tmp_path / "pump_7" / "basal_20240301_a.csv").write_text("created_at,value\n2024-03-01 00:00:00,\n")
    (tmp_path / "pump_7" / "bolus_20240301_a.csv").write_text("created_at,bolus\n2024-03-01,2.5\n")
    rows = csv_files.read_streams(spark, str(tmp_path)).orderBy("stream", "pump_serial", "seq_num").collect()
    assert [(r.pump_serial, r.stream, r.ts, r.value) for r in rows] == [
        (7, "basal", at(0), 0.0), (7, "bolus", at(0), 2.5), (7, "cgm", at(0), 120.0), (7, "cgm", at(5) + dt.timedelta(milliseconds=250), None), (8, "cgm", at(10), 130.0),
    ]
    raw = csv_files.read_stream(spark, f"{tmp_path}/*/cgmreading_*", "cgm")
    assert [tuple(r) for r in csv_files.reject_counts(raw).collect()] == [(7, "cgm", 1)]
    (tmp_path / "pump_8" / "basal_20240301_a.csv").write_text("time,value\n2024-03-01,1\n")
    with pytest.raises(ValueError, match="created_at"):
        csv_files.read_streams(spark, str(tmp_path))


@pytest.mark.parametrize("few", [0, 64])
def test_layouts_are_scanned_apart_and_joined_by_name(spark, tmp_path, monkeypatch, few):
    """Reordered, missing and repeated columns, header blocks and repeated header lines; directly and by Spark."""
    monkeypatch.setattr(csv_files, "FEW_FILES", few)
    texts = {
        "a.csv": "# made: x\n\ntimestamp,bg,basal_rate\n2024-01-01 00:00:00,100.5,1\n2024-01-01 00:05:00, ,bad\ntimestamp,bg,basal_rate\n",
        "b.csv": 'basal_rate , "timestamp" ,bg\n2,2024-01-02 00:00:00,90\n',
        "c.csv": "timestamp,bg,bg,extra\n2024-01-03 00:00:00,80,70,z\n\n2024-01-03 00:05:00,81\n",
        "d.csv": "# only a comment\n",
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    assert len(csv_files.layouts(spark, str(tmp_path))) == 3
    out = csv_files.read_merged(spark, str(tmp_path)).select(F.col("timestamp").cast("string"), "bg", "basal_rate").collect()
    assert sorted(map(tuple, out)) == [
        ("2024-01-01 00:00:00", 100.5, 1.0), ("2024-01-01 00:05:00", None, None), ("2024-01-02 00:00:00", 90.0, 2.0),
        ("2024-01-03 00:00:00", 80.0, None), ("2024-01-03 00:05:00", 81.0, None),
    ]
    (tmp_path / "e.csv").write_text("time,bg\n1,2\n")
    with pytest.raises(ValueError, match="required columns"):
        csv_files.read_merged(spark, str(tmp_path))


def test_newest_file_of_each_device_and_stream(spark, tmp_path):
    for k, (serial, name) in enumerate([(7, "cgmreading_20240301_a"), (7, "cgmreading_20240201_b"), (8, "cgmreading_20240301_a")]):
        (tmp_path / f"pump_{serial}").mkdir(exist_ok=True)
        file = tmp_path / f"pump_{serial}" / f"{name}.csv"
        file.write_text(f"created_at,sgv\n2024-03-01 00:0{k}:00,10{k}\n")
        os.utime(file, (1_700_000_000 + k, 1_700_000_000 + k))
    rows = dataflows.newest_files_grid(spark, str(tmp_path)).filter("bg IS NOT NULL").collect()
    assert {(r.pump_serial, r.bg) for r in rows} == {(7, 101.0), (8, 102.0)}


def test_multi_line_config(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"pumps": [{"serial": "1", "device_id": "a"}, {"serial": "2", "device_id": "b"}]}, indent=2))
    rows = csv_files.read_config(spark, str(tmp_path / "c.json")).orderBy("serial").collect()
    assert [tuple(r) for r in rows] == [("1", "a"), ("2", "b")]


def test_fingerprint_sees_changes(grid):
    rows = grid([100.0, 110.0, 120.0])
    assert [r.intact for r in store.verify(rows.orderBy(F.desc("ts")), rows).collect()] == [True]
    changed = rows.withColumn("bg", F.when(F.col("bg") == 110, 111.0).otherwise(F.col("bg")))
    assert [r.intact for r in store.verify(changed, rows).collect()] == [False]
    assert [r.intact for r in store.verify(rows.limit(2), rows).collect()] == [False]


def test_fingerprint_sees_a_changed_pair(grid):
    rows = grid([5.0, 5.0, 7.0]).withColumn("ts", F.lit("2024-01-01").cast("timestamp"))
    other = rows.withColumn("bg", F.when(F.col("bg") == 5, 9.0).otherwise(F.col("bg")))
    assert [r.intact for r in store.verify(other, rows).collect()] == [False]
    assert [r.intact for r in store.verify(rows, rows).collect()] == [True]


def test_sinks_write_a_file_per_folder_and_month(events, spark, tmp_path):
    rows = events([(d, 60.0 * 24 * k, "cgm", 1.0) for d in (1, 2) for k in range(60)]).repartition(8).withColumn("segment_id", F.col("seq_num") % 5)
    store.append_dataset(rows, str(tmp_path / "a"))
    store.write_sequences(rows, rows.groupBy("pump_serial", "segment_id").count(), str(tmp_path / "s"))
    files = lambda p: sorted(str(f.parent.relative_to(p)) for f in p.rglob("part-*"))
    assert len(files(tmp_path / "a")) <= 4  # two devices, two months
    assert files(tmp_path / "s" / "rows") == [f"pump_serial={d}/month=2024{m}" for d in (1, 2) for m in ("03", "04")]


def test_replace_partitions_is_idempotent(events, spark, tmp_path):
    rows = events([(1, 0, "cgm", 1), (2, 5, "cgm", 2)])
    path = str(tmp_path / "d")
    for _ in range(2):
        store.replace_partitions(rows, path, ["pump_serial"])
    store.replace_partitions(rows.filter("pump_serial = 2").withColumn("value", F.lit(9.0)), path, ["pump_serial"])
    assert ordered(spark.read.parquet(path), "pump_serial", "value") == [(1, 1.0), (2, 9.0)]


def test_union_keeps_missing_columns_null(grid):
    both = store.union_sources({"a": grid([1.0]), "b": grid([2.0]).drop("bolus_dose")})
    assert sorted((r.source, r.bolus_dose) for r in both.collect()) == [("a", 0.0), ("b", None)]


def test_gate_routes_rows_in_one_pass_and_readers_see_whole_versions(events, spark, tmp_path):
    rows = events([(d, 5 * i, "cgm", d) for d in (1, 2, 3) for i in range(4)])
    verdicts = spark.createDataFrame([(1, True), (2, False), (2, True)], "pump_serial long, is_valid boolean")
    table = published.publish_accepted(rows, verdicts, str(tmp_path / "gate"))
    found = {(r.pump_serial, r.place, r["count"]) for r in table.read().groupBy("pump_serial", "place").count().collect()}
    assert found == {(1, "accepted", 4), (2, "quarantine", 4), (3, "quarantine", 4)}
    publish, table.manifest.publish = table.manifest.publish, lambda *_: 1 / 0
    with pytest.raises(ZeroDivisionError):  # killed after its files and before the switch
        table.write(rows.limit(2).withColumn("place", F.lit("accepted")))
    assert table.read().count() == 12
    table.manifest.publish = publish
    table.write(rows.filter("pump_serial = 3").withColumn("place", F.lit("accepted")), "append")
    assert table.read().filter("place = 'accepted'").count() == 8


def test_published_partitions_are_replaced_or_appended(events, spark, tmp_path):
    rows = events([(d, 5 * i, "cgm", d) for d in (1, 2) for i in range(3)])
    table = published.Published(spark, str(tmp_path / "t"), rows.schema, ["pump_serial"])
    assert table.read().count() == 0
    table.write(rows)
    table.write(rows.filter("pump_serial = 2").withColumn("value", F.lit(9.0)), "touched")
    assert sorted((r.pump_serial, r.value) for r in table.read().collect()) == [(1, 1.0)] * 3 + [(2, 9.0)] * 3
    table.write(rows.filter("pump_serial = 1"), "append")
    assert table.read().count() == 9 and table.manifest.versions() == [0, 1, 2]


def test_sorted_files_do_not_overlap_and_zones_skip_files(events, spark, tmp_path):
    rows = events([(1 if i % 3 else 2 + i % 7, 5.0 * i, "cgm", i) for i in range(600)])
    table = published.SortedTable(spark, str(tmp_path / "sorted"), rows.schema)
    table.write(rows, files=12)
    zones = sorted(table.zones().collect(), key=lambda z: (z.low_key, z.low_ts))
    assert len(zones) > 6 and sum(z.n_rows for z in zones) == 600
    assert all((a.high_key, a.high_ts) < (b.low_key, b.low_ts) for a, b in zip(zones[:-1], zones[1:], strict=True))
    everything = rows.collect()
    for start, end, key in ((at(500), at(700), 1), (at(500), at(700), None), (None, at(100), 3), (at(2900), None, None), (at(0), at(1), 99)):
        wanted = {
            r.seq_num for r in everything if (start is None or r.ts >= start) and (end is None or r.ts <= end) and (key is None or r.pump_serial == key)
        }
        assert {r.seq_num for r in table.between(start, end, key).collect()} == wanted
        assert table.zones_between(start, end, key).count() < len(zones)
    assert table.zones_of_latest(20).count() < len(zones)
    latest = {r.seq_num for r in table.latest(20).collect()}
    for device in {r.pump_serial for r in everything}:
        own = sorted(r.seq_num for r in everything if r.pump_serial == device)
        assert set(own[-20:]) <= latest


def test_distinct_sketches_merge_within_their_bound(spark):
    rows = spark.range(60000).select(
        (F.col("id") % 3).alias("pump_serial"), (F.col("id") % 5).alias("month"),
        F.when(F.col("id") % 11 > 0, F.pmod(F.xxhash64("id"), F.when(F.col("id") % 3 == 0, 50).otherwise(20000)).cast("double")).alias("bg"),
    )
    found = summary.distinct_estimates(summary.distinct_sketches(rows, "bg", ["pump_serial", "month"]))
    exact = {r.pump_serial: (r.n, r.d) for r in rows.groupBy("pump_serial").agg(F.count("bg").alias("n"), F.count_distinct("bg").alias("d")).collect()}
    for r in found.collect():
        n, d = exact[r.pump_serial]
        assert r.n_values == n and abs(r.n_distinct - d) <= 0.05 * d
    profile = summary.value_profile(rows, "bg")
    assert {r.pump_serial: r.n_distinct for r in profile.collect()} == {k: d for k, (_, d) in exact.items()}
    assert "SortAggregate" not in profile._jdf.queryExecution().executedPlan().toString()


def many_devices(events, n=300):
    return events([(d, 60.0 * k, s, 1.0 + d) for d in range(n) for k, s in enumerate(("cgm", "basal", "bolus"))]).withColumn("segment_id", F.lit(1).cast("long"))


def parts(folder):
    return [str(f.relative_to(folder)) for f in folder.rglob("part-*")]


def test_sinks_of_many_devices_write_few_files(events, spark, tmp_path):
    """A folder per device was a file per device: 300 of each."""
    rows = many_devices(events)
    wanted = ordered(rows, "pump_serial", "ts", "value")
    store.store_batch(rows, str(tmp_path / "batch"), folders=False)
    store.write_sequences(rows, rows.groupBy("pump_serial", "segment_id").count(), str(tmp_path / "sequences"), folders=["month"])
    store.write_split(rows.withColumn("subset", F.lit("train")), rows.groupBy("pump_serial").count(), str(tmp_path / "split"), folders=["subset"])
    gate = published.publish_accepted(rows, rows.select("pump_serial", F.lit(True).alias("is_valid")), str(tmp_path / "gate"), folders=["place"])
    store.write_dataset(rows.withColumn("month", F.lit("202403")), str(tmp_path / "dataset"), "merged", folders=["month"])
    for folder, rows_again in (
        ("batch", store.load_batch(spark, str(tmp_path / "batch"))),
        ("sequences/rows", spark.read.parquet(str(tmp_path / "sequences" / "rows"))),
        ("split/rows", spark.read.parquet(str(tmp_path / "split" / "rows"))),
        ("gate", gate.read()),
        ("dataset/data", spark.read.option("header", True).schema(rows.select(*rows.columns).schema).csv(str(tmp_path / "dataset" / "data"))),
    ):
        assert len(parts(tmp_path / folder)) <= 8, folder
        if folder != "dataset/data":
            assert ordered(rows_again, "pump_serial", "ts", "value") == wanted, folder
        assert rows_again.count() == len(wanted)
    meta = spark.read.parquet(str(tmp_path / "dataset" / "metadata"))
    assert meta.count() == 300 and {r.record_count for r in meta.collect()} == {3}


def test_newest_file_of_each_device_where_files_hold_several(spark, tmp_path):
    """The newest file of all is not the newest of a device that it does not have."""
    texts = {"cgmreading_20240201_a": "7,2024-03-01 00:00:00,100\n8,2024-03-01 00:00:00,101\n", "cgmreading_20240301_b": "7,2024-03-01 00:05:00,102\n"}
    for k, (name, text) in enumerate(texts.items()):
        (tmp_path / f"{name}.csv").write_text(f"pump_serial,created_at,sgv\n{text}")
        os.utime(tmp_path / f"{name}.csv", (1_700_000_000 + k, 1_700_000_000 + k))
    rows = dataflows.newest_files_grid(spark, str(tmp_path)).filter("bg IS NOT NULL").collect()
    assert {(r.pump_serial, r.bg) for r in rows} == {(7, 102.0), (8, 101.0)}


def test_stream_files_of_many_devices_are_few(spark, tmp_path, monkeypatch):
    from tidegrid.catalog import flows

    source = spark.range(900).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(1_704_067_200 + F.col("id")).cast("timestamp_ntz").alias("ts"), (F.col("id") % 300).alias("user_id"),
        F.element_at(F.array(*map(F.lit, ("view", "click", "purchase"))), (F.floor(F.col("id") / 300) + 1).cast("int")).alias("event_type"), F.lit(40.0).alias("value"),
    )
    source.write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(flows, "scratch_dir", lambda _, label: str(tmp_path / label))
    root = flows.write_stream_files(spark, str(tmp_path), "streams")
    assert len(parts(tmp_path / "streams")) <= 12  # a file per device and stream were 900
    rows = csv_files.read_streams(spark, root)
    assert rows.select("pump_serial", "stream").distinct().count() == 900
    assert flows.s02(spark, str(tmp_path)).filter("record_count = 3 AND tz_handling = 'stored_in=UTC'").count() == 300
    assert len(parts(tmp_path / "headers")) <= 4
    assert flows.s01(spark, str(tmp_path)).select("pump_serial").distinct().count() == 300
    assert len(parts(tmp_path / "merged")) <= 8
