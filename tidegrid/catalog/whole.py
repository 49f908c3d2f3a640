"""Whole results of operators whose other queries compare a summary: window cells, split rows, members, all sequences."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidegrid.catalog.base import HOURLY, ORACLE, SIG_SQL, SIX_HOURLY, W_SQL, query, r
from tidegrid.catalog.events import HOUR_GRID, hour_grid
from tidegrid.catalog.flows import ALL_SIG, AHEAD, HOUR, LOOK, PADDED, Q10_SQL, SEQ_SQL, STRIDE, write_stream_files
from tidegrid.catalog.grids import DENSE_SQL, dense_grid
from tidegrid.catalog.summaries import BULK_SQL, JOBS_SQL, bulk, jobs
from tidegrid.config import WindowSpecParams
from tidegrid.operators import summary, windows
from tidegrid.plans import dataflows
from tidegrid.quality import checks, placeholder
from tidegrid.session import scratch_dir
from tidegrid.signals import signal_events

NOW = dt.datetime(2024, 1, 25)


def cells(frame, keys, features, target=None):
    """One row per window and step; target steps follow the window's own."""
    zipped = frame.select(*keys, F.posexplode(F.arrays_zip(*features)).alias("step", "c"))
    out = zipped.select(*keys, "step", *[F.col(f"c.{f}").alias(f) for f in features])
    if target is None:
        return out
    after = frame.select(*keys, F.size(features[0]).alias("_n"), F.posexplode(target).alias("step", target))
    return out.unionByName(after.select(*keys, (F.col("step") + F.col("_n")).alias("step"), target), allowMissingColumns=True)


@query(
    "w16_sliding_cells",
    f"""WITH {DENSE_SQL}, n AS (SELECT *, row_number() OVER {W_SQL} AS rn, count(*) OVER (PARTITION BY pump_serial) AS c FROM dn),
    k AS (SELECT a.pump_serial, a.ts, a.rn FROM n a JOIN n b ON b.pump_serial = a.pump_serial AND b.rn BETWEEN a.rn AND a.rn + {LOOK + AHEAD - 1}
      WHERE (a.rn - 1) % {STRIDE} = 0 AND a.rn + {LOOK + AHEAD - 1} <= a.c GROUP BY 1, 2, 3
      HAVING count(b.bg) FILTER (WHERE b.rn >= a.rn + {LOOK}) = {AHEAD} AND {LOOK} - count(b.bg) FILTER (WHERE b.rn < a.rn + {LOOK}) <= 0.1 * {2 * LOOK})
    SELECT k.pump_serial, k.ts AS window_start, (n.rn - k.rn)::INT AS step, CASE WHEN n.rn < k.rn + {LOOK} THEN round(n.bg, 6) END AS bg,
      CASE WHEN n.rn < k.rn + {LOOK} THEN round(n.bolus_dose, 6) END AS bolus_dose, CASE WHEN n.rn >= k.rn + {LOOK} THEN round(n.bg, 6) END AS target
    FROM k JOIN n ON n.pump_serial = k.pump_serial AND n.rn BETWEEN k.rn AND k.rn + {LOOK + AHEAD - 1}""",
)
def w16_cells(spark, sf):
    rows = dense_grid(spark, sf).withColumn("segment_id", F.lit(1))
    out = windows.sliding_windows(rows, SIX_HOURLY, ["bg", "bolus_dose"], params=WindowSpecParams(LOOK, AHEAD, STRIDE))
    return cells(out, ["pump_serial", "window_start"], ["bg", "bolus_dose"], "target")


@query(
    "w17_latest_cells",
    f"""WITH {HOUR_GRID}, x AS (SELECT *, row_number() OVER (PARTITION BY pump_serial ORDER BY ts DESC) AS rn, min(ts) OVER (PARTITION BY pump_serial) AS a, count(*) OVER (PARTITION BY pump_serial) AS c FROM grid)
    SELECT pump_serial, (288 - rn)::INT AS step, round(basal_rate, 6) AS basal_rate, round(bg, 6) AS bg FROM x WHERE rn <= 288 AND c >= 288""",
)
def w17_cells(spark, sf):
    return cells(windows.latest_window(hour_grid(spark, sf), HOURLY, ["basal_rate", "bg"]), ["pump_serial"], ["basal_rate", "bg"])


@query(
    "q08_training_cells",
    f"""WITH {DENSE_SQL}, x AS (SELECT *, row_number() OVER {W_SQL} AS rn, count(*) OVER (PARTITION BY pump_serial) AS n FROM dn),
    sp AS (SELECT *, CASE WHEN rn <= (n * 70) // 100 THEN 'train' WHEN rn <= (n * 85) // 100 THEN 'validate' ELSE 'test' END AS subset FROM x),
    q AS (SELECT quantile_cont(bg, 0.25) AS b1, quantile_cont(bg, 0.5) AS b2, quantile_cont(bg, 0.75) AS b3, quantile_cont(basal_rate, 0.25) AS a1, quantile_cont(basal_rate, 0.5) AS a2,
      quantile_cont(basal_rate, 0.75) AS a3 FROM sp WHERE subset = 'train'),
    o AS (SELECT *, row_number() OVER (PARTITION BY pump_serial, subset ORDER BY ts) AS k, count(*) OVER (PARTITION BY pump_serial, subset) AS c FROM sp),
    w AS (SELECT a.pump_serial, a.subset, a.ts, a.k FROM o a JOIN o b ON b.pump_serial = a.pump_serial AND b.subset = a.subset AND b.k BETWEEN a.k AND a.k + {LOOK + AHEAD - 1}
      WHERE (a.k - 1) % {STRIDE} = 0 AND a.k + {LOOK + AHEAD - 1} <= a.c GROUP BY 1, 2, 3, 4
      HAVING count(b.bg) FILTER (WHERE b.k >= a.k + {LOOK}) = {AHEAD}
        AND 2 * {LOOK} - count(b.bg) FILTER (WHERE b.k < a.k + {LOOK}) - count(b.basal_rate) FILTER (WHERE b.k < a.k + {LOOK}) <= 0.1 * {2 * LOOK})
    SELECT w.pump_serial, w.subset, w.ts AS window_start, (o.k - w.k)::INT AS step,
      CASE WHEN o.k < w.k + {LOOK} THEN {r('(coalesce(o.bg, 0) - b2) / CASE WHEN b3 = b1 THEN 1 ELSE b3 - b1 END', 'x')[:-5]} END AS bg,
      CASE WHEN o.k < w.k + {LOOK} THEN {r('(coalesce(o.basal_rate, 0) - a2) / CASE WHEN a3 = a1 THEN 1 ELSE a3 - a1 END', 'x')[:-5]} END AS basal_rate,
      CASE WHEN o.k >= w.k + {LOOK} THEN round(o.bg, 6) END AS target
    FROM w JOIN o ON o.pump_serial = w.pump_serial AND o.subset = w.subset AND o.k BETWEEN w.k AND w.k + {LOOK + AHEAD - 1}, q""",
)
def q08_cells(spark, sf):
    rows = dense_grid(spark, sf).withColumn("segment_id", F.lit(1))
    out = dataflows.training_windows(rows, SIX_HOURLY, ["bg", "basal_rate"], WindowSpecParams(LOOK, AHEAD, STRIDE))
    return cells(out, ["pump_serial", "subset", "window_start"], ["bg", "basal_rate"], "target")


@query(
    "q09_inference_cells",
    f"""WITH {HOUR_GRID}, n AS (SELECT *, row_number() OVER {W_SQL} AS rn, count(*) OVER (PARTITION BY pump_serial) AS c FROM grid),
    io AS (SELECT a.pump_serial, a.rn, sum(b.bolus_dose * exp(-0.0144 * (a.rn - b.rn + 1))) AS iob FROM n a JOIN n b ON a.pump_serial = b.pump_serial AND b.rn BETWEEN a.rn - 71 AND a.rn GROUP BY 1, 2),
    f AS (SELECT n.*, coalesce(last_value(bg IGNORE NULLS) OVER {W_SQL}, 0.0) AS fb, greatest(least(basal_rate, 25.0), 0.0) AS bc, coalesce(bg - lag(bg, 6) OVER {W_SQL}, 0.0) AS tr FROM n)
    SELECT f.pump_serial, (f.rn - f.c + 287)::INT AS step, {r('fb', 'bg')}, {r('bc', 'basal_rate_clipped')}, {r('tr', 'bg_trend_30min')}, {r('iob', 'insulin_on_board')}
    FROM f JOIN io ON io.pump_serial = f.pump_serial AND io.rn = f.rn WHERE f.rn > c - 288 AND c >= 288""",
)
def q09_cells(spark, sf):
    features = ["bg", "basal_rate_clipped", "bg_trend_30min", "insulin_on_board"]
    return cells(dataflows.inference_windows(hour_grid(spark, sf), HOURLY), ["pump_serial"], features)


def overlapping_chunks(spark, sf):
    """The events of a device in two chunks that overlap."""
    rows = signal_events(spark, sf).select("pump_serial", "ts", "seq_num", F.col("value").alias("bg"))
    return rows.unionByName(rows.filter(F.col("ts") >= F.lit("2024-01-15").cast("timestamp")))


@query(
    "q07_split_rows",
    f"""WITH {SIG_SQL}, x AS (SELECT *, row_number() OVER {W_SQL} AS rn, count(*) OVER (PARTITION BY pump_serial) AS n FROM sig)
    SELECT pump_serial, ts, seq_num, round(value, 6) AS bg, CASE WHEN rn <= (n * 70) // 100 THEN 'train' WHEN rn <= (n * 85) // 100 THEN 'validate' ELSE 'test' END AS subset FROM x""",
)
def q07_rows(spark, sf):
    out = dataflows.split_with_gaps(overlapping_chunks(spark, sf), 86400)[0]
    return out.select("pump_serial", "ts", "seq_num", "bg", "subset")


@query("q07_gap_report", ORACLE["w12_gap_summary"])
def q07_gaps(spark, sf):
    return dataflows.split_with_gaps(overlapping_chunks(spark, sf), 86400)[1]


@query(
    "q13_client_sequences",
    f"WITH {SEQ_SQL} SELECT pump_serial, segment_id, ts, {r('bg', 'bg')}, {r('basal_rate', 'basal_rate')}, {r('bolus_dose', 'bolus_dose')}, mask_bg, mask_label FROM sx",
)
def q13_all(spark, sf):
    rows = dataflows.client_sequences(signal_events(spark, sf), PADDED)
    return rows.select("pump_serial", "segment_id", "ts", "bg", "basal_rate", "bolus_dose", "mask_bg", "mask_label")


@query("q13_client_streams", ALL_SIG)
def q13_streams(spark, sf):
    """The three stream outputs, one below the other; every event arrives twice."""
    events = signal_events(spark, sf)
    parts = dataflows.client_streams(events.unionByName(events))
    return parts["cgm"].unionByName(parts["basal"]).unionByName(parts["bolus"])


@query("q04_accepted_from_files", ORACLE["q04_accepted_rows"])
def q04_files(spark, sf):
    """Monthly stream files to the sink, and the sink read back."""
    path = scratch_dir(spark, "file-sequences")
    dataflows.sequences_from_files(spark, write_stream_files(spark, sf, "months"), path, PADDED)
    return spark.read.parquet(f"{path}/rows").select(F.col("pump_serial").cast("bigint").alias("pump_serial"), "segment_id", "ts", "bg", "mask_bg")


@query("q04_report_from_files", ORACLE["q04_validated_sequences"])
def q04_report(spark, sf):
    return dataflows.sequences_from_files(spark, write_stream_files(spark, sf, "months"), scratch_dir(spark, "file-sequences"), PADDED)


SPLIT_CASE = "CASE WHEN rn <= (n * 70) // 100 THEN 'train' WHEN rn <= (n * 85) // 100 THEN 'validate' ELSE 'test' END"


@query(
    "a20_split_members",
    f"""WITH {SEQ_SQL}, t AS (SELECT pump_serial, segment_id, min(ts) AS segment_start, count(*) AS n_rows FROM sx GROUP BY 1, 2),
    x AS (SELECT *, row_number() OVER (PARTITION BY pump_serial ORDER BY segment_start) AS rn, count(*) OVER (PARTITION BY pump_serial) AS n FROM t), s AS (SELECT *, {SPLIT_CASE} AS subset FROM x)
    SELECT pump_serial, subset, (row_number() OVER (PARTITION BY pump_serial, subset ORDER BY segment_start))::INT AS position, segment_id, segment_start, n_rows FROM s""",
)
def a20_members(spark, sf):
    rows = dataflows.stage(dataflows.client_sequences(signal_events(spark, sf), PADDED), "client")
    table = rows.groupBy("pump_serial", "segment_id").agg(F.min("ts").alias("ts"), F.count(F.lit(1)).alias("n_rows"))
    split = windows.chronological_split(table, tile_seconds=86400 * 365, order=("ts", "segment_id"))
    return summary.split_members(split.withColumnRenamed("ts", "segment_start"))


@query(
    "a24_sync_overall",
    f"""WITH {JOBS_SQL}, p AS (SELECT pump_serial, count(*) AS n, sum(total_records)::BIGINT AS s, bool_and(final_status <> 'failed') AS ok FROM jobs GROUP BY 1)
    SELECT count(*) AS n_devices, sum(n)::BIGINT AS n_files, sum(s)::BIGINT AS n_records, count(*) FILTER (WHERE ok) AS n_successful, bool_and(ok) AS success FROM p""",
)
def a24_overall(spark, sf):
    files = jobs(spark, sf).select("pump_serial", F.col("total_records").alias("n_records"), (F.col("final_status") != "failed").alias("ok"))
    return summary.sync_overall(files)


V12_SQL = f"""WITH {BULK_SQL}, b AS (SELECT pump_serial, strftime(ts, '%Y%m') AS month, count(*) AS n_rows, count(bg) AS n_readings, avg((bg BETWEEN 50 AND 400)::INT) AS s,
  CAST((epoch_us(max(ts)) - epoch_us(min(ts))) // 86400000000 AS BIGINT) AS span_days, count(DISTINCT bg) AS n_distinct FROM bulk GROUP BY 1, 2)
SELECT pump_serial, month, n_rows, n_readings, {r('s', 'realistic_share')}, span_days, n_distinct, """


@query("v12_validity_by_month", V12_SQL + "n_rows >= 5 AND n_distinct > 1 AND s >= 0.8 AND span_days >= 10 AS is_valid FROM b")
def v12_months(spark, sf):
    return placeholder.monthly_validity(bulk(spark, sf).withColumn("month", F.date_format("ts", "yyyyMM")), min_rows=5, min_days=10)


@query("v12_required_columns", V12_SQL + "'basal_rate, bolus_dose' AS missing_columns, false AS is_valid FROM b")
def v12_columns(spark, sf):
    rows = bulk(spark, sf).withColumn("month", F.date_format("ts", "yyyyMM"))
    return placeholder.monthly_validity(rows, required=placeholder.REQUIRED_COLUMNS)


@query("v07_dataset_checks_uncut", f"WITH {Q10_SQL} SELECT pump_serial, check_name, status, severity, {r('value', 'value')} FROM ck")
def v07_uncut(spark, sf):
    """All checks over the organised grid as it is, with basal-only and empty rows."""
    return checks.dataset_checks(dataflows.stage(dataflows.organised_grid(signal_events(spark, sf), HOUR), "organised"), HOUR, "comprehensive", NOW)


@query(
    "v07_schema_checks",
    f"""WITH {SIG_SQL}, n AS (SELECT count(*)::DOUBLE AS n FROM sig), b AS (SELECT count(*) FILTER (WHERE stream = 'bolus')::DOUBLE AS b FROM sig)
    SELECT 'whole' AS data, 'schema' AS check_name, 'PASS' AS status, 'LOW' AS severity, n AS value FROM n
    UNION ALL SELECT 'no device', 'schema', 'FAIL', 'CRITICAL', 1 UNION ALL SELECT 'no signal', 'schema', 'FAIL', 'CRITICAL', 3
    UNION ALL SELECT 'no rows', 'dataset_empty', 'FAIL', 'CRITICAL', 0 UNION ALL SELECT 'bad times', 'schema', 'FAIL', 'HIGH', b FROM b""",
)
def v07_schema(spark, sf):
    rows = signal_events(spark, sf).withColumnRenamed("value", "bg")
    text = F.when(F.col("stream") == "bolus", "??").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    cases = {
        "whole": rows,
        "no device": rows.drop("pump_serial"),
        "no signal": rows.drop("bg"),
        "no rows": rows.filter("bg < -1"),
        "bad times": rows.withColumn("ts", text),
    }
    out = None
    for name, frame in cases.items():
        one = checks.schema_checks(frame).select(F.lit(name).alias("data"), "*")
        out = one if out is None else out.unionByName(one)
    return out
