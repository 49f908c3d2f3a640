"""A8-A28, W14, W15, W24-W26, P35, L1-L4, U1-U4."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.catalog.base import DAILY, HOURLY, SIG_SQL, SIX_HOURLY, W_SQL, aligned_sql, floor_sql, query, r
from tidegrid.catalog.events import HOUR_GRID, ORDER_SQL, hour_grid, order_events
from tidegrid.catalog.grids import SIX_SQL, STEP_SQL, readings, six_grid
from tidegrid.operators import constant_runs, events as ev, gaps, grid, summary, windows
from tidegrid.session import scratch_dir
from tidegrid.signals import labelled_events, read_table, signal_events
from tidegrid.sources.published import SortedTable

CGM_SQL = f"{SIG_SQL}, cgm AS (SELECT pump_serial, ts, value AS bg FROM sig WHERE stream = 'cgm')"
# Bulk readings: one device per supplier, the quantity as value.
BULK_SQL = "bulk AS (SELECT l_suppkey AS pump_serial, l_shipdate AS ts, l_quantity * 8 AS bg FROM lineitem)"


def bulk(spark, sf):
    return read_table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("pump_serial"), F.col("l_shipdate").cast("timestamp").alias("ts"), (F.col("l_quantity") * 8).alias("bg")
    )


@query(
    "a08_device_summary",
    f"""WITH {SIX_SQL} SELECT pump_serial, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n_rows, CAST(round(CAST(avg(bg) AS DECIMAL(38, 9)), 2) AS DOUBLE) AS bg_mean,
    CAST(round(CAST(stddev_samp(bg) AS DECIMAL(38, 9)), 2) AS DOUBLE) AS bg_std, CAST(round(CAST(avg(basal_rate) AS DECIMAL(38, 9)), 2) AS DOUBLE) AS basal_mean, CAST(round(CAST(stddev_samp(basal_rate) AS DECIMAL(38, 9)), 2) AS DOUBLE) AS basal_std,
    CAST(round(CAST(sum(bolus_dose) AS DECIMAL(38, 9)), 2) AS DOUBLE) AS bolus_sum FROM grid GROUP BY 1""",
)
def a08(spark, sf):
    return summary.device_summary(six_grid(spark, sf))


@query(
    "a09_coverage",
    f"""WITH {HOUR_GRID} SELECT pump_serial, count(*) AS n_intervals, {r('avg((bg IS NOT NULL)::INT) * 100', 'bg_coverage_pct')},
    {r('avg((basal_rate > 0)::INT) * 100', 'basal_coverage_pct')}, count(*) FILTER (WHERE bolus_dose > 0) AS bolus_events,
    date_diff('second', min(ts), max(ts)) / 3600.0 AS span_hours FROM grid GROUP BY 1""",
)
def a09(spark, sf):
    return summary.coverage(hour_grid(spark, sf))


SEQ_SQL = "seq AS (SELECT pump_serial, CAST(ts AS DATE) AS day, count(*) AS n_rows, avg((bg IS NOT NULL)::INT) AS bg_coverage FROM grid GROUP BY 1, 2)"


@query(
    "a10_weighted_coverage",
    f"""WITH {HOUR_GRID}, {SEQ_SQL} SELECT pump_serial, count(*) AS n_sequences, sum(n_rows)::BIGINT AS total_rows,
    {r('sum(bg_coverage * n_rows) / sum(n_rows)', 'avg_bg_coverage')} FROM seq GROUP BY 1""",
)
def a10(spark, sf):
    rows = hour_grid(spark, sf)
    sequences = rows.groupBy("pump_serial", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(F.col("bg").isNotNull().cast("int")).alias("bg_coverage")
    )
    return summary.weighted_coverage(sequences)


def _describe_sql(source: str) -> str:
    return f"""SELECT pump_serial, count(bg) AS count, {r('avg(bg)', 'mean')}, {r('stddev_samp(bg)', 'std')}, {r('min(bg)', 'min')}, {r('max(bg)', 'max')},
    {r('quantile_cont(bg, 0.25)', 'q25')}, {r('quantile_cont(bg, 0.5)', 'q50')}, {r('quantile_cont(bg, 0.75)', 'q75')} FROM {source} GROUP BY 1"""


@query("a11_describe", f"WITH {CGM_SQL} {_describe_sql('cgm')}")
def a11(spark, sf):
    return summary.describe(readings(spark, sf), "bg")


@query("a11_describe_bulk", f"WITH {BULK_SQL} {_describe_sql('bulk')}")
def a11b(spark, sf):
    return summary.describe(bulk(spark, sf), "bg")


PROFILE_SQL = """c AS (SELECT pump_serial, bg, count(*) AS n FROM bulk GROUP BY 1, 2),
prof AS (SELECT pump_serial, sum(n)::BIGINT AS n_rows, count(bg) AS n_distinct, max(n) AS top_count FROM c GROUP BY 1),
top AS (SELECT c.pump_serial, min(bg) AS top_value FROM c JOIN prof ON prof.pump_serial = c.pump_serial AND c.n = prof.top_count GROUP BY 1)"""


@query(
    "a12_most_frequent_value",
    f"""WITH {BULK_SQL}, {PROFILE_SQL} SELECT p.pump_serial, top_value, top_count, {r('top_count / n_rows', 'top_share')} FROM prof p
    JOIN top ON top.pump_serial = p.pump_serial""",
)
def a12(spark, sf):
    return summary.value_profile(bulk(spark, sf), "bg").select("pump_serial", "top_value", "top_count", "top_share")


@query("a13_distinct_values", f"WITH {BULK_SQL} SELECT pump_serial, count(DISTINCT bg) AS n_distinct, count(*) AS n_rows FROM bulk GROUP BY 1")
def a13(spark, sf):
    return summary.value_profile(bulk(spark, sf), "bg").select("pump_serial", "n_distinct", "n_rows")


@query(
    "a13_distinct_sketches",
    f"""WITH {BULK_SQL}, b AS (SELECT pump_serial, bg FROM bulk WHERE bg IS NOT NULL)
    SELECT pump_serial, count(*) AS n_values, true AS within_five_percent FROM b GROUP BY 1""",
)
def a13_sketches(spark, sf):
    """Sketches per device and month, merged per device, beside the exact count."""
    rows = bulk(spark, sf)
    exact = summary.value_profile(rows, "bg").select("pump_serial", F.col("n_distinct").alias("exact"))
    sketches = summary.distinct_sketches(rows.withColumn("month", F.date_format("ts", "yyyyMM")), "bg", ["pump_serial", "month"])
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= 0.05 * F.col("exact")
    return summary.distinct_estimates(sketches).join(exact, "pump_serial").filter("exact > 0").select("pump_serial", "n_values", near.alias("within_five_percent"))


@query(
    "a14_band_shares",
    f"""WITH {BULK_SQL} SELECT pump_serial, {r('avg((bg BETWEEN 95 AND 105)::INT)', 'narrow_share')}, {r('avg((bg = 100)::INT)', 'exact_100_share')},
    {r('avg((bg BETWEEN 50 AND 400)::INT)', 'realistic_share')} FROM bulk GROUP BY 1""",
)
def a14(spark, sf):
    return summary.band_shares(bulk(spark, sf))


ANOMALY_SQL = """an AS (SELECT b.pump_serial, count(*) AS n_values, count(*) FILTER (WHERE s > 0 AND abs(bg - m) / s > 3) AS z_anomalies,
    count(*) FILTER (WHERE bg < q1 - 2.5 * (q3 - q1) OR bg > q3 + 2.5 * (q3 - q1)) AS iqr_anomalies
  FROM {src} b JOIN (SELECT pump_serial, avg(bg) AS m, stddev_pop(bg) AS s, quantile_cont(bg, 0.25) AS q1, quantile_cont(bg, 0.75) AS q3
    FROM {src} GROUP BY 1) st ON st.pump_serial = b.pump_serial WHERE bg IS NOT NULL GROUP BY 1)"""
ANOMALY_OUT = f"""SELECT pump_serial, n_values, z_anomalies, iqr_anomalies, greatest(z_anomalies, iqr_anomalies) AS anomalies,
  {r('greatest(z_anomalies, iqr_anomalies) / n_values * 100', 'anomaly_pct')} FROM an"""


@query("a15_anomaly_counts", f"WITH {CGM_SQL}, {ANOMALY_SQL.format(src='cgm')} {ANOMALY_OUT}")
def a15(spark, sf):
    return summary.anomaly_counts(readings(spark, sf))


@query("a15_anomaly_counts_bulk", f"WITH {BULK_SQL}, {ANOMALY_SQL.format(src='bulk')} {ANOMALY_OUT}")
def a15b(spark, sf):
    return summary.anomaly_counts(bulk(spark, sf))


def _corr_sql(fn: str) -> str:
    return f"""WITH {SIX_SQL}, x AS (SELECT pump_serial, bg, {fn}(bolus_dose, 6) OVER {W_SQL} AS d FROM grid)
    SELECT pump_serial, {r('CASE WHEN NOT isnan(corr(bg, d)) THEN corr(bg, d) END', 'correlation')} FROM x GROUP BY 1"""


@query("a16_dose_correlation", _corr_sql("lag"))
def a16(spark, sf):
    return summary.dose_correlation(six_grid(spark, sf), SIX_HOURLY)


@query("a16_dose_correlation_ahead", _corr_sql("lead"))
def a16b(spark, sf):
    return summary.dose_correlation(six_grid(spark, sf), SIX_HOURLY, -6)


@query(
    "a17_trend",
    f"""WITH {BULK_SQL}, d AS (SELECT pump_serial, date_diff('day', DATE '1992-01-01', CAST(ts AS DATE)) AS x, bg FROM bulk)
    SELECT pump_serial, {r('regr_slope(bg, x)', 'slope')}, count(*) AS n FROM d GROUP BY 1""",
)
def a17(spark, sf):
    rows = bulk(spark, sf).withColumn("x", F.datediff("ts", F.lit("1992-01-01").cast("date")))
    return summary.trend(rows, "bg", "x")


@query(
    "a18_basic_statistics",
    f"""WITH {CGM_SQL}, s AS (SELECT pump_serial, avg(bg) AS m, stddev_samp(bg) AS d FROM cgm GROUP BY 1)
    SELECT pump_serial, {r('m', 'mean')}, {r('d', 'std')}, {r('d / m * 100', 'cv')}, CASE WHEN m < 80 OR m > 200 THEN 'WARN' ELSE 'PASS' END AS mean_status,
    CASE WHEN d / m * 100 > 50 OR d / m * 100 < 5 THEN 'WARN' ELSE 'PASS' END AS cv_status FROM s""",
)
def a18(spark, sf):
    return summary.basic_statistics(readings(spark, sf))


SCORE_SQL = "sc AS (SELECT pump_serial, avg((bg IS NOT NULL)::INT) * 100 AS completeness, avg((basal_rate > 0)::INT) * 100 AS score FROM grid GROUP BY 1)"


def scores(spark, sf):
    return hour_grid(spark, sf).groupBy("pump_serial").agg(
        (summary.share(F.col("bg").isNotNull()) * 100).alias("completeness"), (summary.share(F.col("basal_rate") > 0) * 100).alias("score")
    )


def _spread_sql(col: str, name: str) -> str:
    parts = [("avg", "mean"), ("stddev_pop", "std"), ("min", "min"), ("max", "max"), ("median", "median")]
    return ", ".join(r(f"{f}({col})", f"{name}_{n}") for f, n in parts)


@query(
    "a19_cross_device_stats",
    f"WITH {HOUR_GRID}, {SCORE_SQL} SELECT count(*) AS n_devices, {_spread_sql('score', 'score')}, {_spread_sql('completeness', 'completeness')} FROM sc",
)
def a19(spark, sf):
    return summary.cross_device_stats(scores(spark, sf))


@query(
    "a20_split_summary",
    f"""WITH {SIX_SQL}, x AS (SELECT *, row_number() OVER {W_SQL} AS rn, count(*) OVER (PARTITION BY pump_serial) AS n FROM grid),
    s AS (SELECT *, CASE WHEN rn <= (n * 70) // 100 THEN 'train' WHEN rn <= (n * 85) // 100 THEN 'validate' ELSE 'test' END AS subset FROM x)
    SELECT pump_serial, subset, count(*) AS n_rows, min(ts) AS start_ts, max(ts) AS end_ts, {r('avg((bg IS NOT NULL)::INT)', 'bg_coverage')},
    {r('count(*) / any_value(n) * 100', 'pct')} FROM s GROUP BY 1, 2""",
)
def a20(spark, sf):
    return summary.split_summary(windows.chronological_split(six_grid(spark, sf), tile_seconds=SIX_HOURLY.tile_seconds))


# Jobs: one per order.
JOBS_SQL = """jobs AS (SELECT o_orderkey AS job_id, o_custkey AS pump_serial, o_orderpriority AS job_type, o_orderdate AS start_time,
    o_totalprice / 100 AS total_duration_seconds, CAST(floor(o_totalprice) AS BIGINT) AS total_records, o_totalprice / 1000 AS data_size_mb,
    floor(o_totalprice) / (o_totalprice / 100) AS throughput_records_per_second, o_totalprice / 5000 AS data_completeness_pct,
    o_totalprice / 6000 AS validation_score, o_orderkey % 3 AS critical_issues, o_custkey % 4 AS warnings,
    CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'failed' ELSE 'pending' END AS final_status FROM orders)"""


def jobs(spark, sf):
    price = F.col("o_totalprice")
    return read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("job_id"),
        F.col("o_custkey").alias("pump_serial"),
        F.col("o_orderpriority").alias("job_type"),
        F.col("o_orderdate").cast("timestamp").alias("start_time"),
        (price / 100).alias("total_duration_seconds"),
        F.floor(price).alias("total_records"),
        (price / 1000).alias("data_size_mb"),
        (F.floor(price) / (price / 100)).alias("throughput_records_per_second"),
        (price / 5000).alias("data_completeness_pct"),
        (price / 6000).alias("validation_score"),
        (F.col("o_orderkey") % 3).alias("critical_issues"),
        (F.col("o_custkey") % 4).alias("warnings"),
        F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "failed").otherwise("pending").alias("final_status"),
    )


@query(
    "a21_job_performance",
    f"""WITH {JOBS_SQL} SELECT count(*) AS n_jobs, {_spread_sql('total_duration_seconds', 'duration')}, {r('avg(throughput_records_per_second)', 'throughput_mean')},
    {r('stddev_pop(throughput_records_per_second)', 'throughput_std')}, {r('median(throughput_records_per_second)', 'throughput_median')} FROM jobs""",
)
def a21(spark, sf):
    return summary.job_performance(jobs(spark, sf))


@query(
    "a21_job_types",
    f"""WITH {JOBS_SQL} SELECT job_type, count(*) AS job_count, {r('avg(total_duration_seconds)', 'mean_duration')},
    {r('sum(total_duration_seconds)', 'total_duration')} FROM jobs GROUP BY 1""",
)
def a21b(spark, sf):
    return summary.job_types(jobs(spark, sf))


@query(
    "a21_job_quality",
    f"""WITH {JOBS_SQL} SELECT {_spread_sql('validation_score', 'score')}, {r('avg(data_completeness_pct)', 'completeness_mean')},
    {r('min(data_completeness_pct)', 'completeness_min')}, {r('max(data_completeness_pct)', 'completeness_max')}, {r('median(data_completeness_pct)', 'completeness_median')},
    sum(critical_issues)::BIGINT AS total_critical_issues, sum(warnings)::BIGINT AS total_warnings, count(*) FILTER (WHERE critical_issues > 0) AS jobs_with_critical_issues,
    count(*) FILTER (WHERE warnings > 0) AS jobs_with_warnings, count(*) FILTER (WHERE critical_issues = 0 AND warnings = 0) AS clean_jobs
    FROM jobs WHERE final_status = 'completed'""",
)
def a21c(spark, sf):
    return summary.job_quality(jobs(spark, sf))


@query(
    "a21_session_status",
    f"""WITH {JOBS_SQL} SELECT count(*) AS total_jobs, count(*) FILTER (WHERE final_status = 'completed') AS completed_jobs,
    count(*) FILTER (WHERE final_status = 'failed') AS failed_jobs, sum(total_records)::BIGINT AS total_records, {r('sum(data_size_mb) / 1024', 'total_data_gb')},
    min(start_time) AS earliest_ts, max(start_time) AS latest_ts, count(DISTINCT pump_serial) AS total_devices, 'partial_success' AS session_status FROM jobs""",
)
def a21d(spark, sf):
    return summary.session_status(jobs(spark, sf))


BATCH_OUT = f"""count(*) AS total_jobs, count(*) FILTER (WHERE final_status = 'completed') AS completed_jobs, count(*) FILTER (WHERE final_status = 'failed') AS failed_jobs,
    count(*) FILTER (WHERE final_status = 'pending') AS pending_jobs, coalesce(sum(total_records) FILTER (WHERE final_status = 'completed'), 0)::BIGINT AS total_records,
    {r("coalesce(sum(data_size_mb) FILTER (WHERE final_status = 'completed'), 0)", 'total_mb')}"""


@query("a22_batch_summary", f"WITH {JOBS_SQL} SELECT pump_serial, {BATCH_OUT} FROM jobs GROUP BY 1")
def a22(spark, sf):
    return summary.batch_summary(jobs(spark, sf))


@query(
    "a23_sync_status",
    f"""WITH {JOBS_SQL}, y AS (SELECT pump_serial, max(start_time) FILTER (WHERE final_status = 'completed') AS last_successful_sync,
      sum(total_records)::BIGINT AS total_records, count(*) FILTER (WHERE final_status = 'failed') AS n_failed_ranges,
      count(*) FILTER (WHERE final_status = 'completed') AS n_files FROM jobs GROUP BY 1) SELECT * FROM y""",
)
def a23(spark, sf):
    rows = jobs(spark, sf)
    sync = rows.groupBy("pump_serial").agg(
        F.max(F.when(F.col("final_status") == "completed", F.col("start_time"))).alias("last_successful_sync"),
        F.sum("total_records").alias("total_records"),
    )
    status = F.col("final_status")
    return summary.sync_status(sync, rows.filter(status == "completed"), rows.filter(status == "failed"))


@query(
    "a24_sync_rollup",
    f"WITH {JOBS_SQL} SELECT pump_serial, count(*) AS n_files, sum(total_records)::BIGINT AS n_records, bool_and(final_status <> 'failed') AS success FROM jobs GROUP BY 1",
)
def a24(spark, sf):
    files = jobs(spark, sf).select("pump_serial", F.col("total_records").alias("n_records"), (F.col("final_status") != "failed").alias("ok"))
    return summary.sync_rollup(files)


@query(
    "a25_completeness",
    f"""WITH {SIG_SQL}, {STEP_SQL} SELECT pump_serial, count(*) AS actual_rows, CAST((epoch_us(max(ts)) - epoch_us(min(ts))) // 300000000 AS BIGINT) AS expected_rows,
    count(*) FILTER (WHERE s > 3600) AS large_gaps, {r('coalesce(max(s), 0)', 'max_gap_seconds')},
    {r('coalesce(count(*) / nullif((epoch_us(max(ts)) - epoch_us(min(ts))) // 300000000, 0), 0)', 'completeness_ratio')} FROM st GROUP BY 1""",
)
def a25(spark, sf):
    return summary.completeness(gaps.observed_times(signal_events(spark, sf)))


@query(
    "a26_range_report",
    f"""WITH {HOUR_GRID}, u AS (SELECT pump_serial, 'glucose' AS signal, bg AS v, 40.0::DOUBLE AS lo, 600.0::DOUBLE AS hi FROM grid
      UNION ALL SELECT pump_serial, 'basal', basal_rate, 0, 10 FROM grid UNION ALL SELECT pump_serial, 'bolus', bolus_dose, 0, 50 FROM grid)
    SELECT pump_serial, signal, count(*) AS n_values, count(*) FILTER (WHERE v < lo OR v > hi) AS n_violations, any_value(lo) AS expected_min, any_value(hi) AS expected_max,
    {r('min(v)', 'actual_min')}, {r('max(v)', 'actual_max')}, {r('count(*) FILTER (WHERE v < lo OR v > hi) / count(*) * 100', 'violation_pct')}
    FROM u WHERE v IS NOT NULL GROUP BY 1, 2""",
)
def a26(spark, sf):
    return summary.range_report(hour_grid(spark, sf))


# Forecasts: the price as forecast and the quantity as truth, step = line number, model = return flag.
PRED_SQL = """pred AS (SELECT l_suppkey AS pump_serial, l_partkey AS window_id, l_linenumber AS step, l_extendedprice / 100 AS y_pred,
  l_quantity * 10 AS y_true, l_returnflag AS model_id FROM lineitem)"""


def predictions(spark, sf):
    return read_table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("pump_serial"),
        F.col("l_partkey").alias("window_id"),
        F.col("l_linenumber").alias("step"),
        (F.col("l_extendedprice") / 100).alias("y_pred"),
        (F.col("l_quantity") * 10).alias("y_true"),
        F.col("l_returnflag").alias("model_id"),
    )


@query(
    "a27_forecast_error",
    f"""WITH {PRED_SQL} SELECT model_id, {r('avg(abs(y_pred - y_true))', 'mae')}, {r('sqrt(avg((y_pred - y_true) * (y_pred - y_true)))', 'rmse')},
    {r('avg(abs(y_pred - y_true)) FILTER (WHERE step <= 6)', 'mae_short')}, {r('avg(abs(y_pred - y_true)) FILTER (WHERE step <= 12)', 'mae_long')} FROM pred GROUP BY 1""",
)
def a27(spark, sf):
    return summary.forecast_error(predictions(spark, sf))


@query(
    "a28_ensemble",
    f"""WITH {PRED_SQL}, c AS (SELECT *, greatest(least(y_pred, 600.0), 20.0) AS y FROM pred)
    SELECT pump_serial, window_id, step, {r('avg(y)', 'y_mean')}, {r('stddev_samp(y)', 'y_std')}, count(*) AS n_models FROM c GROUP BY 1, 2, 3""",
)
def a28(spark, sf):
    return summary.ensemble(predictions(spark, sf))


@query(
    "w24_best_and_worst",
    f"""WITH {HOUR_GRID}, {SCORE_SQL}, s AS (SELECT pump_serial, round(score, 6) AS score FROM sc)
    SELECT (SELECT pump_serial FROM s ORDER BY score DESC, pump_serial LIMIT 1) AS best_device, max(score) AS best_score,
      (SELECT pump_serial FROM s ORDER BY score, pump_serial DESC LIMIT 1) AS worst_device, min(score) AS worst_score FROM s""",
)
def w24(spark, sf):
    return summary.ranking(scores(spark, sf).withColumn("score", F.round("score", 6)))


@query(
    "w25_basal_patterns",
    f"""WITH {HOUR_GRID}, x AS (SELECT pump_serial, basal_rate AS v, abs(basal_rate - lag(basal_rate) OVER {W_SQL}) AS j FROM grid)
    SELECT pump_serial, count(*) FILTER (WHERE v > 5) AS high_values, count(*) FILTER (WHERE v IN (21, 10)) AS suspicious_values, count(*) FILTER (WHERE v = 0) AS zero_values,
    count(*) FILTER (WHERE j > 2) AS large_changes, {r('max(j)', 'max_change')} FROM x GROUP BY 1""",
)
def w25(spark, sf):
    return summary.basal_patterns(hour_grid(spark, sf), HOURLY.tile_seconds)


@query(
    "w26_glucose_patterns",
    f"""WITH {SIX_SQL}, x AS (SELECT pump_serial, bg AS v, abs(bg - lag(bg) OVER {W_SQL}) AS j FROM grid)
    SELECT pump_serial, count(*) FILTER (WHERE v < 70) AS low_values, count(*) FILTER (WHERE v > 300) AS high_values, count(*) FILTER (WHERE v > 400) AS very_high_values,
    count(*) FILTER (WHERE j > 50) AS rapid_changes, {r('coalesce(max(CASE WHEN j > 50 THEN j END), 0)', 'max_rate_of_change')} FROM x GROUP BY 1""",
)
def w26(spark, sf):
    return summary.glucose_patterns(six_grid(spark, sf), SIX_HOURLY.tile_seconds)


@query(
    "p35_job_rates",
    f"""WITH {JOBS_SQL} SELECT job_id, {r('total_records / total_duration_seconds', 'records_per_second')}, {r('data_size_mb / total_duration_seconds', 'mb_per_second')} FROM jobs""",
)
def p35(spark, sf):
    return ev.job_rates(jobs(spark, sf)).select("job_id", "records_per_second", "mb_per_second")


# Plateaus: readings between 60 and 300 become the placeholder, so that daily bins hold runs of it.
PLATEAU = "CASE WHEN bg BETWEEN 60 AND 300 THEN 100.0 ELSE bg END"
PLATEAU_SQL = f"""{aligned_sql(DAILY)}, pl AS (SELECT pump_serial, ts, {PLATEAU} AS bg, basal_rate, bolus_dose FROM grid),
i1 AS (SELECT *, row_number() OVER {W_SQL} AS rn, (bg IS NOT NULL AND bg = 100) AS is100 FROM pl),
i2 AS (SELECT *, rn - row_number() OVER (PARTITION BY pump_serial, is100 ORDER BY ts) AS grp,
  basal_rate - lag(basal_rate) OVER {W_SQL} AS db FROM i1),
rr AS (SELECT pump_serial, grp, min(rn) AS a, max(rn) AS z, min(ts) AS run_start, max(ts) AS run_end, count(*) AS run_len FROM i2 WHERE is100 GROUP BY 1, 2 HAVING count(*) >= 2),
e AS (SELECT rr.pump_serial, rr.grp,
    coalesce(bool_or(i.rn BETWEEN a - 6 AND z + 6 AND (i.bolus_dose > 0 OR (i.rn >= a - 5 AND abs(i.db) > 0.05))), false) AS has_insulin_activity,
    arg_min(i.bg, i.rn) FILTER (WHERE i.rn BETWEEN a - 6 AND a - 1 AND i.bg IS NOT NULL AND i.bg <> 100) AS b0,
    arg_min(i.bg, i.rn) FILTER (WHERE i.rn BETWEEN z + 1 AND z + 6 AND i.bg IS NOT NULL AND i.bg <> 100) AS b1
  FROM rr JOIN i2 i ON i.pump_serial = rr.pump_serial AND i.rn BETWEEN a - 6 AND z + 6 GROUP BY 1, 2),
v0 AS (SELECT rr.*, has_insulin_activity, coalesce(abs(b1 - b0) / (run_len + 2), 0.0) AS g FROM rr JOIN e ON e.pump_serial = rr.pump_serial AND e.grp = rr.grp),
v1 AS (SELECT *, (run_len >= 6 OR (run_len >= 4 AND NOT has_insulin_activity) OR g > 3) AS is_synthetic,
  round(least(1.0, (CASE WHEN run_len >= 6 THEN least(0.4, run_len / 20.0) ELSE 0 END)::DOUBLE + 0.3::DOUBLE
    + (CASE WHEN NOT has_insulin_activity AND run_len >= 4 THEN 0.2 ELSE 0 END)::DOUBLE + (CASE WHEN g > 3 THEN least(1.0, g / 6.0) * 0.1 ELSE 0 END)::DOUBLE), 9) AS confidence FROM v0),
v2 AS (SELECT *, is_synthetic AND confidence >= 0.6 AS replaced FROM v1)"""


def plateau_grid(spark, sf):
    rows = grid.align(signal_events(spark, sf), DAILY)
    return rows.withColumn("bg", F.when(F.col("bg").between(60, 300), F.lit(100.0)).otherwise(F.col("bg")))


@query(
    "w14_placeholder_runs",
    f"""WITH {PLATEAU_SQL} SELECT pump_serial, run_start, run_end, run_len, has_insulin_activity, {r('g', 'transition_gradient')}, is_synthetic,
    {r('confidence', 'confidence')}, replaced FROM v2""",
)
def w14(spark, sf):
    return constant_runs.placeholder_runs(plateau_grid(spark, sf), DAILY)


@query(
    "w15_repair_placeholders",
    f"""WITH {PLATEAU_SQL} SELECT i.pump_serial, i.ts, CASE WHEN replaced THEN NULL ELSE round(i.bg, 6) END AS bg, coalesce(replaced, false)::INT AS bg_flagged_fake_100,
    CASE WHEN replaced THEN run_len ELSE 0 END AS bg_100_run_len, coalesce(replaced, false)::INT AS bg_replaced_from_fake,
    coalesce(NOT replaced AND run_len = 2, false)::INT AS bg_100_real
    FROM i2 i LEFT JOIN v2 ON v2.pump_serial = i.pump_serial AND i.is100 AND v2.grp = i.grp""",
)
def w15(spark, sf):
    return constant_runs.repair_placeholders(plateau_grid(spark, sf), DAILY).drop("basal_rate", "bolus_dose")


@query(
    "w15_repair_stats",
    f"""WITH {PLATEAU_SQL}, q AS (SELECT i.pump_serial, i.is100, replaced, run_len FROM i2 i LEFT JOIN v2 ON v2.pump_serial = i.pump_serial AND i.is100 AND v2.grp = i.grp)
    SELECT pump_serial, count(*) FILTER (WHERE is100) AS n_placeholder, count(*) AS n_rows, count(*) FILTER (WHERE replaced) AS n_replaced,
    count(*) FILTER (WHERE NOT replaced AND run_len = 2) AS n_real FROM q GROUP BY 1""",
)
def w15b(spark, sf):
    rows = plateau_grid(spark, sf)
    return constant_runs.repair_stats(constant_runs.repair_placeholders(rows, DAILY), rows)


@query("l01_sorted_events", f"WITH {SIG_SQL} SELECT pump_serial, ts, stream, round(value, 6) AS value FROM sig")
def l01(spark, sf):
    return signal_events(spark, sf).select("pump_serial", "ts", "stream", "value").orderBy("pump_serial", "ts")


@query("l01_sorted_files", f"WITH {SIG_SQL} SELECT pump_serial, ts, stream, round(value, 6) AS value FROM sig")
def l01_files(spark, sf):
    """L1 on write: the rows of a sink whose files follow each other in device and time."""
    rows = signal_events(spark, sf).select("pump_serial", "ts", "stream", "value")
    table = SortedTable(spark, scratch_dir(spark, "sorted"), rows.schema)
    table.write(rows)
    return table.read()


@query("l02_first_issues", f"WITH {SIG_SQL} SELECT seq_num, pump_serial FROM sig WHERE stream = 'cgm' AND value < 20 ORDER BY seq_num LIMIT 20")
def l02(spark, sf):
    low = signal_events(spark, sf).filter((F.col("stream") == "cgm") & (F.col("value") < 20))
    return low.select("seq_num", "pump_serial").orderBy("seq_num").limit(20)


@query(
    "l03_newest_per_stream",
    f"WITH {SIG_SQL} SELECT stream, max(ts) AS ts, arg_max(seq_num, ts) AS seq_num FROM sig GROUP BY 1",
)
def l03(spark, sf):
    return signal_events(spark, sf).groupBy("stream").agg(F.max("ts").alias("ts"), F.max_by("seq_num", "ts").alias("seq_num"))


@query("l04_devices_newest_first", f"WITH {SIG_SQL} SELECT pump_serial, max(ts) AS last_event FROM sig GROUP BY 1")
def l04(spark, sf):
    last = signal_events(spark, sf).groupBy("pump_serial").agg(F.max("ts").alias("last_event"))
    return last.orderBy(F.col("last_event").desc_nulls_last(), "pump_serial")


UNION_SQL = f"""{SIG_SQL}, {ORDER_SQL}"""


@query(
    "u01_union_with_source",
    f"""WITH {UNION_SQL} SELECT 'events' AS source, pump_serial, seq_num, ts, round(value, 6) AS value FROM sig
    UNION ALL SELECT 'orders', pump_serial, seq_num, ts, round(value, 6) FROM ord""",
)
def u01(spark, sf):
    from tidegrid.sources.store import union_sources

    both = union_sources({"events": signal_events(spark, sf), "orders": order_events(spark, sf).drop("stream")})
    return both.select("source", "pump_serial", "seq_num", "ts", "value")


@query(
    "u02_merge_overlapping_batches",
    f"""WITH {SIG_SQL} SELECT pump_serial, ts, stream, max(seq_num) AS seq_num, round(arg_max(value, seq_num), 6) AS value FROM sig GROUP BY 1, 2, 3""",
)
def u02(spark, sf):
    from tidegrid.plans.merge import merge_batches

    events = signal_events(spark, sf)
    early = events.filter(F.col("ts") <= F.lit("2024-01-20").cast("timestamp"))
    late = events.filter(F.col("ts") >= F.lit("2024-01-10").cast("timestamp"))
    return merge_batches([early, late])


@query("u03_concat_split_halves", f"WITH {SIG_SQL} SELECT pump_serial, ts, stream, seq_num, round(value, 6) AS value FROM sig")
def u03(spark, sf):
    from tidegrid.plans.merge import concat_halves

    events = signal_events(spark, sf)
    border = F.lit("2024-01-15").cast("timestamp")
    next_day = F.lit("2024-01-16").cast("timestamp")
    return concat_halves(events.filter(F.col("ts") < next_day), events.filter(F.col("ts") >= border))


@query("u04_new_files", "SELECT DISTINCT o_custkey AS pump_serial FROM orders EXCEPT SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'")
def u04(spark, sf):
    from tidegrid.operators.joins import not_yet_done

    orders = read_table(spark, sf, "orders").withColumnRenamed("o_custkey", "pump_serial")
    before = orders.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return not_yet_done(orders.select("pump_serial").distinct(), before, ["pump_serial"])
