"""Event rules over ``events`` and ``orders``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidegrid import tiles
from tidegrid.catalog.base import HOURLY, LABELLED_SQL, SIG_SQL, W_SQL, aligned_sql, floor_sql, query, r, sin_cos_sql
from tidegrid.functions import timegrid as tg
from tidegrid.operators import events as ev
from tidegrid.operators import features, grid
from tidegrid.session import scratch_dir
from tidegrid.signals import labelled_events, read_table, signal_events
from tidegrid.sources.published import SortedTable

NOW = dt.datetime(2024, 1, 20)
NOW_SQL = "TIMESTAMP '2024-01-20 00:00:00'"

# Orders as a second series: the device is the nation of the customer, so one time occurs more than once.
ORDER_SQL = """ord AS (SELECT c_nationkey AS pump_serial, o_orderdate AS ts, o_orderkey AS seq_num, 'cgm' AS stream,
    o_totalprice / 1000.0 AS value FROM orders JOIN customer ON o_custkey = c_custkey)"""


def order_events(spark, sf):
    orders, customer = read_table(spark, sf, "orders"), read_table(spark, sf, "customer")
    dimension = customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return orders.join(dimension, "o_custkey").select(
        F.col("c_nationkey").alias("pump_serial"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("o_orderkey").alias("seq_num"),
        F.lit("cgm").alias("stream"),
        (F.col("o_totalprice") / 1000.0).alias("value"),
    )


@query(
    "p01_categorise_events",
    f"WITH {LABELLED_SQL} SELECT stream, count(*) AS n_events FROM lab GROUP BY 1",
)
def p01(spark, sf):
    names = {"view": "CgmReading", "signup": "GxReading", "click": "BasalDelivery", "purchase": "BolusDelivery"}
    table = read_table(spark, sf, "events")
    name = F.coalesce(F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[F.col("event_type")], F.lit("Alarm"))
    return ev.category_counts(table.select(ev.category(name).alias("stream")))


@query(
    "p02_event_time_chain",
    f"""SELECT event_id, CASE WHEN year(t) BETWEEN 2008 AND 2030 THEN
      make_timestamp(CAST(round_even(epoch_us(t) / 1000000.0, 0) AS BIGINT) * 1000000) END AS event_time
    FROM (SELECT event_id, coalesce(CASE WHEN event_type = 'view' THEN ts END,
        CASE WHEN event_type = 'signup' THEN ts + INTERVAL 40 YEAR END,
        CASE WHEN event_type = 'click' THEN make_timestamp((1199145600 + user_id) * 1000000) END) AS t FROM events)""",
)
def p02(spark, sf):
    kind, ts = F.col("event_type"), F.col("ts").cast("timestamp")
    chain = [F.when(kind == "view", ts), F.when(kind == "signup", F.add_months(F.to_date(ts), 480).cast("timestamp"))]
    raw = F.when(kind == "click", F.col("user_id"))
    return read_table(spark, sf, "events").select("event_id", ev.event_time(chain, raw).alias("event_time"))


@query("p03_drop_early", "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'")
def p03(spark, sf):
    orders = read_table(spark, sf, "orders").withColumn("ts", F.col("o_orderdate").cast("timestamp"))
    return ev.drop_early(orders, "1998-01-01").select("o_orderkey")


@query(
    "p04_glucose_value",
    "SELECT event_id, value * 2 AS bg FROM events WHERE event_type IN ('view','signup') AND value > 0",
)
def p04(spark, sf):
    kind, value = F.col("event_type"), F.col("value")
    first, second = F.when(kind == "view", value * 2), F.when(kind == "signup", value * 2)
    table = read_table(spark, sf, "events").filter(kind.isin("view", "signup"))
    return table.select("event_id", ev.glucose_value([first, second]).alias("bg")).filter(F.col("bg").isNotNull())


@query(
    "p05_basal_value",
    f"""SELECT event_id, {r("value * 10 / 1000.0", 'rate_milli')}, {r("value * 10 / 100.0", 'rate_hundredths')},
    {r("CASE WHEN value > 10 THEN value / 100.0 ELSE value END", 'rate_rule')} FROM events WHERE event_type = 'click'""",
)
def p05(spark, sf):
    table = read_table(spark, sf, "events").filter(F.col("event_type") == "click")
    raw = F.col("value") * 10
    return table.select(
        "event_id",
        ev.basal_value(raw, None, None).alias("rate_milli"),
        ev.basal_value(raw, None, None, rate_divisor=100.0).alias("rate_hundredths"),
        ev.basal_value(None, None, F.col("value")).alias("rate_rule"),
    )


@query(
    "p06_bolus_value",
    f"""SELECT event_id, {r("value * 50 / 1000.0", 'dose_total')},
    {r("CASE WHEN value > 10 THEN value / 100.0 ELSE value END", 'dose_rule')}
    FROM events WHERE event_type = 'purchase' AND value > 0""",
)
def p06(spark, sf):
    table = read_table(spark, sf, "events").filter(F.col("event_type") == "purchase")
    return table.select(
        "event_id",
        ev.bolus_value(delivered_milliunits=F.col("value") * 50).alias("dose_total"),
        ev.bolus_value(insulin=F.col("value")).alias("dose_rule"),
    ).filter(F.col("dose_total").isNotNull())


@query(
    "p07_dedup_keep_last",
    f"""WITH {ORDER_SQL} SELECT pump_serial, ts, max(seq_num) AS seq_num, round(arg_max(value, seq_num), 6) AS value
    FROM ord GROUP BY 1, 2""",
)
def p07(spark, sf):
    return ev.dedup_last(order_events(spark, sf)).select("pump_serial", "ts", "seq_num", "value")


@query(
    "p08_dedup_keep_first",
    f"""WITH {ORDER_SQL} SELECT pump_serial, ts, min(seq_num) AS seq_num, round(arg_min(value, seq_num), 6) AS value
    FROM ord GROUP BY 1, 2""",
)
def p08(spark, sf):
    return ev.dedup_first(order_events(spark, sf)).select("pump_serial", "ts", "seq_num", "value")


@query(
    "p09_spread_duplicate_times",
    f"""WITH {ORDER_SQL} SELECT pump_serial, seq_num,
    ts + (row_number() OVER (PARTITION BY pump_serial, ts ORDER BY seq_num) - 1) * INTERVAL 1 MICROSECOND AS ts FROM ord""",
)
def p09(spark, sf):
    return ev.spread_duplicates(order_events(spark, sf)).select("pump_serial", "seq_num", "ts")


@query(
    "p10_time_guard",
    """SELECT event_id, ts BETWEEN TIMESTAMP '2023-12-20' - INTERVAL 7300 DAY AND TIMESTAMP '2023-12-20' + INTERVAL 30 DAY
    AS time_ok FROM events""",
)
def p10(spark, sf):
    ok = ev.time_is_valid(F.col("ts").cast("timestamp"), dt.datetime(2023, 12, 20))
    return read_table(spark, sf, "events").select("event_id", ok.alias("time_ok"))


@query(
    "p11_lacks_value",
    """SELECT event_type, count(*) FILTER (WHERE event_type <> 'error' AND nullif(value, 100.0) IS NULL) AS n_null
    FROM events GROUP BY 1""",
)
def p11(spark, sf):
    table = read_table(spark, sf, "events")
    stream = F.when(F.col("event_type") != "error", "cgm").otherwise("unknown")
    lacks = ev.lacks_value(stream, F.nullif(F.col("value"), F.lit(100.0)))
    return table.groupBy("event_type").agg(F.count_if(lacks).alias("n_null"))


RANGE_SQL = """CASE stream WHEN 'cgm' THEN value BETWEEN 20 AND 600 WHEN 'basal' THEN value BETWEEN 0 AND 8
  WHEN 'bolus' THEN value BETWEEN 0 AND 30 ELSE true END"""


@query(
    "p12_value_ranges",
    f"WITH {SIG_SQL} SELECT stream, {RANGE_SQL} AS in_range, count(*) AS n FROM sig GROUP BY 1, 2",
)
def p12(spark, sf):
    ok = ev.value_in_range(F.col("stream"), F.col("value")).alias("in_range")
    return signal_events(spark, sf).groupBy("stream", ok).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p13_reject_reasons",
    f"""WITH {LABELLED_SQL} SELECT CASE WHEN ts > TIMESTAMP '2023-12-25' + INTERVAL 30 DAY THEN 'invalid_timestamp'
      WHEN stream <> 'unknown' AND value IS NULL THEN 'null_value'
      WHEN NOT ({RANGE_SQL}) THEN 'out_of_range' ELSE 'valid' END AS outcome, count(*) AS n_events FROM lab GROUP BY 1""",
)
def p13(spark, sf):
    return ev.reject_counts(ev.with_reject_reason(labelled_events(spark, sf), dt.datetime(2023, 12, 25)))


@query(
    "p14_validate_table",
    f"""WITH {ORDER_SQL}, u AS (SELECT pump_serial, ts, arg_min(value, seq_num) AS value FROM ord GROUP BY 1, 2),
    t AS (SELECT *, ts BETWEEN TIMESTAMP '2000-06-01' - INTERVAL 7300 DAY AND TIMESTAMP '2000-06-01' + INTERVAL 30 DAY AS ok,
      value BETWEEN 20 AND 600 AS rng FROM u)
    SELECT (SELECT count(*) FROM ord) AS original_count, count(*) AS unique_count,
      count(*) FILTER (WHERE NOT ok) AS invalid_timestamps, count(*) FILTER (WHERE ok AND NOT rng) AS out_of_range,
      count(*) FILTER (WHERE ok AND rng) AS final_count FROM t""",
)
def p14(spark, sf):
    _, report = ev.validate_events(order_events(spark, sf), dt.datetime(2000, 6, 1))
    return report


@query(
    "p15_null_out_of_range",
    f"""WITH {SIG_SQL} SELECT pump_serial, count(*) AS n, count(CASE WHEN value BETWEEN 40 AND 600 THEN 1 END) AS n_kept,
    count(*) FILTER (WHERE value NOT BETWEEN 40 AND 600) AS n_nulled FROM sig WHERE stream = 'cgm' GROUP BY 1""",
)
def p15(spark, sf):
    cgm = signal_events(spark, sf).filter(F.col("stream") == "cgm")
    kept = cgm.withColumn("kept", ev.null_out_of_range("value", 40.0, 600.0))
    return kept.groupBy("pump_serial").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("kept").alias("n_kept"),
        F.count_if(F.col("kept").isNull()).alias("n_nulled"),
    )


@query(
    "p16_clip_and_flag",
    f"""WITH {SIG_SQL} SELECT seq_num, round(greatest(least(value, 600.0), 20.0), 6) AS value,
    CAST(value < 20 OR value > 600 AS INT) AS bg_clip_flag FROM sig WHERE stream = 'cgm'""",
)
def p16(spark, sf):
    cgm = signal_events(spark, sf).filter(F.col("stream") == "cgm")
    return cgm.withColumns(features.clip_cols("value", 20.0, 600.0, "bg_clip_flag")).select("seq_num", "value", "bg_clip_flag")


HOUR_GRID = aligned_sql(HOURLY)


def hour_grid(spark, sf, how=grid.Alignment()):
    return grid.align(signal_events(spark, sf), HOURLY, how)


@query(
    "p17_outlier_flags",
    f"""WITH {HOUR_GRID}, c AS (SELECT pump_serial, ts, bg AS bg_original, basal_rate AS basal_original,
      coalesce(CAST(bg < 39 OR bg > 401 AS INT), 0) AS bg_anomaly_flag, CAST(basal_rate > 8 OR basal_rate < 0 AS INT) AS basal_anomaly_flag,
      CASE WHEN bg IS NOT NULL THEN greatest(least(bg, 401.0), 39.0) END AS bg, greatest(least(basal_rate, 8.0), 0.0) AS basal_rate FROM grid),
    s AS (SELECT pump_serial, avg(basal_rate) AS m, stddev_samp(basal_rate) AS d FROM c GROUP BY 1)
    SELECT c.pump_serial, ts, round(bg, 6) AS bg, round(basal_rate, 6) AS basal_rate, round(bg_original, 6) AS bg_original,
      round(basal_original, 6) AS basal_original, bg_anomaly_flag, basal_anomaly_flag,
      CASE WHEN d > 0 AND abs((basal_rate - m) / d) > 3 THEN 1 ELSE 0 END AS basal_statistical_outlier
    FROM c JOIN s ON s.pump_serial = c.pump_serial""",
)
def p17(spark, sf):
    return ev.outlier_flags(hour_grid(spark, sf)).drop("bolus_dose")


@query(
    "p18_missing_flag",
    f"WITH {HOUR_GRID} SELECT pump_serial, sum(CAST(bg IS NULL AS BIGINT))::BIGINT AS n_missing, count(*) AS n FROM grid GROUP BY 1",
)
def p18(spark, sf):
    flagged = hour_grid(spark, sf).withColumn("missing", features.missing_col("bg"))
    return flagged.groupBy("pump_serial").agg(F.sum("missing").alias("n_missing"), F.count(F.lit(1)).alias("n"))


@query(
    "p19_round_times",
    f"""SELECT event_id, {floor_sql('ts', 300)} AS t_floor, make_timestamp(((epoch_us(ts) + 299999999) // 300000000) * 300000000) AS t_ceil,
    make_timestamp(CAST(round_even(epoch_us(ts) / 300000000.0, 0) AS BIGINT) * 300000000) AS t_round FROM events""",
)
def p19(spark, sf):
    ts = F.col("ts").cast("timestamp")
    return read_table(spark, sf, "events").select(
        "event_id",
        tg.floor_to(ts, 300).alias("t_floor"),
        tg.ceil_to(ts, 300).alias("t_ceil"),
        tg.round_to(ts, 300).alias("t_round"),
    )


@query("p20_zone_conversion", "SELECT event_id, ts - INTERVAL 3 HOUR AS ts_utc, ts + INTERVAL 3 HOUR AS ts_local FROM events")
def p20(spark, sf):
    ts = F.col("ts").cast("timestamp")
    return read_table(spark, sf, "events").select(
        "event_id", ev.to_utc(ts, "+03:00").alias("ts_utc"), ev.from_utc(ts, "+03:00").alias("ts_local")
    )


@query(
    "p21_parse_dates",
    """SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN CAST(CAST(ts AS DATE) AS TIMESTAMP)
    WHEN 'signup' THEN ts ELSE date_trunc('second', ts) END AS parsed FROM events""",
)
def p21(spark, sf):
    ts, kind = F.col("ts").cast("timestamp"), F.col("event_type")
    text = (
        F.when(kind == "view", F.date_format(ts, "yyyy-MM-dd"))
        .when(kind == "click", F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == "purchase", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == "signup", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .otherwise(F.lit("not a date"))
    )
    return read_table(spark, sf, "events").select("event_id", ev.parse_date(text).alias("parsed"))


@query(
    "p22_name_filter",
    "SELECT event_id, event_type FROM events WHERE contains(event_type, 'ur') OR contains(event_type, 'ig')",
)
def p22(spark, sf):
    table = read_table(spark, sf, "events")
    return table.filter(ev.name_contains(F.col("event_type"), ["ur", "ig"])).select("event_id", "event_type")


@query(
    "p23_date_range",
    f"""WITH {SIG_SQL} SELECT pump_serial, seq_num FROM sig WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-12 12:00:00'""",
)
def p23(spark, sf):
    return ev.in_range(signal_events(spark, sf), "2024-01-05", "2024-01-12 12:00:00").select("pump_serial", "seq_num")


@query(
    "p23_range_of_sorted_files",
    f"""WITH {SIG_SQL} SELECT pump_serial, seq_num FROM sig WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-12 12:00:00'""",
)
def p23_sorted(spark, sf):
    """The range from a sink sorted by device and time; files that cannot have it are not opened."""
    events = signal_events(spark, sf)
    table = SortedTable(spark, scratch_dir(spark, "sorted"), events.schema)
    table.write(events)
    return table.between("2024-01-05", "2024-01-12 12:00:00").select("pump_serial", "seq_num")


@query(
    "p23_since_last_sync",
    f"""WITH {SIG_SQL}, s AS (SELECT pump_serial, max(ts) AS t FROM sig WHERE stream = 'basal' GROUP BY 1)
    SELECT sig.pump_serial, seq_num FROM sig LEFT JOIN s ON s.pump_serial = sig.pump_serial WHERE t IS NULL OR ts > t""",
)
def p23b(spark, sf):
    events = signal_events(spark, sf)
    sync = events.filter(F.col("stream") == "basal").groupBy("pump_serial").agg(F.max("ts").alias("last_successful_sync"))
    return ev.since_last_sync(events, sync).select("pump_serial", "seq_num")


@query("p24_time_of_day", f"SELECT event_id, {sin_cos_sql()} FROM events")
def p24(spark, sf):
    table = read_table(spark, sf, "events").withColumn("t", F.col("ts").cast("timestamp"))
    return table.select("event_id", *[c.alias(n) for n, c in tg.time_of_day(F.col("t")).items()])


@query(
    "p25_calendar_features",
    f"""SELECT event_id, hour(ts)::INT AS hour, (isodow(ts) - 1)::INT AS day_of_week, month(ts)::INT AS month,
    {r('sin(2*pi()*hour(ts)/24.0)', 'hour_sin')}, {r('cos(2*pi()*hour(ts)/24.0)', 'hour_cos')},
    {r('sin(2*pi()*(isodow(ts)-1)/7.0)', 'day_sin')}, {r('cos(2*pi()*(isodow(ts)-1)/7.0)', 'day_cos')} FROM events""",
)
def p25(spark, sf):
    table = read_table(spark, sf, "events").withColumn("t", F.col("ts").cast("timestamp"))
    return table.select("event_id", *[c.alias(n) for n, c in tg.calendar(F.col("t")).items()])


@query(
    "p26_features_to_json_and_back",
    f"WITH {SIG_SQL} SELECT seq_num, round(value, 6) AS value, stream, CAST(NULL AS DOUBLE) AS spare FROM sig",
)
def p26(spark, sf):
    packed = signal_events(spark, sf).select(
        "seq_num",
        F.to_json(F.struct("value", "stream", F.lit(None).cast("double").alias("spare")), {"ignoreNullFields": "false"}).alias("features"),
    )
    unpacked = packed.select("seq_num", F.from_json("features", "value double, stream string, spare double").alias("f"))
    return unpacked.select("seq_num", "f.*")


@query(
    "p27_standard_columns",
    f"WITH {SIG_SQL} SELECT ts AS timestamp, round(value, 6) AS bg, pump_serial FROM sig WHERE stream = 'cgm'",
)
def p27(spark, sf):
    cgm = signal_events(spark, sf).filter(F.col("stream") == "cgm")
    return cgm.withColumnsRenamed({"ts": "timestamp", "value": "bg"}).select("timestamp", "bg", "pump_serial")


@query(
    "p28_decode_enum_bitmask_ratio",
    f"""SELECT event_id, n_name AS label,
    concat_ws(',', CASE WHEN user_id & 1 = 1 THEN 'b0' END, CASE WHEN user_id & 2 = 2 THEN 'b1' END,
      CASE WHEN user_id & 4 = 4 THEN 'b2' END) AS flags,
    {r('value * 0.1', 'scaled')}, {r('(256 * (hour(ts) - 14) + minute(ts)) / 768.0', 'battery')}
    FROM events LEFT JOIN nation ON n_nationkey = user_id""",
)
def p28(spark, sf):
    codes = read_table(spark, sf, "nation").select(F.col("n_nationkey").cast("bigint").alias("code"), F.col("n_name").alias("label"))
    ts = F.col("ts").cast("timestamp")
    table = read_table(spark, sf, "events").withColumn("code_value", F.col("user_id"))
    return ev.decode_codes(table, "code_value", codes, "label").select(
        "event_id",
        "label",
        F.array_join(ev.bitmask_names(F.col("user_id"), ["b0", "b1", "b2"]), ",").alias("flags"),
        ev.ratio(F.col("value"), 0.1).alias("scaled"),
        ev.battery_percent(F.hour(ts), F.minute(ts)).alias("battery"),
    )


SPAN_SQL = f"{SIG_SQL}, span AS (SELECT pump_serial, min(ts) AS first_event, max(ts) AS last_event FROM sig GROUP BY 1)"


def device_span(spark, sf):
    return signal_events(spark, sf).groupBy("pump_serial").agg(F.min("ts").alias("first_event"), F.max("ts").alias("last_event"))


@query(
    "p29_device_activity",
    f"""WITH {SPAN_SQL}, a AS (SELECT *, floor((epoch_us(TIMESTAMP '2024-02-01') - epoch_us(last_event)) / 86400000000) AS age FROM span)
    SELECT pump_serial, first_event, last_event,
      CAST((epoch_us(last_event) - epoch_us(first_event)) // 86400000000 + 1 AS BIGINT) AS duration_days,
      CASE WHEN age <= 1 THEN 'Active (current)' WHEN age <= 7 THEN 'Recently active' WHEN age <= 30 THEN 'Inactive (recent)'
        ELSE 'Inactive (old)' END AS status FROM a""",
)
def p29(spark, sf):
    return ev.activity(device_span(spark, sf), dt.datetime(2024, 2, 1))


@query(
    "p30_sync_range",
    f"""WITH {SPAN_SQL} SELECT pump_serial, CASE WHEN (epoch_us(last_event) - epoch_us(first_event)) // 86400000000 > 14
      THEN last_event - INTERVAL 14 DAY ELSE first_event END AS sync_start, last_event AS sync_end FROM span""",
)
def p30(spark, sf):
    return ev.sync_range(device_span(spark, sf), 14)


@query(
    "p31_required_columns",
    """SELECT 'schema' AS check_name, 'event_id' AS column_name, 'PASS' AS status, 'LOW' AS severity, count(event_id) AS n_present FROM events
    UNION ALL SELECT 'schema', 'ts', 'PASS', 'LOW', count(ts) FROM events
    UNION ALL SELECT 'schema', 'bg', 'FAIL', 'CRITICAL', 0""",
)
def p31(spark, sf):
    return ev.column_checks(read_table(spark, sf, "events"), ["event_id", "ts", "bg"])


@query(
    "p32_capped_difference",
    f"""WITH {SIG_SQL} SELECT seq_num, {r('greatest(least(greatest((value - 110.0) / 40.0, 0.0) - 0.5, 5.0), 0.0)', 'capped')}
    FROM sig WHERE stream = 'cgm'""",
)
def p32(spark, sf):
    cgm = signal_events(spark, sf).filter(F.col("stream") == "cgm")
    return cgm.select("seq_num", ev.capped_difference(F.col("value"), 110.0, 40.0, F.lit(0.5), 5.0).alias("capped"))


@query(
    "p33_unpivot_streams",
    f"""WITH {HOUR_GRID} SELECT pump_serial, ts, 'cgm' AS stream, round(bg, 6) AS value FROM grid WHERE bg IS NOT NULL
    UNION ALL SELECT pump_serial, ts, 'basal', round(basal_rate, 6) FROM grid
    UNION ALL SELECT pump_serial, ts, 'bolus', round(bolus_dose, 6) FROM grid WHERE bolus_dose > 0""",
)
def p33(spark, sf):
    return ev.unpivot_streams(hour_grid(spark, sf))


@query(
    "p34_model_frame",
    f"""WITH {HOUR_GRID} SELECT pump_serial, ts, coalesce(round(bg, 6), 0.0) AS bg, round(basal_rate, 6) AS basal_rate,
    0.0 :: DOUBLE AS bg_velocity, coalesce(round(bg, 6), 0.0) AS target FROM grid""",
)
def p34(spark, sf):
    return ev.model_frame(hour_grid(spark, sf), ["bg", "basal_rate", "bg_velocity"])


@query(
    "p36_stream_frame",
    f"""WITH {ORDER_SQL} SELECT pump_serial, ts, round(arg_max(value, seq_num), 6) AS bg FROM ord GROUP BY 1, 2""",
)
def p36(spark, sf):
    return ev.stream_frame(order_events(spark, sf), "ts", "value", "bg")
