"""The eleven dataset checks, their report, and the continuity metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid import tiles
from tidegrid.config import RAW_TILE_SECONDS, GridSpec
from tidegrid.functions import timegrid as tg
from tidegrid.operators import gaps, joins, runs, summary
from tidegrid.operators.events import parse_date
from tidegrid.operators.summary import share
from tidegrid.session import stage
from tidegrid.tiles import KEYS, TILE

LEVELS = {"basic": 1, "standard": 2, "comprehensive": 3}


LAG_ROWS = 6


def with_history(rows: DataFrame, spec: GridSpec, min_dose: float = 2.0) -> DataFrame:
    """Rows in time with what the checks ask of those before them, from one shuffle, one carry and one sort for all checks.

    ``_before``: the time of the row before.  ``_read_ts``, ``_read_bg``: the reading before.  ``rn``, ``n_values``: the number of the last
    reading up to the row and that of all readings.  ``_dosed``: the time of the last dose of at least ``min_dose`` up to the row.  ``_dose``: the dose
    ``LAG_ROWS`` rows earlier in the tile, with ``tiles.edge_cols`` for the first rows of it.
    """
    ts, bg = F.col("ts"), F.col("bg")
    read, large = bg.isNotNull(), F.col("bolus_dose") >= min_dose
    items = {
        "_c_row": tiles.Prev({"ts": ts}, ts),
        "_c_read": tiles.Prev({"ts": ts, "v": bg}, ts, read),
        "_c_large": tiles.Prev({"ts": ts}, ts, large),
        "_c_rn": tiles.Running(read.cast("bigint")),
        "n_values": tiles.Total(F.count(bg), F.sum),
    }
    w = tiles.in_tile(KEYS, ["ts"])
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = {
        "_before": F.lag("ts").over(w),
        "_read_ts": tiles.nearest("lag", "_rts", KEYS),
        "_read_bg": tiles.nearest("lag", "bg", KEYS),
        "rn": F.count(bg).over(upto),
        "_dosed": F.max(F.when(large, ts)).over(upto),
        "_dose": F.lag("bolus_dose", LAG_ROWS).over(w),
    } | tiles.edge_cols(w, LAG_ROWS)

    def build(tiled: DataFrame) -> DataFrame:
        return tiled.withColumn("_rts", F.when(read, ts)).withColumns(inside).drop("_rts")

    tiled = tiles.add_tile(rows.select(*KEYS, "ts", "bg", "bolus_dose"), spec.tile_seconds)
    carries = {"_before": "_c_row.ts", "_read_ts": "_c_read.ts", "_read_bg": "_c_read.v", "_dosed": "_c_large.ts"}
    found = {name: F.coalesce(F.col(name), F.col(carry)) for name, carry in carries.items()}
    out = tiles.with_carry(tiled, items, build=build).withColumns(found | {"rn": F.col("rn") + F.col("_c_rn")})
    return out.drop(TILE, "_c_row", "_c_read", "_c_large", "_c_rn")


def dataset_metrics(rows: DataFrame, spec: GridSpec, level: str, now: dt.datetime) -> DataFrame:
    """One row per device with every figure the checks look at."""
    depth = LEVELS[level]
    bg, basal, bolus = F.col("bg"), F.col("basal_rate"), F.col("bolus_dose")
    ts = F.col("ts")
    given = bolus > 0
    out = rows.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n_rows"),
        (share(bg.isNotNull()) * 100).alias("cgm_pct"),
        (share(basal.isNotNull()) * 100).alias("basal_pct"),
        (share(given) * 100).alias("bolus_pct"),
        F.count(bg).alias("n_bg"),
        F.count_if((bg < 40) | (bg > 600)).alias("cgm_extreme"),
        F.count_if((bg < 70) | (bg > 180)).alias("cgm_not_normal"),
        F.count_if((basal < 0) | (basal > 10)).alias("basal_extreme"),
        F.count_if(given).alias("n_bolus"),
        F.count_if(given & (bolus > 50)).alias("bolus_extreme"),
        F.count_if(ts > F.lit(now)).alias("n_future"),
        F.count_if(ts < F.lit("2000-01-01").cast("timestamp")).alias("n_old"),
        ((tg.micros(F.max("ts")) - tg.micros(F.min("ts"))) / F.lit(3600.0 * tg.MICROS)).alias("span_hours"),
        F.avg(bg).alias("bg_mean"),
        F.stddev_samp(bg).alias("bg_std"),
        F.count_if(bolus >= 2).alias("n_large_bolus"),
    )
    if depth >= 2:
        laid = stage(with_history(rows, spec), "history")
        steps = gaps.steps(gaps.observed_times(laid, "_before"), spec.tile_seconds, "_before").groupBy(*KEYS).agg(
            F.count(F.lit(1)).alias("n_times"),
            F.count_if(F.col("step_seconds") > 600).alias("n_gaps"),
            F.max(F.when(F.col("step_seconds") > 600, F.col("step_seconds") / 60)).alias("max_gap"),
            F.avg(F.when(F.col("step_seconds") > 600, F.col("step_seconds") / 60)).alias("avg_gap"),
        )
        out = out.join(steps, list(KEYS))
    if depth >= 3:
        anomalies = summary.anomaly_counts(rows).select(*KEYS, "anomalies", "anomaly_pct")
        rates = gaps.rate_report(laid, tile_seconds=spec.tile_seconds, before=("_read_ts", "_read_bg"))
        # the reference shift looks six rows ahead; the default here is six rows back
        moved = tiles.rows_back(laid.select(*KEYS, "ts", "bg", "bolus_dose", "_dose", "_pos", "_tail"), "bolus_dose", "_dose", LAG_ROWS)
        corr = summary.dose_correlation(moved, spec, LAG_ROWS, regular=False, dose="_dose")
        trend = gaps.sensor_trend(laid, tile_seconds=spec.tile_seconds, numbered=True).select(*KEYS, "mean_slope", "std_slope")
        drops = joins.response_after_dose(laid, spec, dosed="_dosed").groupBy(*KEYS).agg(F.avg("drop_bg").alias("avg_drop"))
        for part in (anomalies, rates, corr, trend, drops):
            out = out.join(part, list(KEYS), "left")
    return out


def _check(name: str, status: Column, severity: Column, value: Column, emit: Column) -> Column:
    row = F.struct(
        F.lit(name).alias("check_name"), status.alias("status"), severity.alias("severity"), value.cast("double").alias("value")
    )
    return F.when(emit, row)


def _ladder(*rungs: tuple[Column, str, str], default: tuple[str, str] = ("PASS", "LOW")) -> tuple[Column, Column]:
    """Status and severity of the first rung that holds."""
    status: Column | None = None
    severity: Column | None = None
    for test, s, v in rungs:
        status = F.when(test, s) if status is None else status.when(test, s)
        severity = F.when(test, v) if severity is None else severity.when(test, v)
    return status.otherwise(default[0]), severity.otherwise(default[1])


SIGNALS = ("bg", "basal_rate", "bolus_dose")


def schema_checks(rows: DataFrame) -> DataFrame:
    """V7 row 1, over the whole dataset: ``check_name, status, severity, value``.

    An empty dataset gives ``dataset_empty`` alone.  The value is the number of missing columns or of unreadable times where
    the check fails, else the number of rows.
    """
    missing = [c for c in ("ts", *KEYS) if c not in rows.columns]
    signals = [c for c in SIGNALS if c in rows.columns]
    bad_times = F.lit(0).cast("bigint")
    if not missing and dict(rows.dtypes)["ts"] == "string":
        bad_times = F.count_if(F.col("ts").isNotNull() & parse_date(F.col("ts")).isNull())
    figures = rows.agg(F.count(F.lit(1)).alias("n"), bad_times.alias("bad"))
    if missing or not signals:
        status, severity, value = F.lit("FAIL"), F.lit("CRITICAL"), F.lit(len(missing) or len(SIGNALS))
    else:
        status = F.when(F.col("bad") > 0, "FAIL").otherwise("PASS")
        severity = F.when(F.col("bad") > 0, "HIGH").otherwise("LOW")
        value = F.when(F.col("bad") > 0, F.col("bad")).otherwise(F.col("n"))
    empty = F.col("n") == 0
    return figures.select(
        F.when(empty, "dataset_empty").otherwise("schema").alias("check_name"),
        F.when(empty, "FAIL").otherwise(status).alias("status"),
        F.when(empty, "CRITICAL").otherwise(severity).alias("severity"),
        F.when(empty, 0).otherwise(value).cast("double").alias("value"),
    )


def dataset_checks(rows: DataFrame, spec: GridSpec, level: str, now: dt.datetime) -> DataFrame:
    """V7: all checks per device; a dataset that is empty or lacks its columns gives the schema row alone, without a device."""
    schema = stage(schema_checks(rows), "schema-check")
    if schema.filter("status = 'FAIL'").isEmpty():
        have = rows.withColumns({c: F.lit(None).cast("double") for c in SIGNALS if c not in rows.columns})
        if dict(rows.dtypes)["ts"] == "string":
            have = have.withColumn("ts", parse_date(F.col("ts")))
        return checks_from_metrics(dataset_metrics(have, spec, level, now), level)
    kind = dict(rows.dtypes).get(KEYS[0], "bigint")
    return schema.select(F.lit(None).cast(kind).alias(KEYS[0]), "check_name", "status", "severity", "value")


def checks_from_metrics(metrics: DataFrame, level: str) -> DataFrame:
    """V7: one row per emitted check."""
    c, depth = F.col, LEVELS[level]
    true = F.lit(True)
    normal_pct = c("cgm_not_normal") / c("n_bg") * 100
    cv = F.when(c("bg_mean") > 0, c("bg_std") / c("bg_mean") * 100).otherwise(F.lit(0.0))
    rows = [
        _check("schema", F.lit("PASS"), F.lit("LOW"), c("n_rows"), true),
        _check(
            "completeness_cgm",
            *_ladder((c("cgm_pct") < 85, "FAIL", "HIGH"), (c("cgm_pct") < 95, "WARN", "MEDIUM")),
            c("cgm_pct"),
            true,
        ),
        _check("completeness_basal", *_ladder((c("basal_pct") < 90, "WARN", "MEDIUM")), c("basal_pct"), true),
        _check("completeness_bolus", *_ladder((c("bolus_pct") > 20, "WARN", "MEDIUM")), c("bolus_pct"), true),
        _check("range_cgm_extreme", F.lit("FAIL"), F.lit("HIGH"), c("cgm_extreme"), c("cgm_extreme") > 0),
        _check(
            "range_cgm_normal",
            *_ladder((F.when(c("n_bg") > 0, normal_pct) > 50, "WARN", "MEDIUM")),
            F.when(c("n_bg") > 0, normal_pct),
            c("cgm_not_normal") > 0,
        ),
        _check("range_basal", *_ladder((c("basal_extreme") > 0, "FAIL", "HIGH")), c("basal_extreme"), true),
        _check("range_bolus", *_ladder((c("bolus_extreme") > 0, "FAIL", "HIGH")), c("bolus_extreme"), c("n_bolus") > 0),
    ]
    if depth >= 2:
        duplicates = c("n_rows") - c("n_times")
        rows += [
            _check(
                "continuity_gaps",
                *_ladder((c("max_gap") > 60, "FAIL", "HIGH"), (c("n_gaps") > 10, "WARN", "MEDIUM")),
                c("n_gaps"),
                true,
            ),
            _check("temporal_duplicates", F.lit("WARN"), F.lit("MEDIUM"), duplicates, duplicates > 0),
            _check("temporal_future", F.lit("WARN"), F.lit("HIGH"), c("n_future"), c("n_future") > 0),
            _check("temporal_epoch", F.lit("FAIL"), F.lit("CRITICAL"), c("n_old"), c("n_old") > 0),
            _check("temporal_span", *_ladder((c("span_hours") < 24, "WARN", "MEDIUM")), c("span_hours"), c("n_rows") > 1),
            _check(
                "stats_cgm_mean", F.lit("WARN"), F.lit("MEDIUM"), c("bg_mean"), (c("bg_mean") < 80) | (c("bg_mean") > 200)
            ),
            _check("stats_cgm_variability", F.lit("WARN"), F.lit("MEDIUM"), cv, (c("n_bg") > 0) & ((cv > 50) | (cv < 5))),
            _check(
                "stats_cgm",
                F.lit("PASS"),
                F.lit("LOW"),
                c("bg_mean"),
                (c("n_bg") > 0) & ~F.coalesce((cv > 50) | (cv < 5), F.lit(False)),
            ),
        ]
    if depth >= 3:
        rows += [
            _check(
                "anomalies_statistical",
                *_ladder((c("anomaly_pct") > 5, "WARN", "MEDIUM")),
                c("anomalies"),
                c("n_bg") > 10,
            ),
            _check("plausibility_glucose_rate", *_ladder((c("n_extreme") > 0, "WARN", "HIGH")), c("n_extreme"), c("n_rates") > 0),
            _check(
                "consistency_insulin_glucose",
                *_ladder((c("correlation") > 0.2, "WARN", "MEDIUM")),
                c("correlation"),
                c("correlation").isNotNull(),
            ),
            _check("sensor_drift", F.lit("WARN"), F.lit("HIGH"), c("mean_slope"), F.abs(c("mean_slope")) > 5),
            _check("sensor_degradation", F.lit("WARN"), F.lit("MEDIUM"), c("std_slope"), c("std_slope") < -2),
            _check(
                "sensor_quality",
                F.lit("PASS"),
                F.lit("LOW"),
                c("std_slope"),
                c("mean_slope").isNotNull() & ~F.coalesce(c("std_slope") < -2, F.lit(False)),
            ),
            _check(
                "insulin_dynamics",
                *_ladder((c("avg_drop") < 5, "WARN", "MEDIUM"), (c("avg_drop") > 100, "WARN", "HIGH")),
                c("avg_drop"),
                (c("n_large_bolus") >= 5) & c("avg_drop").isNotNull(),
            ),
        ]
    emitted = metrics.select(*KEYS, F.explode(F.array_compact(F.array(*rows))).alias("c"))
    return emitted.select(*KEYS, "c.*")


def validation_report(checks: DataFrame, metrics: DataFrame) -> DataFrame:
    """V8: counts, score, overall status, continuity and temporal score per device."""
    status, severity = F.col("status"), F.col("severity")
    temporal = F.col("check_name").startswith("temporal_")
    counted = checks.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("total_checks"),
        *[F.count_if(status == s).alias(f"n_{s.lower()}") for s in ("PASS", "WARN", "FAIL")],
        *[F.count_if(severity == s).alias(f"n_{s.lower()}") for s in ("LOW", "MEDIUM", "HIGH", "CRITICAL")],
        F.sum(F.when(temporal & (status == "WARN"), 1).when(temporal & (status == "FAIL"), 3).otherwise(0)).alias("_penalty"),
    )
    c = F.col
    score = c("n_pass") / c("total_checks") * 100 - c("n_fail") / c("total_checks") * 200
    overall = (
        F.when((c("n_fail") > 0) & (c("n_critical") > 0), "CRITICAL_FAILURE")
        .when(c("n_fail") > 0, "FAILURE")
        .when((c("n_warn") > 0) & (c("n_high") > 0), "WARNING_HIGH")
        .when(c("n_warn") > 0, "WARNING")
        .otherwise("PASS")
    )
    parts = F.array_compact(
        F.array(
            F.when(c("cgm_pct") > 0, c("cgm_pct") * 0.7),
            F.when(c("basal_pct") > 0, c("basal_pct") * 0.2),
            F.when(c("bolus_pct") > 0, F.least(c("bolus_pct") * 5, F.lit(100.0)) * 0.1),
        )
    )
    joined = counted.join(metrics.select(*KEYS, "n_rows", "cgm_pct", "basal_pct", "bolus_pct"), list(KEYS))
    return joined.withColumns(
        {
            "overall_score": F.greatest(F.lit(0.0), F.least(F.lit(100.0), score)),
            "overall_status": overall,
            "continuity_score": _mean_of(parts),
            "temporal_score": F.greatest(F.lit(0), F.lit(100) - c("_penalty") * 10).cast("double"),
        }
    ).drop("_penalty")


def _mean_of(parts: Column) -> Column:
    total = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(parts) > 0, total / F.size(parts)).otherwise(F.lit(0.0))


def continuity_metrics(grid: DataFrame, spec: GridSpec) -> DataFrame:
    """V9: shares of bins with signal, null runs closed by a reading, weighted score over its three parts."""
    base = grid.groupBy(*KEYS).agg(
        (share(F.col("bg").isNotNull()) * 100).alias("cgm_pct"),
        (share(F.col("basal_rate").isNotNull()) * 100).alias("basal_pct"),
        (share(F.col("bolus_dose") > 0) * 100).alias("bolus_pct"),
    )
    closed = runs.null_runs(grid, spec, include_open_end=False).groupBy(*KEYS).agg(
        F.max("run_len").alias("max_gap_bins"), F.avg("run_len").alias("avg_gap_bins"), F.count(F.lit(1)).alias("n_gaps")
    )
    out = base.join(closed, list(KEYS), "left").fillna(0, ["max_gap_bins", "n_gaps"]).fillna(0.0, ["avg_gap_bins"])
    score = (F.col("cgm_pct") * 0.6 + F.col("basal_pct") * 0.3 + F.col("bolus_pct") * 0.1) / 3
    return out.withColumn("continuity_score", score)


def quality_check(rows: DataFrame, tile_seconds: int = RAW_TILE_SECONDS) -> DataFrame:
    """V4: range, gaps over two hours, missing share per signal, value figures and a status."""
    signals = ("bg", "basal_rate", "bolus_dose")
    aggs = [
        F.count(F.lit(1)).alias("n_rows"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    ]
    for s in signals:
        aggs += [(share(F.col(s).isNull()) * 100).alias(f"{s}_missing_pct")]
        aggs += [f(s).alias(f"{s}_{n}") for f, n in ((F.min, "min"), (F.max, "max"), (F.avg, "mean"), (F.stddev_samp, "std"))]
    base = rows.groupBy(*KEYS).agg(*aggs)
    steps = gaps.steps(gaps.observed_times(rows), tile_seconds).groupBy(*KEYS).agg(
        F.count_if(F.col("step_seconds") > 7200).alias("n_gaps"),
        F.coalesce(F.max("step_seconds") / 3600, F.lit(0.0)).alias("max_gap_hours"),
    )
    mean_missing = (F.col("bg_missing_pct") + F.col("basal_rate_missing_pct") + F.col("bolus_dose_missing_pct")) / 3
    status = F.when(mean_missing > 50, "poor").when(mean_missing > 20, "fair").otherwise("good")
    return base.join(steps, list(KEYS)).withColumn("status", status)


def suggestions(rows: DataFrame, tile_seconds: int = RAW_TILE_SECONDS) -> DataFrame:
    """V5: texts built from the counts."""
    base = rows.groupBy(*KEYS).agg(
        F.count_if(F.col("bg").isNull()).alias("_missing"),
        F.count_if(F.col("bg") < 70).alias("_low"),
        F.count_if(F.col("bg") > 400).alias("_high"),
    )
    steps = gaps.steps(gaps.observed_times(rows), tile_seconds).groupBy(*KEYS).agg(
        F.count_if(F.col("step_seconds") > 7200).alias("_gaps")
    )
    # The wording of the suggestions.
    texts = [
        ("_missing", "Consider interpolating %d missing BG values"),
        ("_gaps", "Consider handling %d temporal gaps > 2 hours"),
        ("_low", "Review %d extreme low BG values (<70)"),
        ("_high", "Review %d extreme high BG values (>400)"),
    ]
    found = F.array_compact(F.array(*[F.when(F.col(c) > 0, F.format_string(t, F.col(c))) for c, t in texts]))
    joined = base.join(steps, list(KEYS)).withColumn("_found", found)
    text = F.when(F.size("_found") > 0, F.array_join("_found", "; ")).otherwise(F.lit("Data quality looks good!"))
    return joined.select(*KEYS, text.alias("suggestions"))


def quality_report(grid: DataFrame, spec: GridSpec, gap_hours: float = 18.0) -> DataFrame:
    """Continuity, basal and glucose patterns, completeness, GOOD or NEEDS_ATTENTION."""
    size = spec.tile_seconds
    grid = stage(grid, "report-input")  # read by three reports
    times = gaps.steps(gaps.observed_times(grid), size).groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("step_seconds") > gap_hours * 3600).alias("n_gaps"),
        F.max("step_seconds").alias("max_step_seconds"),
        ((tg.micros(F.max("ts")) - tg.micros(F.min("ts"))) / F.lit(float(spec.freq_seconds * tg.MICROS))).alias("_expected"),
    )
    basal = summary.basal_patterns(grid, size).select(*KEYS, "suspicious_values", "large_changes")
    glucose = summary.glucose_patterns(grid, size).select(*KEYS, "very_high_values", "rapid_changes")
    joined = times.join(basal, list(KEYS)).join(glucose, list(KEYS))
    c = F.col
    issues = (c("n_gaps") > 0).cast("int") + (c("suspicious_values") > 0).cast("int") + (c("very_high_values") > 0).cast("int")
    return joined.withColumns(
        {
            "completeness_pct": F.when(c("_expected") > 0, c("n_rows") / c("_expected") * 100).otherwise(F.lit(0.0)),
            "n_issues": issues,
            "overall_quality": F.when(issues == 0, "GOOD").otherwise("NEEDS_ATTENTION"),
        }
    ).drop("_expected")
