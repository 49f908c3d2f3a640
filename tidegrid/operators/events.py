"""Event-level rules: categories, times, values, duplicates, ranges."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid import tiles
from tidegrid.config import DEVICE_EPOCH_SECONDS, EARLIEST_EVENT, MAX_VALID_YEAR, MIN_VALID_YEAR, Ranges
from tidegrid.functions import timegrid as tg
from tidegrid.tiles import KEYS

# Substrings of an event type name, and field names, that put an event into a stream.
STREAM_NAMES = {"cgm": "Cgm|cgm|Gx", "basal": "Basal|basal", "bolus": "Bolus|bolus"}
STREAM_FIELDS = {
    "cgm": ("sgv", "bg", "currentglucosedisplayvalue", "glucoseValue"),
    "basal": ("commandedRate", "commandedbasalrate"),
    "bolus": ("bolusAmount", "insulin"),
}
DATE_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]'Z'",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX",
    "MM/dd/yyyy",
)


def category(name: Column, present: dict[str, Column] | None = None) -> Column:
    """Stream of an event by its type name or by a field it carries; cgm wins over basal over bolus."""
    out: Column | None = None
    for stream, pattern in STREAM_NAMES.items():
        test = name.rlike(pattern)
        for field in STREAM_FIELDS[stream]:
            if present and field in present:
                test = test | present[field].isNotNull()
        out = F.when(test, stream) if out is None else out.when(test, stream)
    return out.otherwise("unknown")


def category_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("stream").agg(F.count(F.lit(1)).alias("n_events"))


def device_time(raw_seconds: Column, zone: str = "UTC") -> Column:
    """Seconds since 2008 are the wall clock of the device: the zone is put on, not converted from UTC."""
    return F.to_utc_timestamp(F.timestamp_seconds(raw_seconds + F.lit(DEVICE_EPOCH_SECONDS)), zone)


def event_time(candidates: Sequence[Column], raw_seconds: Column | None = None, fallback: Column | None = None) -> Column:
    """First present time, else device seconds, else a fallback; rounded to the second, null outside the valid years."""
    chain = list(candidates)
    if raw_seconds is not None:
        chain.append(F.timestamp_seconds(raw_seconds + F.lit(DEVICE_EPOCH_SECONDS)))
    if fallback is not None:
        chain.append(fallback)
    ts = F.coalesce(*chain)
    return F.when(tg.valid_year(ts, MIN_VALID_YEAR, MAX_VALID_YEAR), tg.round_to(ts, 1))


def drop_early(df: DataFrame, earliest: str = EARLIEST_EVENT) -> DataFrame:
    return df.filter(F.col("ts") >= F.lit(earliest).cast("timestamp"))


def glucose_value(candidates: Sequence[Column]) -> Column:
    """First present attribute; values that are not positive are dropped by the caller's filter on null."""
    value = F.coalesce(*[c.cast("double") for c in candidates])
    return F.when(value > 0, value)


def unit_rule(value: Column) -> Column:
    """A bare value above 10 is in hundredths."""
    return F.when(value > 10, value / 100.0).otherwise(value)


def basal_value(
    commanded_rate: Column | None, commanded_basal: Column | None, value: Column | None, rate_divisor: float = 1000.0
) -> Column:
    """P5: ``rate_divisor`` is 1000 because the device reports milliunits; 100 repeats the older reading."""
    parts = []
    if commanded_rate is not None:
        parts.append(commanded_rate / F.lit(rate_divisor))
    if commanded_basal is not None:
        parts.append(commanded_basal)
    if value is not None:
        parts.append(unit_rule(value))
    rate = F.coalesce(*parts, F.lit(0.0))
    return F.when(rate >= 0, rate)


def bolus_value(
    delivered_milliunits: Column | None = None,
    delivered: Column | None = None,
    amount: Column | None = None,
    insulin: Column | None = None,
    value: Column | None = None,
) -> Column:
    """Decoded totals first, then the older attribute names; doses must be positive."""
    parts = []
    if delivered_milliunits is not None:
        parts.append(delivered_milliunits / 1000.0)
    if delivered is not None:
        parts.append(delivered)
    if amount is not None:
        parts.append(amount / 100.0)
    if insulin is not None:
        parts.append(unit_rule(insulin))
    if value is not None:
        parts.append(unit_rule(value))
    dose = F.coalesce(*parts, F.lit(0.0))
    return F.when(dose > 0, dose)


def dedup_last(df: DataFrame, on: Sequence[str] = ("pump_serial", "ts", "stream"), order: str = "seq_num") -> DataFrame:
    """Keep the row with the highest sequence number; pre-aggregated, so a hot key never meets in one sort."""
    return _dedup(df, on, F.max_by, order, -1)


def dedup_first(df: DataFrame, on: Sequence[str] = ("pump_serial", "ts", "stream"), order: str = "seq_num") -> DataFrame:
    """P8."""
    return _dedup(df, on, F.min_by, order, 1)


def _dedup(df: DataFrame, on: Sequence[str], pick, order: str, side: int) -> DataFrame:
    """One aggregate per column: with columns of fixed width that is a hash aggregation (a struct would be sorted).

    Among rows of equal order every column comes from the same row, because all of them see the rows in one sequence.  A row without
    a sequence number stays only where its group has none with one.
    """
    rest = [c for c in df.columns if c not in on]
    unnumbered = F.lit(float("inf") * side) if dict(df.dtypes)[order] in ("double", "float") else F.lit(side * (2**63 - 1))
    place = F.coalesce(F.col(order), unnumbered)
    kept = df.groupBy(*on).agg(*[pick(c, place).alias(f"_kept_{c}") for c in rest])
    return kept.select(*[F.col(c) if c in on else F.col(f"_kept_{c}").alias(c) for c in df.columns])


def spread_duplicates(
    df: DataFrame, by: Sequence[str] = ("pump_serial",), order: str = "seq_num", block: int = 1_000_000
) -> DataFrame:
    """The n-th row of one time gets ``n - 1`` microseconds more, in sequence order.

    Rows of one (device, time) are numbered within blocks of sequence numbers, so even a time shared by a very large
    number of rows is numbered by many tasks.
    """
    keys = [*by, "ts"]
    tiled = df.withColumn(tiles.TILE, tg.int_div(F.col(order), block))
    carried = tiles.with_carry(tiled, {"_before": tiles.Running(F.lit(1))}, by=keys)
    position = F.row_number().over(tiles.in_tile(keys, [order])) - 1 + F.col("_before")
    return carried.withColumn("ts", F.timestamp_micros(tg.micros(F.col("ts")) + position)).drop("_before", tiles.TILE)


def time_is_valid(ts: Column, now: dt.datetime) -> Column:
    """P10: at most 20 years old and at most 30 days ahead of ``now``."""
    low, high = now - dt.timedelta(days=7300), now + dt.timedelta(days=30)
    return F.coalesce(ts.between(F.lit(low), F.lit(high)), F.lit(False))


def lacks_value(stream: Column, value: Column) -> Column:
    """A known stream without its value."""
    return stream.isin("cgm", "basal", "bolus") & value.isNull()


def value_in_range(stream: Column, value: Column, ranges: Ranges = Ranges()) -> Column:
    """Range of the value by stream; other streams have no range."""
    return (
        F.when(stream == "cgm", value.between(*ranges.bg_clip))
        .when(stream == "basal", value.between(0.0, ranges.basal_max))
        .when(stream == "bolus", value.between(0.0, ranges.bolus_max))
        .otherwise(F.lit(True))
    )


def with_reject_reason(df: DataFrame, now: dt.datetime, ranges: Ranges = Ranges()) -> DataFrame:
    """First failed rule of an event, null for a good one."""
    stream, value = F.col("stream"), F.col("value")
    reason = (
        F.when(~time_is_valid(F.col("ts"), now), "invalid_timestamp")
        .when(lacks_value(stream, value), "null_value")
        .when(~F.coalesce(value_in_range(stream, value, ranges), F.lit(False)), "out_of_range")
    )
    return df.withColumn("reject_reason", reason)


def reject_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(F.coalesce("reject_reason", F.lit("valid")).alias("outcome")).agg(F.count(F.lit(1)).alias("n_events"))


def validate_events(df: DataFrame, now: dt.datetime, ranges: Ranges = Ranges()) -> tuple[DataFrame, DataFrame]:
    """First of each duplicate, valid times, values in range; and a one-row report."""
    unique = dedup_first(df, ["pump_serial", "ts", "stream"])
    timed = time_is_valid(F.col("ts"), now)
    ranged = F.coalesce(value_in_range(F.col("stream"), F.col("value"), ranges), F.lit(False))
    valid = unique.filter(timed & ranged)
    before = df.agg(F.count(F.lit(1)).alias("original_count"))
    after = unique.agg(
        F.count(F.lit(1)).alias("unique_count"),
        F.count_if(~timed).alias("invalid_timestamps"),
        F.count_if(timed & ~ranged).alias("out_of_range"),
        F.count_if(timed & ranged).alias("final_count"),
    )
    # one row joined to one row
    return valid, before.withColumn("_k", F.lit(1)).join(after.withColumn("_k", F.lit(1)), "_k").drop("_k")


def null_out_of_range(col: str, low: float, high: float) -> Column:
    """P15."""
    return F.when(F.col(col).between(low, high), F.col(col))


def outlier_flags(grid: DataFrame, ranges: Ranges = Ranges(), bounds: tuple[float, float] | None = None) -> DataFrame:
    """Originals kept, hard clip, anomaly flags, and basal rates more than 3 standard deviations off after clipping."""
    low, high = bounds or ranges.bg_clip_monthly
    bg, basal = F.col("bg"), F.col("basal_rate")
    clipped = grid.withColumns(
        {
            "bg_original": bg,
            "basal_original": basal,
            "bg_anomaly_flag": F.coalesce((bg < low) | (bg > high), F.lit(False)).cast("int"),
            "basal_anomaly_flag": F.coalesce((basal < 0.0) | (basal > ranges.basal_max), F.lit(False)).cast("int"),
            "bg": F.when(bg.isNotNull(), F.greatest(F.least(bg, F.lit(high)), F.lit(low))),
            "basal_rate": F.when(basal.isNotNull(), F.greatest(F.least(basal, F.lit(ranges.basal_max)), F.lit(0.0))),
        }
    )
    stats = clipped.groupBy(*KEYS).agg(F.avg("basal_rate").alias("_mean"), F.stddev_samp("basal_rate").alias("_std"))
    joined = tiles.lookup(clipped, stats, KEYS, salt_by=["ts"])
    z = F.abs((F.col("basal_rate") - F.col("_mean")) / F.when(F.col("_std") > 0, F.col("_std")))
    return joined.withColumn("basal_statistical_outlier", F.coalesce(z > 3, F.lit(False)).cast("int")).drop("_mean", "_std")


def to_utc(ts: Column, zone: str) -> Column:
    """P20: local wall clock of ``zone`` to UTC; a time without zone is UTC already (``zone='UTC'``)."""
    return F.to_utc_timestamp(ts, zone)


def from_utc(ts: Column, zone: str) -> Column:
    return F.from_utc_timestamp(ts, zone)


def parse_date(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Any ISO form (space or T, fraction, offset), else the first format that fits, null when none does."""
    iso = F.when(F.trim(text).rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(F.trim(text)))
    return F.coalesce(iso, *[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def name_contains(name: Column, wanted: Sequence[str]) -> Column:
    """P22."""
    return F.exists(F.array(*[F.lit(w) for w in wanted]), lambda w: F.contains(name, w))


def in_range(df: DataFrame, start: str, end: str) -> DataFrame:
    """Plain bounds on ``ts``, so the scan can prune."""
    return df.filter((F.col("ts") >= F.lit(start).cast("timestamp")) & (F.col("ts") <= F.lit(end).cast("timestamp")))


def since_last_sync(df: DataFrame, sync: DataFrame) -> DataFrame:
    """P23 incremental: only rows after the last successful sync of their device (all rows of a new device)."""
    joined = tiles.lookup(df, sync.select(*KEYS, "last_successful_sync"), KEYS, salt_by=["ts"])
    return joined.filter(F.col("last_successful_sync").isNull() | (F.col("ts") > F.col("last_successful_sync"))).drop(
        "last_successful_sync"
    )


def bitmask_names(mask: Column, names: Sequence[str]) -> Column:
    """Names of the set bits, lowest bit first."""
    return F.filter(
        F.array(*[F.when(F.getbit(mask, F.lit(i)) == 1, F.lit(n)) for i, n in enumerate(names)]), lambda x: x.isNotNull()
    )


def ratio(raw: Column, factor: float) -> Column:
    return raw * F.lit(factor)


def battery_percent(msb: Column, lsb: Column) -> Column:
    return (F.lit(256) * (msb - 14) + lsb) / F.lit(3.0 * 256)


def decode_codes(df: DataFrame, code: str, codes: DataFrame, name: str) -> DataFrame:
    """Enum or dictionary text of a code; unknown codes keep null."""
    return df.join(codes.select(F.col("code").alias(code), F.col("label").alias(name)), code, "left")


def activity(span: DataFrame, now: dt.datetime) -> DataFrame:
    """Status by the age of the last event and days covered, from ``first_event`` and ``last_event``."""
    age = tg.int_div(tg.micros(F.lit(now)) - tg.micros(F.col("last_event")), 86400 * tg.MICROS)
    days = tg.int_div(tg.micros(F.col("last_event")) - tg.micros(F.col("first_event")), 86400 * tg.MICROS) + 1
    status = (
        F.when(F.col("last_event").isNull(), "Unknown")
        .when(age <= 1, "Active (current)")
        .when(age <= 7, "Recently active")
        .when(age <= 30, "Inactive (recent)")
        .otherwise("Inactive (old)")
    )
    return span.withColumns({"duration_days": days, "status": status})


def sync_range(span: DataFrame, max_days: int | None = None) -> DataFrame:
    """The whole span, or its last ``max_days``."""
    start = F.col("first_event")
    if max_days is not None:
        late = tg.shift(F.col("last_event"), -max_days * 86400)
        days = tg.int_div(tg.micros(F.col("last_event")) - tg.micros(start), 86400 * tg.MICROS)
        start = F.when(days > max_days, late).otherwise(start)
    return span.select(*KEYS, start.alias("sync_start"), F.col("last_event").alias("sync_end"))


def column_checks(df: DataFrame, required: Sequence[str], name: str = "schema") -> DataFrame:
    """One row per required column with its status and the number of non-null values."""
    have = set(df.columns)
    counts = df.agg(*[(F.count(c) if c in have else F.count(F.lit(None))).alias(f"n{i}") for i, c in enumerate(required)])
    rows = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.lit(c).alias("column_name"),
            F.lit("PASS" if c in have else "FAIL").alias("status"),
            F.lit("LOW" if c in have else "CRITICAL").alias("severity"),
            F.col(f"n{i}").alias("n_present"),
        )
        for i, c in enumerate(required)
    ]
    return counts.select(F.inline(F.array(*rows)))


def capped_difference(pred: Column, target: float, divisor: float, offset: Column, cap: float) -> Column:
    """``max(0, (pred - target) / divisor) - offset``, kept in [0, cap].  Arithmetic only, never dosing advice."""
    raw = F.greatest((pred - F.lit(target)) / F.lit(divisor), F.lit(0.0)) - offset
    return F.greatest(F.least(raw, F.lit(cap)), F.lit(0.0))


def unpivot_streams(grid: DataFrame) -> DataFrame:
    """A merged grid back to long events; absent readings and zero boluses are no events."""
    long = grid.select(
        *KEYS,
        "ts",
        F.expr("stack(3, 'cgm', bg, 'basal', basal_rate, 'bolus', bolus_dose) AS (stream, value)"),
    )
    return long.filter(F.col("value").isNotNull() & ((F.col("stream") != "bolus") | (F.col("value") > 0)))


def model_frame(df: DataFrame, features: Sequence[str], target: str = "bg") -> DataFrame:
    """Every feature present (absent columns are 0), nulls are 0, target of the same row."""
    cols = [
        (F.coalesce(F.col(f).cast("double"), F.lit(0.0)) if f in df.columns else F.lit(0.0)).alias(f) for f in features
    ]
    return df.select(*KEYS, "ts", *cols, F.coalesce(F.col(target), F.lit(0.0)).alias("target"))


def job_rates(jobs: DataFrame) -> DataFrame:
    """Records and megabytes per second, and the compression ratio where a compressed size is known."""
    seconds = F.col("total_duration_seconds")
    cols = {
        "records_per_second": F.try_divide(F.col("total_records").cast("double"), seconds),
        "mb_per_second": F.try_divide(F.col("data_size_mb"), seconds),
    }
    if "compressed_size_mb" in jobs.columns:
        cols["compression_ratio"] = F.try_divide(F.col("data_size_mb"), F.col("compressed_size_mb"))
    return jobs.withColumns(cols)


def stream_frame(df: DataFrame, time_col: str, value_col: str, out_col: str) -> DataFrame:
    """Two columns renamed, without null times or values, last of each duplicate time."""
    two = df.select(*KEYS, F.col(time_col).alias("ts"), F.col(value_col).alias(out_col), "seq_num")
    return dedup_last(two.filter(F.col("ts").isNotNull() & F.col(out_col).isNotNull()), [*KEYS, "ts"]).drop("seq_num")
