"""Query registry: every operator of the engine over the given tables, with its SQL twin where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.config import GridSpec
from tidegrid.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
DIGITS = 6

HOURLY = GridSpec(freq_seconds=3600, pad_seconds=3600, tile_bins=336)
SIX_HOURLY = GridSpec(freq_seconds=21600, pad_seconds=0, tile_bins=40)
DAILY = GridSpec(freq_seconds=86400, pad_seconds=0, tile_bins=20)
FIVE_MINUTES = GridSpec()


def rounded(x: Column) -> Column:
    """Six digits, by way of nine, so that the last bits of a sum do not decide an exact half.

    Whole part and fraction apart, in arithmetic that stays in generated code, by one formula for all sizes.  ``+ 0.0`` turns a negative
    zero into zero.
    """
    size = F.abs(x)
    fraction = size % F.lit(1.0)
    nine = F.floor(fraction * F.lit(1e9) + F.lit(0.5))
    six = F.call_function("div", nine + F.lit(500), F.lit(1000).cast("bigint"))
    return F.signum(x) * (((size - fraction) * F.lit(1e6) + six) / F.lit(1e6)) + F.lit(0.0)


def _tidy_column(field: T.StructField) -> Column:
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return rounded(col.cast("double")).alias(field.name)
    if isinstance(field.dataType, T.TimestampType):
        return col.cast("timestamp_ntz").alias(field.name)
    return col


def tidy(df: DataFrame) -> DataFrame:
    """Comparable output: doubles rounded, times without zone."""
    return df.select(*[_tidy_column(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return tidy(fn(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


# ---- SQL fragments of the twins -------------------------------------------------------------------------------------

LABELLED_SQL = """lab AS (
  SELECT user_id AS pump_serial, ts, event_id AS seq_num,
    CASE WHEN event_type IN ('view','signup') THEN 'cgm' WHEN event_type = 'click' THEN 'basal'
         WHEN event_type = 'purchase' THEN 'bolus' ELSE 'unknown' END AS stream,
    CASE WHEN event_type IN ('view','signup') THEN value * 2.0 WHEN event_type = 'click' THEN value / 50.0
         WHEN event_type = 'purchase' THEN value / 20.0 END AS value
  FROM events)"""

SIG_SQL = (
    LABELLED_SQL
    + """,
sig AS (SELECT * FROM lab WHERE (stream = 'basal' AND value >= 0) OR (stream IN ('cgm','bolus') AND value > 0))"""
)


def floor_sql(ts: str, seconds: int) -> str:
    step = seconds * 1_000_000
    return f"make_timestamp((epoch_us({ts}) // {step}) * {step})"


def ceil_sql(ts: str, seconds: int) -> str:
    step = seconds * 1_000_000
    return f"make_timestamp(((epoch_us({ts}) + {step - 1}) // {step}) * {step})"


def extent_sql(spec: GridSpec, where: str = "true") -> str:
    f, p = spec.freq_seconds, spec.pad_seconds
    low = floor_sql(f"min(ts) - INTERVAL {p} SECOND", f)
    high = ceil_sql(f"max(ts) + INTERVAL {p} SECOND", f)
    return f"""ext AS (SELECT pump_serial, {low} AS grid_start, {high} AS grid_end
  FROM sig WHERE {where} GROUP BY pump_serial),
pts AS (SELECT pump_serial, unnest(generate_series(grid_start, grid_end, INTERVAL {f} SECOND)) AS ts FROM ext)"""


def aligned_sql(
    spec: GridSpec,
    *,
    bg: str = "arg_max(value, ts)",
    basal: str = "asof",
    basal_default: str = "0.0",
    where: str = "true",
) -> str:
    """CTEs ending in ``grid(pump_serial, ts, bg, basal_rate, bolus_dose)``."""
    f = spec.freq_seconds
    basal_bin = ceil_sql("ts", f) if basal == "asof" else floor_sql("ts", f)
    basal_agg = "avg(value)" if basal == "mean" else "arg_max(value, ts)"
    return f"""{SIG_SQL},
{extent_sql(spec, where)},
cg AS (SELECT pump_serial, {floor_sql('ts', f)} AS ts, {bg} AS v FROM sig WHERE stream = 'cgm' GROUP BY 1, 2),
ba AS (SELECT pump_serial, {basal_bin} AS ts, {basal_agg} AS v FROM sig WHERE stream = 'basal' GROUP BY 1, 2),
bo AS (SELECT pump_serial, {floor_sql('ts', f)} AS ts, sum(value) AS v FROM sig WHERE stream = 'bolus' GROUP BY 1, 2),
grid AS (SELECT p.pump_serial, p.ts, cg.v AS bg,
    coalesce(last_value(ba.v IGNORE NULLS) OVER (PARTITION BY p.pump_serial ORDER BY p.ts
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), {basal_default}) AS basal_rate,
    coalesce(bo.v, 0.0) AS bolus_dose
  FROM pts p LEFT JOIN cg ON cg.pump_serial = p.pump_serial AND cg.ts = p.ts
  LEFT JOIN ba ON ba.pump_serial = p.pump_serial AND ba.ts = p.ts
  LEFT JOIN bo ON bo.pump_serial = p.pump_serial AND bo.ts = p.ts)"""


W_SQL = "(PARTITION BY pump_serial ORDER BY ts)"


def r(expr: str, name: str) -> str:
    """The twin of ``rounded``: decimal arithmetic, half away from zero."""
    return f"CAST(round(CAST(({expr}) AS DECIMAL(38, 9)), {DIGITS}) AS DOUBLE) + 0.0 AS {name}"


def sin_cos_sql(ts: str = "ts") -> str:
    angle = f"2 * pi() * (hour({ts}) + minute({ts}) / 60.0) / 24.0"
    return f"{r(f'sin({angle})', 'sin_time')}, {r(f'cos({angle})', 'cos_time')}"
