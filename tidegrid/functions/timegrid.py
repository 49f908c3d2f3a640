"""Timestamp arithmetic as Column expressions (integer microseconds, no Python code per row)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def int_div(a: Column, n: int) -> Column:
    return F.call_function("div", a, F.lit(n).cast("bigint"))


def floor_to(ts: Column, seconds: int) -> Column:
    step = F.lit(seconds * MICROS)
    return F.timestamp_micros(micros(ts) - F.pmod(micros(ts), step))


def ceil_to(ts: Column, seconds: int) -> Column:
    step = F.lit(seconds * MICROS)
    return F.timestamp_micros(micros(ts) + F.pmod(-micros(ts), step))


def round_to(ts: Column, seconds: int) -> Column:
    """Nearest multiple of ``seconds``; a tie goes to the even multiple."""
    step = seconds * MICROS
    part = F.pmod(micros(ts), F.lit(step))
    low = micros(ts) - part
    odd = F.pmod(int_div(low, step), F.lit(2)) == 1
    up = (part * 2 > step) | ((part * 2 == step) & odd)
    return F.timestamp_micros(low + F.when(up, F.lit(step)).otherwise(F.lit(0)))


def shift(ts: Column, seconds: int) -> Column:
    return F.timestamp_micros(micros(ts) + F.lit(int(seconds * MICROS)))


def seconds_between(later: Column, earlier: Column) -> Column:
    return (micros(later) - micros(earlier)) / F.lit(float(MICROS))


def minutes_between(later: Column, earlier: Column) -> Column:
    return (micros(later) - micros(earlier)) / F.lit(60.0 * MICROS)


def bins_between(later: Column, earlier: Column, freq_seconds: int) -> Column:
    """Whole grid steps from ``earlier`` to ``later``."""
    return int_div(micros(later) - micros(earlier), freq_seconds * MICROS)


def valid_year(ts: Column, low: int, high: int) -> Column:
    return F.year(ts).between(low, high)


def time_of_day(ts: Column) -> dict[str, Column]:
    """Cyclic time of day at minute resolution; seconds are ignored."""
    angle = F.lit(2.0 * math.pi) * (F.hour(ts) + F.minute(ts) / F.lit(60.0)) / F.lit(24.0)
    return {"sin_time": F.sin(angle), "cos_time": F.cos(angle)}


def calendar(ts: Column) -> dict[str, Column]:
    """Hour, weekday (Monday = 0) and month, with the cyclic form of hour and weekday."""
    hour, weekday = F.hour(ts), F.weekday(ts)
    two_pi = 2.0 * math.pi
    return {
        "hour": hour,
        "day_of_week": weekday,
        "month": F.month(ts),
        "hour_sin": F.sin(F.lit(two_pi) * hour / F.lit(24.0)),
        "hour_cos": F.cos(F.lit(two_pi) * hour / F.lit(24.0)),
        "day_sin": F.sin(F.lit(two_pi) * weekday / F.lit(7.0)),
        "day_cos": F.cos(F.lit(two_pi) * weekday / F.lit(7.0)),
    }
