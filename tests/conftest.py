from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidegrid.session import local_session

START = dt.datetime(2024, 3, 1)
EVENTS = "pump_serial long, ts timestamp, seq_num long, stream string, value double"
GRID = "pump_serial long, ts timestamp, bg double, basal_rate double, bolus_dose double"


@pytest.fixture(scope="session")
def spark():
    os.environ["TZ"] = "UTC"
    os.environ.setdefault("TIDEGRID_DRIVER_MEMORY", "4g")
    session = local_session("4", "tests", shuffle_partitions=4)
    yield session
    session.stop()


def at(minutes: float) -> dt.datetime:
    return START + dt.timedelta(minutes=minutes)


@pytest.fixture(scope="session")
def events(spark):
    """Build canonical events from (device, minute, stream, value) tuples; the position is the sequence number."""

    def make(rows):
        return spark.createDataFrame([(d, at(m), i, s, float(v)) for i, (d, m, s, v) in enumerate(rows)], EVENTS)

    return make


@pytest.fixture(scope="session")
def grid(spark):
    """A five-minute grid from a list of glucose values (None = missing), optionally with basal and bolus lists."""

    def make(bg, basal=None, bolus=None, device=1, start=0.0):
        n = len(bg)
        basal = basal if basal is not None else [1.0] * n
        bolus = bolus if bolus is not None else [0.0] * n
        rows = [
            (device, at(start + 5 * i), None if bg[i] is None else float(bg[i]), None if basal[i] is None else float(basal[i]), float(bolus[i]))
            for i in range(n)
        ]
        return spark.createDataFrame(rows, GRID)

    return make


def ordered(frame, *cols):
    """Rows as tuples in (device, time) order."""
    names = cols or frame.columns
    keys = [c for c in ("pump_serial", "segment_id", "ts") if c in frame.columns]
    return [tuple(r[c] for c in names) for r in frame.orderBy(*keys).collect()]


def one_column(frame, name):
    return [r[0] for r in ordered(frame, name)]
