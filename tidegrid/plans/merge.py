"""Merging batches and devices."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.operators.events import dedup_last
from tidegrid.operators.summary import device_summary


def merge_batches(batches: Sequence[DataFrame], on: Sequence[str] = ("pump_serial", "ts", "stream")) -> DataFrame:
    """Union, keep the last of each duplicate.  Order is left to the writer (``sortWithinPartitions``) or to L1."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)
    return dedup_last(merged, on)


def concat_halves(first: DataFrame, second: DataFrame, on: Sequence[str] = ("pump_serial", "ts", "stream")) -> DataFrame:
    """Two halves of one range that share their border day."""
    return dedup_last(first.unionByName(second), on)


def merge_devices(frames: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Q12: one dataset of all devices, and its summary per device."""
    tagged = [frame.withColumn("source", F.lit(name)) for name, frame in frames.items()]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return merged, device_summary(merged)
