"""The canonical long event table ``(pump_serial, ts, seq_num, stream, value)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.session import configure

COLUMNS = ("pump_serial", "ts", "seq_num", "stream", "value")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def labelled_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``events`` with its stream (``unknown`` included) and the value in the unit of the stream."""
    kind, value = F.col("event_type"), F.col("value")
    stream = (
        F.when(kind.isin("view", "signup"), "cgm").when(kind == "click", "basal").when(kind == "purchase", "bolus")
    ).otherwise("unknown")
    scaled = (
        F.when(kind.isin("view", "signup"), value * 2.0).when(kind == "click", value / 50.0).when(kind == "purchase", value / 20.0)
    )
    return read_table(spark, sf_dir, "events").select(
        F.col("user_id").alias("pump_serial"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("seq_num"),
        stream.alias("stream"),
        scaled.alias("value"),
    )


def signal_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three signal streams; glucose and bolus must be positive, a basal rate may be zero."""
    keep = ((F.col("stream") == "basal") & (F.col("value") >= 0)) | (
        F.col("stream").isin("cgm", "bolus") & (F.col("value") > 0)
    )
    return labelled_events(spark, sf_dir).filter(keep)
