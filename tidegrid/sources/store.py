"""Parquet and CSV sinks, batch store, fingerprints, (S8-S13, S16, U1); the quality gate is in `published`."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.tiles import KEYS

# File roles and the standard name of each.
ROLES = ("raw_cgm", "raw_basal", "raw_bolus", "merged", "train", "validate", "test")


def union_sources(frames: dict[str, DataFrame]) -> DataFrame:
    """Union by name with a source tag; a column missing in a source is null."""
    tagged = [frame.withColumn("source", F.lit(name)) for name, frame in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def _month():
    return F.date_format("ts", "yyyyMM")


def store_batch(df: DataFrame, path: str, partitions: Sequence[str] = KEYS, folders: bool = True) -> None:
    """Compressed Parquet; a partition is written month by month, so a busy device is no single task and a quiet one
    does not fall into many small files.

    ``folders=False`` is for keys of many values, such as devices: a folder each would cost more than the rows in it.  Rows of a partition
    are then neighbours in one file, sorted, and filters on the key prune by the statistics of its pages.
    """
    spread = df.repartition(*partitions, _month()) if "ts" in df.columns else df
    if folders:
        spread.write.mode("overwrite").option("compression", "gzip").partitionBy(*partitions).parquet(path)
    else:
        spread = spread.sortWithinPartitions(*partitions, *[c for c in ("ts",) if c in df.columns])
        spread.write.mode("overwrite").option("compression", "gzip").parquet(path)


def load_batch(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Partition folders become columns, filters on them prune."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def fingerprint(df: DataFrame, by: Sequence[str] = KEYS) -> DataFrame:
    """Order-insensitive fingerprint and row count per batch.

    The sum beside the exclusive-or does not cancel where a pair of equal rows changes into another pair.
    """
    cols = sorted(c for c in df.columns if c not in by)
    value = F.xxhash64(*cols)
    total = F.sum(value.cast("decimal(38,0)")).cast("string")
    both = F.concat_ws(":", F.hex(F.bit_xor(value)), total).alias("fingerprint")
    return df.groupBy(*by).agg(both, F.count(F.lit(1)).alias("n_rows"))


def verify(stored: DataFrame, expected: DataFrame, by: Sequence[str] = KEYS) -> DataFrame:
    """One row per batch with ``intact``; a batch present on one side only is not intact."""
    a = fingerprint(stored, by).withColumnsRenamed({"fingerprint": "_f", "n_rows": "_n"})
    b = fingerprint(expected, by)
    joined = a.join(b, list(by), "full")
    same = (F.col("_f") == F.col("fingerprint")) & (F.col("_n") == F.col("n_rows"))
    return joined.select(*by, F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce(same, F.lit(False)).alias("intact"))


def standard_name(role: str, serial="pump_serial", month="month"):
    """``pump_<serial>_<month>_<role>.csv`` as a column."""
    if role not in ROLES:
        raise ValueError(f"unknown role {role}")
    return F.concat(F.concat_ws("_", F.lit("pump"), F.col(serial).cast("string"), F.col(month), F.lit(role)), F.lit(".csv"))


def dataset_metadata(df: DataFrame, role: str, by: Sequence[str] = ("pump_serial", "month")) -> DataFrame:
    """What a file header states, one row per output partition."""
    aggregates = [
        F.min("ts").alias("range_start"),
        F.max("ts").alias("range_end"),
        F.count(F.lit(1)).alias("record_count"),
    ]
    if "bg_clip_flag" in df.columns:
        aggregates.append(F.sum("bg_clip_flag").cast("bigint").alias("bg_clipped_count"))
    return df.groupBy(*by).agg(*aggregates).withColumns(
        {
            "file_role": F.lit(role),
            "tz_handling": F.lit("stored_in=UTC"),
            "columns": F.lit(", ".join(df.columns)),
            "file_name": standard_name(role, *by),
        }
    )


def write_dataset(
    df: DataFrame, path: str, role: str, by: Sequence[str] = ("pump_serial", "month"), folders: Sequence[str] | None = None
) -> None:
    """CSV partitions with a header line, and the metadata as a side table.

    ``folders`` (``by`` if None) get folders of their own; the rest of ``by`` stay columns, and their rows neighbours in one file.
    """
    folders = list(by if folders is None else folders)
    _neighbours(df, by, folders, ["ts"]).write.mode("overwrite").option("header", True).partitionBy(*folders).csv(f"{path}/data")
    dataset_metadata(df, role, by).write.mode("overwrite").parquet(f"{path}/metadata")


def _neighbours(df: DataFrame, by: Sequence[str], folders: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of one key ``by`` (and month) in one task, beside each other within their folder, in order."""
    return df.repartition(*by, _month()).sortWithinPartitions(*folders, *[c for c in by if c not in folders], *order)


def _by_folder(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rows of a folder (and month) together, so that a folder gets a file per month and not one per task."""
    return df.repartition(*partitions, *([_month()] if "ts" in df.columns else []))


def append_dataset(df: DataFrame, path: str, partitions: Sequence[str] = KEYS) -> None:
    """Plain append."""
    _by_folder(df, partitions).write.mode("append").partitionBy(*partitions).parquet(path)


def replace_partitions(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """S12, idempotent: only the partitions present in ``df`` are replaced."""
    _by_folder(df, partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def write_sequences(rows: DataFrame, segments: DataFrame, path: str, folders: Sequence[str] = (*KEYS, "month")) -> None:
    """Sequence rows in folders by device and month, sorted by segment and time inside, so that a segment's rows are
    found by the file statistics; one JSON record per sequence beside them.  With many devices ``folders`` names the month alone:
    a device's rows are then neighbours in a file of its month."""
    dated = rows.withColumn("month", _month())
    placed = _neighbours(dated, [*KEYS, "month"], folders, ["segment_id", "ts"])
    placed.write.mode("overwrite").partitionBy(*folders).parquet(f"{path}/rows")
    segments.write.mode("overwrite").json(f"{path}/segments")


def write_split(rows: DataFrame, summary: DataFrame, path: str, folders: Sequence[str] = (*KEYS, "subset")) -> None:
    """S16; with many devices ``folders`` names the subset alone."""
    placed = _neighbours(rows, [*KEYS, "subset"], folders, ["ts"])
    placed.write.mode("overwrite").partitionBy(*folders).parquet(f"{path}/rows")
    summary.write.mode("overwrite").json(f"{path}/summary")
