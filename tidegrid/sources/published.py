"""Tables that change by a manifest switch (S12, S17), and a globally sorted sink whose zone map spares readers files.

Writers put rows into a new folder and then publish a manifest that names the folders of the new state.  A reader takes the newest committed manifest:
the table before a write or after it, whatever happens to the writer in between.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid import tiles
from tidegrid.sources.merge_tree import Folder, Manifest
from tidegrid.tiles import KEYS

PLACE = "place"
PLACES = ("accepted", "quarantine")


class Published:
    """A table in folders by ``partitions``; the manifest names the write each partition's rows are from.

    The rows of a folder are spread over files by ``within``, and those of one value of it are neighbours in a file.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, partitions: Sequence[str], within: Sequence[str] = ()):
        self.spark, self.path, self.schema, self.partitions, self.within = spark, path, schema, list(partitions), list(within)
        self.manifest = Manifest(spark, path, "folder string, partition string")

    def _write(self, rows: DataFrame) -> list[tuple[str, str]]:
        month = [F.date_format("ts", "yyyyMM")] if "ts" in rows.columns else []
        folder = f"write-{uuid.uuid4().hex[:12]}"
        spread = rows.select(*self.schema.fieldNames()).repartition(*self.partitions, *self.within, *month)
        if self.within:
            spread = spread.sortWithinPartitions(*self.partitions, *self.within)
        spread.write.partitionBy(*self.partitions).parquet(f"{self.path}/{folder}")
        found = [""]
        for name in self.partitions:
            below = [(at, Folder(self.spark, f"{self.path}/{folder}/{at}").names()) for at in found]
            found = [f"{at}/{n}".strip("/") for at, names in below for n in names if n.startswith(f"{name}=")]
        return [(folder, at) for at in found]

    def entries(self) -> dict[str, list[str]]:
        """The folders of every partition: a listing, as the driver needs it to read the table."""
        held: dict[str, list[str]] = {}
        for r in self.manifest.read().collect():
            held.setdefault(r["partition"], []).append(r["folder"])
        return held

    def write(self, rows: DataFrame, mode: str = "replace") -> int:
        """``replace`` the whole table or the ``touched`` partitions, or ``append``; the number of the new version."""
        new, held = self._write(rows), {} if mode == "replace" else self.entries()
        for folder, at in new:
            held[at] = [*(held.get(at, []) if mode == "append" else []), folder]
        version = self.manifest.latest() + 1
        self.manifest.publish(version, [(folder, at) for at, folders in sorted(held.items()) for folder in folders])
        return version

    def read(self) -> DataFrame:
        """The newest version; partition columns have the types of the schema."""
        by_folder: dict[str, list[str]] = {}
        for at, folders in self.entries().items():
            for folder in folders:
                by_folder.setdefault(folder, []).append(at)
        out = None
        for folder, places in sorted(by_folder.items()):
            base = f"{self.path}/{folder}"
            part = self.spark.read.schema(self.schema).option("basePath", base).parquet(*[f"{base}/{at}" for at in places])
            part = part.select(*self.schema.fieldNames())
            out = part if out is None else out.unionByName(part)
        return self.spark.createDataFrame([], self.schema) if out is None else out


def publish_accepted(rows: DataFrame, verdicts: DataFrame, path: str, by: Sequence[str] = KEYS, folders: Sequence[str] | None = None) -> Published:
    """Batches judged valid are ``accepted``, the others, and those without a verdict, go to ``quarantine``; nothing is deleted.

    The verdict is joined once and the rows are written in one pass, routed by a partition column.  A batch has a folder in its place;
    with many batches ``folders`` names the place alone, and a batch's rows are neighbours in a file.
    """
    judged = verdicts.select(*by, F.coalesce("is_valid", F.lit(False)).alias("_ok")).groupBy(*by).agg(F.bool_and("_ok").alias("_ok"))
    routed = tiles.lookup(rows, judged, list(by), salt_by=[c for c in rows.columns if c not in by] or list(by))
    place = F.when(F.coalesce("_ok", F.lit(False)), PLACES[0]).otherwise(PLACES[1])
    routed = routed.withColumn(PLACE, place).drop("_ok")
    folders = [PLACE, *by] if folders is None else list(folders)
    schema = T.StructType([*rows.schema.fields, T.StructField(PLACE, T.StringType())])
    table = Published(rows.sparkSession, path, schema, folders, [c for c in by if c not in folders])
    table.write(routed)
    return table


class SortedTable:
    """L1 on write: files in the order of (device, time) that do not overlap, and a zone map with the first and last key of each."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str = "pump_serial", time: str = "ts"):
        self.spark, self.path, self.schema, self.key, self.time = spark, path, schema, key, time
        kind = schema[key].dataType.simpleString()
        self.manifest = Manifest(spark, path, f"file string, low_key {kind}, low_ts timestamp, high_key {kind}, high_ts timestamp, n_rows bigint")

    def write(self, rows: DataFrame, files: int | None = None) -> None:
        """Range partitions by key and time, so a device with a third of all rows fills many files; ``files`` defaults to the shuffle partitions."""
        n = files or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        order = [self.key, self.time]
        folder = f"{self.path}/write-{uuid.uuid4().hex[:12]}"
        rows.select(*self.schema.fieldNames()).repartitionByRange(n, *order).sortWithinPartitions(*order).write.parquet(folder)
        written = self.spark.read.schema(self.schema).parquet(folder)
        first, last = F.struct(*order), F.struct(*order)
        zones = written.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(first).alias("_a"), F.max(last).alias("_z"), F.count("*").alias("n_rows"))
        low, high = F.col("_a"), F.col("_z")
        self.manifest.publish(
            self.manifest.latest() + 1,
            zones.select(
                "file", low[self.key].alias("low_key"), low[self.time].alias("low_ts"), high[self.key].alias("high_key"), high[self.time].alias("high_ts"), "n_rows"
            ),
        )

    def _open(self, zones: DataFrame) -> DataFrame:
        files = [r["file"] for r in zones.select("file").collect()]  # paths to read
        return self.spark.read.schema(self.schema).parquet(*files) if files else self.spark.createDataFrame([], self.schema)

    def zones(self) -> DataFrame:
        return self.manifest.read()

    def read(self) -> DataFrame:
        return self._open(self.zones())

    def zones_between(self, start=None, end=None, key=None) -> DataFrame:
        """Files that can hold a row of ``key`` (any if None) from ``start`` to ``end``.

        Within a file keys rise, and times rise within a key; so times alone rule out a file of one device only.
        """
        low = F.lit(start).cast("timestamp") if start is not None else F.lit(None).cast("timestamp")
        high = F.lit(end).cast("timestamp") if end is not None else F.lit(None).cast("timestamp")
        zones = self.zones()
        begins, finishes = F.col("low_key"), F.col("high_key")
        if key is not None:
            zones = zones.filter((begins <= F.lit(key)) & (finishes >= F.lit(key)))
            late = (begins == F.lit(key)) & (F.col("low_ts") > high)
            early = (finishes == F.lit(key)) & (F.col("high_ts") < low)
        else:
            late = begins.eqNullSafe(finishes) & (F.col("low_ts") > high)
            early = begins.eqNullSafe(finishes) & (F.col("high_ts") < low)
        return zones.filter(~(F.coalesce(late, F.lit(False)) | F.coalesce(early, F.lit(False))))

    def between(self, start=None, end=None, key=None) -> DataFrame:
        """The rows of a time range, and of one device if named; other files are not opened."""
        rows = self._open(self.zones_between(start, end, key))
        for ok in (
            None if start is None else F.col(self.time) >= F.lit(start).cast("timestamp"),
            None if end is None else F.col(self.time) <= F.lit(end).cast("timestamp"),
            None if key is None else F.col(self.key) == F.lit(key),
        ):
            rows = rows if ok is None else rows.filter(ok)
        return rows

    def zones_of_latest(self, n: int) -> DataFrame:
        """Files that can hold one of the last ``n`` rows of a device: not those that later files of that device alone leave behind."""
        only = F.col("low_key").eqNullSafe(F.col("high_key"))
        behind = Window.partitionBy("low_key").orderBy(F.col("low_ts").desc(), F.col("high_ts").desc()).rowsBetween(Window.unboundedPreceding, -1)
        later = F.coalesce(F.sum(F.when(only, F.col("n_rows")).otherwise(0)).over(behind), F.lit(0))
        return self.zones().withColumn("_later", later).filter(~(only & (F.col("_later") >= n))).drop("_later")

    def latest(self, n: int) -> DataFrame:
        """Rows among which are the last ``n`` of every device."""
        return self._open(self.zones_of_latest(n))
