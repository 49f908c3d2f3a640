"""Structured Streaming forms of the core steps (T-1 to T-8).

All jobs read a growing folder of Parquet files, keep their progress in a checkpoint below the shared folder and run with
``availableNow``, so a restart continues where the last run stopped.  Results go to files, never through the driver.  No
result depends on how many files a batch takes or in which order rows arrive: batches are reduced to mergeable rows, written
idempotently, and merged when read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid import tiles
from tidegrid.functions import timegrid as tg
from tidegrid.operators.events import time_is_valid
from tidegrid.session import stage
from tidegrid.sources.merge_tree import MergeTree
from tidegrid.streaming import state
from tidegrid.tiles import KEYS


def read_files(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet", files_per_batch: int = 1000) -> DataFrame:
    """T-1: every file once."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def run_to_files(stream: DataFrame, path: str, mode: str = "append") -> None:
    """T-1 / T-2: exactly-once file sink; a second run adds only what arrived since."""
    writer = stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", f"{path}/_progress")
    writer.option("path", f"{path}/data").trigger(availableNow=True).start().awaitTermination()


def run_batches(stream: DataFrame, path: str, handle: Callable[[DataFrame, int], None]) -> None:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", f"{path}/_progress")
    writer.trigger(availableNow=True).start().awaitTermination()


def write_batch(frame: DataFrame, path: str, batch_id: int) -> None:
    """T-2: a batch that is repeated after a failure replaces its own folder."""
    frame.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def latest_rows(stream: DataFrame, path: str, **layout: int) -> DataFrame:
    """T-3: keep the last of each (device, time, stream) over all batches.

    A batch is upserted into a merge tree: it writes its own run and merges only the partitions it touches (``sources.merge_tree``).
    """
    table = MergeTree(stream.sparkSession, f"{path}/data", stream.schema, ["pump_serial", "ts", "stream"], ["seq_num"], **layout)
    run_batches(stream, path, table.upsert)
    return table.read()


def run_partials(stream: DataFrame, path: str, partial: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Reduce every batch to mergeable rows in a folder of its own, and return all of them.

    No watermark decides what counts: a row may arrive in any batch, and a batch repeated after a failure replaces its folder.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(partial(batch), f"{path}/data", batch_id)

    run_batches(stream, path, handle)
    return stream.sparkSession.read.parquet(f"{path}/data").drop("batch")


def binned(stream: DataFrame, path: str, bin_text: str = "5 minutes") -> DataFrame:
    """T-4: last reading and dose total per bin; the last value is by time and sequence, not by arrival."""
    kind, order = F.col("stream"), F.struct("ts", "seq_num")

    def partial(batch: DataFrame) -> DataFrame:
        read = kind == "cgm"
        return batch.groupBy(*KEYS, F.window("ts", bin_text).getField("start").alias("bin_ts")).agg(
            F.max_by(F.when(read, F.col("value")), F.when(read, order)).alias("bg"),
            F.max(F.when(read, order)).alias("bg_order"),
            F.sum(F.when(kind == "bolus", F.col("value"))).alias("bolus_dose"),
            F.count(F.lit(1)).alias("n_events"),
        )

    merged = run_partials(stream, path, partial).groupBy(*KEYS, "bin_ts").agg(
        F.max_by("bg", "bg_order").alias("bg"), F.coalesce(F.sum("bolus_dose"), F.lit(0.0)).alias("bolus_dose"), F.sum("n_events").alias("n_events")
    )
    return merged.withColumnRenamed("bin_ts", "ts")


def sessions(stream: DataFrame, path: str, gap: str = "15 hours") -> DataFrame:
    """T-5: segments between gaps longer than ``gap``.

    A batch is reduced to its own segments; segments of all batches are merged where they overlap or lie no further apart than the
    gap, each reaching from its start to its end plus the gap.
    """

    def joined(rows: DataFrame, start: str, end: str, reach: Column, n: Column) -> DataFrame:
        grouped = rows.groupBy(*KEYS, F.session_window(start, reach)).agg(
            F.min(start).alias("segment_start"), F.max(end).alias("segment_end"), F.sum(n).alias("n_rows")
        )
        return grouped.select(*KEYS, "segment_start", "segment_end", "n_rows")

    segments = run_partials(stream, path, lambda batch: joined(batch, "ts", "ts", F.lit(gap), F.lit(1)))
    length = tg.micros(F.col("segment_end")) - tg.micros(F.col("segment_start"))
    reach = F.concat(length.cast("string"), F.lit(f" microseconds {gap}"))
    return joined(segments, "segment_start", "segment_end", reach, F.col("n_rows"))


def sliding(stream: DataFrame, path: str, width: str = "30 days", step: str = "15 days") -> DataFrame:
    """T-6."""

    def partial(batch: DataFrame) -> DataFrame:
        return batch.groupBy(*KEYS, F.window("ts", width, step).getField("start").alias("range_start")).agg(F.count(F.lit(1)).alias("n_events"))

    return run_partials(stream, path, partial).groupBy(*KEYS, "range_start").agg(F.sum("n_events").alias("n_events"))


CARRIED = T.StructType(
    [
        T.StructField("pump_serial", T.LongType()),
        T.StructField(tiles.TILE, T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("seq_num", T.LongType()),
        T.StructField("copy", T.LongType()),
        T.StructField("stream", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("basal_rate", T.DoubleType()),
        T.StructField("dose_us", T.LongType()),
        T.StructField("batch", T.LongType()),
    ]
)


def _resolved(events: DataFrame) -> DataFrame:
    """Rate and last dose at every event from its own tile, and ``copy`` among events of one time and number."""
    order = [F.col("ts"), F.col("seq_num"), F.coalesce("stream", F.lit("")), F.col("value")]
    by = [*KEYS, tiles.TILE]
    upto = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    copy = F.row_number().over(Window.partitionBy(*by, "ts", "seq_num").orderBy(*order[2:])) - 1
    rate = F.last(F.when(F.col("stream") == "basal", F.col("value")), ignorenulls=True).over(upto)
    dose = F.last(F.when((F.col("stream") == "bolus") & (F.col("value") > 0), tg.micros(F.col("ts"))), ignorenulls=True).over(upto)
    return events.withColumns({"copy": copy.cast("bigint"), "basal_rate": rate, "dose_us": dose})


class CarriedState:
    """T-7: at every event the basal rate in force and the time of the last dose, kept up to date batch by batch.

    ``rows`` has every event with what its own tile knows, ``tails`` what every tile hands on; both are merge trees.  A batch reads its
    files, the state of the tiles they touch, and partitions it merges; nothing else of the history.
    """

    def __init__(self, spark: SparkSession, path: str, tile_seconds: int = 86400, keep_ms: int | None = None, **layout: int):
        self.spark, self.path, self.tile_seconds, self.keep_ms = spark, path, tile_seconds, keep_ms
        self.rows = MergeTree(spark, f"{path}/rows", CARRIED, [*KEYS, "ts", "seq_num", "copy"], ["batch"], **layout)
        self.tails = MergeTree(spark, f"{path}/tails", CARRIED, [*KEYS, tiles.TILE], ["batch"], **layout)

    def run(self, stream: DataFrame) -> None:
        """Take in what arrived since the last run."""
        events = stream.select(
            F.col("pump_serial").cast("long").alias("pump_serial"),
            tiles.tile_of(F.col("ts"), self.tile_seconds).cast("long").alias(tiles.TILE),
            tg.micros(F.col("ts")).alias("us"),
            F.coalesce(F.col("seq_num").cast("long"), F.lit(state.NO_NUMBER)).alias("seq_num"),
            "stream",
            F.col("value").cast("double").alias("value"),
        ).filter("us IS NOT NULL")
        mode = "none" if self.keep_ms is None else "processingTime"
        keyed = events.groupBy(*KEYS, tiles.TILE)
        changes = keyed.transformWithState(state.tile_processor(self.keep_ms), state.OUTPUT, "Update", mode)
        before = self.spark.conf.get(state.PROVIDER)
        self.spark.conf.set(state.PROVIDER, state.ROCKSDB)
        try:
            writer = changes.writeStream.outputMode("update").foreachBatch(self._take).option("checkpointLocation", f"{self.path}/_progress")
            writer.trigger(availableNow=True).start().awaitTermination()
        finally:
            self.spark.conf.set(state.PROVIDER, before)

    def _take(self, batch: DataFrame, batch_id: int) -> None:
        start = F.timestamp_micros(F.col(tiles.TILE) * F.lit(self.tile_seconds * tg.MICROS))
        changed = stage(batch, "carry-batch").withColumns({"ts": F.coalesce(F.timestamp_micros("us"), start), "batch": F.lit(batch_id).cast("long")})
        found, tails = changed.filter("us IS NOT NULL"), changed.filter("us IS NULL")
        if self.keep_ms is not None:
            found, tails = self._with_expired(found, tails, batch_id)
        names = CARRIED.fieldNames()
        self.rows.upsert(found.select(*names), batch_id)
        self.tails.upsert(tails.select(*names), batch_id)

    def _with_expired(self, found: DataFrame, tails: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame]:
        """Tiles that lost their state are resolved from the table and the batch; only the partitions of such tiles are read."""
        by = [*KEYS, tiles.TILE]
        new = found.filter("fresh").select(*by, "ts").distinct()
        names = CARRIED.fieldNames()
        stored = self.rows.read(self.rows.places(new)).select(*names).join(new.select(*by).distinct(), by, "left_semi")
        stored = stage(stored.filter(F.col("batch") < batch_id), "carry-expired")
        lost = stored.select(*by).distinct()
        again = _resolved(stored.unionByName(found.join(lost, by, "left_semi").select(*names))).withColumn("batch", F.lit(batch_id).cast("long"))
        again = stage(again, "carry-again")
        last = again.groupBy(*by).agg(
            F.min("ts").alias("ts"), F.max_by("basal_rate", F.when(F.col("basal_rate").isNotNull(), F.struct("ts", "seq_num", "copy"))).alias("basal_rate"),
            F.max("dose_us").alias("dose_us"),
        )
        start = F.timestamp_micros(F.col(tiles.TILE) * F.lit(self.tile_seconds * tg.MICROS))
        nothing = [F.lit(None).cast(CARRIED[n].dataType).alias(n) for n in ("seq_num", "copy", "stream", "value")]
        last = last.select(*by, start.alias("ts"), *nothing, "basal_rate", "dose_us", F.lit(batch_id).cast("long").alias("batch"))
        rows = found.join(lost, by, "left_anti").select(*names).unionByName(again.select(*names))
        return rows, tails.join(lost, by, "left_anti").select(*names).unionByName(last.select(*names))

    def read(self, cap: int = 1440) -> DataFrame:
        """``ts, seq_num, basal_rate, time_since_last_bolus`` of every event."""
        along = Window.partitionBy(*KEYS).orderBy(tiles.TILE).rowsBetween(Window.unboundedPreceding, -1)
        earlier = self.tails.read().select(
            *KEYS, tiles.TILE, F.last("basal_rate", ignorenulls=True).over(along).alias("_rate"), F.last("dose_us", ignorenulls=True).over(along).alias("_dose")
        )
        rows = self.rows.read().join(earlier, [*KEYS, tiles.TILE])
        since = (tg.micros(F.col("ts")) - F.coalesce("dose_us", "_dose")) / F.lit(60.0 * tg.MICROS)
        return rows.select(
            *KEYS, "ts", F.nullif("seq_num", F.lit(state.NO_NUMBER)).alias("seq_num"), F.coalesce("basal_rate", "_rate", F.lit(0.0)).alias("basal_rate"),
            F.coalesce(F.least(since, F.lit(float(cap))), F.lit(float(cap))).alias("time_since_last_bolus"),
        )


def carry_state(stream: DataFrame, path: str, tile_seconds: int = 86400, cap: int = 1440, keep_ms: int | None = None, **layout: int) -> DataFrame:
    """T-7: at every event the basal rate in force and the minutes since the last dose, across batches.

    An event that arrives late changes the state of the events behind it; those, and no others, are written again.  Events without a time
    are left out; of equal times the lower sequence number comes first, a missing one before all.
    """
    table = CarriedState(stream.sparkSession, path, tile_seconds, keep_ms, **layout)
    table.run(stream)
    return table.read(cap)


def guarded(stream: DataFrame, path: str, now: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """T-8: rows whose time is too old or in the future go to a dead-letter folder."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        ok = time_is_valid(F.col("ts"), now)
        write_batch(batch.filter(ok), f"{path}/data", batch_id)
        write_batch(batch.filter(~ok), f"{path}/dead_letter", batch_id)

    run_batches(stream, path, handle)
    read = stream.sparkSession.read
    return read.parquet(f"{path}/data").drop("batch"), read.parquet(f"{path}/dead_letter").drop("batch")
