"""Tables that are written in runs and merged a partition at a time (T-3, T-7), and the manifest that says which runs count.

A batch becomes one *run*: its rows in folders by month and bucket of the key.  The manifest names, for every (month, bucket), the runs
that hold its rows.  Once a partition has more than ``max_runs`` of them, those are merged into one, and only those of the partitions
the batch touched.  So a batch reads and writes what it touches, whatever the length of the history, and a reader opens at most ``max_runs``
runs of ``files`` files each per partition.  A manifest is a numbered folder that counts once Spark has committed it: a reader sees the table
before a batch or after it, and a batch repeated after a failure writes the same folders again or, if published, nothing.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN, MONTH, BUCKET = "_run", "_month", "_bucket"
PLACE = (RUN, MONTH, BUCKET)


class Folder:
    """A folder of the shared file system, through Hadoop's interface (any store that Spark reads)."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path
        self._at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        self._new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self._at)] if self._fs.exists(self._at) else []

    def holds(self, name: str) -> bool:
        return self._fs.exists(self._new(f"{self.path}/{name}"))

    def remove(self, name: str) -> None:
        self._fs.delete(self._new(f"{self.path}/{name}"), True)


class Manifest:
    """Numbered snapshots of a small table, usually of the folders that make up a large one; the highest committed number counts."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, f"{path}/_manifest", schema

    def versions(self) -> list[int]:
        folder = Folder(self.spark, self.path)
        return sorted(int(n) for n in folder.names() if n.isdigit() and folder.holds(f"{n}/_SUCCESS"))

    def latest(self) -> int:
        return max(self.versions(), default=-1)

    def read(self, version: int | None = None) -> DataFrame:
        number = self.latest() if version is None else version
        if number < 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{number:012d}")

    def publish(self, version: int, rows: Iterable[tuple] | DataFrame) -> None:
        frame = rows if isinstance(rows, DataFrame) else self.spark.createDataFrame(list(rows), self.schema)
        frame.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{version:012d}")

    def forget(self, keep: int = 2) -> None:
        """Drop all but the newest ``keep`` snapshots."""
        for number in self.versions()[:-keep]:
            Folder(self.spark, self.path).remove(f"{number:012d}")


class MergeTree:
    """Rows by key, the newest of each key; ``order`` says which of two rows of a run or of two runs is newer (a later run on ties)."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        order: Sequence[str] = (),
        *,
        time: str = "ts",
        by: Sequence[str] = ("pump_serial",),
        buckets: int = 16,
        files: int = 2,
        max_runs: int = 4,
    ):
        self.spark, self.path, self.schema, self.keys, self.order = spark, path, schema, list(keys), list(order)
        self.time, self.by, self.buckets, self.files, self.max_runs = time, list(by), buckets, files, max_runs
        self.manifest = Manifest(spark, path, f"{RUN} string, {MONTH} string, {BUCKET} int")
        self._placed = T.StructType(
            [*schema.fields, T.StructField(RUN, T.StringType()), T.StructField(MONTH, T.StringType()), T.StructField(BUCKET, T.IntegerType())]
        )

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """Add a batch; one that is already published is left out."""
        if self.manifest.latest() >= batch_id:
            return
        month = F.coalesce(F.date_format(self.time, "yyyyMM"), F.lit("none"))
        placed = batch.select(*self.schema.fieldNames()).withColumns({MONTH: month, BUCKET: F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int")})
        touched = self._write(self._newest(placed, []), f"batch-{batch_id:012d}")
        runs = defaultdict(list)
        for r in self.manifest.read().collect():  # folders of the table, a listing that the driver needs to read it
            runs[r[MONTH], r[BUCKET]].append(r[RUN])
        for place in touched:
            runs[place].append(f"batch-{batch_id:012d}")
        full = [p for p in touched if len(runs[p]) > self.max_runs]
        if full:
            merged = f"merge-{batch_id:012d}"
            self._write(self._newest(self._open([(r, *p) for p in full for r in runs[p]]), [RUN]).drop(RUN), merged)
            runs.update({p: [merged] for p in full})
        self.manifest.publish(batch_id, [(r, *p) for p, own in sorted(runs.items()) for r in own])

    def read(self, where: DataFrame | None = None) -> DataFrame:
        """The table, or its partitions named by the months and buckets of ``where``; a partition of one run is read as it is."""
        entries = self.manifest.read()
        if where is not None:
            entries = entries.join(F.broadcast(where.select(MONTH, BUCKET).distinct()), [MONTH, BUCKET], "left_semi").select(*PLACE)
        runs = defaultdict(list)
        for r in entries.collect():
            runs[r[MONTH], r[BUCKET]].append(r[RUN])
        single = self._open([(own[0], *p) for p, own in runs.items() if len(own) == 1]).drop(*PLACE)
        several = self._open([(r, *p) for p, own in runs.items() if len(own) > 1 for r in own])
        return single.unionByName(self._newest(several, [RUN]).drop(*PLACE))

    def places(self, rows: DataFrame) -> DataFrame:
        """Month and bucket of the partitions that ``rows`` (with time and ``by`` columns) belong to."""
        month = F.coalesce(F.date_format(self.time, "yyyyMM"), F.lit("none"))
        return rows.select(month.alias(MONTH), F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int").alias(BUCKET)).distinct()

    def vacuum(self) -> int:
        """Remove runs that neither of the newest two manifests names, and older manifests; the number of runs removed."""
        self.manifest.forget(2)
        named = {r[RUN] for v in self.manifest.versions() for r in self.manifest.read(v).select(RUN).distinct().collect()}
        latest, folder, gone = self.manifest.latest(), Folder(self.spark, self.path), 0
        for name in folder.names():
            run = name.removeprefix(f"{RUN}=")
            if run != name and run not in named and int(run.rsplit("-", 1)[1]) <= latest:
                folder.remove(name)
                gone += 1
        return gone

    def _newest(self, rows: DataFrame, later: list[str]) -> DataFrame:
        """Keys are told apart within months and buckets, so a device with a third of all rows is spread over its keys."""
        # runs by their number: "merge-3" has older rows than "batch-4", whatever their names
        age = [F.substring_index(c, "-", -1).desc() for c in later]
        newest = [*[F.col(c).desc_nulls_last() for c in self.order], *age] or [F.lit(1)]
        rank = F.row_number().over(Window.partitionBy(*self.keys).orderBy(*newest))
        return rows.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")

    def _write(self, rows: DataFrame, run: str) -> list[tuple[str, int]]:
        """Write a run, at most ``files`` files a partition; the partitions it has."""
        piece = F.pmod(F.xxhash64(*self.keys), F.lit(self.files))
        folder = f"{self.path}/{RUN}={run}"
        rows.repartition(MONTH, BUCKET, piece).write.mode("overwrite").partitionBy(MONTH, BUCKET).parquet(folder)
        found = set()
        for month in Folder(self.spark, folder).names():
            if month.startswith(f"{MONTH}="):
                buckets = Folder(self.spark, f"{folder}/{month}").names()
                found |= {(month.split("=", 1)[1], int(b.split("=", 1)[1])) for b in buckets if b.startswith(f"{BUCKET}=")}
        return sorted(found)

    def _open(self, entries: list[tuple[str, str, int]]) -> DataFrame:
        if not entries:
            return self.spark.createDataFrame([], self._placed)
        folders = [f"{self.path}/{RUN}={r}/{MONTH}={m}/{BUCKET}={b}" for r, m, b in entries]
        return self.spark.read.schema(self._placed).option("basePath", self.path).parquet(*folders)
