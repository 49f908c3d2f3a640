"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # HotSpot leaves larger methods to the interpreter; past this size Spark compiles the expressions one by one instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # 96-bit times, the default, are an object per value to write and to read
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # sessions are merged map-side before the shuffle, so a busy device sends sessions, not events
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on (UTC clock, adaptive execution)."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: str = "8", name: str = "tidegrid", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TIDEGRID_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, the folder every executor can reach.

    A machine-local folder is used only where that setting is absent *and* the session is local, as in tests.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = os.path.join(tempfile.gettempdir(), "tidegrid-scratch")
    return f"{base.rstrip('/')}/tidegrid-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove every table this application staged.  Call it when no result that was read from them is needed any more;
    tables of applications that ended without it can be removed by their folder."""
    folder = scratch_dir(spark, "x").rsplit("/", 1)[0]
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, label: str, lean: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives the loss of executors.

    With ``lean`` the shuffle files behind it go when the write is done, not when the driver happens to collect its garbage.
    """
    path = scratch_dir(df.sparkSession, label)
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP)
    if lean:
        conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if lean:
            conf.set(SHUFFLE_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)
