"""Small helpers shared by the text operators."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.session import stage

BROADCAST_ROWS = 200_000
BATCH_ROWS = 1024
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, as ``--py-files`` would, and keep Arrow batches small.

    The archive is handed to Spark, whose file service brings it to every executor; no executor reads the driver's folder.  Whole texts
    are long rows: Spark's default of 10,000 rows a batch would hold tens of megabytes on both sides of every worker.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="py-files-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Column names near ``wanted`` that ``df`` does not have (names compare without case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col(f"`{name.replace('`', '``')}`")


def checked_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a staged table: counting it is cheap) with a broadcast hint if it has at most ``rows`` rows.

    Beyond that it is left as it is, and Spark joins by shuffling; the result is the same.
    """
    return F.broadcast(df) if df.count() <= rows else df


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def stage_only(df: DataFrame, label: str) -> DataFrame:
    """``stage`` whose shuffle files go when the write is done, not when the driver happens to collect its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        return stage(df, label)
    finally:
        conf.set(SHUFFLE_CLEANUP, before)


def unstage(df: DataFrame) -> None:
    """Remove a table written by ``stage`` that nothing will read again."""
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
