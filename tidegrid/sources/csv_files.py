"""CSV stream files: scan, header lines, role mapping, discovery."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.operators.events import parse_date
from tidegrid.tiles import KEYS

# Columns of the three stream files, the name each value gets, and the word in the file name.
ROLE_COLUMNS = {"cgm": "sgv", "basal": "value", "bolus": "bolus"}
STANDARD_NAMES = {"cgm": "bg", "basal": "basal_rate", "bolus": "bolus_dose"}
ROLE_WORDS = {"cgm": "cgmreading", "basal": "basal", "bolus": "bolus"}

MERGED_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("bg", T.DoubleType()),
        T.StructField("delta_bg", T.DoubleType()),
        T.StructField("basal_rate", T.DoubleType()),
        T.StructField("bolus_dose", T.DoubleType()),
        T.StructField("sin_time", T.DoubleType()),
        T.StructField("cos_time", T.DoubleType()),
        T.StructField("bg_clip_flag", T.IntegerType()),
        T.StructField("bg_missing_flag", T.IntegerType()),
    ]
)


FEW_FILES = 512
COMPRESSED = (".gz", ".bz2", ".zst", ".snappy", ".lz4", ".deflate", ".xz")


def _lines(spark: SparkSession, path) -> DataFrame:
    """Lines with their file and a number that grows along the file (a line is at least a byte long)."""
    raw = spark.read.text(path).withColumnRenamed("value", "_line")
    block = F.col("_metadata.file_block_start")
    in_task = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return raw.select("*", F.col("_metadata.file_path").alias("file_path"), block.alias("_block"), (block + in_task).alias("place"))


def _names(line: str) -> tuple[str, ...]:
    return tuple(x.replace('"', "").strip() for x in line.split(","))


def _first_lines(spark: SparkSession, files: Sequence[str]) -> dict[str, str]:
    """The header line of a few files, read from their beginning; a file without one is left out."""
    jvm, out = spark.sparkContext._jvm, {}
    for file in files:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
        try:
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
            while (line := reader.readLine()) is not None:
                if line.strip() and not line.startswith("#"):
                    out[file] = line
                    break
        finally:
            stream.close()
    return out


def layouts(spark: SparkSession, path) -> dict[tuple[str, ...], list[str]]:
    """The layout catalogue: the files of every sequence of column names, by their header lines.

    Of at most ``FEW_FILES`` plain files the first lines are read directly; of more, or compressed ones, Spark reads the first split of
    each.  The driver gets names and paths, as in any listing.
    """
    files = list(spark.read.text(path).inputFiles())
    if len(files) <= FEW_FILES and not any(f.lower().endswith(COMPRESSED) for f in files):
        first = _first_lines(spark, files)
    else:
        lines = _lines(spark, path).filter(~F.col("_line").startswith("#") & (F.trim("_line") != "") & (F.col("_block") == 0))
        first = {r["file_path"]: r["_header"] for r in lines.groupBy("file_path").agg(F.min_by("_line", "place").alias("_header")).toLocalIterator()}
    found: dict[tuple[str, ...], list[str]] = {}
    for file, line in first.items():
        found.setdefault(_names(line), []).append(file)
    return found


def read_by_name(spark: SparkSession, path, types: dict[str, T.DataType], required: Sequence[str]) -> DataFrame:
    """CSV files whose columns are found by the header line of each file, whatever their order; ``#`` lines are skipped.

    Files of one layout are one native CSV scan that parses only the wanted columns; the layouts are unioned by name.  Adds ``file_path``,
    ``file_time`` (its modification) and ``place``, a number that grows along a file.  A column that a file does not have is null, unless it is required: then
    reading fails.  Columns of partition folders count as well.
    """
    folders = [c for c in spark.read.text(path).columns if c != "value" and c in types]
    found = layouts(spark, path)
    wanted = [r for r in required if r not in folders]
    if bad := [(files[0], names) for names, files in found.items() if not set(wanted) <= set(names)]:
        raise ValueError(f"required columns {wanted} missing: " + "; ".join(f"{file} has {list(names)}" for file, names in bad[:3]))
    parts = [_one_layout(spark, path, files if len(found) > 1 else None, names, types, folders) for names, files in found.items()]
    if not parts:
        added = {"file_path": T.StringType(), "file_time": T.TimestampType(), "place": T.LongType()}
        schema = T.StructType([T.StructField(n, k) for n, k in (types | added).items()])
        return spark.createDataFrame([], schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _one_layout(spark: SparkSession, path, files: list[str] | None, names: Sequence[str], types: dict[str, T.DataType], folders: Sequence[str]) -> DataFrame:
    """The files (all of ``path`` if None) that have the columns ``names``; a name that comes twice is its first column."""
    reader = spark.read.schema(", ".join(f"_c{i} string" for i in range(len(names)))).option("header", True).option("comment", "#")
    if files is not None and folders:
        reader = reader.option("basePath", path)
    raw = reader.csv(path if files is None else files)
    column = {name: F.trim(F.col(f"_c{i}")) for i, name in reversed(list(enumerate(names)))}

    def named(name: str, kind: T.DataType):
        text = F.col(name).cast("string") if name in folders else column.get(name, F.lit(None).cast("string"))
        return (parse_date(text) if isinstance(kind, T.TimestampType) else text.try_cast(kind)).alias(name)

    # a header line repeated further down, as files put together have it, is no row
    again = [F.coalesce(column[n], F.lit("")) == n for n in types if n in column and n not in folders]
    rows = raw if not again else raw.filter(~reduce(lambda a, b: a & b, again))
    place = F.col("_metadata.file_block_start") + F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    file = [F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_modification_time").alias("file_time")]
    return rows.select(*[named(n, k) for n, k in types.items()], *file, place.alias("place"))


def read_merged(spark: SparkSession, path, schema: T.StructType = MERGED_SCHEMA) -> DataFrame:
    """Columns by header name, explicit types (never inferred), times in UTC; a file without a time column fails."""
    types = {f.name: f.dataType for f in schema.fields}
    return read_by_name(spark, path, types, ["timestamp"]).select(*types)


def read_headers(spark: SparkSession, path) -> DataFrame:
    """``# key: value`` lines as one map per file.  Headers stand at the top: only the first split of a file is looked at."""
    lines = _lines(spark, path).filter("_block = 0")
    marked = lines.filter(F.col("_line").startswith("#") & F.col("_line").contains(":"))
    parts = F.split(F.regexp_replace("_line", r"^#\s*", ""), ":", 2)
    pairs = marked.select("file_path", F.trim(parts[0]).alias("key"), F.trim(parts[1]).alias("text"))
    unique = pairs.groupBy("file_path", "key").agg(F.max("text").alias("text"))
    return unique.groupBy("file_path").agg(F.map_from_entries(F.collect_list(F.struct("key", "text"))).alias("header"))


def serial_of(path):
    """The device of a file: the last ``pump_<serial>`` or ``pump=<serial>`` in its path."""
    return F.regexp_extract(path, r"^.*pump(?:_serial)?[_=](\w+?)(?:/|_|\.|$)", 1)


FILE = ("file_path", "file_time")


def read_stream(spark: SparkSession, path, stream: str, serial_type: T.DataType = T.LongType(), files: bool = False) -> DataFrame:
    """S3: stream files (a time and one value column) as ``(pump_serial, created_at, seq_num, value, stream)``.

    The device comes from the path and the sequence from the order in the file, unless the file has such columns.  A
    missing value is 0 except for glucose.  ``files`` adds the file of each row, ``file_path`` and ``file_time``.
    """
    types = {"pump_serial": serial_type, "created_at": T.StringType(), "seq_num": T.LongType(), ROLE_COLUMNS[stream]: T.DoubleType()}
    raw = read_by_name(spark, path, types, ["created_at", ROLE_COLUMNS[stream]])
    value = F.col(ROLE_COLUMNS[stream])
    if stream != "cgm":
        value = F.coalesce(value, F.lit(0.0))
    serial = F.coalesce("pump_serial", serial_of(F.col("file_path")).try_cast(serial_type))
    return raw.select(
        serial.alias("pump_serial"), "created_at", F.coalesce("seq_num", "place").alias("seq_num"), value.alias("value"), F.lit(stream).alias("stream"),
        *(FILE if files else ()),
    )


def normalise(frame: DataFrame) -> DataFrame:
    """Times parsed as UTC, rows without a readable time dropped.  Order is left to whoever needs it."""
    parsed = frame.withColumn("ts", parse_date(F.col("created_at")))
    return parsed.filter(F.col("ts").isNotNull()).select(*KEYS, "ts", "seq_num", "stream", "value", *[c for c in FILE if c in frame.columns])


def reject_counts(frame: DataFrame) -> DataFrame:
    """What ``normalise`` drops: rows without a readable time per device and stream."""
    return frame.filter(parse_date(F.col("created_at")).isNull()).groupBy(*KEYS, "stream").agg(F.count(F.lit(1)).alias("n_rejected"))


def read_streams(spark: SparkSession, root: str, serial_type: T.DataType = T.LongType()) -> DataFrame:
    """S3 + S4: the three streams below ``root`` (directly, or in a folder per device) as one long event table."""
    frames = [normalise(read_stream(spark, f"{root}/{{,*/}}*{word}_*", stream, serial_type)) for stream, word in ROLE_WORDS.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def discover(spark: SparkSession, root: str) -> DataFrame:
    """One row per stream file with its month; only the file listing is used, no content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "modificationTime", "length")
    word = F.regexp_extract("path", r"(cgmreading|basal|bolus)_(\d{6})", 1)
    month = F.regexp_extract("path", r"(cgmreading|basal|bolus)_(\d{6})", 2)
    stream = F.when(word == "cgmreading", "cgm").when(word != "", word)
    named = files.select("path", "modificationTime", "length", stream.alias("stream"), month.alias("month"), serial_of(F.col("path")).alias("serial"))
    return named.filter(F.col("stream").isNotNull())


def complete_months(files: DataFrame) -> DataFrame:
    """Files of the months in which all three streams are present."""
    full = files.groupBy("month").agg(F.count_distinct("stream").alias("_n")).filter(F.col("_n") == 3).select("month")
    return files.join(full, "month", "left_semi")


def most_recent(files: DataFrame, by: Sequence[str] = ("stream",)) -> DataFrame:
    """Newest file of each stream (or of each device and stream); the path decides ties."""
    newest = F.struct("modificationTime", "path")
    return files.groupBy(*by).agg(F.max_by("path", newest).alias("path"), F.max("modificationTime").alias("modificationTime"))


def newest_file_rows(rows: DataFrame) -> DataFrame:
    """S6 for files that hold several devices: of every device and stream the rows of the newest file that has any of them.

    ``rows`` has the file of each row (``read_stream``); the path decides ties, as in ``most_recent``.
    """
    by = [*KEYS, "stream"]
    newest = rows.groupBy(*by).agg(F.max(F.struct("file_time", "file_path"))["file_path"].alias("file_path"))
    same = " AND ".join(f"r.{c} <=> n.{c}" for c in [*by, "file_path"])
    return rows.alias("r").join(newest.alias("n"), F.expr(same), "left_semi").drop(*FILE)


def read_config(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """``{"pumps": [{...}]}`` to one row per device."""
    device = T.StructType([T.StructField("serial", T.StringType()), T.StructField("device_id", T.StringType())])
    schema = T.StructType([T.StructField("pumps", T.ArrayType(device))])
    return spark.read.schema(schema).option("multiLine", multi_line).json(path).select(F.inline("pumps"))
