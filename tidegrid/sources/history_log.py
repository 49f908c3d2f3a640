"""Binary history log: base64 blobs of 26-byte records to typed fields.

Everything is built-in expressions over the blob table: the record split, the big-endian header, the field layout from a
small definition table, sign and IEEE-754 decoding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.operators.events import device_time

RECORD_BYTES = 26
WIDTH = {"u8": 1, "i8": 1, "u16": 2, "i16": 2, "u32": 4, "f32": 4}

# Event id, field, type, absolute byte offset, factor.
FIELD_LAYOUT = (
    (3, "commandedbasalrate", "f32", 10, 1.0),
    (20, "insulindelivered", "f32", 18, 1.0),
    (48, "carbs", "f32", 10, 1.0),
    (81, "dailytotalbasal", "f32", 10, 1.0),
    (81, "batterychargepercentmsb", "u8", 22, 1.0),
    (81, "batterychargepercentlsb", "u8", 23, 1.0),
    (256, "currentglucosedisplayvalue", "u16", 14, 1.0),
    (256, "rate", "i8", 10, 0.1),
    (279, "commandedRate", "u16", 16, 1.0),
    (280, "deliveredTotal", "u16", 22, 1.0),
    (280, "bolusid", "u16", 12, 1.0),
    (372, "currentglucosedisplayvalue", "u16", 14, 1.0),
    (372, "rate", "i16", 10, 0.1),
    (399, "currentglucosedisplayvalue", "u16", 14, 1.0),
    (399, "rate", "i8", 10, 0.1),
    (399, "interval", "u8", 23, 1.0),
)

# Which field of which event feeds a stream, and its unit divisor.
SIGNAL_FIELDS = (
    (3, "commandedbasalrate", "basal", 1.0),
    (20, "insulindelivered", "bolus", 1.0),
    (256, "currentglucosedisplayvalue", "cgm", 1.0),
    (279, "commandedRate", "basal", 1000.0),
    (280, "deliveredTotal", "bolus", 1000.0),
    (372, "currentglucosedisplayvalue", "cgm", 1.0),
    (399, "currentglucosedisplayvalue", "cgm", 1.0),
)


def unsigned(raw: Column) -> Column:
    return F.conv(F.hex(raw), 16, 10).cast("bigint")


def field_layout(spark: SparkSession) -> DataFrame:
    rows = [(i, name, kind, offset, WIDTH[kind], factor) for i, name, kind, offset, factor in FIELD_LAYOUT]
    return spark.createDataFrame(rows, "event_id int, field string, kind string, field_offset int, width int, factor double")


def records(blobs: DataFrame, blob: str = "blob", zone: str = "UTC") -> DataFrame:
    """One row per 26-byte record with its header; an incomplete tail of a blob is dropped."""
    binary = blobs.withColumn("_b", F.unbase64(blob)).drop(blob)
    n = F.call_function("div", F.length("_b").cast("bigint"), F.lit(RECORD_BYTES).cast("bigint")).cast("int")
    split = binary.withColumn("_i", F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1))))
    rows = split.withColumn("record", F.substring("_b", F.col("_i") * RECORD_BYTES + 1, F.lit(RECORD_BYTES))).drop("_b", "_i")
    head = unsigned(F.substring("record", 1, 2))
    raw_time = unsigned(F.substring("record", 3, 4))
    return rows.withColumns(
        {
            "source": F.shiftright(head, 12).cast("int"),
            "event_id": head.bitwiseAND(F.lit(4095)).cast("int"),
            "raw_seconds": raw_time,
            "ts": device_time(raw_time, zone),
            "seq_num": unsigned(F.substring("record", 7, 4)),
            "payload": F.substring("record", 11, 16),
        }
    )


def float32(bits: Column) -> Column:
    """IEEE-754 single from its 32 bits; infinities and NaN become null."""
    sign = F.when(F.shiftright(bits, 31).bitwiseAND(F.lit(1)) == 1, F.lit(-1.0)).otherwise(F.lit(1.0))
    exponent = F.shiftright(bits, 23).bitwiseAND(F.lit(255))
    fraction = bits.bitwiseAND(F.lit(8388607)).cast("double") / F.lit(8388608.0)
    normal = sign * (F.lit(1.0) + fraction) * F.pow(F.lit(2.0), exponent - 127)
    tiny = sign * fraction * F.pow(F.lit(2.0), F.lit(-126))
    return F.when(exponent == 255, F.lit(None).cast("double")).when(exponent == 0, tiny).otherwise(normal)


def fields(recs: DataFrame, layout: DataFrame | None = None) -> DataFrame:
    """Long table of decoded fields; records of an unknown id are kept with a null field.

    The layout is a fixed table of a few rows, so it is broadcast.
    """
    layout = layout if layout is not None else field_layout(recs.sparkSession)
    joined = recs.join(F.broadcast(layout), "event_id", "left")
    part = F.expr("substring(record, field_offset + 1, width)")
    bits = unsigned(part)
    half = F.pow(F.lit(2.0), F.col("width") * 8 - 1).cast("bigint")
    signed = F.when(bits >= half, bits - half * 2).otherwise(bits)
    value = (
        F.when(F.col("kind") == "f32", float32(bits))
        .when(F.col("kind").isin("i8", "i16"), signed.cast("double"))
        .otherwise(bits.cast("double"))
    )
    return joined.withColumn("value", value * F.col("factor")).drop("record", "kind", "field_offset", "width", "factor")


def signal_view(decoded: DataFrame, rate_divisor: float = 1000.0) -> DataFrame:
    """Decoded fields to the canonical events; ``rate_divisor`` is the unit of the delivered basal rate."""
    rows = [(i, f, s, rate_divisor if f == "commandedRate" else d) for i, f, s, d in SIGNAL_FIELDS]
    table = decoded.sparkSession.createDataFrame(rows, "event_id int, field string, stream string, divisor double")
    joined = decoded.join(F.broadcast(table), ["event_id", "field"])
    value = F.col("value") / F.col("divisor")
    keep = (F.col("stream") == "basal") & (value >= 0) | (F.col("stream") != "basal") & (value > 0)
    return joined.filter(keep).select("pump_serial", "ts", "seq_num", "stream", value.alias("value"))


def encode() -> Column:
    """Hex text of one record from ``source, event_id, raw_seconds, seq_num`` and a 32-digit ``payload_hex``."""
    head = F.lpad(F.hex(F.col("source") * 4096 + F.col("event_id")), 4, "0")
    return F.concat(head, F.lpad(F.hex("raw_seconds"), 8, "0"), F.lpad(F.hex("seq_num"), 8, "0"), F.col("payload_hex"))
