"""Exact duplicates by progressive refinement: length, then a hash of the prefix, then a hash of the whole text.

Texts are equal when they are identical after replacing every run of ``[\\x20\\x09-\\x0D]`` by one space.  Each round groups
only the rows that still share everything seen so far; the whole text is hashed only for rows whose length and prefix
hash are shared.  Groups are counted by hash aggregation (combined before the shuffle), and the figures return by broadcast or, beyond
a counted number of groups, by a salted join, so that a group with a large part of the rows is read by many tasks.

Defined cases: a null text counts as empty; a null id sorts after every id; of repeated rows (same id, equal text) exactly one
stays; an empty table gives an empty table; other columns, whatever their names, pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.frames import SPACES, checked_broadcast, col, fresh
from tidegrid.session import stage
from tidegrid.tiles import lookup

PREFIX_CHARS = 128


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def text_sha256(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, row_hash, keep_id, group_size, kept``.

    ``row_hash`` (xxhash64 of the normalised text) tells rows of one id apart.  ``keep_id`` is the smallest id of the
    row's group of equal texts.
    """
    text = normalised(col(text_col))
    light = stage(
        docs.select(col(id_col).alias("doc_id"), text.alias("t")).select(
            "doc_id",
            F.length("t").alias("chars"),
            F.xxhash64(F.substring("t", 1, prefix_chars)).alias("prefix_hash"),
            F.xxhash64("t").alias("row_hash"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "dedup-light",
    )
    by_length = stage(light.groupBy("chars").count().filter("count > 1").select("chars"), "dedup-lengths")
    alike = light.join(checked_broadcast(by_length), "chars", "left_semi")
    by_prefix = stage(alike.groupBy("chars", "prefix_hash").count().filter("count > 1").select("chars", "prefix_hash"), "dedup-prefixes")
    alive = stage(alike.join(checked_broadcast(by_prefix), ["chars", "prefix_hash"], "left_semi"), "dedup-alive")

    # the whole content is read for the surviving rows only
    ids = stage(alive.select(F.col("doc_id").alias("alive_id"), F.col("row_hash").alias("alive_hash")).distinct(), "dedup-ids")
    full = (
        docs.select(col(id_col).alias("doc_id"), text.alias("t"))
        .withColumn("row_hash", F.xxhash64("t"))
        .join(checked_broadcast(ids), F.expr("doc_id <=> alive_id AND row_hash = alive_hash"), "left_semi")
        .select("doc_id", "row_hash", F.sha2("t", 256).alias("text_hash"))
        .distinct()
    )
    keyed = stage(
        alive.alias("a")
        .join(full.alias("f"), F.expr("a.doc_id <=> f.doc_id AND a.row_hash = f.row_hash"))
        .select("a.doc_id", "a.chars", "a.row_hash", "a.row", "f.text_hash"),
        "dedup-keyed",
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")
    groups = keyed.groupBy("chars", "text_hash").agg(first, F.count(F.lit(1)).alias("group_size"))
    members = lookup(keyed, groups.filter("group_size > 1"), ["chars", "text_hash"], salt_by=["row"], how="inner").select(
        "doc_id", "row_hash", "row", F.col("first.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept")
    )
    alone = light.join(members.select("row"), "row", "left_anti").select(
        "doc_id", "row_hash", "row", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")
    )
    return members.unionByName(alone).drop("row")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    drop_id, drop_hash, seen = fresh(docs, "_drop_id", "_drop_hash", "_copies")
    verdict = stage(classify(docs, id_col, text_col), "dedup-verdict")
    by_row = verdict.groupBy(F.col("doc_id").alias(drop_id), F.col("row_hash").alias(drop_hash)).agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias(seen)
    )
    row_hash = F.xxhash64(normalised(col(text_col)))
    on = (col(id_col).eqNullSafe(F.col(drop_id))) & (row_hash == F.col(drop_hash))
    dropped = stage(by_row.filter(~F.col("kept")).select(drop_id, drop_hash), "dedup-dropped")
    kept = docs.join(checked_broadcast(dropped), on, "left_anti")
    repeated = stage(by_row.filter(F.col("kept") & (F.col(seen) > 1)).select(drop_id, drop_hash), "dedup-repeated")
    if repeated.isEmpty():
        return kept
    twice = kept.join(checked_broadcast(repeated), on, "left_semi")
    once = kept.join(checked_broadcast(repeated), on, "left_anti")
    return once.unionByName(twice.withColumn(drop_hash, row_hash).dropDuplicates([id_col, drop_hash]).drop(drop_hash))
