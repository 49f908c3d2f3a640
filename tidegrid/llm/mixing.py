"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, target / source size.  Documents are ordered within
their source by (size, hash of the id, id), the expected copies are summed up along that order, one offset in [0, 1) is
added, and a document is emitted once per whole number that its stretch crosses.  Ordering by size keeps the words taken
close to the target: neighbouring documents are about equally long.  The offset of a source is drawn from a small,
fixed set of pseudo-random offsets: the one whose words come nearest to the target.

The running position is a distributed prefix sum: rows (without their texts) are range-partitioned by the order, counted per
partition and source, and the counts are folded; no task sees a whole source.

Targets: sources by code point, null last, weigh 1, 2, 3, repeating, and share all words; a target stops at
``max_copies`` times its source's size and the excess is shared again by weight until none is above.

Defined cases: a null text has size 0; a document of size 0 is ordered like every other; a source without words has target 0
and is taken 0 times; repeated rows count as documents of their own; null ids come first in their group of equal hashes; an empty table
gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.frames import WORD, checked_broadcast, col, fresh
from tidegrid.session import stage

MAX_COPIES = 3
OFFSETS = 32
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """``source, source_size`` -> with ``target``: shares by weight, none above ``max_copies`` times its source.

    Sources that reach their limit first are those with the smallest size per weight; with the sources in that order the
    first one whose limit is not reached fixes the words per weight for all that follow.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weighed = sizes.withColumn("weight", (F.row_number().over(order) - 1) % 3 + 1)
    full = weighed.withColumn("cap", F.col("source_size") * max_copies).withColumn("reach", F.col("cap") / F.col("weight"))
    by_reach = Window.orderBy("reach", F.col("source").isNull(), "source")
    before = by_reach.rowsBetween(Window.unboundedPreceding, -1)
    after = by_reach.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    levels = full.withColumn("level", left / F.sum("weight").over(after))
    level = F.min(F.when(F.col("level") <= F.col("reach"), F.struct("reach", "level"))).over(everything)["level"]
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("weight") * level, F.col("cap").cast("double")))
    return levels.withColumn("target", target).select("source", "source_size", "target")


def hex_fraction(text: Column) -> Column:
    """A number in [0, 1) from the first 32 bits of an MD5."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    max_copies: int = MAX_COPIES,
    offsets: int = OFFSETS,
    seed: str = SEED,
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken``."""
    light = docs.select(col(id_col).alias("doc_id"), col(source_col).alias("source"), word_count(col(text_col)).alias("size"))
    light = light.withColumn("place", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    along = ["source", "size", "place", "doc_id"]
    ranged = light.repartitionByRange(*along).sortWithinPartitions(*along)

    # the running number of a row within its partition; staged, so that it is drawn once
    number = F.monotonically_increasing_id()
    lined = stage(ranged.withColumn("n", number).withColumn("part", F.shiftright("n", 33)).withColumn("line", F.col("n").bitwiseAND((1 << 33) - 1)).drop("n"), "mix-lined")

    pieces = lined.groupBy("source", "part").agg(F.count(F.lit(1)).alias("n"), F.min("line").alias("first_line"), F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = stage(pieces.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first_line")), "mix-pieces")
    targets = stage(source_targets(pieces.groupBy("source").agg(F.sum("words").alias("source_size")), max_copies), "mix-targets")
    draws = [hex_fraction(F.concat(F.lit(f"{seed}/{k}/"), F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")))) for k in range(offsets)]
    known = pieces.alias("p").join(targets.alias("t"), F.expr("p.source <=> t.source"))
    known = known.select("p.source", "p.part", "p.base", "t.source_size", "t.target", F.expr("if(t.source_size > 0, t.target / t.source_size, 0.0D)").alias("rate"))
    known = stage(known.withColumn("draws", F.array(*draws)), "mix-known")

    def placed(known: DataFrame, extra: str) -> DataFrame:
        rows = lined.alias("d").join(checked_broadcast(known).alias("k"), F.expr("d.part = k.part AND d.source <=> k.source"))
        return rows.select("d.doc_id", "d.source", "d.size", "k.source_size", "k.target", "k.rate", f"k.{extra}", (F.col("d.line") + F.col("k.base")).alias("rank"))

    def copies(offset: Column) -> Column:
        return (F.floor((F.col("rank") + 1) * F.col("rate") + offset) - F.floor(F.col("rank") * F.col("rate") + offset)).cast("long")

    taken = [F.sum(copies(F.col("draws")[k]) * F.col("size")).alias(f"taken_{k}") for k in range(offsets)]
    tried = placed(known, "draws").groupBy("source").agg(F.first("target").alias("target"), *taken)
    options = F.array(*[F.struct(F.abs(F.col(f"taken_{k}") - F.col("target")).alias("miss"), F.lit(k).alias("k"), draw.alias("offset")) for k, draw in enumerate(draws)])
    chosen = stage(tried.select("source", F.array_min(options)["offset"].alias("offset")), "mix-offsets")
    # the offset goes to the rows by (source, part), so a source with most rows is no hot key
    known = known.drop("draws").alias("k").join(checked_broadcast(chosen).alias("c"), F.expr("k.source <=> c.source")).select("k.*", "c.offset")
    drawn = placed(stage(known, "mix-drawn"), "offset").withColumn("copies", copies(F.col("offset")))
    return drawn.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    Rows are matched with their copies by (id, source, size); rows that agree in all three are told apart by a number,
    and which of them gets which of their copies does not change what the mix takes of the source.
    """
    the_id, the_source, the_size, the_turn, times = fresh(docs, "_mix_id", "_mix_source", "_mix_size", "_mix_turn", "_mix_copies")
    counts = plan(docs, id_col, text_col, source_col, **options)
    grouped = counts.groupBy(
        F.col("doc_id").alias(the_id), F.col("source").alias(the_source), F.col("size").alias(the_size)
    ).agg(F.count(F.lit(1)).alias("rows"), F.sort_array(F.collect_list("copies")).alias(times))
    grouped = stage(grouped, "mix-copies")
    single = grouped.filter("rows = 1").withColumn(times, F.col(times)[0]).drop("rows")
    several = grouped.filter("rows > 1").drop("rows")
    on = (col(id_col).eqNullSafe(F.col(the_id))) & (col(source_col).eqNullSafe(F.col(the_source))) & (word_count(col(text_col)) == F.col(the_size))
    taken = docs.join(checked_broadcast(single.filter(F.col(times) > 0)), on)
    parts = [taken]
    if not several.isEmpty():
        turn = Window.partitionBy(the_id, the_source, the_size).orderBy(col(text_col))
        again = docs.join(several, on).withColumn(the_turn, F.row_number().over(turn))
        parts.append(again.withColumn(times, F.element_at(F.col(times), F.col(the_turn))).drop(the_turn))
    each = [p.withColumn(the_turn, F.explode(F.expr(f"array_repeat(0, int(`{times}`))"))) for p in parts]
    out = each[0] if len(each) == 1 else each[0].unionByName(each[1])
    return out.select(*[col(c) for c in docs.columns])
