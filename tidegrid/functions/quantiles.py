"""Exact interpolated percentiles per key, distributed by ranges of value that hold about equally many values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid import tiles
from tidegrid.session import stage

BUCKETS = 256
BUSY = 50_000


def in_buckets(counts: DataFrame, keys: Sequence[str], buckets: int = BUCKETS, busy: int = BUSY) -> DataFrame:
    """Counted values ``(keys, _v, _n)`` with ``_bucket``, which grows with the value, and the key's ``_total``."""
    keys = list(keys)
    sizes = stage(counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_distinct"), F.sum("_n").alias("_total")), "percentile-sizes")
    large = sizes.filter(F.col("_distinct") > busy).select(*keys)
    shares = [(i + 1) / buckets for i in range(buckets - 1)]
    borders = F.array_distinct(F.percentile_approx("_v", shares, 20 * buckets)).alias("_borders")
    bounds = sizes.join(counts.join(large, keys, "left_semi").groupBy(*keys).agg(borders), keys, "left")
    place = F.when(F.col("_borders").isNull(), 0).otherwise(F.size(F.filter("_borders", lambda b: b < F.col("_v"))))
    return tiles.lookup(counts, bounds, keys, salt_by=["_v"], how="inner").withColumn("_bucket", place)


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: dict[str, float],
    buckets: int = BUCKETS,
    weight: str | None = None,
    busy: int = BUSY,
) -> DataFrame:
    """``probs`` maps an output column to a probability; the result has one row per key with non-null values.

    The built-in ``percentile`` holds every distinct value of a key in one aggregation buffer.  Here equal values are
    counted first.  The counts of a key are sorted whole; a key with more than ``busy`` distinct values is cut into ``buckets`` by
    borders from a mergeable quantile sketch of those values, so buckets are about equal in size however the values lie; counts between
    borders are exact, and only the few buckets that hold a wanted rank are sorted.  ``weight`` names a column of row counts for counted input.
    """
    keys = list(keys)
    counts = (
        df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(
            (F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("_n")
        )
    )
    counts = stage(counts, "percentile-counts").dropna(subset=keys)
    position = {name: F.lit(float(p)) * (F.col("_total") - 1) for name, p in probs.items()}
    sizes = counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_distinct"))
    large = stage(sizes.filter(F.col("_distinct") > busy).select(*keys), "percentile-busy")
    if large.isEmpty():
        ranked = _ranked_whole(counts, keys)
    else:  # at most one such key in ``busy`` counted values
        ranked = _ranked_whole(counts.join(F.broadcast(large), keys, "left_anti"), keys)
        ranked = ranked.unionByName(_ranked_by_bucket(counts.join(F.broadcast(large), keys, "left_semi"), keys, position, buckets, busy))

    def at(rank):
        return F.max(F.when((rank >= F.col("_start")) & (rank < F.col("_start") + F.col("_n")), F.col("_v")))

    picks = [F.first("_total").alias("_total")]
    for name in probs:
        picks += [at(F.floor(position[name])).alias(f"_l_{name}"), at(F.ceil(position[name])).alias(f"_h_{name}")]
    picked = ranked.groupBy(*keys).agg(*picks)
    return picked.select(
        *keys,
        *[
            (
                F.col(f"_l_{n}") + (F.col(f"_h_{n}") - F.col(f"_l_{n}")) * (position[n] - F.floor(position[n]))
            ).alias(n)
            for n in probs
        ],
    )


def _ranked_whole(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Counted values of quiet keys with the number of values below (``_start``) and of all (``_total``), from one sort of each key."""
    below = Window.partitionBy(*keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        *keys, "_v", "_n", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_start"), F.sum("_n").over(Window.partitionBy(*keys)).alias("_total")
    )


def _ranked_by_bucket(counts: DataFrame, keys: list[str], position: dict[str, Column], buckets: int, busy: int) -> DataFrame:
    """The same for busy keys, of which only the buckets that hold a wanted rank are sorted and returned."""
    bucketed = in_buckets(counts, keys, buckets, busy)
    ranks = [f(p) for p in position.values() for f in (F.floor, F.ceil)]
    per_bucket = bucketed.groupBy(*keys, "_bucket").agg(F.sum("_n").alias("_size"), F.first("_total").alias("_total"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    located = per_bucket.withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
    holds = F.lit(False)
    for rank in ranks:
        holds = holds | ((rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_size")))
    wanted = located.filter(holds).select(*keys, "_bucket", "_before")

    inside = Window.partitionBy(*keys, "_bucket").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = bucketed.join(wanted, [*keys, "_bucket"]).withColumn(
        "_start", F.col("_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0))
    )
    return ranked.select(*keys, "_v", "_n", "_start", "_total")
