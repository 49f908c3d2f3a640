"""Training windows, latest window, chronological split, scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid import tiles
from tidegrid.config import GridSpec, SplitRules, WindowSpecParams
from tidegrid.functions import timegrid as tg
from tidegrid.functions.quantiles import exact_percentiles
from tidegrid.tiles import KEYS, TILE


WINDOWS_AT_ONCE = 64


def _field(name: str):
    return lambda row: row[name]


def _repeated(name: str):
    return lambda row: F.array_repeat(row[name], row["_n"])


def sliding_windows(
    grid: DataFrame,
    spec: GridSpec,
    features: Sequence[str],
    target: str = "bg",
    params: WindowSpecParams = WindowSpecParams(),
    by: Sequence[str] = ("pump_serial", "segment_id"),
    until: str | None = None,
) -> DataFrame:
    """Windows of ``lookback + horizon`` consecutive bins that start every ``stride`` bins of a segment.

    A window is dropped when a bin is missing from it, a target is null, or more than the given share of its feature cells is.
    ``until`` names a column for grids that come as stretches of equal rows (``grid.align``): a row then stands for all bins
    from ``ts`` to there.

    Only rows as they come are shuffled and sorted.  A tile and its halo become one row of plain arrays, in which stretches are as long as
    their bins; running counts of nulls tell of a start whether its window counts, and are left out where nothing is null.  A row per picked
    start is then cut from the arrays in generated code, which copies a window and no more.
    """
    step, look, ahead = spec.freq_seconds, params.lookback, params.horizon
    size, names = look + ahead, list(dict.fromkeys([*features, target]))
    step_us, tile_us = step * tg.MICROS, spec.tile_seconds * tg.MICROS
    one_step = F.lit(step_us).cast("bigint")
    starts = tiles.add_tile(grid.select(*by, "ts"), spec.tile_seconds)
    starts = tiles.summarise(starts, by, TILE, {"_from": tiles.Total(F.min("ts"), F.min)})
    last = F.col(until or "ts")
    rows = grid.select(*by, "ts", last.alias("_last"), *[F.col(c).cast("double").alias(c) for c in names])
    reach = F.sequence(tiles.tile_of(tg.shift(F.col("ts"), -size * step), spec.tile_seconds), tiles.tile_of(F.col("_last"), spec.tile_seconds))
    rows = rows.withColumn(TILE, F.explode(reach))
    # the part of a stretch inside the tile and its halo: its first time and its number of bins
    ts, low = tg.micros(F.col("ts")), F.col(TILE) * F.lit(tile_us)
    begin = ts + F.greatest(tg.int_div(low - ts + one_step - 1, step_us), F.lit(0)) * one_step
    end = F.least(tg.micros(F.col("_last")), low + F.lit(tile_us + size * step_us - 1))
    absent = sum((F.col(f).isNull().cast("int") for f in features), F.lit(0))
    rows = rows.select(*by, TILE, begin.alias("_us"), end.alias("_end"), absent.alias("_absent"), F.col(target).isNull().cast("int").alias("_blind"), *names)
    rows = rows.withColumn("_n", tg.int_div(F.col("_end") - F.col("_us"), step_us).cast("int") + 1).drop("_end")
    # the start of the segment reaches a tile as one more row of it; by device and tile, as a constant key would hide the order
    rows = tiles.spread(rows.unionByName(starts, allowMissingColumns=True).dropna(subset=list(by)), by[:1])
    earlier = tiles.in_tile(by, ["_us"]).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({f"{c}_before": F.coalesce(F.sum(F.col(c) * F.col("_n")).over(earlier), F.lit(0)) for c in ("_absent", "_blind")})
    joined = F.lag(F.col("_us") + F.col("_n") * one_step).over(tiles.in_tile(by, ["_us"])) == F.col("_us")
    rows = rows.withColumn("_joined", F.coalesce(joined, F.lit(True)))
    piece = F.struct("_us", "_n", "_absent", "_blind", "_absent_before", "_blind_before", *names)
    packed = rows.groupBy(*by, TILE).agg(
        F.sort_array(F.collect_list(F.when(F.col("_us").isNotNull(), piece))).alias("_rows"),
        F.max(F.col("_absent") + F.col("_blind") > 0).alias("_any_null"),
        F.max("_from").alias("_from"),
        F.min("_joined").alias("_regular"),
    )
    placed = packed.filter(F.col("_from").isNotNull())  # else a halo only

    def bins(each, one) -> Column:
        """An array with an item per bin: ``one`` of a row, or the array ``each`` of a stretch."""
        return F.transform("_rows", one) if until is None else F.flatten(F.transform("_rows", each))

    def counted(c: str) -> Column:
        upto = lambda r, j: r[f"{c}_before"] + r[c] * j
        return F.when(F.col("_any_null"), bins(lambda r: F.transform(F.sequence(F.lit(1), r["_n"]), lambda j: upto(r, j)), lambda r: upto(r, F.lit(1))))

    arrays = placed.select(
        *by, TILE, "_any_null", "_regular", tg.micros(F.col("_from")).alias("_from"),
        bins(lambda r: F.sequence(r["_us"], r["_us"] + (r["_n"] - 1) * one_step, one_step), _field("_us")).alias("_us"),
        *[bins(_repeated(c), _field(c)).alias(f"_{c}") for c in names],
        counted("_absent").alias("_nulls_upto"), counted("_blind").alias("_blind_upto"),
    )

    def counts(i: Column) -> Column:
        at, after = F.get("_us", i), F.get("_us", i + size - 1)
        core = (at >= F.col(TILE) * F.lit(tile_us)) & (at < (F.col(TILE) + 1) * F.lit(tile_us))
        own = sum((F.get(f"_{f}", i).isNull().cast("int") for f in features), F.lit(0))
        nulls = F.get("_nulls_upto", i + look - 1) - F.get("_nulls_upto", i) + own
        blind = F.get("_blind_upto", i + size - 1) - F.get("_blind_upto", i + look - 1)
        seen = ~F.col("_any_null") | ((nulls <= params.max_null_share * look * len(features)) & (blind == 0))
        on_stride = F.pmod(tg.int_div(at - F.col("_from"), step_us), F.lit(params.stride)) == 0
        return on_stride & core & (tg.int_div(after - at, step_us) == size - 1) & seen

    # bins without a hole: only every stride-th is asked
    first = F.pmod(tg.int_div(F.col("_from") - F.get("_us", F.lit(0)), step_us), F.lit(params.stride)).cast("int")
    first, each = (F.when(F.col("_regular"), x).otherwise(other) for x, other in ((first, F.lit(0)), (F.lit(params.stride), F.lit(1))))
    at = F.when(F.size("_us") >= first + size, F.filter(F.sequence(first, F.size("_us") - size, each), counts))
    starts_here = F.transform("_at", lambda i: F.struct(i.alias("_i")))
    parts = F.transform(
        F.sequence(F.lit(0), tg.int_div((F.size("_at") - 1).cast("bigint"), WINDOWS_AT_ONCE).cast("int")),
        lambda k: F.slice(starts_here, k * WINDOWS_AT_ONCE + 1, F.lit(WINDOWS_AT_ONCE)),
    )
    kept = [*by, "_us", *[f"_{c}" for c in names]]
    # outer, since of a plain explode Spark infers a filter that would make the arrays anew for every bin
    some = arrays.withColumn("_at", F.coalesce(at, F.array().cast("array<int>"))).select(*kept, F.explode_outer(parts).alias("_part"))
    picked = some.select(*kept, F.inline("_part"))
    i = F.col("_i")
    return picked.select(
        *by,
        F.timestamp_micros(F.get("_us", i)).alias("window_start"),
        *[F.slice(f"_{f}", i + 1, F.lit(look)).alias(f) for f in features],
        F.slice(f"_{target}", i + look + 1, F.lit(ahead)).alias("target"),
    )


def latest_window(grid: DataFrame, spec: GridSpec, features: Sequence[str], lookback: int = 288, last: DataFrame | None = None) -> DataFrame:
    """The last ``lookback`` rows of each device as arrays in time order; devices with fewer rows are left out.

    ``last`` may give the last time of every device (``last_ts``) where that is cheaper to get than from ``grid``.
    """
    last = grid.groupBy(*KEYS).agg(F.max("ts").alias("last_ts")) if last is None else last
    joined = tiles.lookup(grid.select(*KEYS, "ts", *features), last, KEYS, salt_by=["ts"], how="inner")
    recent = joined.filter(F.col("ts") > tg.shift(F.col("last_ts"), -lookback * spec.freq_seconds))
    cell = F.struct("ts", *[F.col(c).cast("double").alias(c) for c in features])
    packed = recent.groupBy(*KEYS).agg(F.sort_array(F.collect_list(cell)).alias("rows"))
    full = packed.filter(F.size("rows") == lookback)
    return full.select(
        *KEYS,
        F.col("rows")[0]["ts"].alias("window_start"),
        *[F.transform("rows", _field(f)).alias(f) for f in features],
    )


def chronological_split(
    rows: DataFrame,
    rules: SplitRules = SplitRules(),
    *,
    tile_seconds: int,
    by: Sequence[str] = KEYS,
    order: Sequence[str] = ("ts",),
) -> DataFrame:
    """``subset`` train / validate / test by position in time within each device."""
    numbered = tiles.row_numbers(rows, seconds=tile_seconds, by=by, order=order, number="_rn", count="_n")
    n = F.col("_n")
    upper = rules.train_pct + rules.validate_pct
    if rules.truncate_double:
        train_end = F.floor(n * F.lit(rules.train_pct / 100.0))
        validate_end = F.floor(n * F.lit(upper / 100.0))
    else:
        train_end = tg.int_div(n * rules.train_pct, 100)
        validate_end = tg.int_div(n * upper, 100)
    subset = F.when(F.col("_rn") <= train_end, "train").when(F.col("_rn") <= validate_end, "validate").otherwise("test")
    return numbered.withColumn("subset", subset).drop("_rn", "_n")


def zscore_params(rows: DataFrame, features: Sequence[str], by: Sequence[str] = KEYS) -> DataFrame:
    aggs = [a for f in features for a in (F.avg(f).alias(f"{f}_mean"), F.stddev_samp(f).alias(f"{f}_std"))]
    return rows.groupBy(*by).agg(*aggs)


def zscore(rows: DataFrame, features: Sequence[str], by: Sequence[str] = KEYS, params: DataFrame | None = None) -> DataFrame:
    """(x - mean) / sample deviation per device; a constant feature becomes 0, an all-null one stays null."""
    params = params if params is not None else zscore_params(rows, features, by)
    joined = tiles.lookup(rows, params, by, salt_by=["ts"])
    scaled = {}
    for f in features:
        centred = F.col(f) - F.col(f"{f}_mean")
        scaled[f] = F.when(F.col(f"{f}_std") > 0, centred / F.col(f"{f}_std")).when(F.col(f).isNotNull(), F.lit(0.0))
    return joined.withColumns(scaled).drop(*[f"{f}_{s}" for f in features for s in ("mean", "std")])


def minmax(rows: DataFrame, features: Sequence[str], by: Sequence[str] = KEYS) -> DataFrame:
    """To [0, 1]; a constant feature becomes 0."""
    aggs = [a for f in features for a in (F.min(f).alias(f"{f}_lo"), F.max(f).alias(f"{f}_hi"))]
    joined = tiles.lookup(rows, rows.groupBy(*by).agg(*aggs), by, salt_by=["ts"])
    scaled = {}
    for f in features:
        width = F.col(f"{f}_hi") - F.col(f"{f}_lo")
        scaled[f] = F.when(width > 0, (F.col(f) - F.col(f"{f}_lo")) / width).when(F.col(f).isNotNull(), F.lit(0.0))
    return joined.withColumns(scaled).drop(*[f"{f}_{s}" for f in features for s in ("lo", "hi")])


def robust_params(train: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """N3 fit: median and interquartile range of the non-null training values, one row per (key, feature).

    A zero range becomes 1.  The table is small and is kept as Parquet (N4).
    """
    pairs = ", ".join(f"'{f}', CAST({f} AS DOUBLE)" for f in features)
    long = train.select(*by, F.expr(f"stack({len(features)}, {pairs}) AS (feature, value)"))
    quartiles = exact_percentiles(long, [*by, "feature"], "value", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    width = F.col("q3") - F.col("q1")
    return quartiles.select(*by, "feature", F.col("median").alias("center"), F.when(width == 0, 1.0).otherwise(width).alias("scale"))


def robust_scale(rows: DataFrame, params: DataFrame, features: Sequence[str]) -> DataFrame:
    """N3 apply: null becomes 0 before scaling.  ``params`` has one row per feature, so it is a fixed-size broadcast."""
    wide = params.groupBy().agg(
        *[F.max(F.when(F.col("feature") == f, F.col(p))).alias(f"{f}_{p}") for f in features for p in ("center", "scale")]
    )
    joined = rows.withColumn("_one", F.lit(1)).join(F.broadcast(wide.withColumn("_one", F.lit(1))), "_one").drop("_one")
    scaled: dict[str, Column] = {
        f: (F.coalesce(F.col(f).cast("double"), F.lit(0.0)) - F.col(f"{f}_center")) / F.col(f"{f}_scale") for f in features
    }
    return joined.withColumns(scaled).drop(*[f"{f}_{p}" for f in features for p in ("center", "scale")])


def save_params(params: DataFrame, path: str) -> None:
    """N4."""
    params.write.mode("overwrite").parquet(path)


def load_params(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)
