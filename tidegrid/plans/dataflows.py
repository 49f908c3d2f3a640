"""End-to-end dataflows over the operators (Q1-Q15)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from tidegrid import tiles
from tidegrid.config import RAW_TILE_SECONDS, GapRules, GridSpec, Ranges, SplitRules, WindowSpecParams
from tidegrid.functions import timegrid as tg
from tidegrid.operators import constant_runs, events as ev, features, gaps, grid as gr, joins, runs, summary, windows
from tidegrid.quality import checks, sequences as seq
from tidegrid.session import stage
from tidegrid.sources import csv_files, store
from tidegrid.tiles import KEYS, TILE

SEGMENT = ("pump_serial", "segment_id")
SEQUENCE_FEATURES = (
    "bg",
    "basal_rate",
    "bolus_dose",
    "time_since_last_bolus",
    "basal_delta",
    "bg_slope_15min",
    "bg_slope_30min",
)


def device_events(raw: DataFrame) -> DataFrame:
    """Decoded device events to the canonical event table.

    ``raw`` has ``pump_serial, ts, seq_num, name`` and the attributes ``sgv``, ``commandedRate`` (milliunits an hour) and
    ``deliveredTotal`` (milliunits).  Unknown types, times before 2020 and events without a usable value go.
    """
    stream = ev.category(F.col("name"))
    value = (
        F.when(stream == "cgm", ev.glucose_value([F.col("sgv")]))
        .when(stream == "basal", F.when(F.col("commandedRate").isNotNull(), ev.basal_value(F.col("commandedRate"), None, None)))
        .when(stream == "bolus", ev.bolus_value(F.col("deliveredTotal")))
    )
    timed = raw.withColumn("ts", ev.event_time([F.col("ts")])).filter(F.col("ts").isNotNull())
    return ev.drop_early(timed.select(*KEYS, "ts", "seq_num", stream.alias("stream"), value.alias("value"))).filter(F.col("value").isNotNull())


def event_grid(events: DataFrame, spec: GridSpec = GridSpec(pad_seconds=0)) -> DataFrame:
    """Q1: events to the nine standard columns; of events with one device, time and stream the last counts."""
    aligned = gr.align(ev.dedup_last(events), spec, gr.Alignment(with_delta=True), extent_of=events)
    return features.event_grid(aligned, spec)


def bounded_fill_grid(events: DataFrame, spec: GridSpec = GridSpec(pad_seconds=0), fill_edges: bool = True) -> DataFrame:
    """Q2: grid over the glucose extent, bin means, a reading carried for at most 30 minutes, basal carried.

    ``delta_bg`` is taken from that bounded fill; afterwards glucose is carried forward, then backward.
    """
    how = gr.Alignment(
        bg_agg="mean", bg_fill="bounded", bg_fill_seconds=6 * spec.freq_seconds, basal_agg="mean", extent_streams=("cgm",)
    )
    aligned = gr.align(ev.dedup_last(events), spec, how)
    out = features.add_delta(aligned, spec, "bg", "delta_bg", 0.0)
    if fill_edges:
        out = runs.forward_fill(out, spec, "bg", then_back=True)
    return out.withColumns(tg.time_of_day(F.col("ts")))


def label_segments(grid: DataFrame, segments: DataFrame, spec: GridSpec) -> DataFrame:
    """Grid rows between the first and last observation of a segment get its id; rows inside gaps are dropped.

    Segments are cut at tile borders and joined by (device, tile); few segments fit into one tile.  A grid that has its tile column already
    is dealt by it.
    """
    step = spec.freq_seconds
    bounds = segments.select(
        *SEGMENT,
        tg.floor_to(F.col("segment_start"), step).alias("_from"),
        tg.floor_to(F.col("segment_end"), step).alias("_to"),
    )
    cut = bounds.withColumn(
        TILE, F.explode(F.sequence(tiles.tile_of(F.col("_from"), spec.tile_seconds), tiles.tile_of(F.col("_to"), spec.tile_seconds)))
    )
    tiled = grid if TILE in grid.columns else tiles.add_tile(grid, spec.tile_seconds)
    joined = tiled.join(cut, [*KEYS, TILE])
    return joined.filter(F.col("ts").between(F.col("_from"), F.col("_to"))).drop("_from", "_to", TILE)


def observed_segments(events: DataFrame, spec: GridSpec, rules: GapRules = GapRules(), lean: bool = False) -> DataFrame:
    """Segments between observation gaps, kept when they cover enough grid bins.

    With ``lean`` the times are dealt by tile before they are made unique, and the table is written once.
    """
    if lean:
        # rows without a device or a time are in no segment; left out here, both readers of the dealt rows share one shuffle
        known = events.select(*KEYS, "ts").dropna()
        times = tiles.spread(tiles.add_tile(known, RAW_TILE_SECONDS).filter(F.col(TILE).isNotNull())).distinct()
    else:
        times = gaps.observed_times(events)
    table = gaps.segment_table(gaps.with_segments(times, rules), rules, keep_short=True)
    table = stage(table, "observed", lean=True) if lean else table
    step = spec.freq_seconds
    bins = tg.bins_between(tg.floor_to(F.col("segment_end"), step), tg.floor_to(F.col("segment_start"), step), step) + 1
    return table.filter(bins >= rules.min_segment_bins)


def sequence_rows(labelled: DataFrame, spec: GridSpec, rules: GapRules = GapRules(), cap: int = 1440) -> DataFrame:
    """Imputation, masks and derived features of each segment in one tile layout (one shuffle)."""
    limit = rules.max_impute_bins
    step = spec.freq_seconds
    low, high = Ranges().bg_clip

    def build(rows: DataFrame, w: WindowSpec) -> DataFrame:
        rows = runs.with_neighbours(rows, SEGMENT).withColumn("_fill", runs.short_gap_cols(spec, limit)["_fill"])
        value = F.coalesce("bg", "_fill")
        rows = rows.withColumns(
            {
                "mask_bg": F.col("bg").isNull(),
                "mask_label": value.isNull(),
                "bg": F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(high)), F.lit(low))),
            }
        )
        return rows.withColumns(
            {
                "time_since_last_bolus": features.minutes_since_col(w, "bolus_dose", cap),
                "basal_delta": features.delta_col(w, "basal_rate", 1, 0.0),
                "bg_slope_15min": features.slope_col(w, "bg", 3, step),
                "bg_slope_30min": features.slope_col(w, "bg", 6, step),
            }
        ).drop("_fill", *runs.NEIGHBOURS)

    before = max((limit + 1 + 6) * step, cap * 60)
    out = tiles.with_halo(
        labelled, build, seconds=spec.tile_seconds, before=before, after=(limit + 1) * step, by=SEGMENT
    )
    return out.withColumns(tg.time_of_day(F.col("ts")))


def raw_sequences(events: DataFrame, spec: GridSpec, rules: GapRules = GapRules(), repair: bool = True, lean: bool = False) -> DataFrame:
    """Q3 up to scaling: align, repair placeholder runs, cut segments, impute, derive.

    The aligned and the repaired grid are written once to the shared folder: later steps read them several times.  ``lean`` is for events
    about as many as grid points: each step is written once and its shuffle files go before the next, since rows in order take a tenth
    of the disk that shuffled ones do.
    """
    clean = ev.dedup_last(events)
    clean = stage(clean, "clean", lean=True) if lean else clean
    aligned = gr.align(clean, spec, gr.Alignment(basal_agg="last"), lean=lean)
    if repair:
        aligned = stage(aligned.drop(TILE), "aligned", lean)
        flags = ["bg_flagged_fake_100", "bg_100_run_len", "bg_replaced_from_fake", "bg_100_real"]
        aligned = stage(constant_runs.repair_placeholders(aligned, spec).drop(*flags), "repaired")
    labelled = label_segments(aligned, observed_segments(clean, spec, rules, lean), spec)
    return sequence_rows(stage(labelled, "labelled", lean=True) if lean else labelled, spec, rules)


def unified_sequences(
    events: DataFrame, spec: GridSpec = GridSpec(), rules: GapRules = GapRules(), scope: str = "device", method: str = "zscore"
) -> DataFrame:
    """Q3: scaled training sequences.  ``scope`` is ``device`` (default) or ``segment``; masks and time of day stay."""
    rows = stage(raw_sequences(events, spec, rules), "sequences")
    by = KEYS if scope == "device" else SEGMENT
    scale = windows.zscore if method == "zscore" else windows.minmax
    return scale(rows, list(SEQUENCE_FEATURES), by).select(
        *SEGMENT, "ts", *SEQUENCE_FEATURES, "sin_time", "cos_time", "mask_bg", "mask_label"
    )


def validated_sequences(rows: DataFrame, spec: GridSpec) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Q4: validate before scaling; returns kept rows, per-sequence checks, per-device report."""
    checked = seq.sequence_checks(rows, spec)
    accepted = checked.filter("passed").select(*SEGMENT, F.lit(True).alias("_accepted"))
    kept = tiles.attach_group(tiles.add_tile(rows, spec.tile_seconds), accepted, ["segment_id"]).filter("_accepted")
    return kept.drop("_accepted", TILE), checked, seq.sequence_report(checked)


def sequences_from_files(spark, root: str, path: str, spec: GridSpec = GridSpec(), rules: GapRules = GapRules()) -> DataFrame:
    """Q4 from monthly stream files to the sink: complete months, sequences, checks, accepted rows and their metadata.

    Returns the report per device; rows and metadata lie below ``path``.
    """
    files = csv_files.complete_months(csv_files.discover(spark, root)).collect()  # a listing, as it is in the driver anyway
    if not files:
        raise ValueError(f"no month with all three streams below {root}")
    events = None
    for stream in csv_files.ROLE_WORDS:
        own = csv_files.normalise(csv_files.read_stream(spark, sorted(f.path for f in files if f.stream == stream), stream))
        events = own if events is None else events.unionByName(own)
    rows = stage(raw_sequences(stage(events, "file-events"), spec, rules), "sequences")
    kept, _, report = validated_sequences(rows, spec)
    kept = stage(kept, "accepted")
    store.write_sequences(kept, seq.sequence_metadata(kept, spec), path, folders=["month"])
    return report


def gap_aware_grid(
    events: DataFrame, spec: GridSpec = GridSpec(pad_seconds=0), repair: bool = True, extent: Sequence[str] | None = ("cgm",)
) -> DataFrame:
    """Q5: bin means with a bounded fill, repaired, gap-aware imputed, edge filled, with the change recomputed last."""
    how = gr.Alignment(
        bg_agg="mean",
        bg_fill="bounded",
        bg_fill_seconds=6 * spec.freq_seconds,
        basal_agg="mean",
        extent_streams=tuple(extent) if extent else None,
    )
    out = stage(gr.align(ev.dedup_last(events), spec, how), "aligned")
    if repair:
        out = constant_runs.repair_placeholders(out, spec)
        out = stage(out.drop("bg_flagged_fake_100", "bg_100_run_len", "bg_replaced_from_fake", "bg_100_real"), "repaired")
    out = runs.edge_fill(runs.impute_with_flags(out, spec), spec)
    out = features.add_delta(out, spec, "bg", "delta_bg", 0.0)
    return out.withColumns(tg.time_of_day(F.col("ts")))


def organised_grid(events: DataFrame, spec: GridSpec = GridSpec(pad_seconds=0), ranges: Ranges = Ranges(), bg_how: str = "mean") -> DataFrame:
    """Q6 up to the fill: resampled streams, out-of-range values nulled, the fill chain.

    The grid comes sparse first (``grid.align``), with the time-weighted basal rate, and goes into the fill as stretches; only the median of
    the readings, where it is asked for, is joined to its points.
    """
    clean = stage(ev.dedup_last(events), "clean")
    median = bg_how == "median"
    how = gr.Alignment(bg_agg="last" if median else bg_how, basal_agg="weighted", basal_fill="until_last", basal_default=None)
    until = None if median else "_until"
    out = gr.align(clean, spec, how, until=until)
    if median:
        out = gr.join_on_grid(out.drop("bg"), {"bg": gr.bin_median(clean, "cgm", spec)})
    limits = {"bg": ranges.bg_valid, "basal_rate": (0.0, ranges.basal_max_organised), "bolus_dose": (0.0, ranges.bolus_max_organised)}
    valid = {name: ev.null_out_of_range(name, *borders) for name, borders in limits.items()}
    valid["bolus_dose"] = F.coalesce(valid["bolus_dose"], F.lit(0.0))
    return runs.fill_chain(stage(out.withColumns(valid), "organised"), spec, until=until)


def organised_features(filled: DataFrame, spec: GridSpec) -> DataFrame:
    """Q6: calendar, lag, rolling and time-since-dose features in one tile layout."""

    def build(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return rows.withColumns(
            features.lag_cols(w) | features.rolling_cols(w) | {"minutes_since_bolus": features.minutes_since_col(w, "bolus_dose", 999)}
        )

    before = max(23 * spec.freq_seconds, 999 * 60)
    out = tiles.with_halo(filled, build, seconds=spec.tile_seconds, before=before)
    return out.withColumns(tg.calendar(F.col("ts")))


def split_with_gaps(rows: DataFrame, tile_seconds: int, rules: SplitRules = SplitRules(), gap_hours: float = 15.0):
    """Q7: duplicates of overlapping chunks removed, chronological split, gap report, split summary."""
    if "seq_num" in rows.columns:
        unique = ev.dedup_last(rows, [*KEYS, "ts"])
    else:
        # without a sequence the smallest decides where repeated rows differ, so a rerun gives the same
        rest = [c for c in rows.columns if c not in (*KEYS, "ts")]
        unique = rows.groupBy(*KEYS, "ts").agg(F.min(F.struct(*rest)).alias("_r")).select(*KEYS, "ts", "_r.*")
    unique = stage(unique, "unique")
    split = windows.chronological_split(unique, rules, tile_seconds=tile_seconds)
    found = gaps.gap_summary(unique.select(*KEYS, "ts"), gap_hours * 3600, tile_seconds)
    return split, found, summary.split_summary(split)


def training_windows(
    rows: DataFrame, spec: GridSpec, feature_names: Sequence[str], params: WindowSpecParams, rules: SplitRules = SplitRules()
) -> DataFrame:
    """Q8: chronological split, scaler fitted on the training part, windows inside each device, segment and subset.

    Null features are 0 before scaling, but a window is judged by its nulls before that.
    """
    split = stage(windows.chronological_split(rows, rules, tile_seconds=spec.tile_seconds), "split")
    scaler = stage(windows.robust_params(split.filter(F.col("subset") == "train"), feature_names), "scaler")
    cells = windows.sliding_windows(split, spec, feature_names, params=params, by=(*SEGMENT, "subset"))
    pairs = scaler.groupBy().agg(
        *[F.max(F.when(F.col("feature") == f, F.col(p))).alias(f"{f}_{p}") for f in feature_names for p in ("center", "scale")]
    )
    # one row of parameters
    joined = cells.withColumn("_one", F.lit(1)).join(F.broadcast(pairs.withColumn("_one", F.lit(1))), "_one").drop("_one")
    scaled = {f: _scaled_array(f) for f in feature_names}
    return joined.withColumns(scaled).drop(*[f"{f}_{p}" for f in feature_names for p in ("center", "scale")])


def _scaled_array(name: str):
    center, scale = F.col(f"{name}_center"), F.col(f"{name}_scale")
    return F.transform(name, lambda x: (F.coalesce(x, F.lit(0.0)) - center) / scale)


def organised_dataset(events: DataFrame, spec: GridSpec = GridSpec(pad_seconds=0), ranges: Ranges = Ranges(), bg_how: str = "mean") -> DataFrame:
    """Q6: the filled grid is written once; planned as one query, the fill expressions end up inside the feature stage and
    outgrow generated code."""
    return organised_features(stage(organised_grid(events, spec, ranges, bg_how), "organised_filled"), spec)


INFERENCE_FEATURES = ("bg", "basal_rate_clipped", "bolus_dose", "bg_trend_30min", "insulin_on_board", "basal_anomaly_flag")


def inference_windows(grid: DataFrame, spec: GridSpec, scaler: DataFrame | None = None, lookback: int = 288) -> DataFrame:
    """Q9: features of the latest window of each device: clipped basal, trend, decayed dose, carried, scaled.

    Glucose is carried over the whole history; the windowed features are made once, after that.
    """

    def build(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return features.with_insulin_on_board(rows.withColumn("bg_trend_30min", features.delta_col(w, "_read", 6, 0.0)), w, "insulin_on_board")

    filled = runs.forward_fill(grid.withColumn("_read", F.col("bg")), spec, "bg", default=0.0)
    filled = tiles.with_halo(filled, build, seconds=spec.tile_seconds, before=features.IOB_ROWS * spec.freq_seconds).drop("_read")
    filled = filled.withColumns(
        {
            "basal_rate_clipped": F.greatest(F.least("basal_rate", F.lit(25.0)), F.lit(0.0)),
            "basal_anomaly_flag": F.lit(0.0),
        }
    )
    last = grid.groupBy(*KEYS).agg(F.max("ts").alias("last_ts"))
    if scaler is not None:
        filled = windows.robust_scale(filled, scaler, [f for f in INFERENCE_FEATURES if f != "basal_anomaly_flag"])
    return windows.latest_window(filled, spec, INFERENCE_FEATURES, lookback, last)


def score(windows_frame: DataFrame, predict, schema: str) -> DataFrame:
    """Extension point: ``predict`` maps Arrow-fed pandas batches of windows to forecasts (``mapInPandas``)."""
    return windows_frame.mapInPandas(predict, schema=schema)


def validation_run(events: DataFrame, spec: GridSpec, now: dt.datetime, level: str = "comprehensive"):
    """Q10: organise, check, report per device, and compare devices."""
    filled = stage(organised_grid(events, spec), "organised_filled")
    metrics = stage(checks.dataset_metrics(filled, spec, level, now), "metrics")
    found = checks.checks_from_metrics(metrics, level)
    report = stage(checks.validation_report(found, metrics), "report")
    scores = report.select(*KEYS, F.col("overall_score").alias("score"), F.col("cgm_pct").alias("completeness"))
    return found, report, summary.cross_device_stats(scores), summary.ranking(scores)


def monthly_ranges(events: DataFrame, spec: GridSpec, days: int = 30, step: int = 15) -> DataFrame:
    """Q11: grid rows put into overlapping ranges, with outlier flags on the whole device first."""
    flagged = ev.outlier_flags(gr.align(ev.dedup_last(events), spec))
    starts = events.groupBy(*KEYS).agg(F.to_date(F.min("ts")).alias("first_day"))
    return joins.overlapping_ranges(flagged, starts, days, step)


def client_streams(events: DataFrame) -> dict[str, DataFrame]:
    """Q13: the three stream outputs of the client: guarded, unique events by stream."""
    clean = stage(ev.dedup_last(ev.drop_early(events)), "client-events")
    return {stream: clean.filter(F.col("stream") == stream) for stream in ("cgm", "basal", "bolus")}


def client_sequences(events: DataFrame, spec: GridSpec, rules: GapRules = GapRules(), first_only: bool = False) -> DataFrame:
    """Q13: guarded, valued and unique events to sequences; the older form keeps the first sequence of a device."""
    rows = raw_sequences(ev.drop_early(events), spec, rules, repair=False)
    if not first_only:
        return rows
    rows = stage(rows, "client")
    first = rows.groupBy(*KEYS).agg(F.min("segment_id").alias("segment_id")).withColumn("_first", F.lit(True))
    kept = tiles.attach_group(tiles.add_tile(rows, spec.tile_seconds), first, ["segment_id"]).filter("_first")
    return kept.drop("_first", TILE)


def resequenced(merged: DataFrame, spec: GridSpec, rules: GapRules = GapRules(), split: SplitRules = SplitRules()) -> tuple[DataFrame, DataFrame]:
    """Q14: merged files back to streams, sequences again, sequences split in time; rows and summary."""
    long = ev.unpivot_streams(merged).withColumn("seq_num", F.lit(0))
    rows = stage(raw_sequences(long, spec, rules, repair=False, lean=True), "resequenced", lean=True)
    table = rows.groupBy(*SEGMENT).agg(
        F.min("ts").alias("ts"), F.count(F.lit(1)).alias("n_rows"), F.avg(F.col("bg").isNotNull().cast("int")).alias("bg_coverage")
    )
    subsets = windows.chronological_split(table, split, tile_seconds=86400 * 365, order=("ts", "segment_id"))
    labels = subsets.select(*SEGMENT, "subset")
    labelled = tiles.attach_group(tiles.add_tile(rows, spec.tile_seconds), labels, ["segment_id"]).drop(TILE)
    return labelled, subsets.withColumnRenamed("ts", "segment_start")


def newest_files_grid(spark, root: str, spec: GridSpec = GridSpec(pad_seconds=0)) -> DataFrame:
    """Q15: the newest stream file of each device and stream to a regular dataset.

    Of files of one device the path tells the newest; files of several devices are read, and the newest with rows of a device counts.
    The chosen paths go through the driver, as the listing they come from does.
    """
    files = csv_files.discover(spark, root)
    own, shared = files.filter("serial <> ''"), files.filter("serial = ''")
    newest = csv_files.most_recent(own, ("serial", "stream")).select("stream", "path").unionByName(shared.select("stream", "path")).collect()
    frames = []
    for stream in csv_files.ROLE_WORDS:
        paths = sorted(r.path for r in newest if r.stream == stream)
        if paths:
            rows = csv_files.normalise(csv_files.read_stream(spark, paths, stream, files=True))
            frames.append(csv_files.newest_file_rows(stage(rows, "newest-rows")))
    if not frames:
        raise ValueError(f"no stream files below {root}")
    events = frames[0]
    for frame in frames[1:]:
        events = events.unionByName(frame)
    return bounded_fill_grid(events, spec)
