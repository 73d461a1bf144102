"""Registered queries: one per operator, over panels that Spark derives from the given tables."""

from pyspark.sql import DataFrame, functions as F

from brimline.functions.calendar import parse_day_first
from brimline.operators import (
    cleaning, features as X, metrics as M, models, scaling, segments, selection, sequences, shared, splits, stations, weights,
)
from brimline.plans import backtest
from brimline.settings import DEFAULT_SEQ_LENS, HORIZONS, LEVEL_SUFFIX, WEATHER_MEASURES
from brimline.sources import panels as P, readers, reshape, writers

SPLIT = "2000-01-01"
BASELINE, WALK_FORWARD = splits.BASELINE, splits.WALK_FORWARD
GRAM_COLUMNS = ("lag_7", "rain_30d", "temp_7d")
DIGITS = {"demand": 2, "rain_x_level": 4}


def _round(df: DataFrame, digits=6, only=None) -> DataFrame:
    names = only or [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(c, DIGITS.get(c, digits)) for c in names})


def _text(c):
    return F.array_join(F.col(c).cast("array<string>"), ",").alias(c)


# --- scans, layouts, cleaning -------------------------------------------------------------------


def _names(df, column):
    """Distinct values that become columns, so they are few."""
    return [r[0] for r in df.select(column).where(f"{column} is not null").distinct().orderBy(column).collect()]


def _wide_flags(spark, sf):
    """Flag panel in the wide daily layout of the input file."""
    flags = _names(P.table(spark, sf, "lineitem"), "l_returnflag")
    wide = P.flag_panel(spark, sf).groupBy("date").pivot("entity", flags).agg(
        F.first("level").alias("level"), F.first("rain").alias("rain"), F.first("temp").alias("temp"))
    return wide.select("date", *[c for f in flags for c in (
        F.col(f"{f}_level").alias(f"{f}{LEVEL_SUFFIX}"),
        F.col(f"{f}_rain").alias(f"prcp_{f}"), F.col(f"{f}_temp").alias(f"tavg_{f}"))])


def csv_scan(spark, sf):
    path = writers.shared_folder(spark)
    writers.write_wide_csv(_wide_flags(spark, sf), path)
    return _round(readers.read_wide_csv(spark, path)).orderBy("date")


def rejected_rows(spark, sf):
    """What cannot be read of a damaged file: dates and numbers overwritten on some days, and lines cut short on others."""
    path, wide = writers.shared_folder(spark), _wide_flags(spark, sf)
    names = [c for c in wide.columns if c != "date"]
    day, date = F.dayofmonth("date"), F.date_format("date", "dd.MM.yyyy")
    broken = {names[0]: F.when(day == 13, F.lit("12,5x")), names[4]: F.when(day == 19, F.lit("none")),
              names[8]: F.when((day == 19) | (day == 13), F.lit("--"))}
    fields = [F.concat(F.lit('"'), F.coalesce(broken.get(c, F.lit(None)), F.col(f"`{c}`").cast("string"), F.lit("")), F.lit('"'))
              for c in names]
    date = F.when(day == 17, F.concat(F.lit("on "), date)).otherwise(date)
    line = F.when(day == 23, date).otherwise(F.concat_ws(",", date, *fields))
    head = spark.createDataFrame([(None, ",".join(["Date", *names]))], "date date, value string")
    lines = head.union(wide.select("date", line.alias("value")))
    lines.coalesce(1).sortWithinPartitions(F.col("date").asc_nulls_first()).select("value").write.text(path)
    good, rejected = readers.split_wide_csv(spark, path)
    kept = good.agg(F.count("date").alias("line")).select("line", F.lit("rows kept").alias("column"), F.lit(None).cast("string").alias("text"))
    return rejected.select("line", "column", "text").union(kept)


def date_parse(spark, sf):
    day = F.col("o_orderdate").cast("date")
    kind = F.col("o_orderkey") % 4
    text = (F.when(kind == 0, F.date_format(day, "dd.MM.yyyy")).when(kind == 1, F.date_format(day, "d/M/yyyy"))
            .when(kind == 2, F.date_format(day, "yyyy-MM-dd")).otherwise(F.concat(F.lit("on "), day.cast("string"))))
    return P.table(spark, sf, "orders").select("o_orderkey", text.alias("date_text")).select(
        "o_orderkey", "date_text", parse_day_first(F.col("date_text")).alias("parsed"))


def _config_text(config):
    return config.select(
        "entity", _text("prod_cols"), _text("weather_stations"), _text("lag_days"), "model",
        _text("seq_lens"), _text("halflives"), "strategy")


def config_scan(spark, sf):
    path = writers.shared_folder(spark)
    writers.write_config(P.region_config(spark, sf), path)
    return _config_text(readers.read_config(spark, path, whole_file=False))


def config_file_scan(spark, sf):
    """Settings as people keep them: one object over many lines."""
    path = writers.shared_folder(spark)
    writers.write_config(P.region_config(spark, sf), path, whole_file=True)
    return _config_text(readers.read_config(spark, path))


def unpivot_long(spark, sf):
    return _round(reshape.unpivot_series(_wide_flags(spark, sf)))


def _station_series(spark, sf, measures=("prcp", "tavg", "tmax", "tmin")):
    rows = [F.struct(F.concat(F.lit(f"{m}_"), F.col("station")).alias("series"), F.col(m).alias("value"))
            for m in measures]
    return P.station_panel(spark, sf).select("date", F.inline(F.array(*rows)))


def pivot_wide(spark, sf):
    series = _station_series(spark, sf, ("prcp",))
    return reshape.pivot_series(series, [f"prcp_{n}" for n in _names(P.table(spark, sf, "nation"), "n_name")])


def series_by_name(spark, sf):
    names = reshape.unpivot_series(_wide_flags(spark, sf)).groupBy("series").agg(F.count("value").alias("n_values"))
    return cleaning.series_by_name(names)


def drop_empty_series(spark, sf):
    measures = ("level", "rain", "temp", "demand", "empty_col")
    long = P.dirty_panel(spark, sf).unpivot(["entity", "date"], list(measures), "series", "value")
    kept = cleaning.drop_empty_series(long, ("entity", "series"))
    return kept.groupBy("entity", "series").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("value").alias("n_values"))


def missing_flags(spark, sf):
    flagged = cleaning.missing_flags(P.dirty_panel(spark, sf), ["rain", "temp"])
    return flagged.select("entity", "date", "rain_missing", "temp_missing")


def fill_zero(spark, sf):
    filled = cleaning.flag_and_fill(P.dirty_panel(spark, sf), ["rain"])
    return filled.select("entity", "date", "rain_missing", "rain")


def cap_level(spark, sf):
    return _round(cleaning.cap_level(P.dirty_panel(spark, sf)).select("entity", "date", "level"))


def bad_level_count(spark, sf):
    return cleaning.bad_levels(P.dirty_panel(spark, sf))


def profile(spark, sf):
    return cleaning.profile(P.dirty_panel(spark, sf))


# --- features -----------------------------------------------------------------------------------


def _clean_dirty(spark, sf):
    return cleaning.cap_level(P.dirty_panel(spark, sf)).drop("empty_col")


def rain_range_sums(spark, sf):
    df = X.rain_sums(P.supplier_panel(spark, sf))
    return _round(df.select("entity", "date", "rain_7d", "rain_30d", "rain_90d"), 2)


def temp_range_mean(spark, sf):
    return _round(X.temp_mean(P.dirty_panel(spark, sf)).select("entity", "date", "temp_7d"))


def lags(spark, sf):
    df = X.lags(X.unique_dates(P.supplier_panel(spark, sf)))
    return _round(df.drop("level", "rain", "temp", "demand"))


def deltas(spark, sf):
    return _round(X.deltas(P.supplier_panel(spark, sf)).drop("level", "rain", "temp", "demand"))


def rolling_means(spark, sf):
    return _round(X.rolling_means(P.supplier_panel(spark, sf)).drop("level", "rain", "temp", "demand"))


def rolling_std(spark, sf):
    return _round(X.rolling_std(P.supplier_panel(spark, sf)).drop("level", "rain", "temp", "demand"))


def rain_x_level(spark, sf):
    df = X.rain_x_level(X.lags(P.supplier_panel(spark, sf), [7]))
    return _round(df.select("entity", "date", "rain_x_level"))


def demand_lag(spark, sf):
    return _round(X.shift_one(P.supplier_panel(spark, sf), ["demand"]).select("entity", "date", "demand"))


def forward_fill(spark, sf):
    df = X.forward_fill(_clean_dirty(spark, sf), ["level", "rain", "temp"])
    return _round(df.select("entity", "date", "level", "rain", "temp"))


def targets(spark, sf):
    df = X.targets(X.forward_fill(_clean_dirty(spark, sf), ["level"]))
    return _round(df.select("entity", "date", *[f"target_{h}" for h in HORIZONS]))


def seasonal(spark, sf):
    return _round(X.add_seasonal(P.supplier_panel(spark, sf).select("entity", "date")))


def _frame(spark, sf, panel=P.flag_panel):
    return X.feature_frame(panel(spark, sf))


def _stored(spark, sf, panel):
    """Numbered feature table, written once: fits and scores read it several times, a few columns each."""
    return writers.materialize(splits.number_rows(_frame(spark, sf, panel), SPLIT))


def feature_frame(spark, sf):
    return _round(_frame(spark, sf))


def feature_frame_dirty(spark, sf):
    """Nulls and bad levels: flags and zero fill first, then features on the raw level, then the fill."""
    clean = cleaning.fill_zero(_clean_dirty(spark, sf), ["rain"])
    return _round(X.feature_frame(clean))


def feature_frame_supplier(spark, sf):
    return _round(_frame(spark, sf, P.supplier_panel))


def feature_frame_segments(spark, sf):
    """The feature table with each series cut into segments, so that a few long series are computed by many tasks."""
    return _round(segments.feature_frame(P.flag_panel(spark, sf), segment_rows=512, part_days=365))


def _known_series(spark, sf):
    own = P.region_panel(spark, sf).select(F.inline(F.array(
        F.struct(F.concat("entity", F.lit(LEVEL_SUFFIX)).alias("series"), F.col("level").alias("value")),
        F.struct(F.lit("demand").alias("series"), F.col("demand").alias("value")))))
    long = _station_series(spark, sf).select("series", "value").unionByName(own)
    return long.groupBy("series").agg(F.count("value").alias("n_values"))


def config_projection(spark, sf):
    config = selection.with_defaults(P.region_config(spark, sf))
    return selection.project_series(config, _known_series(spark, sf)).select(
        "entity", "position", "series", "n_values")


def missing_config_columns(spark, sf):
    config = selection.with_defaults(P.region_config(spark, sf))
    return selection.missing_production(config, _known_series(spark, sf).select("series"))


def station_features(spark, sf):
    config = selection.with_defaults(P.region_config(spark, sf))
    out = stations.station_features(
        P.region_panel(spark, sf).select("entity", "date", "level"),
        stations.station_frame(P.station_panel(spark, sf)), config)
    return _round(out)


# --- ranges and backtests -----------------------------------------------------------------------


def entity_subset(spark, sf):
    """The choice is made among the few names, before the records are grouped."""
    known = P.table(spark, sf, "region").select(F.col("r_name").alias("entity"))
    chosen = selection.choose_entities(known, " EUROPE, ATLANTIS ,AFRICA,ASIA")
    sizes = P.region_panel(spark, sf, chosen).groupBy("entity").agg(F.count(F.lit(1)).alias("n_dates"))
    return sizes.join(chosen, "entity").select("entity", "position", "n_dates")


def config_defaults(spark, sf):
    config = selection.with_defaults(P.region_config(spark, sf))
    return _config_text(config).join(config.select("entity", "requested_strategy"), "entity")


def horizon_config(spark, sf):
    config = selection.with_defaults(P.region_config(spark, sf))
    return selection.horizon_config(config).select("entity", "horizon", "seq_len", _text("lag_days"))


def lag_columns(spark, sf):
    config = selection.with_defaults(P.region_config(spark, sf))
    return selection.lag_columns(selection.horizon_config(config)).select(
        "entity", F.array_join("lag_columns", ",").alias("lag_columns"))


def _sparse_levels(spark, sf):
    return P.supplier_panel(spark, sf).select("entity", "date", F.nullif("level", F.lit(0.0)).alias("level"))


def natural_start(spark, sf):
    return selection.natural_start(_sparse_levels(spark, sf))


def date_bounds(spark, sf):
    panel = writers.materialize(_sparse_levels(spark, sf))
    bounds = selection.date_bounds(panel, 1996, {"S1": "2000-06-30"}, "2001-06-30")
    sizes = selection.limit_dates(panel, bounds).groupBy("entity").agg(F.count(F.lit(1)).alias("n_rows"))
    return bounds.join(sizes, "entity", "left").select(
        "entity", "natural_start", "start_date", "end_date", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def date_bounds_table(spark, sf):
    """Bounds with a table of ends: the last day of each supplier's even orders; suppliers of other numbers take the default."""
    panel = writers.materialize(_sparse_levels(spark, sf))
    even = F.col("l_orderkey") % 2 == 0
    ends = P.table(spark, sf, "lineitem").filter("l_suppkey % 3 > 0").groupBy("l_suppkey").agg(
        F.max(F.when(even, F.col("l_shipdate"))).cast("date").alias("end_date"))
    ends = ends.select(F.concat(F.lit("S"), F.col("l_suppkey")).alias("entity"), F.date_sub("end_date", 200).alias("end_date"))
    return selection.date_bounds(panel, 1996, ends, "1998-01-31")


def _roles(spark, sf, strategies, panel=P.flag_panel, frame=None):
    return backtest.roles(frame if frame is not None else _frame(spark, sf, panel), strategies, SPLIT)


def baseline_split(spark, sf):
    rows = _roles(spark, sf, [BASELINE])
    role = F.when(F.col("train_after").isNotNull(), "train").otherwise("test")
    return rows.select("entity", "date", "horizon", F.date_add("date", F.col("horizon")).alias("target_date"),
                       role.alias("role"))


def folds(spark, sf):
    return splits.walk_forward_folds(P.region_panel(spark, sf), SPLIT)


def fold_rows(spark, sf):
    table = splits.fold_table(_roles(spark, sf, splits.STRATEGIES))
    return table.select(
        "entity", "strategy", "horizon", "seq_len", "fold", "train_rows", "train_samples", "test_rows",
        ((F.col("test_rows") > 0) & splits.enough_train()).alias("usable"))


def strategy_union(spark, sf):
    rows = _roles(spark, sf, splits.STRATEGIES).filter(F.col("test_fold").isNotNull() & splits.has_sequence())
    return rows.select("entity", "date", "strategy", "horizon", "test_fold")


def _training(spark, sf, strategies):
    rows = _roles(spark, sf, strategies, frame=_stored(spark, sf, P.flag_panel))
    usable = splits.fold_table(rows).filter((F.col("test_rows") > 0) & splits.enough_train())
    return splits.training_rows(rows, usable)


def sample_weights(spark, sf):
    samples = _training(spark, sf, [WALK_FORWARD]).filter("row_no >= seq_len")
    out = weights.sample_weights(samples, ["entity", "horizon", "fold"])
    return _round(out.select("entity", "horizon", "fold", "date", "weight"))


def validation_tail(spark, sf):
    train = splits.validation_tail(_training(spark, sf, splits.STRATEGIES))
    return train.select("entity", "strategy", "horizon", "fold", "date", "sample_no", "is_val")


# --- scaling and sequences ----------------------------------------------------------------------


def _features(numbered):
    """Feature columns of a numbered frame."""
    return [c for c in X.feature_columns(numbered) if c not in ("row_no", "test_row_no", "last_date")]


def scale_bounds(spark, sf):
    frame = _frame(spark, sf)
    columns = [*X.feature_columns(frame), "target"]
    bounds = scaling.fold_bounds(_roles(spark, sf, splits.STRATEGIES, frame=frame), columns)
    return _round(scaling.long_bounds(bounds, columns), 4).drop("seq_len")


def scaled_features(spark, sf):
    frame = _stored(spark, sf, P.flag_panel)
    rows = _roles(spark, sf, splits.STRATEGIES, frame=frame)
    columns = [*_features(frame), "target"]
    scaled = scaling.scale_rows(rows, scaling.fold_bounds(rows, columns), columns)
    out = scaling.unscale_rows(scaled, ["target"])
    return _round(out.select("entity", "strategy", "horizon", "date", *[f"scaled_{c}" for c in columns],
                             "restored_target"))


def _sequences(spark, sf, strategy, from_shards=False):
    frame = _stored(spark, sf, P.flag_panel)
    columns = sorted(_features(frame))
    frame = frame.withColumns({c: F.round(F.col(c) * 100) for c in columns})  # whole numbers add up alike in any order
    stored = writers.materialize(sequences.shards(frame, columns, max(DEFAULT_SEQ_LENS), 256)) if from_shards else None
    out = None
    for h, n in zip(HORIZONS, DEFAULT_SEQ_LENS):
        one = sequences.add_sequences(frame, columns, n) if stored is None else frame.drop("date").join(
            sequences.cut(stored, len(columns), n), ["entity", "row_no"])
        one = one.withColumns({"strategy": F.lit(strategy), "horizon": F.lit(h), "seq_len": F.lit(n)})
        out = one if out is None else out.unionByName(one)
    rows = splits.with_roles(out, SPLIT)
    kept = rows.filter(F.col("train_after").isNotNull() & (F.col("strategy") == BASELINE)
                       | F.col("test_fold").isNotNull() & splits.has_sequence())
    return _round(kept.select(
        "entity", "date", "horizon",
        F.when((F.col("strategy") == BASELINE) & F.col("train_after").isNotNull(), "train").otherwise("test").alias("role"),
        F.size("sequence").alias("n_steps"), F.size(sequences.flat()).alias("n_values"),
        sequences.checksum().alias("checksum")), 4)


def sequences_baseline(spark, sf):
    return _sequences(spark, sf, BASELINE)


def sequence_store(spark, sf):
    """Sequences of three lengths cut out of shards in which every row is stored once."""
    return _sequences(spark, sf, WALK_FORWARD, from_shards=True)


def sequences_walkforward(spark, sf):
    return _sequences(spark, sf, WALK_FORWARD)


def context_rows(spark, sf):
    rows = _roles(spark, sf, [WALK_FORWARD], frame=_stored(spark, sf, P.flag_panel))
    usable = splits.fold_table(rows).filter((F.col("test_rows") > 0) & splits.enough_train())
    return splits.context_rows(rows, usable).select("entity", "horizon", "fold", "date", "is_context")


# --- models and reports -------------------------------------------------------------------------


def slice_ols_report(spark, sf):
    """Shortest whole job: a few features, fixed split with embargo, one regressor, errors per entity."""
    df = X.unique_dates(P.flag_panel(spark, sf).select("entity", "date", "level", "rain"))
    df = X.targets(X.rolling_means(X.rain_sums(X.deltas(X.lags(df, [7]), [7]), days=[7]), [30]), [7])
    df = df.select("entity", "date", "lag_7", "delta_1", "rain_7d", "rolling_mean_30", "target_7").na.drop("any")
    rows = splits.with_roles(
        splits.with_strategies(splits.by_horizon(splits.number_rows(df, SPLIT), [7], [1]), [BASELINE]), SPLIT)
    fitted = models.fit_ols(rows, "lag_7")
    errors = M.metrics(models.predict_ols(rows, fitted, "lag_7"))
    out = errors.join(fitted.select("entity", "train_rows", "test_rows"), "entity")
    return _round(out.select("entity", "train_rows", "test_rows", "rmse", "mae", "r2"), 4)


def _ols(spark, sf, strategy, halflife=None, panel=P.flag_panel):
    frame = _stored(spark, sf, panel)
    rows = _roles(spark, sf, [strategy], frame=frame)
    fitted = models.fit_ols(rows, "lag_7", halflife, around=models.first_values(frame, "lag_7", "target_7"))
    return rows, fitted, models.predict_ols(rows, fitted, "lag_7")


def _metrics(predictions):
    return _round(M.metrics(predictions), 4)


def metrics_baseline(spark, sf):
    return _metrics(_ols(spark, sf, BASELINE)[2])


def metrics_walkforward(spark, sf):
    return _metrics(_ols(spark, sf, WALK_FORWARD, 365)[2])


def metrics_nation_baseline(spark, sf):
    """Many entities, some too short for every horizon."""
    return _metrics(_ols(spark, sf, BASELINE, panel=P.nation_flag_panel)[2])


def metrics_nation_walkforward(spark, sf):
    return _metrics(_ols(spark, sf, WALK_FORWARD, 365, P.nation_flag_panel)[2])


def summary_pivot(spark, sf):
    rows, _, predictions = _ols(spark, sf, BASELINE)
    return M.summary(M.metrics(predictions), splits.fold_table(rows))


def missing_horizons(spark, sf):
    panel = writers.materialize(P.supplier_panel(spark, sf))
    rows = backtest.roles(X.feature_frame(panel), [BASELINE], SPLIT)
    made = splits.fold_table(rows).filter((F.col("test_rows") > 0) & splits.enough_train())
    entities = panel.select("entity").distinct()
    return M.missing_horizons(entities, made.select("entity", "horizon"))


def residual_report(spark, sf):
    return _round(M.residuals(_ols(spark, sf, BASELINE)[2]), 4)


def weighted_ols(spark, sf):
    fitted = _ols(spark, sf, WALK_FORWARD, 365)[1]
    return _round(fitted.select(
        "entity", "horizon", "fold", "train_rows", "train_samples", "test_rows", "slope", "intercept"), 5)


def ridge_statistics(spark, sf):
    """Mean products of the weighted fit part and the plain validation part of every walk-forward fold."""
    frame = _stored(spark, sf, P.flag_panel)
    folds = splits.usable_folds(_roles(spark, sf, [WALK_FORWARD], frame=frame))
    sums = shared.fold_sums(shared.with_vectors(frame, GRAM_COLUMNS), folds, 365)
    every = (*GRAM_COLUMNS, "target")
    width = len(every) + 1
    places = [(f"s_{c}", j + 1) for j, c in enumerate(every)]
    places += [(f"p_{every[i]}_{every[j]}", (i + 1) * width + j + 1)
               for i in range(len(every)) for j in range(i, len(every))]
    terms = [F.struct(F.lit(n).alias("term"), (F.col("fit_sums")[at] / F.col("fit_sums")[0]).alias("fit_mean"),
                      (F.col("val_sums")[at] / F.col("val_sums")[0]).alias("val_mean")) for n, at in places]
    return _round(sums.select("entity", "horizon", "fold", F.inline(F.array(*terms))), 3)


def ridge_pair_report(spark, sf):
    """Ridge on two inputs, small enough to write its solution in SQL."""
    rows = _roles(spark, sf, splits.STRATEGIES, frame=_stored(spark, sf, P.flag_panel))
    rows = rows.withColumn("halflife", F.when(F.col("strategy") == WALK_FORWARD, F.lit(365)))
    keys, inputs = (*splits.KEYS, "halflife"), ("lag_7", "rain_30d")
    fitted = models.fit_ridge(rows, inputs, "halflife", keys=keys)
    return _metrics(models.predict_ridge(rows, fitted, inputs, keys))


def window_slopes(spark, sf):
    """Means and slopes of six features over the last 30 and 90 rows of the whole feature table, summed up by year."""
    names = ("level", "lag_7", "delta_1", "rain_30d", "temp_7d", "rolling_std_30")
    kinds = [f"{k}_{n}" for k in ("mean", "slope") for n in (30, 90)]
    out = models.add_windows(_frame(spark, sf), names, (30, 90))
    rows = [F.struct(F.lit(c).alias("feature"), *[F.col(f"{c}_{k}").alias(k) for k in kinds]) for c in names]
    long = out.select("entity", F.year("date").alias("year"), F.inline(F.array(*rows)))
    return _round(long.groupBy("entity", "year", "feature").agg(
        F.count("mean_30").alias("n_30"), F.count("mean_90").alias("n_90"),
        *[f(k).alias(f"{sd}{k}") for k in kinds for sd, f in (("", F.avg), ("sd_", F.stddev_samp))]), 5)


def _ridge_report(spark, sf, frame, inputs, windows, kinds):
    """Ridge on input columns and on windows of some of them, 365 days of half-life where folds walk forward."""
    frame = writers.materialize(frame)
    rows = models.pick_windows(_roles(spark, sf, splits.STRATEGIES, frame=frame), windows, DEFAULT_SEQ_LENS, kinds)
    rows = rows.withColumn("halflife", F.when(F.col("strategy") == WALK_FORWARD, F.lit(365)))
    keys = (*splits.KEYS, "halflife")
    vectors = shared.with_vectors(frame, inputs, windows, DEFAULT_SEQ_LENS, kinds)
    fitted = shared.fit_ridge(vectors, splits.usable_folds(rows, keys), "halflife", keys=keys, windows=True)
    return _metrics(models.predict_ridge(rows, fitted, [*inputs, *[f"{c}_{k}" for k in kinds for c in windows]], keys))


def ridge_report(spark, sf):
    """Ridge on the last value, mean and slope of every feature over the sequence."""
    frame = splits.number_rows(_frame(spark, sf), SPLIT)
    names = X.feature_columns(_frame(spark, sf))
    return _ridge_report(spark, sf, models.add_windows(frame, names, DEFAULT_SEQ_LENS), names, names, ("mean", "slope"))


def ridge_nation_report(spark, sf):
    """Many entities on a few features and means."""
    frame = splits.number_rows(_frame(spark, sf, P.nation_flag_panel), SPLIT)
    frame = models.add_means(frame, backtest.RIDGE_MEANS, DEFAULT_SEQ_LENS)
    return _ridge_report(spark, sf, frame, backtest.RIDGE_LAST, backtest.RIDGE_MEANS, ("mean",))


def gbt_report(spark, sf):
    rows = writers.materialize(_roles(spark, sf, [BASELINE]))
    inputs = [c for c in X.feature_columns(_frame(spark, sf))]
    return _metrics(models.fit_predict_gbt(rows, inputs, maxIter=10, maxDepth=3))


def _job_tables(spark, sf):
    """The daily region panel, stored once for all that reads it, with its weather and production."""
    panel = writers.materialize(P.region_panel(spark, sf))
    weather = P.station_panel(spark, sf).select(
        "station", "date", *[(F.col(m) if m in ("prcp", "tavg", "tmax", "tmin") else F.lit(None).cast("double")).alias(m)
                             for m in WEATHER_MEASURES])
    demand = panel.groupBy("date").agg(F.sum("demand").alias("value")).withColumn("series", F.lit("demand"))
    return panel.select("entity", "date", "level"), writers.materialize(weather), writers.materialize(demand)


def config_report(spark, sf):
    """The whole job on the region panel, each region with its own stations, lags, model and strategy."""
    report = backtest.run(*_job_tables(spark, sf), P.region_config(spark, sf), split=SPLIT,
                          tree_params={"maxIter": 5, "maxDepth": 3})
    return M.report_names(report.summary)


def _ols_job(spark, sf):
    """The whole job with one regressor: regions without stations, of mixed strategies, lengths and half-lives, one not
    asked for, one asked for without levels, levels above the limit, and dates cut at both ends."""
    levels, weather, demand = _job_tables(spark, sf)
    spike = (F.col("entity") == "ASIA") & F.col("date").between("1998-03-01", "1998-03-03")
    levels = levels.withColumn("level", F.when(spike, F.lit(130.0)).otherwise(F.col("level")))
    config = P.region_config(spark, sf).where("entity <> 'EUROPE'").withColumns({
        "model": F.lit("ols"), "weather_stations": F.array().cast("array<string>"),
        "prod_cols": F.when(F.col("entity") == "ASIA", F.array(F.lit("absent_series"))),
        "lag_days": F.array(F.lit(7), F.lit(14))})
    named = selection.settings_for(spark, ["EUROPE"], model="ols", weather_stations=[], lag_days=[7, 14])
    config = config.unionByName(named).where("entity <> 'AFRICA'")
    africa = selection.settings_for(spark, ["AFRICA", "NOWHERE"], model="ols", strategy="walkfwd_expanding", lag_days=[7, 14],
                                    halflives=[180], seq_lens=[20, 25, 40])
    return backtest.run(
        levels, weather, demand, config.unionByName(africa), entities="AFRICA, ASIA,EUROPE,MIDDLE EAST,NOWHERE",
        split=SPLIT, start_year=1996, ends={"ASIA": "2001-06-30"}, default_end="2001-09-30")


def config_ols_report(spark, sf):
    return _round(_ols_job(spark, sf).metrics, 4)


def prediction_sink(spark, sf):
    """Predictions written as files and read back."""
    path = writers.shared_folder(spark)
    writers.write_predictions(_ols(spark, sf, BASELINE)[2], path)
    back = spark.read.parquet(path)
    return _round(back.select("entity", "strategy", "horizon", "date", "y", "yhat"), 4)


def summary_sink(spark, sf):
    """The summary written as CSV and read back."""
    path = writers.shared_folder(spark)
    table = summary_pivot(spark, sf)
    writers.write_summary(table, path)
    return spark.read.schema(table.schema).option("header", True).csv(path)


def run_warnings(spark, sf):
    """What the whole job passes over."""
    return _ols_job(spark, sf).warnings


def gbt_prediction_keys(spark, sf):
    """Predictions of trees by key where entities differ in half-life: each test row is scored once."""
    rows = writers.materialize(_roles(spark, sf, splits.STRATEGIES).withColumn(
        "halflife", F.when(F.col("entity") == "A", F.lit(90)).when(F.col("entity") == "N", F.lit(365))))
    keys = (*splits.KEYS, "halflife")
    scored = models.fit_predict_gbt(rows, ("lag_7", "rain_30d"), "halflife", keys=keys, maxIter=2, maxDepth=2)
    return scored.groupBy("entity", "strategy", "horizon", F.col("fold").cast("int").alias("fold")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("date").alias("n_dates"))


def time_interpolate(spark, sf):
    return _round(splits.time_interpolate(_clean_dirty(spark, sf).select("entity", "date", "level")))


def test_fill(spark, sf):
    test = _clean_dirty(spark, sf).select("entity", "date", "level").filter(F.col("date") >= "1997-05-05")
    return _round(splits.fill_test_levels(test))


QUERIES = {f.__name__: f for f in (
    slice_ols_report,
    csv_scan, rejected_rows, date_parse, config_scan, config_file_scan, unpivot_long, pivot_wide, series_by_name, drop_empty_series,
    missing_flags, fill_zero, cap_level, bad_level_count, profile,
    rain_range_sums, temp_range_mean, lags, deltas, rolling_means, rolling_std, rain_x_level, demand_lag,
    forward_fill, targets, seasonal, feature_frame, feature_frame_dirty, feature_frame_supplier, feature_frame_segments,
    config_projection, missing_config_columns, station_features,
    entity_subset, config_defaults, horizon_config, lag_columns, natural_start, date_bounds, date_bounds_table,
    baseline_split, folds, fold_rows, strategy_union, sample_weights, validation_tail,
    scale_bounds, scaled_features, sequences_baseline, sequences_walkforward, sequence_store, context_rows,
    metrics_baseline, metrics_walkforward, metrics_nation_baseline, metrics_nation_walkforward, summary_pivot, missing_horizons, residual_report,
    weighted_ols, window_slopes, ridge_statistics, ridge_pair_report, ridge_report, ridge_nation_report, gbt_report, config_report, config_ols_report,
    run_warnings,
    gbt_prediction_keys, prediction_sink, summary_sink,
    time_interpolate, test_fill,
)}
