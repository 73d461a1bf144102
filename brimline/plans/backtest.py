"""From daily tables to predictions and reports, for all entities in one plan."""

import json
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from brimline.operators import (
    cleaning, features as X, metrics as M, models, selection, shared, splits, stations as S,
)
from brimline.settings import (
    DEFAULT_LAGS, DEFAULT_SEQ_LENS, FOLD_MONTHS, HORIZONS, SPLIT_DATE, STRATEGIES, WEATHER_MEASURES,
)
from brimline.sources.writers import Stages, fingerprint

RIDGE_LAST = (
    "lag_7", "delta_1", "rolling_mean_30", "rolling_std_30", "trend_direction", "rain_30d", "temp_7d",
    "month_sin", "month_cos",
)
RIDGE_MEANS = ("rain", "temp", "demand")
RIDGE_INPUTS = (*RIDGE_LAST, *[f"{c}_mean" for c in RIDGE_MEANS])
SETTINGS = ("model", "strategy", "seq_lens", "halflife")


class Report(NamedTuple):
    predictions: DataFrame
    metrics: DataFrame
    summary: DataFrame
    residuals: DataFrame
    missing: DataFrame
    warnings: DataFrame
    stages: Stages


def roles(frame: DataFrame, strategies=STRATEGIES, split=SPLIT_DATE, months=FOLD_MONTHS,
          horizons=HORIZONS, seq_lens=DEFAULT_SEQ_LENS, embargo=False) -> DataFrame:
    """Complete feature rows, once per strategy and horizon, with their train and test roles."""
    numbered = frame if "row_no" in frame.columns else splits.number_rows(frame, split)
    rows = splits.by_horizon(numbered, horizons, seq_lens)
    if strategies is not None:
        rows = splits.with_strategies(rows, strategies)
    return splits.with_roles(rows, split, months, embargo)


STATION = (*WEATHER_MEASURES, *S.DERIVED, "rain_x_level")


def entity_frame(levels, weather, production, config, lag_rows=DEFAULT_LAGS, horizons=HORIZONS,
                 stages: Stages | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Complete feature rows of every entity, and its rows for each of its stations and production series.

    The first table has the features that every entity has as columns, the others (entity, position, date) with those of one station or
    series, as many as the settings of the entity name.
    """
    stages = stages or Stages(levels.sparkSession)
    around = S.empty_as_zero(S.station_frame(weather), (*WEATHER_MEASURES, *S.DERIVED))
    own = config.select("entity", "lag_days", F.size("weather_stations").alias("_stations"))
    base = cleaning.cap_level(X.unique_dates(levels)).join(own, "entity")
    df_of_levels = X.rolling_std(X.rolling_means(X.settings_lags(base, lag_rows)))
    df = stages.table("levels", lambda: df_of_levels.drop("lag_days"))
    nearby = S.join_stations(df.select("entity", "date", "base_level"), around, config).withColumn(
        "rain_x_level", F.col("prcp") * F.col("base_level"))
    stations, series = nearby.drop("station", "base_level"), S.production_rows(df, production, config).drop("series")
    nearby = stages.table("stations", lambda: S.filled(stations, STATION))
    made = stages.table("series", lambda: S.filled(series, ["prod"], 0.0))
    df = df.drop("base_level", "_stations")
    df = X.forward_fill(df, [c for c in df.columns if c not in ("entity", "date")])
    df = X.complete_rows(X.add_seasonal(X.targets(df, horizons)), horizons)
    for side, columns in ((nearby, STATION), (made, ["prod"])):
        # A row is complete if its stations and series are.
        gaps = side.where(" or ".join(f"`{c}` is null" for c in columns)).select("entity", "date")
        df = df.join(gaps, ["entity", "date"], "left_anti")
    return df, nearby, made


def with_inputs(frame, sides, inputs, lengths) -> DataFrame:
    """The vectors that models take: adds `x`, `wx` (see `shared`), `own` and `own_wx` (the parts of stations and series).

    frame has numbered rows with settings; `sides` are pairs of (table of numbered series, its columns). Windows run over the rows of the
    frame, within each series of an entity.
    """
    empty, of = F.array().cast("array<double>"), [f"w_{n}" for n in lengths]
    picked = F.transform("seq_lens", lambda n: shared.of_length(n, lengths, lambda k: F.col(f"w_{k}")))
    frame = models.add_window_vectors(frame, inputs, lengths).withColumns({
        "x": F.array(*[F.col(c).cast("double") for c in inputs]), "wx": picked, "own": empty,
        "own_wx": F.transform("seq_lens", lambda n: F.array().cast("array<double>"))}).drop(*of)
    days = frame.select("entity", "date")
    for side, columns in sides:
        long = models.add_window_vectors(side.join(days, ["entity", "date"]), columns, lengths, ("entity", "position"))
        packed = S.in_order(long, {"_x": F.array(*columns)} | {w: F.col(w) for w in of})
        frame = frame.join(packed, ["entity", "date"], "left")
        more = F.transform(picked, lambda w: F.coalesce(w, empty))
        frame = frame.withColumns({
            "own": F.concat("own", F.coalesce("_x", empty)),
            "own_wx": F.zip_with("own_wx", more, lambda a, b: F.concat(a, b))}).drop("_x", *of)
    return frame


def whole_vectors(frame) -> DataFrame:
    """`x` and `wx` with the parts of the entity's own stations and series behind those that all entities have."""
    return frame.withColumns({
        "x": F.concat("x", "own"),
        "wx": F.zip_with("wx", "own_wx", lambda a, b: F.when(a.isNotNull(), F.concat(a, b)))}).drop("own", "own_wx")


def even_vector(horizons, width: int) -> Column:
    """The input vector of a row with its horizon, as long for every entity: own parts are filled up with zeros."""
    def even(v, n):
        return F.concat(v, F.array_repeat(F.lit(0.0), F.greatest(F.lit(0), n - F.size(v))))

    at = F.array_position(F.array(*[F.lit(h) for h in horizons]), F.col("horizon")).cast("int") - 1
    return F.concat("x", F.get("wx", at), even(F.col("own"), F.lit(width)), even(F.get("own_wx", at), F.lit(2 * width)))


def _distinct_ints(config: DataFrame, column: str) -> list[int]:
    """Distinct numbers in a settings list: a handful of small integers."""
    found = config.select(F.explode(column).alias("n")).filter("n is not null").distinct().collect()
    return sorted(r["n"] for r in found)


def warnings_of(levels, production, config, wanted, bounds, missing) -> DataFrame:
    """(kind, entity, detail) of all that a run passes over: one row for each case."""
    def row(df, kind, detail):
        return df.select(F.lit(kind).alias("kind"), "entity", detail.cast("string").alias("detail"))

    cut = selection.rows_cut(levels, bounds)
    asked = F.col("requested_strategy")
    out = [
        row(cleaning.bad_levels(levels), "levels above the limit", F.col("bad_rows")),
        row(config.where("not has_settings"), "no settings, defaults used", F.lit("")),
        row(config.where(asked != F.col("strategy")), "unknown strategy, baseline used", asked),
        row(selection.missing_production(config, production.select("series").distinct()), "production series absent",
            F.col("series")),
        row(cut.where("before_start > 0"), "rows before the start", F.col("before_start")),
        row(cut.where("after_end > 0"), "rows after the end", F.col("after_end")),
        row(missing, "no model for a horizon", F.col("horizon")),
    ]
    if wanted is not None:
        out.append(row(wanted, "entity without levels", F.lit("")))
    return reduce(DataFrame.unionByName, out)


def _frame(levels, weather, production, config, lag_rows, horizons, split, bounds, stages) -> DataFrame:
    """Numbered feature rows of every entity within its dates, with the settings that fits need."""
    frame, _, _ = entity_frame(levels, weather, production, config, lag_rows, horizons, stages)
    settings = config.select(
        "entity", models.model_column().alias("model"), "strategy", F.slice("seq_lens", 1, len(horizons)).alias("seq_lens"),
        F.when(F.col("strategy") == splits.WALK_FORWARD, F.get("halflives", F.lit(0))).alias("halflife"))
    return splits.number_rows(selection.limit_dates(frame, bounds), split).join(settings, "entity")


def _inputs(frame, lengths, horizons, stages) -> DataFrame:
    """The rows of entities whose models take vectors, with the vectors in place of the features."""
    other = ("row_no", "test_row_no", "last_date", "model", "strategy", "seq_lens", "halflife")
    last = X.feature_columns(frame.drop(*other), horizons)
    sides = ((stages.stored("stations"), STATION), (stages.stored("series"), ("prod",)))
    return with_inputs(frame.filter("model <> 'ols'"), sides, last, lengths).drop(*last)


def _predictions(frame, inputs, used, base, keys, horizons, with_roles, tree_params) -> DataFrame:
    """Predictions of the regressors that settings name, each fitted on its entities."""
    out = []
    if "ols" in used:
        rows = with_roles(frame.filter("model = 'ols'"))
        around = models.first_values(frame, base, f"target_{horizons[0]}")
        out.append(models.predict_ols(rows, models.fit_ols(rows, base, "halflife", keys, around), base, keys))
    if "ridge" in used:
        whole = whole_vectors(inputs.filter("model = 'ridge'"))
        at = F.array_position(F.array(*[F.lit(h) for h in horizons]), F.col("horizon")).cast("int") - 1
        rows = with_roles(whole)
        fitted = shared.fit_ridge(whole, splits.usable_folds(rows, keys), "halflife", horizons, keys, windows=True)
        out.append(shared.predict_ridge(rows, fitted, F.concat("x", F.get("wx", at)), keys))
    if "gbt" in used:
        own = inputs.filter("model = 'gbt'")
        width = own.agg(F.max(F.size("own"))).first()[0] or 0
        rows = with_roles(own).withColumn("_v", even_vector(horizons, width))
        out.append(models.fit_predict_gbt(rows, None, "halflife", keys=keys, sequence="_v", **(tree_params or {})))
    return reduce(DataFrame.unionByName, out)


def run(levels, weather, production, config, *, entities=None, horizons=HORIZONS, split=SPLIT_DATE, months=FOLD_MONTHS,
        start_year=None, ends=None, default_end=None, embargo=False, tree_params=None, folder=None) -> Report:
    """The whole job. Settings decide per entity on stations, lags, model, sequence lengths and strategy.

    `entities` is a comma list of those to run; without one all that have levels run, and with none of them known the
    job fails. Entities without settings take the defaults. Nothing is cut off the end unless `ends` or `default_end`
    say so. `warnings` lists all that the run passes over.

    `config` takes the raw settings rows; pass an override by changing its rows. An entity may have one row only. Ridge and trees take
    the last value, the mean and the slope of every feature; an entity's input vector is as long as its own settings make it.

    Tables that several steps read are written once, by stage, to `folder` or below the shared folder. With a `folder`, a job that was
    ended goes on after its last whole stage, if inputs, settings and arguments are the same; `stages.clear()` of the report
    removes them.
    """
    spark, key = levels.sparkSession, ""
    if folder:
        given = [entities, list(horizons), split, months, start_year, default_end, embargo, tree_params]
        tables = [levels, weather, production, config, *([] if ends is None else [selection.end_dates(spark, ends)])]
        key = json.dumps([given, [fingerprint(t) for t in tables]], default=str)
    stages = Stages(spark, folder, key)
    found = levels.select("entity").distinct()
    unknown = None
    if entities:
        unknown = selection.unknown_entities(found, entities)
        found = selection.choose_entities(found, entities)
        levels = levels.join(found.select("entity"), "entity", "left_semi")
    else:
        unknown = config.select("entity").join(found, "entity", "left_anti")
    asked = config
    config = stages.table("settings", lambda: selection.settings_of(found, asked))
    lengths, lag_rows = _distinct_ints(config, "seq_lens"), _distinct_ints(config, "lag_days")
    bounds = selection.date_bounds(cleaning.cap_level(levels), start_year, ends, default_end)
    base, keys = f"lag_{lag_rows[0]}", (*splits.KEYS, "halflife")
    used = {r[0] for r in config.select(models.model_column()).distinct().collect()}
    frame = stages.table("frame", lambda: _frame(levels, weather, production, config, lag_rows, horizons, split, bounds, stages))
    inputs = None if used == {"ols"} else stages.table("inputs", lambda: _inputs(frame, lengths, horizons, stages))

    def with_roles(df):
        return roles(df, None, split, months, horizons, "seq_lens", embargo)

    predictions = stages.table("predictions", lambda: M.bounded(_predictions(
        frame, inputs, used, base, keys, horizons, with_roles, tree_params)))
    rows = with_roles(frame)
    errors = M.metrics(predictions)
    missing = M.missing_horizons(config.select("entity"), errors.select("entity", "horizon"), horizons)
    return Report(
        predictions, errors, M.summary(errors, splits.fold_table(rows, keys), horizons), M.residuals(predictions),
        missing, warnings_of(levels, production, config, unknown, bounds, missing), stages)
