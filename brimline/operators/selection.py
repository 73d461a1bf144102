"""Settings, entity choice, column choice and date bounds."""

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from brimline.functions.lists import lag_names, split_names
from brimline.settings import (
    DEFAULT_HALFLIVES, DEFAULT_LAGS, DEFAULT_MODEL, DEFAULT_SEQ_LENS, DEFAULT_STRATEGY, HORIZONS, LEVEL_SUFFIX, SETTINGS_SCHEMA, STRATEGIES, WEATHER_MEASURES,
)


def _ints(values) -> Column:
    return F.array(*[F.lit(int(v)) for v in values])


def with_defaults(config: DataFrame) -> DataFrame:
    """Fill absent settings and resolve unknown strategies; `requested_strategy` keeps what was asked for."""
    empty = F.array().cast("array<string>")
    strategy = F.coalesce("strategy", F.lit(DEFAULT_STRATEGY))
    return config.select(
        "entity",
        F.coalesce("prod_cols", empty).alias("prod_cols"),
        F.coalesce("weather_stations", empty).alias("weather_stations"),
        F.coalesce("lag_days", _ints(DEFAULT_LAGS)).alias("lag_days"),
        F.coalesce("model", F.lit(DEFAULT_MODEL)).alias("model"),
        F.coalesce("seq_lens", _ints(DEFAULT_SEQ_LENS)).alias("seq_lens"),
        F.coalesce("halflives", _ints(DEFAULT_HALFLIVES)).alias("halflives"),
        F.when(strategy.isin(*STRATEGIES), strategy).otherwise(DEFAULT_STRATEGY).alias("strategy"),
        strategy.alias("requested_strategy"),
    )


def one_per_entity(config: DataFrame) -> DataFrame:
    """Fail when an entity has several settings rows."""
    rows = F.count(F.lit(1))
    named = {f.name: F.first(f.name).alias(f.name) for f in SETTINGS_SCHEMA}
    message = F.concat(F.lit("several settings rows for "), F.col("entity"))
    checked = config.groupBy("entity").agg(rows.alias("_rows"), *named.values())
    return checked.withColumn("model", F.when(F.col("_rows") > 1, F.raise_error(message).cast("string")).otherwise(
        F.col("model"))).drop("_rows")


def settings_of(entities: DataFrame, config: DataFrame) -> DataFrame:
    """Complete settings of every entity; one without a row takes the defaults, and `has_settings` says so."""
    own = one_per_entity(config).withColumn("has_settings", F.lit(True))
    every = entities.select("entity").join(own, "entity", "left")
    known = every.select("entity", F.coalesce("has_settings", F.lit(False)).alias("has_settings"))
    return with_defaults(every).join(known, "entity")


def settings_for(spark, entities, **settings) -> DataFrame:
    """Settings rows for named entities, e.g. an override passed in place of the stored config."""
    row = tuple(settings.get(f.name) for f in SETTINGS_SCHEMA)
    return spark.createDataFrame(
        [(e, *row) for e in entities], "entity string, " + ", ".join(
            f"{f.name} {f.dataType.simpleString()}" for f in SETTINGS_SCHEMA))


def horizon_config(config: DataFrame, horizons=HORIZONS) -> DataFrame:
    """Pair horizons with sequence lengths by position; positions without a partner give no row."""
    pairs = F.arrays_zip(_ints(horizons).alias("horizon"), F.col("seq_lens").alias("seq_len"))
    return (
        config.select("entity", "lag_days", F.inline(pairs).alias("horizon", "seq_len"))
        .filter("horizon is not null and seq_len is not null")
        .select("entity", "horizon", "seq_len", "lag_days")
    )


def lag_columns(horizons: DataFrame) -> DataFrame:
    """All lag columns an entity needs over its horizons, sorted."""
    return horizons.groupBy("entity").agg(lag_names(F.collect_list("lag_days")).alias("lag_columns"))


def wanted_series(config: DataFrame) -> DataFrame:
    """Series names each entity asks for, in order: level, production, eight measures per station."""
    measures = F.array(*[F.lit(m) for m in WEATHER_MEASURES])
    weather = F.flatten(F.transform("weather_stations", lambda s: F.transform(
        measures, lambda m: F.concat(m, F.lit("_"), s))))
    level = F.array(F.concat("entity", F.lit(LEVEL_SUFFIX)))
    return config.select("entity", F.posexplode(F.concat(level, "prod_cols", weather)).alias("position", "series"))


def project_series(config: DataFrame, known: DataFrame) -> DataFrame:
    """Wanted series that exist, keeping the order; `known` holds one row per series name."""
    return wanted_series(config).join(known, "series")


def missing_production(config: DataFrame, known: DataFrame) -> DataFrame:
    """Production series that are configured but absent."""
    wanted = config.select("entity", F.explode("prod_cols").alias("series"))
    return wanted.join(known, "series", "left_anti")


def rows_cut(panel: DataFrame, bounds: DataFrame) -> DataFrame:
    """Rows of each entity before its start and after its end."""
    date = F.col("date")
    return panel.join(bounds.select("entity", "start_date", "end_date"), "entity").groupBy("entity").agg(
        F.count_if(date < F.col("start_date")).alias("before_start"), F.count_if(date > F.col("end_date")).alias("after_end"))


def _requested(spark, names: str) -> DataFrame:
    listed = spark.range(1).select(F.posexplode(split_names(F.lit(names))).alias("position", "entity"))
    return listed.groupBy("entity").agg(F.min("position").alias("position"))


def unknown_entities(known: DataFrame, names: str) -> DataFrame:
    return _requested(known.sparkSession, names).join(known, "entity", "left_anti")


def choose_entities(known: DataFrame, names: str | None = None) -> DataFrame:
    """Entities of a comma list that exist, with their place in the request; all when none is given."""
    if not names:
        return known.select("entity", F.lit(None).cast("int").alias("position"))
    chosen = _requested(known.sparkSession, names).join(known, "entity", "left_semi")
    if chosen.isEmpty():
        raise ValueError(f"none of the requested entities exists: {names}")
    return chosen


def natural_start(panel: DataFrame) -> DataFrame:
    """First date with a level; entities without one drop out."""
    return (
        panel.groupBy("entity")
        .agg(F.min(F.when(F.col("level").isNotNull(), F.col("date"))).alias("natural_start"))
        .filter("natural_start is not null")
    )


def end_dates(spark, ends) -> DataFrame:
    """(entity, end_date) of a dict of ISO dates or of a table; an entity with two rows fails the job."""
    if not isinstance(ends, DataFrame):
        rows = [(e, None if d is None else dt.date.fromisoformat(d)) for e, d in (ends or {}).items()]
        return spark.createDataFrame(rows, "entity string, end_date date")
    twice = F.raise_error(F.concat(F.lit("two end dates for "), "entity")).cast("date")
    return ends.filter("entity is not null").groupBy("entity").agg(
        F.count(F.lit(1)).alias("_n"), F.max("end_date").alias("end_date")).select(
        "entity", F.when(F.col("_n") > 1, twice).otherwise(F.col("end_date")).alias("end_date"))


def date_bounds(panel: DataFrame, start_year: int | None = None, ends=None, default_end=None) -> DataFrame:
    """First and last usable date per entity; a NULL end cuts nothing.

    `ends` is a dict, or a table (entity, end_date) joined on the entity, so the plan is the same for any number of them.
    An entity without a row there has the default end, one with a NULL there has none.
    """
    start = F.col("natural_start")
    if start_year is not None:
        start = F.greatest(start, F.lit(dt.date(start_year, 1, 1)))
    default = F.lit(None if default_end is None else dt.date.fromisoformat(default_end)).cast("date")
    found = natural_start(panel).select("entity", "natural_start", start.alias("start_date"))
    if ends is None:
        return found.withColumn("end_date", default)
    own = end_dates(panel.sparkSession, ends).withColumn("_own", F.lit(True))
    return found.join(own, "entity", "left").select(
        "entity", "natural_start", "start_date", F.when(F.col("_own"), F.col("end_date")).otherwise(default).alias("end_date"))


def limit_dates(frame: DataFrame, bounds: DataFrame) -> DataFrame:
    """Keep dates inside the bounds; run it after the features, so windows still see earlier history."""
    return (
        frame.join(bounds.select("entity", "start_date", "end_date"), "entity")
        .filter((F.col("date") >= F.col("start_date")) & (F.col("end_date").isNull() | (F.col("date") <= F.col("end_date"))))
        .drop("start_date", "end_date")
    )
