"""Station weather: features once per station, then joined to the entities that use the station."""

from pyspark.sql import DataFrame, Window, functions as F

from brimline.operators.cleaning import flag_and_fill
from brimline.operators.features import by_date, forward_fill, rain_sums, temp_mean, unique_dates
from brimline.settings import FLAGGED_MEASURES, RAIN_DAYS, TEMP_DAYS

DERIVED = (*[f"rain_{k}d" for k in RAIN_DAYS], f"temp_{TEMP_DAYS}d")


def station_frame(weather: DataFrame) -> DataFrame:
    """Rain sums and mean temperature per station, computed once however many entities share it."""
    df = unique_dates(weather, "prcp", ("station",))
    df = flag_and_fill(df, [m for m in FLAGGED_MEASURES if m in weather.columns])
    df = rain_sums(df, "prcp", keys=("station",))
    df = temp_mean(df, "tavg", keys=("station",))
    return df.drop(*[f"{m}_missing" for m in FLAGGED_MEASURES])


def entity_stations(config: DataFrame) -> DataFrame:
    return config.select("entity", F.posexplode("weather_stations").alias("position", "station"))


def join_stations(levels: DataFrame, stations: DataFrame, config: DataFrame) -> DataFrame:
    """One row per entity, date and station of the entity.

    The weather join is on (station, date), so a station shared by many entities spreads over its dates.
    """
    return (
        levels.join(entity_stations(config), "entity")
        .join(stations, ["station", "date"], "left")
    )


def station_features(levels: DataFrame, stations: DataFrame, config: DataFrame, base_lag=7) -> DataFrame:
    """Station features per entity with the rain and level interaction, filled forward."""
    lagged = levels.withColumn("_lag", F.lag("level", base_lag).over(by_date()))
    df = join_stations(lagged, stations, config).withColumn("rain_x_level", F.col("prcp") * F.col("_lag"))
    filled = forward_fill(df, [*DERIVED, "rain_x_level"], ("entity", "station"))
    return filled.select("entity", "position", "station", "date", *DERIVED, "rain_x_level")


def empty_as_zero(stations: DataFrame, columns) -> DataFrame:
    """A measure a station never reports becomes a constant, as if its column were not there."""
    whole = by_date("station").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return stations.withColumns({
        c: F.when(F.count(c).over(whole) == 0, F.lit(0.0)).otherwise(F.col(c)) for c in columns})


def production_rows(days: DataFrame, production: DataFrame, config: DataFrame) -> DataFrame:
    """One row per entity, date and configured production series that exists, with yesterday's value as `prod`.

    The join is on (series, date), so a series that many entities name spreads over its dates. A repeated (series, date) fails.
    """
    wanted = config.select("entity", F.posexplode("prod_cols").alias("position", "series"))
    known = wanted.join(production.select("series").distinct(), "series", "left_semi")
    values = unique_dates(production, "value", ("series",)).select("series", "date", F.col("value").alias("prod"))
    long = days.select("entity", "date").join(known, "entity").join(values, ["series", "date"], "left")
    return long.withColumn("prod", F.lag("prod", 1).over(by_date("entity", "position")))


def filled(long: DataFrame, columns, empty_as=None) -> DataFrame:
    """Rows of numbered series (entity, position, date) with their columns filled forward; with empty_as, a column without any
    value in its series is that number."""
    out = forward_fill(long, columns, ("entity", "position"))
    if empty_as is None:
        return out
    whole = by_date("entity", "position").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return out.withColumns({c: F.when(F.count(c).over(whole) == 0, F.lit(empty_as)).otherwise(F.col(c)) for c in columns})


def in_order(long: DataFrame, vectors: dict) -> DataFrame:
    """(entity, date) with an array for each name: the given array of each numbered row, one position after the other.

    An array is as long as the entity has rows on a date, so entities with many series add nothing to those with few. Where the rows
    have no array, there is none.
    """
    rows = F.array_sort(F.collect_list(F.struct("position", *[c.alias(n) for n, c in vectors.items()])))
    return long.groupBy("entity", "date").agg(rows.alias("_rows")).select(
        "entity", "date", *[F.flatten(F.col(f"_rows.{n}")).alias(n) for n in vectors])
