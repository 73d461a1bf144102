"""Cleaning of raw measurements."""

from pyspark.sql import DataFrame, Window, functions as F

from brimline.functions.numeric import finite
from brimline.settings import FLAGGED_MEASURES, LEVEL_SUFFIX, MAX_LEVEL


def missing_flags(df: DataFrame, columns) -> DataFrame:
    """Add `{column}_missing` (0/1) for each column."""
    return df.withColumns({f"{c}_missing": F.isnull(F.col(f"`{c}`")).cast("int") for c in columns})


def fill_zero(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(0.0)) for c in columns})


def flag_and_fill(df: DataFrame, columns) -> DataFrame:
    """Flag missing values, then set them to 0; the flag is taken first."""
    return fill_zero(missing_flags(df, columns), columns)


def cap_level(df: DataFrame, level="level", limit=MAX_LEVEL) -> DataFrame:
    """Levels above the limit become NULL; negative levels are kept."""
    return df.withColumn(level, F.when(F.col(level) <= limit, finite(level)))


def bad_levels(df: DataFrame, level="level", limit=MAX_LEVEL) -> DataFrame:
    """Entities with levels above the limit, and how many."""
    return (
        df.groupBy("entity")
        .agg(F.count_if(F.col(level) > limit).alias("bad_rows"))
        .filter("bad_rows > 0")
    )


def profile(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


def non_empty_series(series: DataFrame, keys=("series",)) -> DataFrame:
    """Series (long layout) that hold at least one value."""
    return (
        series.groupBy(*keys).agg(F.count("value").alias("n_values")).filter("n_values > 0")
    )


def drop_empty_series(series: DataFrame, keys=("series",)) -> DataFrame:
    """Rows of series with a value, by one count of the key's rows next to them; the series is read once."""
    whole = Window.partitionBy(*keys)
    return series.withColumn("_values", F.count("value").over(whole)).filter("_values > 0").drop("_values")


def drop_empty_columns(wide: DataFrame) -> DataFrame:
    """Drop columns without any value: one aggregate row decides for all columns."""
    counts = wide.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in wide.columns]).first()
    return wide.select(*[F.col(f"`{c}`") for c in wide.columns if counts[c] > 0])


def clean_wide(wide: DataFrame) -> DataFrame:
    """Flags and zero fill for rain and evaporation, level limit, on the wide layout."""
    flagged = [c for c in wide.columns if c.startswith(tuple(f"{m}_" for m in FLAGGED_MEASURES))]
    levels = [c for c in wide.columns if LEVEL_SUFFIX in c]
    out = flag_and_fill(wide, flagged) if flagged else wide
    return out.withColumns(
        {c: F.when(F.col(f"`{c}`") <= MAX_LEVEL, F.col(f"`{c}`")) for c in levels}) if levels else out


def series_by_name(names: DataFrame, name="series") -> DataFrame:
    """Role of each series by its name: prefix for rain and evaporation, substring for levels."""
    role = F.when(F.col(name).contains(LEVEL_SUFFIX), "level")
    for measure in FLAGGED_MEASURES:
        role = role.when(F.startswith(F.col(name), F.lit(f"{measure}_")), measure)
    return names.withColumn("role", role).filter("role is not null")
