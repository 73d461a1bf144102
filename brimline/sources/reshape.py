"""Wide and long layouts, with roles taken from column names."""

from pyspark.sql import DataFrame, functions as F

from brimline.settings import LEVEL_SUFFIX, WEATHER_MEASURES


def _quoted(c):
    return F.col(f"`{c}`")


def unpivot_series(wide: DataFrame, columns=None) -> DataFrame:
    """(date, series, value) for every column; rows without a value stay."""
    columns = columns or [c for c in wide.columns if c != "date"]
    return wide.unpivot([F.col("date")], [_quoted(c) for c in columns], "series", "value")


def pivot_series(series: DataFrame, names) -> DataFrame:
    """One row per date with a column per named series."""
    return series.groupBy("date").pivot("series", list(names)).agg(F.first("value", ignorenulls=True))


def _stack(wide: DataFrame, key: str, groups: dict[str, dict[str, str]], measures) -> DataFrame:
    """One row per (key, date) with a column per measure, taken straight from the named wide columns."""
    rows = [
        F.struct(F.lit(name).alias(key), *[
            (_quoted(cols[m]) if m in cols else F.lit(None)).cast("double").alias(m) for m in measures])
        for name, cols in groups.items()
    ]
    return wide.select("date", F.inline(F.array(*rows))).select(key, "date", *measures)


def levels(wide: DataFrame) -> DataFrame:
    """(entity, date, level) from the level columns."""
    names = {c.replace(LEVEL_SUFFIX, ""): {"level": c} for c in wide.columns if c.endswith(LEVEL_SUFFIX)}
    return _stack(wide, "entity", names, ["level"])


def weather(wide: DataFrame) -> DataFrame:
    """(station, date, eight measures) from the `{measure}_{station}` columns."""
    stations: dict[str, dict[str, str]] = {}
    for c in wide.columns:
        measure, _, station = c.partition("_")
        if measure in WEATHER_MEASURES and station and not c.endswith("_missing"):
            stations.setdefault(station, {})[measure] = c
    return _stack(wide, "station", stations, WEATHER_MEASURES)


def production(wide: DataFrame, names) -> DataFrame:
    """(series, date, value) of the named columns that exist."""
    return unpivot_series(wide, [c for c in names if c in wide.columns])
