"""Lag, rolling, calendar and interaction features over one daily series per entity.

All windows share one partitioning (entity) and one order (date), so a whole feature frame costs one
shuffle and one sort. A partition is one entity; `unique_dates` makes sure it holds one row per day, which
bounds it by the length of the calendar whatever the number of raw records behind it.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from brimline.functions.calendar import seasonal
from brimline.settings import (
    DEFAULT_LAGS, HORIZONS, MEAN_ROWS, RAIN_DAYS, STD_ROWS, TEMP_DAYS,
)


def by_date(*keys):
    return Window.partitionBy(*(keys or ("entity",))).orderBy("date")


def unique_dates(df: DataFrame, column="level", keys=("entity",)) -> DataFrame:
    """Fail when a key repeats a date or has a row without one. Rides on the window shuffle the features need anyway."""
    return df.withColumn("_again", _repeats(by_date(*keys))).withColumn(column, _checked(column, keys)).drop("_again")


def _repeats(w) -> Column:
    return F.col("date").isNull() | F.coalesce(F.lag("date").over(w) == F.col("date"), F.lit(False))


def _checked(column, keys=("entity",)) -> Column:
    message = F.concat(F.lit("duplicate date "), F.coalesce(F.col("date").cast("string"), F.lit("(none)")), F.lit(" for "),
                       F.concat_ws("/", *keys))
    return F.when(F.col("_again"), F.raise_error(message).cast("double")).otherwise(F.col(column))


def _trailing_days(function: str, column: str, days: int, keys=("entity",)) -> Column:
    return F.expr(
        f"{function}(`{column}`) over (partition by {', '.join(keys)} order by date "
        f"range between interval {days - 1} days preceding and current row)")


def _rain_sums(rain, days, keys=("entity",)):
    return {f"rain_{k}d": _trailing_days("sum", rain, k, keys) for k in days}


def rain_sums(df, rain="rain", days=RAIN_DAYS, keys=("entity",)) -> DataFrame:
    """Sum over the last k calendar days, today included."""
    return df.withColumns(_rain_sums(rain, days, keys))


def temp_mean(df, temp="temp", days=TEMP_DAYS, keys=("entity",)) -> DataFrame:
    return df.withColumn(f"temp_{days}d", _trailing_days("avg", temp, days, keys))


def _lags(rows, level, prefix="lag_", keys=("entity",)):
    w = by_date(*keys)
    return {f"{prefix}{k}": F.lag(level, k).over(w) for k in rows}


def lags(df, lag_rows=DEFAULT_LAGS, level="level") -> DataFrame:
    """Level k rows earlier."""
    return df.withColumns(_lags(lag_rows, level))


def delta_steps(lag_rows) -> list[int]:
    """Which differences a lag list asks for."""
    steps = [1]
    if 7 in lag_rows:
        steps.append(7)
    if max(lag_rows) > 30 and 30 in lag_rows:
        steps.append(30)
    return steps


def _delta_lags(lag_rows):
    """Rows back that the differences look at."""
    base = min(lag_rows)
    return [base, *[base + k for k in delta_steps(lag_rows)]]


def _deltas(lag_rows):
    base = min(lag_rows)
    return {f"delta_{k}": F.col(f"_back_{base}") - F.col(f"_back_{base + k}") for k in delta_steps(lag_rows)}


def deltas(df, lag_rows=DEFAULT_LAGS, level="level") -> DataFrame:
    """Change over k rows, seen from the shortest lag."""
    back = _lags(_delta_lags(lag_rows), level, "_back_")
    return df.withColumns(back).withColumns(_deltas(lag_rows)).drop(*back)


def _running(level, keys=("entity",)):
    so_far = by_date(*keys).rowsBetween(Window.unboundedPreceding, 0)
    return {"_sum": F.sum(level).over(so_far), "_count": F.count(level).over(so_far)}


def _ends(rows, keys=("entity",)):
    """Running totals up to the previous row and up to the row before each frame."""
    w = by_date(*keys)
    return {f"_{total}_{k}": F.lag(f"_{total}", k + 1, 0).over(w) for total in ("sum", "count") for k in (0, *rows)}


def _means(rows):
    """Mean of the k rows before this one; NULL unless all k have a value."""
    return {
        f"rolling_mean_{k}": F.expr(
            f"case when _count_0 - _count_{k} = {k} then (_sum_0 - coalesce(_sum_{k}, 0d)) / {k}d end")
        for k in rows
    }


def rolling_means(df, rows=MEAN_ROWS, level="level") -> DataFrame:
    """Mean of the k previous rows, and the direction of the long trend.

    Running totals make each row constant work instead of k additions.
    """
    ends = _ends(rows)
    out = df.withColumns(_running(level)).withColumns(ends).withColumns(_means(rows)).drop("_sum", "_count", *ends)
    if 180 in rows and 365 in rows:
        out = out.withColumn("trend_direction", F.col("rolling_mean_180") - F.col("rolling_mean_365"))
    return out


def _std(rows, level, keys=("entity",)):
    before = by_date(*keys).rowsBetween(-rows, -1)
    return {f"_std_{rows}": F.stddev_samp(level).over(before), f"_std_count_{rows}": F.count(level).over(before)}


def _full_std(rows):
    return {f"rolling_std_{rows}": F.expr(f"case when _std_count_{rows} = {rows} then _std_{rows} end")}


def rolling_std(df, rows=STD_ROWS, level="level") -> DataFrame:
    """Sample deviation of the k previous rows; kept as a frame, since totals of squares cancel badly."""
    std = _std(rows, level)
    return df.withColumns(std).withColumns(_full_std(rows)).drop(*std)


def rain_x_level(df, rain="rain", base_lag=min(DEFAULT_LAGS)) -> DataFrame:
    return df.withColumn("rain_x_level", F.col(rain) * F.col(f"lag_{base_lag}"))


def _shifts(columns, keys=("entity",)):
    return {c: F.lag(c, 1).over(by_date(*keys)) for c in columns}


def shift_one(df, columns) -> DataFrame:
    """Use yesterday's production: today's is not known yet."""
    return df.withColumns(_shifts(columns))


def _fills(columns, keys=("entity",)):
    window = f"over (partition by {', '.join(keys)} order by date rows between unbounded preceding and current row)"
    return {c: F.expr(f"last(`{c}`, true) {window}") for c in columns}


def forward_fill(df, columns, keys=("entity",)) -> DataFrame:
    return df.withColumns(_fills(columns, keys))


def targets(df, horizons=HORIZONS, level="level") -> DataFrame:
    """Level h rows ahead."""
    return df.withColumns({f"target_{h}": F.lead(level, h).over(by_date()) for h in horizons})


def settings_lags(df, lag_rows, lag_days="lag_days", level="level") -> DataFrame:
    """Lags and differences where each row names its own lag list in an array column.

    `lag_rows` holds every lag any list uses. A lag or difference the list does not ask for is 0, a constant the
    fits ignore. `base_level` is the level at the shortest lag of the row's list.
    """
    own = F.col(lag_days)
    backs = sorted({b for k in lag_rows for b in (k, k + 1, k + 7, k + 30)})
    back = _lags(backs, level, "_back_")

    def at_base(extra):
        out = F.lit(None).cast("double")
        for k in lag_rows:
            out = F.when(F.array_min(own) == k, F.col(f"_back_{k + extra}")).otherwise(out)
        return out

    asked = {
        1: F.lit(True), 7: F.array_contains(own, 7),
        30: F.array_contains(own, 30) & (F.array_max(own) > 30),
    }
    return df.withColumns(back).withColumns({
        "base_level": at_base(0),
        **{f"lag_{k}": F.when(F.array_contains(own, k), F.col(f"_back_{k}")).otherwise(0.0) for k in lag_rows},
        **{f"delta_{k}": F.when(on, at_base(0) - at_base(k)).otherwise(0.0) for k, on in asked.items()},
    }).drop(*back)


def add_seasonal(df) -> DataFrame:
    return df.withColumns(seasonal())


def complete_rows(df, horizons=HORIZONS) -> DataFrame:
    """Rows with every target, then rows without any null."""
    return df.na.drop(subset=[f"target_{h}" for h in horizons]).na.drop("any")


def feature_columns(df, horizons=HORIZONS) -> list[str]:
    """Model inputs: all but the keys, today's level and the targets."""
    out = {"entity", "date", "level"} | {f"target_{h}" for h in horizons}
    return [c for c in df.columns if c not in out]


def look_back(lag_rows=DEFAULT_LAGS) -> int:
    """Rows before a row that its features look at: the longest frame, and one more for the end of a running total."""
    return 1 + max(*lag_rows, *_delta_lags(lag_rows), *MEAN_ROWS, STD_ROWS, *RAIN_DAYS, TEMP_DAYS)


def raw_features(panel: DataFrame, lag_rows=DEFAULT_LAGS, production=("demand",), rain="rain", temp="temp",
                 keys=("entity",), kept=()) -> DataFrame:
    """The features of each row before any fill, with the columns of `kept` in front.

    `keys` are the columns of a window's partition, in which a row finds all rows that it looks back at. The same columns as the
    single operators give, grouped so that the windows run in two passes: frames over the raw columns, and ends of the running totals.
    """
    back = [k for k in _delta_lags(lag_rows)]
    df = panel.withColumns({
        "_again": _repeats(by_date(*keys)),
        **_shifts(production, keys), **_rain_sums(rain, RAIN_DAYS, keys),
        f"temp_{TEMP_DAYS}d": _trailing_days("avg", temp, TEMP_DAYS, keys),
        **_lags(lag_rows, "level", keys=keys), **_lags(back, "level", "_back_", keys),
        **_running("level", keys), **_std(STD_ROWS, "level", keys),
    })
    df = df.withColumns(_ends(MEAN_ROWS, keys))
    derived = {
        **_deltas(lag_rows), **_means(MEAN_ROWS),
        "trend_direction": F.expr("rolling_mean_180 - rolling_mean_365"), **_full_std(STD_ROWS),
        "rain_x_level": F.col(rain) * F.col(f"lag_{min(lag_rows)}"),
    }
    trend = derived.pop("trend_direction")
    df = df.withColumns(derived).withColumns({"trend_direction": trend, "level": _checked("level")})
    raw = [c for c in panel.columns if c not in ("entity", "date", *keys, *kept)]
    return df.select("entity", "date", *kept, *raw, *[f"rain_{k}d" for k in RAIN_DAYS], f"temp_{TEMP_DAYS}d",
                     *[f"lag_{k}" for k in lag_rows], *[f"delta_{k}" for k in delta_steps(lag_rows)],
                     *[f"rolling_mean_{k}" for k in MEAN_ROWS], "trend_direction", f"rolling_std_{STD_ROWS}", "rain_x_level")


def feature_frame(panel: DataFrame, lag_rows=DEFAULT_LAGS, horizons=HORIZONS,
                  production=("demand",), rain="rain", temp="temp") -> DataFrame:
    """Features on the raw level, then the fill, then targets on the filled level, then complete rows: four passes of windows."""
    df = raw_features(panel, lag_rows, production, rain, temp)
    fills = _fills([c for c in df.columns if c not in ("entity", "date")])
    df = df.select("entity", "date", *[c.alias(n) for n, c in fills.items()])
    return complete_rows(add_seasonal(targets(df, horizons)), horizons)
