"""Small panels for edge cases."""

import datetime as dt
import math
import statistics

import numpy as np
import pandas as pd

DAY = dt.date(2022, 1, 1)


def panel(spark, rows):
    return spark.createDataFrame(rows, "entity string, date date, level double, rain double, temp double, demand double")


def random_panel(entities=2, days=900, seed=3, gaps=0.1, nulls=0.05, start="2021-06-01"):
    """Pandas panel with missing days and missing levels."""
    rng = np.random.default_rng(seed)
    parts = []
    for e in range(entities):
        dates = pd.date_range(start, periods=days)
        keep = rng.random(days) > gaps
        n = int(keep.sum())
        level = np.clip(50 + np.cumsum(rng.normal(0, 2, n)), 0, 100)
        level[rng.random(n) < nulls] = np.nan
        parts.append(pd.DataFrame({
            "entity": f"E{e}", "date": dates[keep].date, "level": level, "rain": rng.gamma(1.0, 3.0, n),
            "temp": np.where(rng.random(n) < 0.1, np.nan, rng.normal(15, 8, n)), "demand": rng.normal(100, 10, n)}))
    return pd.concat(parts, ignore_index=True)


def to_spark(spark, pdf):
    rows = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in pdf.itertuples(index=False)]
    return panel(spark, rows)


def plain_features(pdf, lags=(7, 14, 30, 60, 90), horizons=(7, 14, 30)):
    """The complete feature rows of one entity, one value at a time.

    Each feature looks values up by row number or by date; a value that is not there makes the feature empty. An
    empty feature takes its value of the row before; targets look ahead on the levels filled that way.
    """
    known = lambda v: None if v is None or (isinstance(v, float) and math.isnan(v)) else float(v)
    days = [d if isinstance(d, dt.date) else d.date() for d in pdf["date"]]
    column = {c: [known(v) for v in pdf[c]] for c in ("level", "rain", "temp", "demand")}
    level, place = column["level"], {d: i for i, d in enumerate(days)}

    def back(name, i, k):
        return column[name][i - k] if i >= k else None

    def change(i, k):
        now, then = back("level", i, min(lags)), back("level", i, min(lags) + k)
        return None if now is None or then is None else now - then

    def recent_days(name, i, k):
        found = [place[days[i] - dt.timedelta(days=j)] for j in range(k) if days[i] - dt.timedelta(days=j) in place]
        return [column[name][j] for j in found if column[name][j] is not None]

    def rows_before(i, k):
        part = level[max(0, i - k) : i]
        return part if len(part) == k and None not in part else None

    rows = []
    for i, day in enumerate(days):
        row = {"level": level[i], "rain": column["rain"][i], "temp": column["temp"][i], "demand": back("demand", i, 1)}
        for k in (7, 30, 90):
            found = recent_days("rain", i, k)
            row[f"rain_{k}d"] = math.fsum(found) if found else None
        warm = recent_days("temp", i, 7)
        row["temp_7d"] = math.fsum(warm) / len(warm) if warm else None
        row |= {f"lag_{k}": back("level", i, k) for k in lags} | {f"delta_{k}": change(i, k) for k in (1, 7, 30)}
        for k in (30, 180, 365):
            part = rows_before(i, k)
            row[f"rolling_mean_{k}"] = statistics.fmean(part) if part else None
        part = rows_before(i, 30)
        row["rolling_std_30"] = statistics.stdev(part) if part else None
        half, whole = row["rolling_mean_180"], row["rolling_mean_365"]
        row["trend_direction"] = None if half is None or whole is None else half - whole
        first = row[f"lag_{min(lags)}"]
        row["rain_x_level"] = None if row["rain"] is None or first is None else row["rain"] * first
        if rows:
            row = {c: rows[-1][c] if v is None else v for c, v in row.items()}
        rows.append(row)
    out = {}
    for i, row in enumerate(rows):
        turn, year = 2 * math.pi * days[i].month / 12, 2 * math.pi * days[i].timetuple().tm_yday / 365
        row = row | {"month_sin": math.sin(turn), "month_cos": math.cos(turn), "doy_sin": math.sin(year), "doy_cos": math.cos(year)}
        row |= {f"target_{h}": rows[i + h]["level"] if i + h < len(rows) else None for h in horizons}
        if None not in row.values():
            out[pd.Timestamp(days[i])] = row
    return pd.DataFrame.from_dict(out, orient="index")
