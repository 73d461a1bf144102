import datetime as dt

import numpy as np
import pandas as pd
import pytest

from brimline.operators import cleaning, features as X, splits
from helpers import DAY, plain_features, panel, random_panel, to_spark


@pytest.fixture(scope="module")
def pdf():
    return random_panel(nulls=0.0)


def collected(df):
    out = df.toPandas()
    out.index = pd.to_datetime(out["date"])
    return out.sort_index()


def test_feature_frame_equals_pandas(spark, pdf):
    got = X.feature_frame(to_spark(spark, pdf))
    for entity, own in pdf.groupby("entity"):
        want = plain_features(own)
        have = collected(got.filter(got.entity == entity))
        assert list(have.index) == list(want.index) and len(want) > 100
        for c in want.columns:
            np.testing.assert_allclose(have[c], want[c], rtol=1e-9, atol=1e-9, err_msg=c)


def test_features_with_missing_levels_equal_pandas(spark):
    """Frames over raw levels need all values; lags and targets see gaps the fill closes later."""
    pdf = random_panel(entities=1, nulls=0.002, seed=11)
    got = collected(X.feature_frame(to_spark(spark, pdf)))
    want = plain_features(pdf)
    assert list(got.index) == list(want.index) and len(want) > 50
    for c in want.columns:
        np.testing.assert_allclose(got[c], want[c], rtol=1e-9, atol=1e-9, err_msg=c)


def test_single_operators_agree_with_the_frame(spark, pdf):
    df = to_spark(spark, pdf)
    one = X.add_seasonal(X.rain_x_level(X.rolling_std(X.rolling_means(X.deltas(X.lags(
        X.temp_mean(X.rain_sums(X.shift_one(X.unique_dates(df), ["demand"]))))))))
    )
    one = X.forward_fill(one, [c for c in one.columns if c not in ("entity", "date")])
    one = X.complete_rows(X.targets(one)).toPandas().sort_values(["entity", "date"], ignore_index=True)
    whole = X.feature_frame(df).toPandas().sort_values(["entity", "date"], ignore_index=True)
    pd.testing.assert_frame_equal(one[sorted(one.columns)], whole[sorted(whole.columns)])


def test_later_rows_do_not_change_earlier_features(spark, pdf):
    cut = dt.date(2023, 3, 1)
    columns = ["entity", "date", "lag_7", "delta_30", "rolling_mean_365", "rolling_std_30", "rain_90d", "demand"]
    whole = X.feature_frame(to_spark(spark, pdf)).select(*columns).filter(f"date < '{cut}'").toPandas()
    early = X.feature_frame(to_spark(spark, pdf[pdf["date"] < cut])).select(*columns).toPandas()
    both = early.merge(whole, on=["entity", "date"])
    assert len(both) == len(early) > 100
    for c in columns[2:]:
        np.testing.assert_allclose(both[f"{c}_x"], both[f"{c}_y"], rtol=1e-12)


def test_constant_window_has_no_deviation(spark):
    rows = [("a", DAY + dt.timedelta(days=i), 100.0 / 3, 0.0, 0.0, 0.0) for i in range(80)]
    got = X.rolling_std(X.rolling_means(panel(spark, rows), [30])).toPandas().dropna()
    assert len(got) == 50
    assert (got["rolling_std_30"] == 0).all()
    np.testing.assert_allclose(got["rolling_mean_30"], 100.0 / 3, rtol=1e-13)


def test_rows_and_days_differ_over_gaps(spark):
    days = [0, 1, 2, 20, 21]
    rows = [("a", DAY + dt.timedelta(days=d), float(d), 1.0, None, 0.0) for d in days]
    got = X.temp_mean(X.rain_sums(X.lags(panel(spark, rows), [2]), days=[7])).orderBy("date").collect()
    assert [r["lag_2"] for r in got] == [None, None, 0.0, 1.0, 2.0]
    assert [r["rain_7d"] for r in got] == [1.0, 2.0, 3.0, 1.0, 2.0]
    assert all(r["temp_7d"] is None for r in got)


def test_duplicate_dates_are_rejected(spark):
    rows = [("a", DAY, 1.0, 0.0, 0.0, 0.0), ("a", DAY, 2.0, 0.0, 0.0, 0.0)]
    with pytest.raises(Exception, match="duplicate date 2022-01-01 for a"):
        X.unique_dates(panel(spark, rows)).collect()


def test_duplicate_dates_fail_the_frame(spark, pdf):
    twice = pd.concat([pdf, pdf.iloc[[500]]])
    with pytest.raises(Exception, match="duplicate date"):
        X.feature_frame(to_spark(spark, twice)).collect()


def test_settings_lags(spark):
    rows = [("a", DAY + dt.timedelta(days=i), float(i * i), 0.0, 0.0, 0.0) for i in range(120)]
    df = panel(spark, rows)
    fixed = X.deltas(X.lags(df, [7, 14, 30]), [7, 14, 30]).orderBy("date").collect()[-1]
    own = X.settings_lags(df.selectExpr("*", "array(7, 14, 30) as lag_days"), [7, 14, 30, 60]).orderBy("date").collect()[-1]
    for c in ("lag_7", "lag_14", "lag_30", "delta_1", "delta_7"):
        assert own[c] == fixed[c]
    assert own["lag_60"] == 0.0 and own["delta_30"] == 0.0 and own["base_level"] == fixed["lag_7"]
    more = X.settings_lags(df.selectExpr("*", "array(14, 30, 60) as lag_days"), [7, 14, 30, 60]).orderBy("date").collect()[-1]
    assert more["lag_7"] == 0.0 and more["delta_7"] == 0.0
    assert more["delta_30"] == float((119 - 14) ** 2 - (119 - 44) ** 2)


def test_cleaning(spark):
    rows = [("a", DAY, 130.0, None, None, 0.0), ("a", DAY + dt.timedelta(days=1), -5.0, 2.0, 1.0, 0.0),
            ("a", DAY + dt.timedelta(days=2), float("nan"), 2.0, 1.0, 0.0)]
    df = panel(spark, rows)
    assert [r["level"] for r in cleaning.cap_level(df).orderBy("date").collect()] == [None, -5.0, None]
    filled = cleaning.flag_and_fill(df, ["rain"]).orderBy("date").collect()
    assert [(r["rain"], r["rain_missing"]) for r in filled] == [(0.0, 1), (2.0, 0), (2.0, 0)]
    wide = spark.createDataFrame([(DAY, 1.0, None)], "date date, x double, empty double")
    assert cleaning.drop_empty_columns(wide).columns == ["date", "x"]


def test_interpolation_equals_pandas(spark):
    pdf = random_panel(entities=1, days=200, nulls=0.3, seed=5)
    got = collected(splits.time_interpolate(to_spark(spark, pdf).select("entity", "date", "level")))
    series = pdf.set_index(pd.to_datetime(pdf["date"]))["level"].interpolate(method="time")
    np.testing.assert_allclose(got["level"].astype(float), series, rtol=1e-12, equal_nan=True)
