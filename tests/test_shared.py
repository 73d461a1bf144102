"""Fits from sums of parts of a series equal fits of each fold's own rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brimline.operators import features as X, models, shared, splits
from brimline.plans import backtest
from helpers import random_panel, to_spark
from test_backtest import brute_ridge, wf_folds

INPUTS = ("lag_7", "rain_30d", "temp_7d", "delta_1")
LENGTHS = (30, 60, 90)


@pytest.fixture(scope="module")
def frame(spark):
    df = X.feature_frame(to_spark(spark, random_panel(entities=2, days=1500, nulls=0.0, start="2020-06-01")))
    return models.add_windows(splits.number_rows(df), INPUTS, LENGTHS).cache()


def inputs_of(own, length, windows):
    x = own[list(INPUTS)].to_numpy()
    more = [own[[f"{c}_{k}_{length}" for k in ("mean", "slope") for c in INPUTS]].to_numpy()] if windows else []
    return np.hstack([x, *more])


@pytest.mark.parametrize("strategy, halflife, windows", [("baseline", None, False), ("walkfwd_expanding", 90, True)])
def test_fits_equal_direct_ones(frame, strategy, halflife, windows):
    rows = backtest.roles(frame, [strategy])
    vectors = shared.with_vectors(frame, INPUTS, INPUTS if windows else (), LENGTHS)
    fitted = shared.fit_ridge(vectors, splits.usable_folds(rows), halflife, windows=windows).toPandas()
    for entity, own in frame.toPandas().sort_values("date").groupby("entity"):
        day = pd.to_datetime(own["date"]).reset_index(drop=True)
        for horizon, length in zip((7, 14, 30), LENGTHS):
            folds = wf_folds(own["date"].tolist()) if halflife else [
                (0, np.flatnonzero(day + pd.Timedelta(days=horizon) < pd.Timestamp("2023-01-01")), None)]
            x, y = inputs_of(own, length, windows), own[f"target_{horizon}"].to_numpy()
            mine = fitted.query(f"entity == '{entity}' and horizon == {horizon}")
            assert sorted(mine["fold"]) == [f for f, *_ in folds]
            for fold, train, _ in folds:
                use = train[length - 1:]
                age = (day.iloc[use].max() - day.iloc[use]).dt.days.to_numpy()
                w = np.exp2(-age / halflife) if halflife else np.ones(len(use))
                predict = brute_ridge(x[use], y[use], w, None, (np.nanmin(x[train], 0), np.nanmax(x[train], 0)),
                                      (y[train].min(), y[train].max()), models.PENALTIES)
                r = mine[mine["fold"] == fold].iloc[0]
                np.testing.assert_allclose(x[use] @ np.array(r["coef"]) + r["intercept"], predict(x[use]), rtol=1e-6)


def test_sums_equal_those_of_each_fold(frame):
    rows = backtest.roles(frame, ["walkfwd_expanding"])
    names = ["entity", "horizon", "fold"]
    old = models.ridge_sums(rows, INPUTS, 365).toPandas().sort_values(names, ignore_index=True)
    new = shared.fold_sums(shared.with_vectors(frame, INPUTS), splits.usable_folds(rows), 365).toPandas().sort_values(names, ignore_index=True)
    assert len(old) == len(new) > 0 and (old[names] == new[names]).all(axis=None)
    for c in ("lo", "hi", "fit_sums", "val_sums"):
        np.testing.assert_allclose(np.stack(new[c]), np.stack(old[c]), rtol=1e-9)


def test_less_to_shuffle_than_by_cells(frame):
    """All strategies and horizons share the matrices of the parts; apart, each has one for every cell."""
    rows = backtest.roles(frame)
    folds = splits.usable_folds(rows)
    names = X.feature_columns(frame.drop("row_no", "test_row_no", "last_date", *[c for c in frame.columns if "_mean_" in c or "_slope_" in c]))
    whole = frame.coalesce(1).sortWithinPartitions("entity", "date")
    sums = shared.part_sums(shared.with_vectors(whole, names), shared._specs(folds, splits.KEYS)).select(
        F.coalesce(F.size("plain"), F.lit(0)).alias("plain"), F.coalesce(F.size("rows"), F.lit(0)).alias("rows")).collect()
    parts = sum(max(r["plain"], 0) + max(r["rows"], 0) for r in sums)
    cuts = folds.groupBy("entity", "strategy", "horizon").agg(F.collect_list(splits.validation_cut()).alias("cuts"))
    below = F.size(F.filter("cuts", lambda c: c < F.col("row_no") - F.col("seq_len") + 1))
    cells = rows.where("train_after is not null").join(cuts, ["entity", "strategy", "horizon"]).select(
        "entity", "strategy", "horizon", "train_after", below.alias("part")).distinct().count()
    k = len(names) + 2
    assert parts < 0.65 * cells * k * (k + 1) / 2


def test_inputs_of_different_length(frame):
    """Each entity has a vector of its own length; without folds there is no model."""
    longer = F.when(F.col("entity") == "E1", F.concat(F.array(*INPUTS), F.array("rain", "temp"))).otherwise(F.array(*INPUTS))
    vectors = shared.with_vectors(frame, INPUTS).withColumn("x", longer)
    folds = splits.usable_folds(backtest.roles(frame, ["baseline"]))
    got = {(r["entity"], r["horizon"]): r for r in shared.fit_ridge(vectors, folds).collect()}
    plain = {(r["entity"], r["horizon"]): r for r in shared.fit_ridge(shared.with_vectors(frame, INPUTS), folds).collect()}
    assert {(e, len(r["coef"])) for (e, _), r in got.items()} == {("E0", 4), ("E1", 6)}
    assert all(np.allclose(got[k]["coef"], plain[k]["coef"]) for k in plain if k[0] == "E0")
    scored = shared.predict_ridge(backtest.roles(vectors, ["baseline"]), shared.fit_ridge(vectors, folds), F.col("x"))
    assert scored.where("yhat is null").count() == 0 and scored.count() > 100
    assert shared.fit_ridge(vectors, folds.where("entity = 'nobody'")).count() == 0
