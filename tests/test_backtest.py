import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from brimline.operators import binning, features as X, metrics as M, models, scaling, sequences, splits, weights
from brimline.plans import backtest
from helpers import DAY, random_panel, to_spark

INPUTS = ("lag_7", "rain_30d", "temp_7d", "delta_1")


@pytest.fixture(scope="module")
def frame(spark):
    df = X.feature_frame(to_spark(spark, random_panel(entities=2, days=1500, nulls=0.0, start="2020-06-01")))
    return df.cache()


@pytest.fixture(scope="module")
def table(frame):
    return {e: g.sort_values("date", ignore_index=True) for e, g in frame.toPandas().groupby("entity")}


def wf_folds(dates, first="2023-01-01", months=6):
    """(fold, train positions, test positions): month numbers decide the fold of each date."""
    month = np.array([d.year * 12 + d.month for d in dates])
    year, start, _ = map(int, first.split("-"))
    fold = (month - year * 12 - start) // months
    last = max(dates)
    out = []
    for k in sorted({int(f) for f in fold if f >= 0}):
        train, test = np.nonzero(fold < k)[0], np.nonzero(fold == k)[0]
        opens = dt.date(year + (start - 1 + months * k) // 12, (start - 1 + months * k) % 12 + 1, 1)
        if len(train) > 60 and opens < last:
            out.append((k, train, test))
    return out


def brute_ridge(x, y, w, n_val, lo_hi_x, lo_hi_y, penalties):
    """Direct ridge on scaled rows, penalty by validation error; the slow way to the same numbers."""
    cut = int(len(x) * 0.8)
    (lx, hx), (ly, hy) = lo_hi_x, lo_hi_y
    sx, sy = (x - lx) / np.where(hx > lx, hx - lx, 1), (y - ly) / (hy - ly)
    best = None
    for p in penalties:
        wt = w[:cut] / w[:cut].sum()
        mx, my = wt @ sx[:cut], wt @ sy[:cut]
        a = ((sx[:cut] - mx) * wt[:, None]).T @ (sx[:cut] - mx) + p * np.eye(x.shape[1])
        b = np.linalg.solve(a, ((sx[:cut] - mx) * wt[:, None]).T @ (sy[:cut] - my))
        pred = ((sx - mx) @ b + my) * (hy - ly) + ly
        err = np.mean((pred[cut:] - y[cut:]) ** 2)
        if best is None or err < best[0]:
            best = (err, b, mx, my)
    _, b, mx, my = best
    return lambda q: (((q - lx) / np.where(hx > lx, hx - lx, 1) - mx) @ b + my) * (hy - ly) + ly


def test_folds_tile_the_test_period(spark, frame, table):
    got = splits.walk_forward_folds(frame).toPandas()
    for entity, own in table.items():
        mine = got[got["entity"] == entity].sort_values("fold")
        want = wf_folds(own["date"])
        assert list(mine["fold"]) == [f for f, _, _ in want]
        assert list(mine["train_rows"]) == [len(t) for _, t, _ in want]
        assert list(mine["test_rows"]) == [len(t) for _, _, t in want]
        assert list(mine["test_end"])[:-1] == list(mine["test_start"])[1:]


def test_fold_at_the_last_date_is_not_opened(spark):
    days = pd.date_range("2022-06-01", "2023-07-01")
    df = spark.createDataFrame([("a", d.date()) for d in days], "entity string, date date")
    assert [r["fold"] for r in splits.walk_forward_folds(df).collect()] == [0]


def test_baseline_roles(frame):
    rows = backtest.roles(frame, ["baseline"])
    train = rows.filter("train_after is not null")
    assert train.filter(F.date_add("date", F.col("horizon")) >= "2023-01-01").count() == 0
    assert rows.filter("train_after is not null and test_fold is not null").count() == 0
    last = {r["horizon"]: r["d"] for r in train.groupBy("horizon").agg(F.max("date").alias("d")).collect()}
    assert last[7] > last[14] > last[30]


def test_embargo_keeps_targets_out_of_the_test_period(frame):
    rows = backtest.roles(frame, ["walkfwd_expanding"], embargo=True)
    folds = splits.fold_table(rows)
    train = splits.training_rows(rows, folds)
    starts = F.add_months(F.lit(dt.date(2023, 1, 1)), (F.col("fold") * 6).cast("int"))
    assert train.filter(F.date_add("date", F.col("horizon")) >= starts).count() == 0
    plain = splits.fold_table(backtest.roles(frame, ["walkfwd_expanding"]))
    joined = folds.alias("a").join(plain.alias("b"), ["entity", "strategy", "horizon", "fold"])
    assert joined.filter("a.train_rows >= b.train_rows").count() == 0


def test_bad_start_day_is_refused(frame):
    with pytest.raises(ValueError):
        backtest.roles(frame, split="2023-01-31")


def test_weights_average_one_and_halve(spark):
    rows = [("a", DAY + dt.timedelta(days=10 * i)) for i in range(5)]
    got = weights.sample_weights(spark.createDataFrame(rows, "entity string, date date"), ["entity"], 10)
    w = [r["weight"] for r in got.orderBy("date").collect()]
    np.testing.assert_allclose(np.mean(w), 1.0)
    np.testing.assert_allclose(np.array(w[1:]) / np.array(w[:-1]), 2.0)


def test_scaling_uses_training_rows_only(frame, table):
    rows = backtest.roles(frame, splits.STRATEGIES)
    bounds = scaling.fold_bounds(rows, ["rain_30d"]).toPandas()
    for entity, own in table.items():
        for fold, train, _ in wf_folds(own["date"]):
            one = bounds.query(f"entity == '{entity}' and strategy == 'walkfwd_expanding' and fold == {fold} and horizon == 7")
            values = own["rain_30d"].iloc[train]
            assert one[["lo_rain_30d", "hi_rain_30d"]].values.tolist() == [[values.min(), values.max()]]


def test_constant_feature_scales_to_zero(spark, frame):
    rows = backtest.roles(frame.withColumn("same", F.lit(4.0)), ["baseline"])
    scaled = scaling.scale_rows(rows, scaling.fold_bounds(rows, ["same"]), ["same"])
    assert [r[0] for r in scaled.select("scaled_same").distinct().collect()] == [0.0]


@pytest.mark.parametrize("length", [1, 5])
def test_sequences(frame, table, length):
    got = sequences.add_sequences(frame, INPUTS, length).select("entity", "date", "sequence").collect()
    for entity, own in table.items():
        x = own[list(INPUTS)].to_numpy()
        mine = sorted((r for r in got if r["entity"] == entity), key=lambda r: r["date"])
        assert len(mine) == len(x) - length + 1
        for i in (0, len(mine) // 2, len(mine) - 1):
            np.testing.assert_array_equal(np.array(mine[i]["sequence"]), x[i:i + length])


@pytest.mark.parametrize("shard_rows", [7, 100, 5000])
def test_sequences_cut_out_of_shards(frame, shard_rows):
    """Every length up to the longest comes out of one store, which holds each row about once."""
    numbered = splits.number_rows(frame)
    stored = sequences.shards(numbered, INPUTS, 90, shard_rows).cache()
    n, k = numbered.count(), len(INPUTS)
    held = stored.agg(F.sum(F.size("data"))).first()[0]
    assert n * k <= held <= n * k * (1 + 89 / shard_rows)
    for length in (1, 30, 90):
        want = sequences.add_sequences(numbered, INPUTS, length).select("entity", "row_no", "date", "sequence")
        got = sequences.cut(stored, k, length)
        assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_ols_equals_direct_fit(frame, table):
    rows = backtest.roles(frame, ["walkfwd_expanding"])
    fitted = models.fit_ols(rows, "lag_7", 30)
    got = models.predict_ols(rows, fitted, "lag_7").toPandas()
    own = table["E0"]
    for horizon, length in ((7, 30), (30, 90)):
        for fold, train, test in wf_folds(own["date"]):
            use = train[length - 1:]
            day = pd.to_datetime(own["date"])
            age = (day.iloc[use].max() - day.iloc[use]).dt.days.to_numpy()
            w = np.sqrt(np.exp2(-age / 30))
            a = np.column_stack([np.ones(len(use)), own["lag_7"].iloc[use]])
            beta = np.linalg.lstsq(a * w[:, None], own[f"target_{horizon}"].iloc[use] * w, rcond=None)[0]
            mine = got.query(f"entity == 'E0' and horizon == {horizon} and fold == {fold}").sort_values("date")
            np.testing.assert_allclose(mine["yhat"], beta[0] + beta[1] * own["lag_7"].iloc[test], rtol=1e-8)


@pytest.mark.parametrize("strategy,halflife", [("baseline", None), ("walkfwd_expanding", 90)])
def test_ridge_equals_direct_fit(frame, table, strategy, halflife):
    rows = backtest.roles(frame, [strategy])
    fitted = models.fit_ridge(rows, INPUTS, halflife)
    got = models.predict_ridge(rows, fitted, INPUTS).toPandas()
    for entity, own in table.items():
        day = pd.to_datetime(own["date"])
        for horizon, length in ((7, 30), (30, 90)):
            if strategy == "baseline":
                split = pd.Timestamp("2023-01-01")
                test = np.flatnonzero(day >= split)[length - 1:]
                parts = [(0, np.flatnonzero(day + pd.Timedelta(days=horizon) < split), test)]
            else:
                parts = wf_folds(own["date"])
            for fold, train, test in parts:
                use = train[length - 1:]
                x, y = own[list(INPUTS)].to_numpy(), own[f"target_{horizon}"].to_numpy()
                age = (day.iloc[use].max() - day.iloc[use]).dt.days.to_numpy()
                w = np.ones(len(use)) if halflife is None else np.exp2(-age / halflife)
                predict = brute_ridge(
                    x[use], y[use], w, None, (x[train].min(0), x[train].max(0)), (y[train].min(), y[train].max()),
                    models.PENALTIES)
                mine = got.query(f"entity == '{entity}' and horizon == {horizon} and fold == {fold}").sort_values("date")
                assert len(mine) == len(test) > 0
                np.testing.assert_allclose(mine["yhat"], predict(x[test]), rtol=1e-6)


def test_short_series_give_no_model(spark):
    pdf = random_panel(entities=1, days=470, gaps=0.0, nulls=0.0, start="2021-12-01")
    frame = X.feature_frame(to_spark(spark, pdf))
    rows = backtest.roles(frame, ["baseline"], split="2023-01-01")
    assert rows.filter("test_fold = 0").count() > 0
    fitted = models.fit_ols(rows, "lag_7")
    assert fitted.count() == 0
    assert M.metrics(models.predict_ols(rows, fitted, "lag_7")).count() == 0


def test_entity_without_test_rows_is_skipped(spark):
    pdf = random_panel(entities=1, days=800, gaps=0.0, nulls=0.0, start="2020-01-01")
    rows = backtest.roles(X.feature_frame(to_spark(spark, pdf)), splits.STRATEGIES)
    assert rows.count() > 0 and splits.fold_table(rows).count() == 0


def test_context_gives_every_test_row_a_sequence(frame):
    """Sequences over context plus test rows are the sequences of the whole series at the test dates."""
    rows = backtest.roles(frame, ["walkfwd_expanding"], horizons=[7], seq_lens=[10])
    folds = splits.fold_table(rows).filter(splits.enough_train())
    joined = splits.context_rows(rows, folds).withColumn(
        "entity", F.concat_ws("/", "entity", F.col("fold").cast("string")))
    cut = sequences.add_sequences(joined, ("lag_7",), 10)
    assert cut.filter("is_context").count() == 0
    assert cut.count() == rows.join(folds.withColumnRenamed("fold", "test_fold").select("entity", "test_fold"),
                                    ["entity", "test_fold"], "left_semi").count()
    whole = sequences.add_sequences(frame, ("lag_7",), 10, "whole").select("entity", "date", "whole")
    both = cut.withColumn("entity", F.split("entity", "/")[0]).join(whole, ["entity", "date"])
    assert both.count() == cut.count() and both.filter("sequence <> whole").count() == 0


def test_gbt_on_flattened_sequences(spark, frame):
    """Trees on the whole sequence, stopped on the validation tail, weighted by age."""
    one = sequences.add_sequences(splits.number_rows(frame), ("lag_7", "rain_7d"), 10, "sequence")
    rows = backtest.roles(one.withColumn("flat", sequences.flat()).drop("sequence"), ["baseline"], horizons=[7], seq_lens=[10])
    got = models.fit_predict_gbt(rows, None, 365, sequence="flat", maxIter=3, maxDepth=2)
    errors = M.metrics(got).collect()
    assert len(errors) == 2 and all(r["rmse"] < 40 for r in errors)
    again = M.metrics(models.fit_predict_gbt(rows, None, 365, sequence="flat", maxIter=3, maxDepth=2)).collect()
    assert sorted(r["rmse"] for r in errors) == pytest.approx(sorted(r["rmse"] for r in again))


@pytest.mark.parametrize("y,yhat,want", [
    ([5.0, 5.0], [5.0, 5.0], 1.0), ([5.0, 5.0], [5.0, 6.0], 0.0), ([5.0], [5.0], None),
    ([1.0, 3.0], [1.0, 2.0], 0.5), ([90.0, 110.0], [90.0, 300.0], 0.5),
])
def test_r2_edges(spark, y, yhat, want):
    rows = [("a", "baseline", "ols", 7, DAY, a, b) for a, b in zip(y, yhat)]
    got = M.metrics(spark.createDataFrame(
        rows, "entity string, strategy string, model string, horizon int, date date, y double, yhat double")).first()
    assert got["r2"] == (pytest.approx(want) if want is not None else None)


def test_unknown_model(spark):
    named = spark.createDataFrame([("Dense",), ("LSTM",), ("ols",)], "model string")
    assert [r[0] for r in named.select(models.model_column()).collect()] == ["ridge", "gbt", "ols"]
    with pytest.raises(Exception, match="unknown model"):
        spark.createDataFrame([("Transformer",)], "model string").select(models.model_column()).collect()


def test_trees_score_each_row_once_under_mixed_half_lives(frame):
    rows = backtest.roles(frame, ["baseline"], horizons=(7,), seq_lens=(30,)).withColumn(
        "halflife", F.when(F.col("entity") == "E0", F.lit(90)).otherwise(F.lit(365)))
    keys = (*splits.KEYS, "halflife")
    got = models.fit_predict_gbt(rows, INPUTS, "halflife", keys=keys, maxIter=2, maxDepth=2)
    assert got.count() == got.select("entity", "date").distinct().count() > 0


@pytest.mark.parametrize("offset", [0.0, 1e6, 1e9])
def test_fits_keep_their_digits_far_from_zero(frame, offset):
    rows = backtest.roles(frame, ["baseline"], horizons=(7,), seq_lens=(30,)).cache()
    moved = rows.withColumn("lag_7", F.col("lag_7") + offset)
    slopes = [[r["slope"] for r in models.fit_ols(d, "lag_7").orderBy("entity").collect()] for d in (rows, moved)]
    assert np.allclose(*slopes, rtol=1e-5)
    given = models.first_values(splits.number_rows(frame).withColumn("lag_7", F.col("lag_7") + offset), "lag_7", "target_7")
    around = [(r["slope"], r["intercept"]) for r in models.fit_ols(moved, "lag_7", around=given).orderBy("entity").collect()]
    assert np.allclose([a for a, _ in around], slopes[0], rtol=1e-5)
    coefs = [[r["coef"] for r in models.fit_ridge(d, ("lag_7", "rain_30d")).orderBy("entity").collect()] for d in (rows, moved)]
    assert np.allclose(*coefs, rtol=1e-5)


def test_means_start_with_the_first_full_sequence(spark):
    rows = [("a", DAY + dt.timedelta(days=i), float(i)) for i in range(10)]
    got = models.add_means(spark.createDataFrame(rows, "entity string, date date, x double"), ["x"], [4]).orderBy("date")
    assert [r["x_mean_4"] for r in got.collect()] == [None] * 3 + [i - 1.5 for i in range(3, 10)]


@pytest.mark.parametrize("offset", [0.0, 1e7])
def test_slopes_equal_a_fitted_line(spark, offset):
    pdf = random_panel(entities=2, days=400, gaps=0.2, nulls=0.0)
    pdf["level"] += offset
    got = models.add_windows(to_spark(spark, pdf), ["level", "rain"], [1, 5, 90]).toPandas()
    for _, g in got.groupby("entity"):
        g = g.sort_values("date", ignore_index=True)
        for c in ("level", "rain"):
            assert g[f"{c}_slope_1"].eq(0).all()
            for n in (5, 90):
                x = g[c].to_numpy()
                want = [np.polyfit(np.arange(n), x[i - n + 1 : i + 1] - offset, 1)[0] for i in range(n - 1, len(x))]
                assert g[f"{c}_slope_{n}"].isna().sum() == n - 1
                np.testing.assert_allclose(g[f"{c}_slope_{n}"].iloc[n - 1 :], want, atol=1e-7 if offset else 1e-9)


def test_window_vectors_equal_window_columns(spark):
    df = to_spark(spark, random_panel(entities=2, days=300, gaps=0.2, nulls=0.0)).withColumn("level", F.col("level") + 1e6)
    names, lengths = ["level", "rain", "demand"], [1, 5, 40]
    both = models.add_window_vectors(models.add_windows(df, names, lengths), names, lengths).toPandas()
    for n in lengths:
        want = both[[f"{c}_{k}_{n}" for k in ("mean", "slope") for c in names]].to_numpy()
        there = ~np.isnan(want).any(1)
        assert (both[f"w_{n}"].notna() == there).all() and (~there).sum() == 2 * (n - 1)
        np.testing.assert_allclose(np.stack(both[f"w_{n}"][there]), want[there], rtol=1e-9, atol=1e-7)


def test_windows_of_the_row_s_own_length(frame):
    rows = models.pick_windows(backtest.roles(models.add_windows(splits.number_rows(frame), ["lag_7"], [30, 60, 90])),
                               ["lag_7"], [30, 60, 90])
    assert {"lag_7_mean", "lag_7_slope"} <= set(rows.columns) and not any(c.endswith(("_30", "_60")) and "lag_7_" in c for c in rows.columns)
    assert rows.filter("(row_no >= seq_len) <> (lag_7_slope is not null)").count() == 0


def test_best_round():
    assert models.best_round([5, 4, 3, 3.5, 3.2]) == 3
    assert models.best_round([5, 4] + [6] * 8 + [1]) == 2 and models.best_round([5, 4] + [6] * 7 + [1]) == 10
    assert models.best_round([1]) == 1 and models.best_round([2, 2, 2], 1) == 1


def test_trees_kept_where_more_of_them_hurt(spark):
    """Noise that trees learn by heart: the kept number is that of a search over all prefixes, and less than all."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(600):
        x = rng.normal(size=3)
        rows.append((*map(float, x), float(2 * (x[0] > 0) + rng.normal(0, 3)), i >= 450, 1.0 + i % 3))
    df = spark.createDataFrame(rows, "a double, b double, c double, target double, is_val boolean, weight double")
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).cache()
    for weight in (None, "weight"):
        trees = GBTRegressor(featuresCol="features", labelCol="target", predictionCol="yhat", seed=1, maxIter=15, maxDepth=4)
        if weight:
            trees = trees.setWeightCol(weight)
        whole = trees.fit(df.filter("not is_val"))
        tail = df.filter("is_val")
        errors = [models.first_trees(whole, n).transform(tail).select(
            F.avg(F.pow(F.col("yhat") - F.col("target"), 2)).alias("e")).first()["e"] for n in range(1, 16)]
        kept = models.fit_trees(df, trees, 50)
        want = int(np.argmin(errors)) + 1
        assert kept.getNumTrees == want < 15 and errors[want - 1] < errors[-1]
        sums = sum(w * t.predict(tail.first()["features"]) for w, t in zip(whole.treeWeights[:want], whole.trees))
        assert kept.transform(tail.limit(1)).first()["yhat"] == pytest.approx(sums)
        patient = models.fit_trees(df, trees, 2)
        assert patient.getNumTrees == models.best_round(errors, 2)
    assert models.fit_trees(df.filter("not is_val"), trees).getNumTrees == 15


def test_bins(spark):
    rng = np.random.default_rng(1)
    x = np.column_stack([rng.normal(size=3000), rng.integers(0, 5, 3000), np.full(3000, 7.0)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i int, v array<double>").repartition(4)
    edges = binning.bin_edges(df, "v", 16)
    assert len(edges[0]) == 15 and edges[1] == [0, 1, 2, 3, 4] and edges[2] == [7.0]
    got = binning.binned(df, "v", edges).orderBy("i").toPandas()
    for k in range(3):
        assert [v[k] for v in got["v"]] == np.searchsorted(edges[k], x[:, k]).tolist()
    sizes = np.bincount([v[0] for v in got["v"]])
    assert len(sizes) == 16 and sizes.min() > 150  # of 187 rows each


def test_trees_on_bins_predict_as_on_values(spark, frame, monkeypatch):
    """Inputs of few values lose nothing in bins; one binned table serves all fits."""
    few = frame.withColumns({c: F.pmod(F.floor(c), F.lit(n)).cast("double") for c, n in (("lag_7", 7), ("rain_30d", 5))})
    rows = backtest.roles(few, ["walkfwd_expanding"], horizons=[7], seq_lens=[10])
    made = []
    monkeypatch.setattr(models, "binned", lambda *a: made.append(1) or binning.binned(*a))
    got = models.fit_predict_gbt(rows, ("lag_7", "rain_30d"), maxIter=4, maxDepth=3, patience=99).toPandas()
    assert len(made) == 1 and got["fold"].nunique() > 2
    folds = splits.usable_folds(rows)
    train = splits.validation_tail(splits.training_rows(rows, folds).filter("fold = 1"))
    vectors = VectorAssembler(inputCols=["lag_7", "rain_30d"], outputCol="features")
    trees = GBTRegressor(featuresCol="features", labelCol="target", predictionCol="yhat", seed=1, maxIter=4, maxDepth=3)
    want = models.fit_trees(vectors.transform(train), trees, 99).transform(
        vectors.transform(rows.filter("test_fold = 1 and row_no >= seq_len"))).toPandas()
    both = got[got["fold"] == 1].merge(want, on=["entity", "date"])
    assert len(both) == len(want) > 0
    np.testing.assert_allclose(both["yhat_x"], both["yhat_y"], rtol=1e-9)
