"""Regressors for every (entity, strategy, horizon, fold) at once.

`ols` and `ridge` are fitted from sums: one pass adds up products per cell, cells are combined into folds,
and only the combined sums are solved. No training set is ever brought together. `gbt` trains one pooled
Spark ML model per (horizon, fold) over all entities.
"""

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from brimline.functions.numeric import decay
from brimline.functions.solve import fold_sums, product_sums, ridge_solver
from brimline.operators.binning import BINS, bin_edges, binned
from brimline.operators.scaling import with_packed
from brimline.operators.splits import (
    KEYS, cells, enough_train, fold_counts, has_sequence, in_train, spread_folds, usable_folds, validation_cut,
    validation_tail,
)
from brimline.sources.writers import materialize

PENALTIES = (1e-6, 1e-4, 1e-2, 1.0)
# Trees without a gain on the validation tail after which no more are looked at.
PATIENCE = 8
# Settings keys of the replaced networks, and the regressor that does their job here.
REGISTRY = {"ols": "ols", "ridge": "ridge", "gbt": "gbt", "Dense": "ridge", "GRU": "ridge", "LSTM": "gbt"}


def model_column(name="model") -> Column:
    """Regressor for a settings column; an unknown key fails the job."""
    out = F.raise_error(F.concat(F.lit("unknown model "), F.col(name))).cast("string")
    for key, value in REGISTRY.items():
        out = F.when(F.col(name) == key, F.lit(value)).otherwise(out)
    return out


def _sample() -> Column:
    return F.col("row_no") >= F.col("seq_len")


def _block_days(halflife) -> Column:
    return F.ceil(halflife * 4)


def _block_weight(rows: DataFrame, halflife) -> DataFrame:
    """Weight of each row against the end of a calendar block of four half-lives, and the number of the block.

    Within a block weights stay above 1/16, so no sum can overflow or vanish, and no pass is needed to find the
    newest row first. A NULL half-life means equal weights.
    """
    day = F.unix_date("date")
    block = F.floor(day / _block_days(halflife))
    end = (block + 1) * _block_days(halflife)
    return rows.withColumns({
        "_block": F.coalesce(block, F.lit(0)).cast("long"),
        "_w": F.coalesce(decay(end - day, halflife), F.lit(1.0)),
    })


def _rescale(halflife) -> Column:
    """Turn weights against the end of a block into weights against the newest row of the fold."""
    end = (F.col("_block") + 1) * _block_days(halflife)
    return F.coalesce(decay(F.unix_date("latest") - end, halflife), F.lit(1.0))


def _around_least(rows: DataFrame, columns) -> tuple[DataFrame, list[Column]]:
    """The columns less their least value in the entity's series, and those values. The rows are in their entities' partitions
    already, and no order among them is asked for."""
    whole = Window.partitionBy("entity")
    names = [f"_least_{c}" for c in columns]
    out = rows.withColumns({n: F.coalesce(F.min(c).over(whole), F.lit(0.0)) for n, c in zip(names, columns)})
    return out.withColumns({c: F.col(c) - F.col(n) for n, c in zip(names, columns)}), [F.col(n) for n in names]


def _halflife(halflife) -> Column:
    return F.col(halflife) if isinstance(halflife, str) else F.lit(float(halflife))


# --- least squares on one regressor -------------------------------------------------------------


def first_values(frame: DataFrame, x: str, target: str) -> DataFrame:
    """(entity, x0, y0) from the first row of each series of a stored, numbered frame; the filter reaches the scan."""
    return frame.filter("row_no = 1").select(
        "entity", F.col(x).cast("double").alias("x0"), F.col(target).cast("double").alias("y0"))


def fit_ols(rows: DataFrame, x: str, halflife=None, keys=KEYS, around: DataFrame | None = None) -> DataFrame:
    """Slope and intercept of target on x for every fold, weighted when a half-life is given.

    Sums are taken around values of the entity, so they keep their digits when values are far from 0: those of `around`
    (entity, x0, y0), which spares the rows a shuffle, or else the least ones.
    """
    train = rows.withColumn("_x", F.col(x))
    if around is None:
        train, (x0, y0) = _around_least(train, ("_x", "target"))
    else:
        x0, y0 = (F.coalesce(c, F.lit(0.0)) for c in ("x0", "y0"))
        train = train.join(around, "entity", "left").withColumns({"_x": F.col("_x") - x0, "target": F.col("target") - y0})
    if halflife is None:
        train = train.withColumns({"_w": F.lit(1.0), "_block": F.lit(0)})
    else:
        halflife = _halflife(halflife)
        train = _block_weight(train, halflife)
    w = F.when(_sample() & F.col("train_after").isNotNull(), F.col("_w"))
    first = {"s_x0": F.min(x0), "s_y0": F.min(y0)}
    sums = {
        "s_w": F.sum(w), "s_x": F.sum(w * F.col("_x")), "s_y": F.sum(w * F.col("target")),
        "s_xx": F.sum(w * F.col("_x") * F.col("_x")), "s_xy": F.sum(w * F.col("_x") * F.col("target")),
    }
    spread = spread_folds(cells(train, sums | first, keys, ("_block",)), keys)
    factor = F.lit(1.0) if halflife is None else _rescale(halflife)
    folds = spread.groupBy(*keys, "fold").agg(
        *fold_counts(),
        *[F.sum(F.when(in_train(), F.col(s) * factor)).alias(s) for s in sums], *[F.min(s).alias(s) for s in first],
    )
    spread_x = F.col("s_xx") - F.col("s_x") * F.col("s_x") / F.col("s_w")
    spread_xy = F.col("s_xy") - F.col("s_x") * F.col("s_y") / F.col("s_w")
    flat = spread_x <= F.lit(1e-12) * F.col("s_xx")
    slope = F.when(flat, F.lit(0.0)).otherwise(spread_xy / F.nullif(spread_x, F.lit(0.0)))
    return (
        folds.filter((F.col("test_rows") > 0) & enough_train())
        .withColumn("slope", slope)
        .withColumn("intercept", F.col("s_y0") - F.col("slope") * F.col("s_x0")
                    + (F.col("s_y") - F.col("slope") * F.col("s_x")) / F.col("s_w"))
        .drop(*sums, *first)
    )


def predict_ols(rows: DataFrame, models: DataFrame, x: str, keys=KEYS) -> DataFrame:
    test = rows.filter(F.col("test_fold").isNotNull() & has_sequence())
    out = with_packed(test, models, ["slope", "intercept"], keys)
    return out.select(
        *keys, F.col("test_fold").alias("fold"), "date", F.lit("ols").alias("model"),
        F.col("target").alias("y"), (F.col("_m.intercept") + F.col("_m.slope") * F.col(x)).alias("yhat"))


# --- ridge on many inputs -----------------------------------------------------------------------


def add_means(frame: DataFrame, columns, seq_lens, keys=("entity",)) -> DataFrame:
    """Mean of each column over the last L rows, for each distinct L, from running totals; NULL before row L."""
    order = f"over (partition by {', '.join(keys)} order by date"
    out = frame.withColumns({f"_t_{c}": F.expr(f"sum(`{c}`) {order} rows unbounded preceding)") for c in columns})
    return out.withColumns({
        f"{c}_mean_{n}": F.expr(
            f"case when row_number() {order}) >= {n} then (`_t_{c}` - lag(`_t_{c}`, {n}, 0d) {order})) / {n}d end")
        for c in columns for n in sorted(set(seq_lens))
    }).drop(*[f"_t_{c}" for c in columns])


def add_slopes(frame: DataFrame, columns, seq_lens, keys=("entity",)) -> DataFrame:
    """Slope per row of each column over the last L rows, for each distinct L; NULL before row L, 0 for L = 1.

    Two running totals, of values and of values times their row number, give every slope in constant work. Values count from the
    first one of the entity, which moves no slope and keeps the totals small.
    """
    order = f"over (partition by {', '.join(keys)} order by date"
    out = frame.withColumns({"_row": F.expr(f"row_number() {order})"), **{f"_x_{c}": F.expr(
        f"`{c}` - first(`{c}`) {order} rows between unbounded preceding and current row)") for c in columns}})
    out = out.withColumns({name: F.expr(f"sum({value}) {order} rows unbounded preceding)") for c in columns for name, value in (
        (f"_t_{c}", f"`_x_{c}`"), (f"_p_{c}", f"`_x_{c}` * _row"))})

    def slope(c, n):
        if n == 1:
            return "0d"
        part = lambda t: f"(`_{t}_{c}` - lag(`_{t}_{c}`, {n}, 0d) {order}))"
        return f"({part('p')} - (_row - {(n - 1) / 2}d) * {part('t')}) / {n * (n * n - 1) / 12}d"

    return out.withColumns({
        f"{c}_slope_{n}": F.expr(f"case when _row >= {n} then {slope(c, n)} end") for c in columns for n in sorted(set(seq_lens))
    }).drop("_row", *[f"_{t}_{c}" for t in "xtp" for c in columns])


def add_windows(frame: DataFrame, columns, seq_lens, keys=("entity",)) -> DataFrame:
    """Mean and slope of each column over the last L rows."""
    return add_slopes(add_means(frame, columns, seq_lens, keys), columns, seq_lens, keys)


def add_window_vectors(frame: DataFrame, columns, seq_lens, keys=("entity",)) -> DataFrame:
    """For each distinct L the means and then the slopes of all columns over the last L rows, as an array `w_{L}`; NULL before row L.

    The same numbers as `add_windows`, for many columns and lengths: running totals are packed into two arrays, so each length asks for two
    earlier rows, not for two of every column.
    """
    order = f"over (partition by {', '.join(keys)} order by date"
    out = frame.withColumns({"_row": F.expr(f"row_number() {order})"), **{f"_x_{c}": F.expr(
        f"`{c}` - first(`{c}`) {order} rows between unbounded preceding and current row)") for c in columns}})
    out = out.withColumns({name: F.expr(f"sum({value}) {order} rows unbounded preceding)") for c in columns for name, value in (
        (f"_t_{c}", f"`_x_{c}`"), (f"_p_{c}", f"`_x_{c}` * _row"))})
    out = out.withColumns({
        "_t": F.array(*[f"_t_{c}" for c in columns]), "_p": F.array(*[f"_p_{c}" for c in columns]),
        "_first": F.array(*[F.col(f"`{c}`") - F.col(f"_x_{c}") for c in columns])}).drop(*[f"_{t}_{c}" for t in "xtp" for c in columns])
    lengths = sorted(set(seq_lens))
    out = out.withColumns({f"_{t}{n}": F.expr(f"lag(_{t}, {n}) {order})") for t in "tp" for n in lengths})
    none = F.array_repeat(F.lit(0.0), len(columns))

    def windows(n):
        t, p = (F.zip_with(f"_{x}", F.coalesce(f"_{x}{n}", none), lambda a, b: a - b) for x in "tp")
        mean = F.zip_with(t, "_first", lambda a, b: a / n + b)
        middle, spread = F.col("_row") - (n - 1) / 2, n * (n * n - 1) / 12
        slope = F.zip_with(p, t, lambda a, b: (a - middle * b) / spread) if n > 1 else none
        return F.when(F.col("_row") >= n, F.concat(mean, slope))

    return out.withColumns({f"w_{n}": windows(n) for n in lengths}).drop(
        "_row", "_t", "_p", "_first", *[f"_{t}{n}" for t in "tp" for n in lengths])


def pick_windows(rows: DataFrame, columns, seq_lens, kinds=("mean", "slope")) -> DataFrame:
    """`{column}_mean` and `{column}_slope` for the sequence length of the row."""
    lengths = sorted(set(seq_lens))
    unknown = "else cast(raise_error(concat('no windows for sequence length ', seq_len)) as double) end"
    picked = {f"{c}_{k}": F.expr("case " + " ".join(f"when seq_len = {n} then `{c}_{k}_{n}`" for n in lengths) + f" {unknown}")
              for c in columns for k in kinds}
    return rows.withColumns(picked).drop(*[f"{c}_{k}_{n}" for c in columns for k in kinds for n in lengths])


def pick_means(rows: DataFrame, columns, seq_lens) -> DataFrame:
    """`{column}_mean` for the sequence length of the row."""
    return pick_windows(rows, columns, seq_lens, ("mean",))


def _own(f, keys):
    hit = f["fold"] > F.col("train_after")
    for k in keys[1:]:
        hit = hit & f[k].eqNullSafe(F.col(k))
    return hit


def ridge_sums(rows: DataFrame, inputs, halflife=None, keys=KEYS, around_first=False) -> DataFrame:
    """Sums of products of (1, inputs, target) per fold: `fit_sums` before the validation cut, `val_sums` after.

    Rows are first labelled with the number of cuts below them, so each cell lies on one side of every cut and one
    pass over the rows serves all folds. Tasks reduce each batch of rows to one matrix per cell; only matrices are
    shuffled, and a key holds a few of them. Matrices come back flat, with the training bounds of every element in
    `lo` and `hi`: of rows with a value, so a mean over a sequence counts from the first full one. With around_first,
    sums are of values less the entity's least ones, which come back as `first`.
    """
    folds = usable_folds(rows, keys)
    cuts = folds.withColumn("cut", validation_cut())
    # Both tables made from the cuts use the same columns, so their common part runs once.
    packed = cuts.groupBy("entity").agg(F.collect_list(F.struct(
        *keys[1:], "fold", "cut", "latest", "train_rows", "test_rows")).alias("_folds"))
    every = [*inputs, "target"]
    below = F.filter("_folds", lambda f: _own(f, keys) & (f["cut"] < F.col("sample_no")))
    held = [F.lit(0.0)] * len(every)
    if around_first:
        rows, held = _around_least(rows, every)
    train = (
        rows.filter("train_after is not null").join(packed, "entity")
        .withColumn("sample_no", F.col("row_no") - F.col("seq_len") + 1)
        .withColumn("part", F.size(below))
        .select(*keys, "train_after", "part", F.unix_date("date").alias("day"), "sample_no", *every,
                F.array(*held).alias("first"))
    )
    numbers = T.ArrayType(T.DoubleType())
    cell_schema = T.StructType([
        *train.select(*keys, "train_after", "part").schema, T.StructField("last_day", T.IntegerType()),
        T.StructField("last_sample", T.IntegerType()),
        *[T.StructField(n, numbers) for n in ("first", "lo", "hi", "weighted", "plain")],
    ])
    cell = train.mapInPandas(product_sums(keys, every, halflife), cell_schema)
    by_key = [k for k in keys if k in ("entity", "strategy", "horizon")]
    listed = cuts.groupBy(*by_key).agg(F.collect_list(F.struct(
        "fold", "cut", F.unix_date("latest").alias("latest"), "train_rows", "test_rows")).alias("_f"))
    named = {"folds": "fold", "cuts": "cut", "latests": "latest", "trains": "train_rows", "tests": "test_rows"}
    listed = listed.select(*by_key, *[F.col(f"_f.{c}").alias(n) for n, c in named.items()])
    sums_schema = T.StructType([
        *train.select(*keys).schema, T.StructField("fold", T.IntegerType()),
        T.StructField("train_rows", T.LongType()), T.StructField("test_rows", T.LongType()),
        *[T.StructField(n, numbers) for n in ("first", "lo", "hi", "fit_sums", "val_sums")],
    ])
    return cell.join(listed, by_key).groupBy(*keys).applyInPandas(fold_sums(keys, halflife), sums_schema)


def fit_ridge(rows: DataFrame, inputs, halflife=None, penalties=PENALTIES, keys=KEYS) -> DataFrame:
    """Ridge on inputs scaled by the training bounds, penalty chosen on the validation tail."""
    sums = ridge_sums(rows, inputs, halflife, keys, around_first=True)
    kept = sums.drop("first", "lo", "hi", "fit_sums", "val_sums").schema
    schema = T.StructType([
        *kept,
        T.StructField("coef", T.ArrayType(T.DoubleType())),
        *[T.StructField(n, T.DoubleType()) for n in ("intercept", "penalty", "val_rmse")],
    ])
    return sums.mapInPandas(ridge_solver(len(inputs), tuple(penalties)), schema)


def predict_ridge(rows: DataFrame, models: DataFrame, inputs, keys=KEYS) -> DataFrame:
    test = rows.filter(F.col("test_fold").isNotNull() & has_sequence())
    out = with_packed(test, models, ["coef", "intercept"], keys)
    yhat = F.col("_m.intercept")
    for i, c in enumerate(inputs):
        yhat = yhat + F.col("_m.coef")[i] * F.col(c)
    return out.select(
        *keys, F.col("test_fold").alias("fold"), "date", F.lit("ridge").alias("model"),
        F.col("target").alias("y"), yhat.alias("yhat"))


# --- pooled boosted trees -----------------------------------------------------------------------


def best_round(errors, patience: int = PATIENCE) -> int:
    """Number of trees to keep: the best one found until `patience` more trees in a row brought no gain."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def first_trees(model: GBTRegressionModel, n: int) -> GBTRegressionModel:
    """The ensemble of the first n trees."""
    if n >= model.getNumTrees:
        return model
    java, gateway = model._java_obj, SparkSession.active().sparkContext._gateway
    vm, trees, weights = gateway.jvm, java.trees(), java.treeWeights()
    kept = gateway.new_array(vm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weight = gateway.new_array(vm.double, n)
    for i in range(n):
        kept[i], weight[i] = trees[i], weights[i]
    shorter = vm.org.apache.spark.ml.regression.GBTRegressionModel(f"{java.uid()}_{n}", kept, weight)
    shorter.setFeaturesCol(java.getFeaturesCol()).setPredictionCol(java.getPredictionCol())
    return GBTRegressionModel(shorter)


def fit_trees(train: DataFrame, trees: GBTRegressor, patience: int = PATIENCE) -> GBTRegressionModel:
    """Trees on the rows before the validation tail (`is_val`), as many as do best on the tail.

    The errors of all numbers of trees come from one pass over the tail. Without a tail all trees stay.
    """
    model = trees.fit(train.filter("not is_val"))
    tail = train.filter("is_val")
    if not tail.limit(1).count():
        return model
    return first_trees(model, best_round(model.evaluateEachIteration(tail, "squared"), patience))


def fit_predict_gbt(rows: DataFrame, inputs, halflife=None, seed=1, keys=KEYS, sequence=None, parallelism=4, patience=PATIENCE,
                    bins=BINS, **params) -> DataFrame:
    """One pooled boosted model per (strategy, horizon, fold), with as many trees as do best on the validation tail.

    `sequence` names a column with the flattened sequence, used in place of `inputs`. There is a fit for each strategy,
    horizon and fold, whatever the number of entities, half-lives and sequence lengths, and `parallelism` of them
    run at a time. A fit reads the rows that train it, and a test row is scored once. Rows before the first full sequence
    neither train nor test, and their means over it are NULL, so vectors are made of the others only. Inputs are put into `bins`
    bins once, by quantiles of all training rows, and stored; every fit and score reads that table.
    """
    folds = usable_folds(rows, keys)
    vector = F.col(sequence) if sequence else F.array(*[F.col(c).cast("double") for c in inputs])
    rows = rows.filter(_sample()).select(
        *keys, "date", "row_no", "test_row_no", "train_after", "test_fold", "target", vector.alias("bins"))
    rows = materialize(binned(rows, "bins", bin_edges(rows.filter("train_after is not null"), "bins", bins)))
    rows = rows.withColumn("features", array_to_vector(F.col("bins").cast("array<double>"))).drop("bins")
    fits = folds.select("strategy", "horizon", "fold").distinct().orderBy("strategy", "horizon", "fold").collect()
    test = rows.filter(F.col("test_fold").isNotNull() & has_sequence())
    test = with_packed(test, folds, ["train_rows"], keys)
    trees = GBTRegressor(
        featuresCol="features", labelCol="target", predictionCol="yhat", seed=seed,
        **{"maxIter": 30, "maxDepth": 4, "maxBins": max(bins, 2), **params})
    if halflife is not None:
        trees = trees.setWeightCol("weight")

    def fit_one(f):
        """The model of one fold, from the rows that train it; the half-life of an entity is a weight of its rows only."""
        same = (F.col("strategy") == f["strategy"]) & (F.col("horizon") == f["horizon"])
        own = folds.filter(same & (F.col("fold") == f["fold"])).select(*keys, "fold", "train_samples", "latest")
        train = rows.filter(same & (F.col("train_after") < f["fold"]))
        hit = [train[k].eqNullSafe(own[k]) for k in keys]
        train = validation_tail(train.join(own, hit).select(train["*"], "fold", "train_samples", "latest"))
        if halflife is not None:
            raw = F.coalesce(decay(F.datediff("latest", "date"), _halflife(halflife)), F.lit(1.0))
            train = train.withColumn("_w", raw).withColumn("weight", F.col("_w") / F.avg("_w").over(Window.partitionBy(*keys)))
        return fit_trees(train, trees, patience).transform(test.filter(same & (F.col("test_fold") == f["fold"])))

    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        scored = list(pool.map(fit_one, fits))
    out = reduce(DataFrame.unionByName, scored) if scored else test.withColumn("yhat", F.lit(None).cast("double"))
    return out.select(
        *keys, F.col("test_fold").alias("fold"), "date", F.lit("gbt").alias("model"),
        F.col("target").alias("y"), "yhat")
