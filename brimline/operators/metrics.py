"""Errors of bounded predictions, report tables and residuals."""

from pyspark.sql import Column, DataFrame, functions as F

from brimline.functions.numeric import clip
from brimline.settings import HORIZONS

GROUP = ("entity", "strategy", "model", "horizon")


def bounded(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("yhat", clip("yhat"))


def r2(sse: Column, sst: Column, n: Column) -> Column:
    """1 - SSE / SST; with a constant target 1 for a perfect fit, else 0; NULL below two rows."""
    flat = F.when(sse == 0, F.lit(1.0)).otherwise(0.0)
    return F.when(n >= 2, F.when(sst == 0, flat).otherwise(1 - sse / F.nullif(sst, F.lit(0.0))))


def metrics(predictions: DataFrame, group=GROUP) -> DataFrame:
    """RMSE, MAE and R2 over all predictions of a group, all folds together.

    SST comes from var_pop, which Spark merges from centred partial states, so one pass is enough.
    """
    err = F.col("y") - F.col("yhat")
    sums = bounded(predictions).groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(err * err).alias("sse"),
        F.avg(F.abs(err)).alias("mae"),
        F.var_pop("y").alias("var_y"),
        F.min("y").alias("low"), F.max("y").alias("high"),
    )
    sst = F.when(F.col("low") == F.col("high"), F.lit(0.0)).otherwise(F.col("var_y") * F.col("n"))
    return sums.select(
        *group, "n",
        F.sqrt(F.col("sse") / F.col("n")).alias("rmse"), "mae",
        r2(F.col("sse"), sst, F.col("n")).alias("r2"),
    )


def missing_horizons(entities: DataFrame, produced: DataFrame, horizons=HORIZONS) -> DataFrame:
    """Expected (entity, horizon) pairs without metrics."""
    expected = entities.select(
        "entity", F.explode(F.array(*[F.lit(h) for h in horizons])).alias("horizon"))
    return expected.join(produced, ["entity", "horizon"], "left_anti")


def summary(table: DataFrame, counts: DataFrame, horizons=HORIZONS) -> DataFrame:
    """One row per entity: three errors per horizon, training rows of the longest horizon, test rows.

    With several folds the training rows are those of the last one and the test rows those of all. Horizons
    without metrics leave NULLs.
    """
    keys = ["entity", "strategy", "model"]
    wide = table.groupBy(*keys).pivot("horizon", list(horizons)).agg(
        F.first("rmse").alias("rmse"), F.first("mae").alias("mae"), F.first("r2").alias("r2"))
    sizes = counts.groupBy("entity", "strategy", "horizon").agg(
        F.max("train_rows").alias("train_rows"), F.sum("test_rows").alias("test_rows"),
    ).groupBy("entity", "strategy").agg(
        F.max(F.when(F.col("horizon") == max(horizons), F.col("train_rows"))).alias("train_rows"),
        F.max("test_rows").alias("test_rows"))
    return wide.join(sizes, ["entity", "strategy"], "left").select(
        *keys,
        *[F.round(f"{h}_{m}", 4 if m == "r2" else 2).alias(f"{m}_{h}d")
          for h in horizons for m in ("rmse", "mae", "r2")],
        "train_rows", "test_rows")


def report_names(table: DataFrame, horizons=HORIZONS) -> DataFrame:
    """The summary under the column names of the report file."""
    return table.select(
        F.col("entity").alias("Dam"), F.col("strategy").alias("Strategy"), F.col("model").alias("Model"),
        *[c for h in horizons for c in (
            F.col(f"rmse_{h}d").alias(f"RMSE +{h}d (%)"), F.col(f"mae_{h}d").alias(f"MAE +{h}d (%)"),
            F.col(f"r2_{h}d").alias(f"R2 +{h}d"))],
        F.col("train_rows").alias("Train rows"), F.col("test_rows").alias("Test rows"))


def residuals(predictions: DataFrame) -> DataFrame:
    """Residual, its sign and the band between truth and prediction, dated at the day predicted."""
    p = bounded(predictions)
    residual = F.col("y") - F.col("yhat")
    return p.select(
        "entity", "strategy", "model", "horizon", "date",
        F.date_add("date", F.col("horizon")).alias("target_date"),
        "y", "yhat", residual.alias("residual"), (residual < 0).alias("is_negative"),
        F.least("y", "yhat").alias("band_low"), F.greatest("y", "yhat").alias("band_high"))
