"""A job that was ended goes on after its last whole stage, and a second run replaces what the first one wrote."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from brimline.operators import selection
from brimline.plans import backtest
from brimline.settings import WEATHER_MEASURES
from brimline.sources import writers
from helpers import random_panel, to_spark


@pytest.fixture(scope="module")
def tables(spark):
    panel = to_spark(spark, random_panel(entities=2, days=1300, gaps=0.0, nulls=0.0, start="2020-09-01")).cache()
    weather = panel.select(
        F.col("entity").alias("station"), "date",
        *[{"prcp": F.col("rain"), "tavg": F.col("temp")}.get(m, F.lit(None).cast("double")).alias(m) for m in WEATHER_MEASURES])
    made = panel.where("entity = 'E0'").select(F.lit("made").alias("series"), "date", F.col("demand").alias("value"))
    config = selection.settings_for(spark, ["E0"], prod_cols=["made"], weather_stations=["E0", "E1"], model="ridge").unionByName(
        selection.settings_for(spark, ["E1"], weather_stations=["E1"], model="ols", seq_lens=[10, 20, 30]))
    return panel.select("entity", "date", "level"), weather, made, config


def refuse(*_, **__):
    raise RuntimeError("ended")


def test_a_job_goes_on_where_it_ended(spark, tables, tmp_path, monkeypatch):
    folder = str(tmp_path / "job")
    plain = sorted(map(tuple, backtest.run(*tables).metrics.collect()))
    with monkeypatch.context() as m:
        m.setattr(backtest, "_predictions", refuse)
        with pytest.raises(RuntimeError, match="ended"):
            backtest.run(*tables, folder=folder)
    assert {"settings", "levels", "stations", "series", "frame", "inputs"} <= set(os.listdir(folder))
    with monkeypatch.context() as m:
        m.setattr(backtest, "entity_frame", refuse)
        report = backtest.run(*tables, folder=folder)
        assert sorted(map(tuple, report.metrics.collect())) == plain
        m.setattr(backtest, "_predictions", refuse)
        assert sorted(map(tuple, backtest.run(*tables, folder=folder).metrics.collect())) == plain
        # Other arguments and other inputs are other tables.
        with pytest.raises(RuntimeError, match="ended"):
            backtest.run(*tables, folder=folder, start_year=2021)
        levels = tables[0].withColumn("level", F.when(F.col("date") == dt.date(2021, 5, 5), 1.0).otherwise(F.col("level")))
        with pytest.raises(RuntimeError, match="ended"):
            backtest.run(levels, *tables[1:], folder=folder)
    report.stages.clear()
    assert not os.path.exists(folder)


def test_half_written_stages_are_made_again(spark, tmp_path):
    stages, made = writers.Stages(spark, str(tmp_path / "s")), []

    def make():
        made.append(1)
        return spark.range(5)

    assert stages.table("a", make).count() == 5 and stages.table("a", make).count() == 5 and len(made) == 1
    spark.range(3).write.parquet(str(tmp_path / "s/b"))  # files without a line in the manifest
    assert stages.table("b", make).count() == 5 and len(made) == 2
    assert writers.Stages(spark, str(tmp_path / "s"), "other").table("a", make).count() == 5 and len(made) == 3


def test_a_second_write_replaces_its_horizons(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = spark.createDataFrame([("e", h, dt.date(2020, 1, d), 1.0) for h in (7, 14) for d in (1, 2, 3)],
                                 "entity string, horizon int, date date, yhat double")
    writers.write_predictions(rows, path)
    writers.write_predictions(rows, path)
    assert spark.read.parquet(path).count() == 6
    writers.write_predictions(rows.where("horizon = 7 and date < '2020-01-03'").withColumn("yhat", F.lit(5.0)), path)
    got = {r["horizon"]: (r["n"], r["s"]) for r in spark.read.parquet(path).groupBy("horizon").agg(
        F.count("yhat").alias("n"), F.sum("yhat").alias("s")).collect()}
    assert got == {7: (2, 10.0), 14: (3, 3.0)}


def test_fingerprints(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", [1.0])], "i int, s string, x array<double>")
    same = writers.fingerprint(df)
    assert same == writers.fingerprint(df.orderBy(F.desc("i")).repartition(3))
    assert len({same, writers.fingerprint(df.union(df)), writers.fingerprint(df.where("i = 1")),
                writers.fingerprint(df.withColumn("s", F.lit("c")))}) == 4
