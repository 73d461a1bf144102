import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from brimline.functions.calendar import parse_day_first
from brimline.operators import cleaning, features as X, metrics as M, selection, splits
from brimline.plans import backtest
from brimline.settings import LEVEL_SUFFIX
from brimline.sources import readers, reshape, writers
from helpers import random_panel


def test_date_text(spark):
    texts = ["05.01.2023", "5/1/2023", "2023-01-05", " 5.1.2023 ", "junk", "31.02.2023", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = [r["d"] for r in df.orderBy("i").select(parse_day_first(F.col("s")).alias("d")).collect()]
    assert got == [dt.date(2023, 1, 5)] * 4 + [None] * 3


def write(path, text):
    path.write_text(text)
    return str(path)


def test_wide_csv(spark, tmp_path):
    path = write(tmp_path / "daily.csv", "\n".join([
        f"Date,Balcova{LEVEL_SUFFIX},prcp_S1,tavg_S1,evap_S1,made", "02.01.2023,130,,5.5,,7", "01.01.2023,50.5,2,NaN,,"]))
    raw = readers.read_wide_csv(spark, path)
    wide = cleaning.clean_wide(cleaning.drop_empty_columns(raw))
    assert "evap_S1" not in wide.columns and "prcp_S1_missing" in wide.columns
    assert [tuple(r) for r in reshape.levels(wide).orderBy("date").collect()] == [
        ("Balcova", dt.date(2023, 1, 1), 50.5), ("Balcova", dt.date(2023, 1, 2), None)]
    station = reshape.weather(wide).orderBy("date").collect()
    assert [(r["station"], r["prcp"], r["tavg"], r["tmax"]) for r in station] == [
        ("S1", 2.0, None, None), ("S1", 0.0, 5.5, None)]
    made = reshape.production(wide, ["made", "absent"]).orderBy("date").collect()
    assert [tuple(r) for r in made] == [(dt.date(2023, 1, 1), "made", None), (dt.date(2023, 1, 2), "made", 7.0)]


def test_csv_reads_only_used_columns(spark, tmp_path):
    path = write(tmp_path / "daily.csv", "Date,a,b\n01.01.2023,1,2\n")
    plan = readers.read_wide_csv(spark, path).select("a")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<a:string>" in plan


CONFIG = {
    "Balcova": {"prod_cols": ["made", "gone"], "weather_stations": ["S1"], "lag_days": [7, 14], "strategy": "odd"},
    "Urkmez": {"model": "LSTM", "seq_lens": [10, 20], "halflives": [90, 30], "strategy": "walkfwd_expanding"},
}


def test_config_file_and_defaults(spark, tmp_path):
    path = write(tmp_path / "config.json", json.dumps(CONFIG, indent=2))
    config = selection.with_defaults(readers.read_config(spark, path))
    got = {r["entity"]: r for r in config.collect()}
    assert got["Balcova"]["strategy"] == "baseline" and got["Balcova"]["requested_strategy"] == "odd"
    assert got["Balcova"]["model"] == "GRU" and got["Balcova"]["seq_lens"] == [30, 60, 90]
    assert got["Urkmez"]["lag_days"] == [7, 14, 30, 60, 90] and got["Urkmez"]["prod_cols"] == []
    pairs = selection.horizon_config(config).filter("entity = 'Urkmez'").orderBy("horizon").collect()
    assert [(r["horizon"], r["seq_len"]) for r in pairs] == [(7, 10), (14, 20)]
    known = spark.createDataFrame([("made",), (f"Balcova{LEVEL_SUFFIX}",), ("prcp_S1",)], "series string")
    assert [tuple(r) for r in selection.missing_production(config, known).select("entity", "series").collect()] == [("Balcova", "gone")]
    wanted = selection.project_series(config, known).orderBy("position").collect()
    assert [r["series"] for r in wanted] == [f"Balcova{LEVEL_SUFFIX}", "made", "prcp_S1"]


def test_config_round_trip(spark, tmp_path):
    config = selection.settings_for(spark, ["a", "b"], prod_cols=["x"], seq_lens=[1, 2, 3])
    path = str(tmp_path / "config")
    writers.write_config(config, path)
    assert sorted(map(str, readers.read_config(spark, path, whole_file=False).collect())) == sorted(map(str, config.collect()))


def test_choose_entities(spark):
    known = spark.createDataFrame([(e,) for e in ("Balcova", "Gordes", "Urkmez")], "entity string")
    got = selection.choose_entities(known, " Urkmez ,Nowhere,Balcova").orderBy("position").collect()
    assert [r["entity"] for r in got] == ["Urkmez", "Balcova"]
    assert [r["entity"] for r in selection.unknown_entities(known, "Urkmez,Nowhere").collect()] == ["Nowhere"]
    assert selection.choose_entities(known).count() == 3
    with pytest.raises(ValueError):
        selection.choose_entities(known, "Nowhere")


def test_rejected_rows_of_damaged_files(spark, tmp_path):
    """Lines count in their file, whatever splits it is read in; rows with any unreadable text are not among the good ones."""
    lines = ["Date,a,b", *[f"{i % 28 + 1:02d}.03.2021,{i}.5,{'NA' if i % 7 else ''}" for i in range(1, 60)]]
    lines[10], lines[20], lines[40] = "someday,1,2", "05.03.2021,x,--", ""
    lines[30], lines[31], lines[50] = "05.03.2021,1", "05.03.2021,1,2,3", ',1,"2"'
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.csv").write_text("\n".join(lines[:12]))
    for size in (200, 1 << 27):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        try:
            good, rejected = readers.split_wide_csv(spark, str(tmp_path))
            got = sorted((r["file"][-5:], r["line"], r["column"] or "", r["text"]) for r in rejected.collect())
            kept = good.collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert got == [
            ("a.csv", 11, "Date", "someday"), ("a.csv", 21, "a", "x"), ("a.csv", 21, "b", "--"), ("a.csv", 31, "", "05.03.2021,1"),
            ("a.csv", 32, "", "05.03.2021,1,2,3"), ("a.csv", 51, "Date", None), ("b.csv", 11, "Date", "someday")]
        assert len(kept) == 59 - 6 + 11 - 1 and all(r["date"] is not None and r["b"] is None for r in kept)
    with pytest.raises(Exception, match="unreadable"):
        readers.read_wide_csv(spark, str(tmp_path)).collect()


def test_date_bounds(spark):
    rows = [("North", dt.date(2010, 5, 1), None), ("North", dt.date(2010, 5, 2), 1.0),
            ("South", dt.date(2016, 1, 1), 1.0), ("West", dt.date(2016, 1, 1), None), ("East", dt.date(2017, 1, 1), 2.0)]
    panel = spark.createDataFrame(rows, "entity string, date date, level double")
    bounds = lambda *a: {r["entity"]: (r["start_date"], r["end_date"]) for r in selection.date_bounds(panel, *a).collect()}
    want = {"North": (dt.date(2015, 1, 1), dt.date(2025, 11, 19)), "South": (dt.date(2016, 1, 1), dt.date(2025, 11, 30)),
            "East": (dt.date(2017, 1, 1), None)}
    ends = {"North": "2025-11-19", "East": None, "Nowhere": "2020-01-01"}
    assert bounds(2015, ends, "2025-11-30") == want
    listed = spark.createDataFrame([(k, v and dt.date.fromisoformat(v)) for k, v in ends.items()], "entity string, end_date date")
    assert bounds(2015, listed, "2025-11-30") == want
    assert bounds() == {"North": (dt.date(2010, 5, 2), None), "South": (dt.date(2016, 1, 1), None), "East": (dt.date(2017, 1, 1), None)}
    with pytest.raises(Exception, match="two end dates for North"):
        bounds(None, listed.union(listed))


def test_plan_does_not_grow_with_ends(spark):
    panel = spark.createDataFrame([("E1", dt.date(2020, 1, 1), 1.0)], "entity string, date date, level double")
    plan = lambda n: selection.date_bounds(panel, None, {f"E{i}": "2021-01-01" for i in range(n)})._jdf.queryExecution(
        ).optimizedPlan().toString()
    assert abs(len(plan(5000)) - len(plan(5))) < 20


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Two entities and two stations in the wide file layout, read back through the reader."""
    pdf = random_panel(entities=2, days=1300, gaps=0.0, nulls=0.0, start="2020-09-01")
    wide = None
    for i, (entity, station) in enumerate((("Balcova", "S1"), ("Urkmez", "S2"))):
        own = pdf[pdf["entity"] == f"E{i}"]
        part = own[["date"]].assign(**{
            f"{entity}{LEVEL_SUFFIX}": own["level"], f"prcp_{station}": own["rain"], f"tavg_{station}": own["temp"],
            f"made_{i}": own["demand"]})
        wide = part if wide is None else wide.merge(part, on="date")
    path = tmp_path_factory.mktemp("csv") / "daily.csv"
    wide.assign(Date=[d.strftime("%d.%m.%Y") for d in wide["date"]]).drop(columns="date").to_csv(path, index=False)
    clean = cleaning.clean_wide(readers.read_wide_csv(spark, str(path)))
    return reshape.levels(clean), reshape.weather(clean), reshape.production(clean, ["made_0", "made_1"])


def test_whole_job(spark, tables, tmp_path):
    config = selection.settings_for(
        spark, ["Balcova"], prod_cols=["made_0"], weather_stations=["S1", "S2"], model="ols").unionByName(
        selection.settings_for(spark, ["Urkmez"], weather_stations=["S2"], lag_days=[7, 14], seq_lens=[10, 20, 30],
                               halflives=[90], strategy="walkfwd_expanding", model="Dense"))
    report = backtest.run(*tables, config)
    assert report.warnings.count() == 0
    summary = {r["entity"]: r for r in report.summary.collect()}
    assert summary["Balcova"]["model"] == "ols" and summary["Balcova"]["strategy"] == "baseline"
    assert summary["Urkmez"]["model"] == "ridge" and summary["Urkmez"]["strategy"] == "walkfwd_expanding"
    assert all(r[f"rmse_{h}d"] is not None for r in summary.values() for h in (7, 14, 30))
    assert report.missing.count() == 0
    assert report.predictions.filter("yhat < 0 or yhat > 100").count() == 0
    late = report.residuals.filter("datediff(target_date, date) <> horizon").count()
    assert late == 0

    path = str(tmp_path / "predictions")
    writers.write_predictions(report.predictions, path)
    back = spark.read.parquet(path)
    assert back.count() == report.predictions.count()
    csv = str(tmp_path / "summary")
    writers.write_summary(M.report_names(report.summary), csv)
    out = spark.read.option("header", True).csv(csv)
    assert out.columns[:5] == ["Dam", "Strategy", "Model", "RMSE +7d (%)", "MAE +7d (%)"] and len(out.columns) == 14
    assert out.count() == 2


def test_many_stations_of_one_entity_widen_no_other(spark, tables):
    """Inputs are as long as an entity's own settings make them, and the other entity's results stay the same."""
    levels, weather, production = tables
    many = [f"M{i}" for i in range(50)]
    more = weather.where("station = 'S1'").drop("station").withColumn("station", F.explode(F.array(*[F.lit(m) for m in many])))
    weather = weather.unionByName(more.withColumn("prcp", F.col("prcp") * (1 + F.length("station"))))
    small = selection.settings_for(spark, ["Urkmez"], weather_stations=["S2"], model="ridge", seq_lens=[10, 20, 30])
    big = selection.settings_for(spark, ["Balcova"], weather_stations=many, prod_cols=["made_0", "made_1"], model="ridge",
                                 seq_lens=[10, 20, 30])
    config = selection.settings_of(levels.select("entity").distinct(), small.unionByName(big))
    frame, nearby, made = backtest.entity_frame(levels, weather, production, config, [7, 14, 30, 60, 90])
    last = X.feature_columns(frame)
    numbered = splits.number_rows(frame).join(config.select("entity", "seq_lens"), "entity")
    inputs = backtest.with_inputs(numbered, ((nearby, backtest.STATION), (made, ("prod",))), last, [10, 20, 30])
    per = len(backtest.STATION)
    sizes = {r["entity"]: (r["own"], r["wx"]) for r in inputs.groupBy("entity").agg(
        F.max(F.size("own")).alias("own"), F.max(F.size(F.get("own_wx", 2))).alias("wx")).collect()}
    assert sizes == {"Urkmez": (per, 2 * per), "Balcova": (50 * per + 2, 2 * (50 * per + 2))}
    assert not [c for c in inputs.columns if c.endswith(("_s1", "_p1"))]
    alone = backtest.run(*tables, small, entities="Urkmez").metrics.collect()
    both = backtest.run(levels, weather, production, small.unionByName(big)).metrics.collect()
    assert len(both) == 6 and len(alone) == 3
    for r in alone:
        other = next(x for x in both if x["entity"] == "Urkmez" and x["horizon"] == r["horizon"])
        assert other["rmse"] == pytest.approx(r["rmse"], rel=1e-9)


def test_start_year_moves_the_start(spark, tables):
    config = selection.settings_for(spark, ["Balcova"], weather_stations=["S1"], model="ols")
    early = backtest.run(*tables, config).summary.first()["train_rows"]
    late = backtest.run(*tables, config, start_year=2022).summary.first()["train_rows"]
    assert late < early and late == (dt.date(2022, 12, 1) - dt.date(2022, 1, 1)).days + 1
