"""Plans keep the shape the design relies on."""

import re

from pyspark.sql import functions as F

from brimline.operators import features as X, models
from brimline.plans import backtest, catalog
from brimline.sources import panels as P


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)


def test_feature_frame_shuffles_once_after_the_panel(spark, sf_dir):
    text = plan(X.feature_frame(P.flag_panel(spark, sf_dir)))
    assert len(shuffles(text)) == 2
    assert text.count("+- Sort [") + text.count("Sort [entity") <= 2
    assert text.count("Window [") == 4


def test_panel_combines_before_the_shuffle(spark, sf_dir):
    text = plan(P.supplier_panel(spark, sf_dir))
    assert len(shuffles(text)) == 1 and "partial_sum" in text


def test_scan_reads_only_needed_columns(spark, sf_dir):
    text = plan(catalog.rain_range_sums(spark, sf_dir))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_quantity", "l_suppkey", "l_shipdate"}


def test_entity_filter_reaches_the_scan(spark, sf_dir):
    text = plan(catalog.lags(spark, sf_dir).filter("entity = 'S3'"))
    filtered = plan(X.feature_frame(P.flag_panel(spark, sf_dir)).filter("entity = 'A'"))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,A)]" in filtered
    assert text.index("Filter") > text.index("Window")


def test_fit_and_score_do_not_move_rows_again(spark, sf_dir):
    """Both branches shuffle the raw records into the panel and the panel by entity; nothing else is shuffled."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = backtest.roles(X.feature_frame(P.flag_panel(spark, sf_dir)), ["walkfwd_expanding"], "2000-01-01")
        scored = models.predict_ols(rows, models.fit_ols(rows, "lag_7", 365), "lag_7")
        keys = shuffles(plan(scored))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(keys) == 4
    assert sum(k.startswith("l_returnflag") for k in keys) + sum("entity" in k.split(",")[0] for k in keys) == 4


def test_no_cross_join_and_no_forced_broadcast(spark, sf_dir):
    rows = catalog._roles(spark, sf_dir, ["baseline", "walkfwd_expanding"])
    text = plan(models.ridge_sums(rows, ("lag_7", "rain_30d"), 365))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_sources_hold_no_forbidden_calls():
    from pathlib import Path
    root = Path(__file__).resolve().parent.parent / "brimline"
    text = "\n".join(p.read_text() for p in root.rglob("*.py") if "llm" not in p.parts)
    for call in ("localCheckpoint", "crossJoin", "toPandas", ".rdd", "F.udf", "F.broadcast("):
        assert call not in text, call


def test_column_prune_of_stored_table(spark, sf_dir):
    stored = catalog._stored(spark, sf_dir, P.flag_panel)
    rows = backtest.roles(stored, ["baseline"], "2000-01-01")
    text = plan(rows.filter(F.col("horizon") == 7).select("entity", "date", "target"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "rolling_mean_365" not in schema


def test_choice_of_entities_comes_before_the_groups(spark, sf_dir):
    text = plan(catalog.entity_subset(spark, sf_dir))
    assert text.count("lineitem.parquet") == 1
    assert text.rindex("LeftSemi") > text.index("HashAggregate")


def test_panel_is_read_once(spark, sf_dir):
    for name, scans in (("config_projection", 2), ("missing_config_columns", 2), ("drop_empty_series", 1), ("date_bounds", 0),
                        ("missing_horizons", 0)):
        assert plan(catalog.QUERIES[name](spark, sf_dir)).count("lineitem.parquet") == scans, name


def test_the_job_joins_production_by_series_and_date(spark, sf_dir):
    levels, weather, demand = catalog._job_tables(spark, sf_dir)
    from brimline.operators import selection
    config = selection.settings_of(levels.select("entity").distinct(), P.region_config(spark, sf_dir))
    text = plan(backtest.entity_frame(levels, weather, demand, config)[0])
    assert "NestedLoop" not in text and "Cartesian" not in text and "lineitem" not in text
