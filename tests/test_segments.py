"""Features by segments equal those of whole series."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brimline.operators import features as X, segments
from helpers import panel, random_panel, to_spark


def same(got, want):
    got, want = (f.toPandas().sort_values(["entity", "date"], ignore_index=True) for f in (got, want))
    assert list(got.columns) == list(want.columns) and len(got) == len(want) > 0
    assert (got["entity"] == want["entity"]).all() and (got["date"] == want["date"]).all()
    for c in got.columns[2:]:
        np.testing.assert_allclose(got[c], want[c], rtol=1e-9, atol=1e-9, err_msg=c)


@pytest.fixture(scope="module")
def table(spark):
    """Three series with gaps, missing levels and weather, one of them short, one with levels missing for longer than a segment."""
    pdf = random_panel(entities=2, days=2600, seed=5, gaps=0.2, nulls=0.05, start="2010-03-01")
    short = random_panel(entities=1, days=500, seed=6, gaps=0.0, nulls=0.0)
    short["entity"] = "short"
    hole = random_panel(entities=1, days=1500, seed=7, gaps=0.0, nulls=0.0, start="2012-01-01")
    hole["entity"] = "hole"
    hole.loc[800:930, "level"] = np.nan
    hole.loc[100:1000, "temp"] = np.nan
    return to_spark(spark, pd.concat([pdf, short, hole], ignore_index=True)).cache()


@pytest.mark.parametrize("segment_rows, part_days", [(100, 90), (700, 365), (10000, 20000)])
def test_segments_equal_whole_series(table, segment_rows, part_days):
    same(segments.feature_frame(table, segment_rows=segment_rows, part_days=part_days), X.feature_frame(table))


def test_numbers_and_fills(table):
    got = segments.numbered(table, ("level", "temp"), 40).toPandas().sort_values(["entity", "date"], ignore_index=True)
    for _, g in got.groupby("entity"):
        assert g["row_no"].tolist() == list(range(1, len(g) + 1))
        for c in ("level", "temp"):
            pd.testing.assert_series_equal(g[f"{c}_filled"], g[c].ffill(), check_names=False)


def test_a_task_gets_a_segment_and_its_halo(table):
    rows = segments.numbered(table)
    halo = segments.with_halo(rows, 200, 50, 10)
    sizes = halo.groupBy("entity", "segment").agg(F.count(F.lit(1)).alias("n"), F.count_if("core").alias("core")).collect()
    assert max(r["n"] for r in sizes) == 260 and max(r["core"] for r in sizes) == 200
    assert sum(r["core"] for r in sizes) == rows.count()
    longest = rows.groupBy("entity").count().agg(F.max("count")).first()[0]
    assert len({r["segment"] for r in sizes if r["core"]}) == -(-longest // 200)


def test_no_window_over_a_whole_series(table):
    """Windows by entity alone stand above counts and last values of parts, never above rows."""
    plan = segments.numbered(table, ("level",))._jdf.queryExecution().optimizedPlan().toString().splitlines()
    for i, line in enumerate(plan):
        if "Window [" in line and "[entity" in line and "_part" not in line.split("], [entity")[1].split("]")[0]:
            assert any("Aggregate" in x for x in plan[i + 1 : i + 3]), plan[i : i + 3]


@pytest.mark.parametrize("bad", [dt.date(2020, 1, 5), None])
def test_repeated_and_missing_dates_fail(spark, bad):
    rows = [("E", dt.date(2020, 1, d), 1.0, 1.0, 1.0, 1.0) for d in range(1, 20)] + [("E", bad, 1.0, 1.0, 1.0, 1.0)]
    with pytest.raises(Exception, match="duplicate date"):
        segments.feature_frame(panel(spark, [r for r in rows if r[1]]) if bad else spark.createDataFrame(
            rows, "entity string, date date, level double, rain double, temp double, demand double"), segment_rows=5).collect()
