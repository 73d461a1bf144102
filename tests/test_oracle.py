"""Every registered query against its SQL, on the smallest tables that give it rows."""

import pytest

import __spark_entry__ as entry
from brimline.plans import catalog, oracle
from compare import differences, duck

WITHOUT_SQL = {"ridge_report", "ridge_nation_report", "gbt_report", "config_report"}
#: Series that the smallest tables make too short.
LONGER = {"metrics_nation_baseline", "metrics_nation_walkforward", "config_ols_report", "run_warnings"}


def test_only_model_fits_lack_sql():
    assert set(catalog.QUERIES) - set(oracle.SQL) == WITHOUT_SQL
    assert set(oracle.SQL) <= set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_matches_sql(spark, sf_dir, name):
    tables = "/root/testdata/sf0.01" if name in LONGER else sf_dir
    found, rows = differences(spark, duck(tables), catalog.QUERIES[name], oracle.SQL[name], tables)
    assert not found, found
    assert rows > 0


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 3
