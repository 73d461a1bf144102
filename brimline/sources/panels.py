"""Daily panels derived from the order tables.

Each panel is one aggregate on (entity, date), so raw rows are combined map-side before the shuffle: an
entity that owns a third of the raw rows still contributes one partial row per task and day. After it, an
entity holds at most one row per calendar day.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _panel(rows: DataFrame, *keys) -> DataFrame:
    filled = F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).otherwise(0.0)
    return (
        rows.groupBy(*keys, F.col("l_shipdate").cast("date").alias("date"))
        .agg(
            (F.lit(100.0) * F.sum(filled) / F.sum("l_quantity")).alias("level"),
            F.sum("l_quantity").alias("rain"),
            (F.avg("l_discount") * 100).alias("temp"),
            F.sum("l_extendedprice").alias("demand"),
        )
    )


def _named(panel: DataFrame, entity) -> DataFrame:
    return panel.select(entity.alias("entity"), "date", "level", "rain", "temp", "demand")


def flag_panel(spark, sf_dir):
    """Few entities with a dense history."""
    return _named(_panel(table(spark, sf_dir, "lineitem"), "l_returnflag"), F.col("l_returnflag"))


def supplier_panel(spark, sf_dir):
    """Many entities with calendar gaps."""
    panel = _panel(table(spark, sf_dir, "lineitem"), "l_suppkey")
    return _named(panel, F.concat(F.lit("S"), F.col("l_suppkey").cast("string")))


def _with_supplier(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))


def region_panel(spark, sf_dir, entities=None):
    """Rows are grouped by the region number; the name joins the few groups, not the rows.

    With `entities`, a table of names, the records of all others are left out before they are grouped.
    """
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    if entities is not None:
        region = region.join(entities, F.col("entity") == F.col("r_name"), "left_semi")
        nation = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
    rows = _with_supplier(spark, sf_dir).join(nation, F.col("n_nationkey") == F.col("s_nationkey"))
    panel = _panel(rows, "n_regionkey").join(region, F.col("r_regionkey") == F.col("n_regionkey"))
    return _named(panel, F.col("r_name"))


def nation_flag_panel(spark, sf_dir):
    """Many entities with a long history."""
    panel = _panel(_with_supplier(spark, sf_dir), "s_nationkey", "l_returnflag")
    panel = panel.join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    return _named(panel, F.concat("n_name", F.lit("-"), "l_returnflag"))


def station_panel(spark, sf_dir):
    panel = (
        _with_supplier(spark, sf_dir)
        .groupBy("s_nationkey", F.col("l_shipdate").cast("date").alias("date"))
        .agg(
            F.sum("l_quantity").alias("prcp"),
            (F.avg("l_discount") * 100).alias("tavg"),
            F.max("l_tax").alias("tmax"),
            F.min("l_tax").alias("tmin"),
        )
    )
    return panel.join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey")).select(
        F.col("n_name").alias("station"), "date", "prcp", "tavg", "tmax", "tmin")


def dirty_panel(spark, sf_dir):
    """The flag panel with nulls, levels above 100 and an empty column."""
    spike = (F.col("entity") == "A") & F.col("date").between("1996-02-10", "1996-02-12")
    return flag_panel(spark, sf_dir).select(
        "entity", "date",
        F.when(spike, 130.0).when(F.col("date") != "1997-05-05", F.col("level")).alias("level"),
        F.when(F.dayofmonth("date") != 11, F.col("rain")).alias("rain"),
        F.when(F.dayofmonth("date") != 17, F.col("temp")).alias("temp"),
        "demand",
        F.lit(None).cast("double").alias("empty_col"),
    )


def region_config(spark, sf_dir):
    """One settings row per region: its nations as stations, some fields left to the defaults."""
    stations = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
        .groupBy(F.col("r_name").alias("entity"), F.col("r_regionkey").alias("number"))
        .agg(F.array_sort(F.collect_list("n_name")).alias("weather_stations"))
    )
    n = F.col("number")
    return stations.select(
        "entity",
        F.array(F.lit("demand"), F.lit("absent_series")).alias("prod_cols"),
        "weather_stations",
        F.when(n % 2 == 0, F.array(F.lit(7), F.lit(14), F.lit(30))).alias("lag_days"),
        F.when(n == 1, F.lit("Dense")).when(n == 3, F.lit("LSTM")).alias("model"),
        F.when(n == 2, F.array(F.lit(10), F.lit(20), F.lit(30)))
        .when(n == 4, F.array(F.lit(15), F.lit(45))).alias("seq_lens"),
        F.when(n == 3, F.array(F.lit(180), F.lit(90))).alias("halflives"),
        F.when(n == 1, F.lit("walkfwd_expanding")).when(n == 2, F.lit("rolling")).alias("strategy"),
    )
