"""Reading wide daily tables and settings."""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from brimline.functions.calendar import parse_day_first
from brimline.functions.numeric import finite
from brimline.settings import CONFIG_SCHEMA, SETTINGS_SCHEMA


def read_wide_csv(spark: SparkSession, path: str, date_column="Date") -> DataFrame:
    """Wide daily table: day-first text date plus numeric columns.

    Only the header line is read to learn the names; values are cast when a column is used, so no pass over the
    data is spent on type inference and unused columns are never parsed. Text that is no date or no number fails the
    job when its column is used: as NULL it would enter windows unseen.
    """
    raw = spark.read.option("header", True).csv(path)
    values = [c for c in raw.columns if c != date_column]
    return raw.select(
        _readable(F.col(f"`{date_column}`"), parse_day_first, "date").alias("date"),
        *[finite(_readable(F.col(f"`{c}`"), _number, "double")).alias(c) for c in values])


def _number(text):
    return text.try_cast("double")


def _allowed(text, read, kind: str):
    """Whether a text has a value; empty text is NULL, but for a date."""
    absent = F.trim(text).isin("", "NA", "null") | text.isNull()
    return read(text).isNotNull() if kind == "date" else read(text).isNotNull() | absent


def _readable(text, read, kind: str):
    """The value of a text; text that is not allowed fails."""
    message = F.concat(F.lit("unreadable "), F.lit(kind), F.lit(": "), F.coalesce(text, F.lit("(empty)")))
    return F.when(_allowed(text, read, kind), read(text)).otherwise(F.raise_error(message).cast(kind))


def split_wide_csv(spark: SparkSession, path: str, date_column="Date") -> tuple[DataFrame, DataFrame]:
    """The wide table of a damaged file without its unreadable rows, and those: (file, line, column, text).

    `rejected` has a row for each text that is no date or no number, and one with a NULL column and the whole line for a line with too
    few or too many fields. Lines count from 1 in their file, the header and empty lines included; a field is within one line. Only
    the numbers of lines cost another pass, and only where `rejected` is read: lines are counted for each split of a file.
    """
    first = spark.read.option("header", True).csv(path)
    names = first.columns
    header = spark.read.text(path).where("trim(value) <> ''").first()
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"))
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))] + [T.StructField("bad", T.StringType())])
    parsed = lines.where((F.trim("value") != "") & (F.col("value") != (header["value"] if header else ""))).select(
        "file", "split", "at", "value", F.from_csv("value", schema.simpleString()[7:-1].replace(":", " "), {
            "columnNameOfCorruptRecord": "bad"}).alias("r"))
    at = names.index(date_column)
    kinds = [(parse_day_first, "date") if i == at else (_number, "double") for i in range(len(names))]
    text = [F.col(f"r.c{i}") for i in range(len(names))]
    faults = F.filter(F.array(*[
        F.when(~F.coalesce(_allowed(t, *k), F.lit(False)), F.struct(F.lit(n).alias("column"), t.alias("text")))
        for t, k, n in zip(text, kinds, names)]), lambda x: x.isNotNull())
    whole = F.array(F.struct(F.lit(None).cast("string").alias("column"), F.col("value").alias("text")))
    found = parsed.withColumn("faults", F.when(F.col("r.bad").isNotNull(), whole).otherwise(faults))
    good = found.where("size(faults) = 0").select(
        parse_day_first(text[at]).alias("date"), *[finite(_number(t)).alias(n) for i, (t, n) in enumerate(zip(text, names)) if i != at])
    counted = lines.groupBy("file", "split").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    rejected = found.where("size(faults) > 0").join(counted, ["file", "split"]).select(
        "file", (F.col("at") - F.col("first") + F.col("before") + 1).alias("line"), F.inline("faults"))
    return good, rejected


def read_config(spark: SparkSession, path: str, whole_file=True) -> DataFrame:
    """Settings JSON, an object from entity to settings, as one row per entity.

    A file holds one object, spread over its lines as it likes. Without `whole_file` each line holds one, which lets a
    large config split over tasks. Text that is no such object fails the job.
    """
    text = spark.read.text(path, wholetext=whole_file).where("trim(value) <> ''")
    parsed = F.from_json("value", CONFIG_SCHEMA, {"mode": "FAILFAST"})
    text = text.select(parsed.alias("value")).select(F.when(F.col("value").isNull(), F.raise_error(F.lit(
        "settings are no JSON object")).cast(CONFIG_SCHEMA)).otherwise(F.col("value")).alias("value"))
    settings = F.explode("value").alias("entity", "settings")
    return text.select(settings).select("entity", *[F.col(f"settings.{f.name}") for f in SETTINGS_SCHEMA])
