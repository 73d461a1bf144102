"""Sinks."""

import json
import tempfile
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from brimline.settings import SETTINGS_SCHEMA


def shared_folder(spark: SparkSession) -> str:
    """A fresh path below the folder the cluster shares; a temporary folder only where none is set."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="brimline-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def write_summary(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").option("header", True).csv(path)


def write_predictions(predictions: DataFrame, path: str) -> None:
    """Predictions by horizon. Entities are not folders: there may be millions, so files are sorted by entity.

    A second write replaces the horizons it has and leaves the others.
    """
    (predictions.repartition("horizon", "entity").sortWithinPartitions("horizon", "entity", "date")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("horizon").parquet(path))


def write_wide_csv(wide: DataFrame, path: str) -> None:
    """Wide table with a day-first text date, as the reader expects it."""
    rest = [c for c in wide.columns if c != "date"]
    (wide.select(F.date_format("date", "dd.MM.yyyy").alias("Date"), *[F.col(f"`{c}`") for c in rest])
     .write.mode("overwrite").option("header", True).csv(path))


def write_config(config: DataFrame, path: str, whole_file=False) -> None:
    """Settings as JSON, one object per line, or with `whole_file` one object over many lines for all entities.

    One object is one row, so that form is for settings that fit in a task, as those that people write do.
    """
    settings = F.struct(*[F.col(f.name) for f in SETTINGS_SCHEMA])
    if whole_file:
        rows = F.array_sort(F.collect_list(F.struct(F.col("entity").alias("key"), settings.alias("value"))))
        text = config.agg(F.to_json(F.map_from_entries(rows), {"pretty": "true"}).alias("value"))
    else:
        text = config.select(F.to_json(F.create_map(F.col("entity"), settings)).alias("value"))
    text.write.mode("overwrite").text(path)


def materialize(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back; the result survives lost executors."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Stages:
    """Named tables of one job in a folder. A table that is there whole, from the same inputs, is read and not made again.

    A table counts as there when its line in the manifest is written, which happens after its files are. `key` says what the tables
    were made from; under another key they are made anew. Without a folder of its own a job gets a fresh one below the shared
    folder. `clear` removes all that was stored.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, key: str = ""):
        self.spark, self.folder, self.key = spark, (folder or shared_folder(spark)).rstrip("/"), key

    def _noted(self, name: str) -> T.StructType | None:
        try:
            found = self.spark.read.text(f"{self.folder}/_manifest/{name}", wholetext=True).first()
        except AnalysisException:
            return None
        entry = json.loads(found["value"]) if found and found["value"].strip() else {}
        return T.StructType.fromJson(entry["schema"]) if entry.get("key") == self.key else None

    def table(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The stored table of that name; `make` builds it if it is not there."""
        schema = self._noted(name)
        if schema is None:
            df = make()
            schema = df.schema
            df.write.mode("overwrite").parquet(f"{self.folder}/{name}")
            entry = json.dumps({"key": self.key, "schema": json.loads(schema.json())})
            self.spark.createDataFrame([(entry,)], "value string").coalesce(1).write.mode("overwrite").text(
                f"{self.folder}/_manifest/{name}")
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    def stored(self, name: str) -> DataFrame:
        """A table that an earlier stage has written."""
        schema = self._noted(name)
        if schema is None:
            raise LookupError(f"no table {name} in {self.folder}")
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    def clear(self) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


def fingerprint(df: DataFrame) -> str:
    """Changes with the rows of a table, whatever their order; one pass, of which the driver gets one row."""
    rows = df.select(F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).alias("h"))
    r = rows.agg(F.count("h").alias("n"), F.bit_xor("h").alias("x"), F.sum(F.col("h") % 1000003).alias("s")).first()
    return f"{r['n']}:{r['x']}:{r['s']}"
