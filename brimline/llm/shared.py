"""Tables and shuffle files that work in several turns leaves behind, and numbers of rows in an order."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brimline.sources.writers import materialize, shared_folder


def free_shuffles(spark: SparkSession) -> None:
    """Let go of shuffle files of finished work: Spark deletes them once the driver has collected what refers to them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Scratch:
    """Tables in the shared folder that a lost executor cannot take along, deleted when their turn is over."""

    def __init__(self, spark: SparkSession):
        self.spark, self.base, self.n = spark, shared_folder(spark), 0
        self.paths: dict[int, str] = {}

    def store(self, df: DataFrame) -> DataFrame:
        """Write a table and read it back."""
        path, self.n = f"{self.base}/{self.n}", self.n + 1
        df.write.parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(stored)] = path
        return stored

    def drop(self, *stored: DataFrame | None) -> None:
        """Delete stored tables that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        for df in stored:
            if df is not None and (path := self.paths.pop(id(df), None)):
                at = jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def numbered(df: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """Adds the place of each row in an order, from 1, with no task that sees all rows.

    Rows are sorted in ranges and written; a range's first number follows from the sizes of those before it, of which the driver gets
    one for each partition of the shuffle. Equal rows are spread over ranges by a salt, in an order of no meaning.
    """
    kept = [c for c in df.columns if c != name]
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    keys = [f"key{i}" for i in range(len(by))]
    keyed = df.select(F.struct(*[f"`{c}`" for c in kept]).alias("kept"), *[c.alias(k) for c, k in zip(by, keys)], F.rand(7).alias("salt"))
    placed = materialize(keyed.repartitionByRange(*keys, "salt").sortWithinPartitions(*keys, "salt").select(
        "kept", F.monotonically_increasing_id().alias("at")))  # the partition above the row's place in it
    part, row = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = {r[0]: r[1] for r in placed.groupBy(part).count().collect()}
    before, total = [], 0
    for i in range(max(sizes, default=0) + 1):
        before.append(total)
        total += sizes.get(i, 0)
    starts = F.split(F.lit(",".join(map(str, before))), ",").cast("array<long>")
    return placed.select("kept.*", (F.get(starts, part.cast("int")) + row + 1).alias(name))
