"""Sliding sequences of the last L feature rows.

A sequence repeats each row L times, so it is built late, per horizon, from the columns a model needs, or not stored at all: `shards`
keeps every row once, and `cut` hands on the sequences of any length as they are read.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from brimline.operators.features import by_date
from brimline.operators.segments import with_halo

#: Rows of a shard, and numbers that a reader hands on at a time.
SHARD_ROWS, BATCH_VALUES = 1024, 1 << 19


def sequence(columns, length: int) -> Column:
    """The last `length` rows of the features, oldest first; NULL before the series is long enough."""
    length = max(length, 1)
    steps = F.collect_list(F.array(*[F.col(c) for c in columns])).over(by_date().rowsBetween(-(length - 1), 0))
    return F.when(F.size(steps) == length, steps)


def add_sequences(frame: DataFrame, columns, length: int, name="sequence") -> DataFrame:
    return frame.withColumn(name, sequence(columns, length)).filter(F.col(name).isNotNull())


def flat(name="sequence") -> Column:
    return F.flatten(F.col(name))


def checksum(name="sequence") -> Column:
    """Sum of all elements, each times its step number and its place in the step."""
    step = lambda s: F.aggregate(
        F.transform(s, lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x)
    return F.aggregate(
        F.transform(F.col(name), lambda s, i: step(s) * (i + 1)), F.lit(0.0), lambda a, x: a + x)


def shards(frame: DataFrame, columns, longest: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Rows of numbered series for sequences of up to `longest` rows, each stored once: (entity, shard, first, begins, dates, data).

    A shard holds `shard_rows` rows of an entity, from row number `begins` on, behind the `longest` - 1 rows before them, so every sequence
    that ends in it lies in it; `first` is the number of its first row. `data` has the columns of one row after the other. This takes
    1 + longest / shard_rows times the bytes of the rows, where sequences themselves take `longest` times.
    """
    rows = with_halo(frame, shard_rows, longest - 1, 0)
    row = F.struct("row_no", "date", F.array(*[F.col(f"`{c}`").cast("double") for c in columns]).alias("x"))
    packed = rows.groupBy("entity", F.col("segment").alias("shard")).agg(
        F.array_sort(F.collect_list(row)).alias("r"), F.max("core").alias("core")).filter("core")
    return packed.select(
        "entity", F.col("shard").cast("int").alias("shard"), F.col("r")[0]["row_no"].cast("int").alias("first"),
        (F.col("shard") * shard_rows + 1).cast("int").alias("begins"), F.col("r.date").alias("dates"), F.flatten(F.col("r.x")).alias("data"))


def cut(stored: DataFrame, width: int, length: int, name="sequence") -> DataFrame:
    """(entity, row_no, date, sequence) of every row with `length` rows up to it, cut out of stored shards of `width` columns.

    Sequences exist only as the reader hands them on, a few megabytes at a time.
    """
    length = max(length, 1)
    kind = stored.schema["entity"].dataType.simpleString()

    def windows(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                entity, first, begins, dates, data = (batch.column(c).slice(i, 1) for c in range(5))
                first, begins, days = first[0].as_py(), begins[0].as_py(), dates.flatten()
                rows = data.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                low, high = max(begins, first + length - 1), first + len(rows)  # numbers of the rows that a sequence ends with
                step = max(1, BATCH_VALUES // (length * width))
                for a in range(low, high, step):
                    ends = np.arange(a, min(a + step, high)) - first
                    values = np.lib.stride_tricks.sliding_window_view(rows, length, axis=0)[ends - length + 1].transpose(0, 2, 1).ravel()
                    steps = pa.ListArray.from_arrays(np.arange(0, len(values) + 1, width, dtype=np.int32), pa.array(values))
                    cuts = pa.ListArray.from_arrays(np.arange(0, len(steps) + 1, length, dtype=np.int32), steps)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([entity[0].as_py()] * len(ends), entity.type), pa.array(ends + first, pa.int32()),
                         days.take(pa.array(ends)), cuts], ["entity", "row_no", "date", name])

    return stored.select("entity", "first", "begins", "dates", "data").mapInArrow(
        windows, f"entity {kind}, row_no int, date date, {name} array<array<double>>")
