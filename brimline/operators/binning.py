"""Input vectors as small integers, made once for all tree fits.

Trees split at a few quantiles of each input. Those are sketched in one pass over the training rows, and every row then holds the number of
its bin, a byte for each input, in one stored table that all fits and scores read.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

BINS, ACCURACY = 32, 10_000


def bin_edges(rows: DataFrame, vector: str, bins: int = BINS) -> list[list[float]]:
    """The edges between the bins of each place of a vector column, from quantile sketches; fewer where values repeat.

    Sketches are put together before the shuffle, and the driver gets bins - 1 numbers for each input.
    """
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    found = rows.select(F.posexplode(vector).alias("at", "x")).groupBy("at").agg(
        F.percentile_approx("x", shares, ACCURACY).alias("edges")).collect()
    return [sorted(set(r["edges"])) for r in sorted(found, key=lambda r: r["at"])]


def binned(rows: DataFrame, vector: str, edges: list[list[float]]) -> DataFrame:
    """Replaces a vector column by the numbers of its bins: how many edges lie below each value."""
    kept = [c for c in rows.columns if c != vector]
    names, width = [*kept, vector], len(edges)

    def number(batches):
        for batch in batches:
            flat = batch.column(len(kept)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, width)
            out = np.empty(flat.shape, np.int8)
            for i, e in enumerate(edges):
                out[:, i] = np.searchsorted(e, flat[:, i], "left")
            ends = np.arange(0, out.size + 1, max(1, width), dtype=np.int32)[: batch.num_rows + 1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.ListArray.from_arrays(ends, pa.array(out.ravel()))], names)

    schema = T.StructType([*[rows.schema[c] for c in kept], T.StructField(vector, T.ArrayType(T.ByteType()))])
    return rows.select(*kept, vector).mapInArrow(number, schema)
