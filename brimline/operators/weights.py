"""Sample weights that halve with age."""

from pyspark.sql import DataFrame, Window, functions as F

from brimline.functions.numeric import decay


def sample_weights(samples: DataFrame, group, halflife=365, date="date") -> DataFrame:
    """Weight of each sample against the newest of its group, scaled to mean 1."""
    g = Window.partitionBy(*group)
    halflife = F.col(halflife) if isinstance(halflife, str) else F.lit(float(halflife))
    raw = decay(F.datediff(F.max(date).over(g), F.col(date)), halflife)
    return samples.withColumn("_raw", raw).withColumn(
        "weight", F.col("_raw") / F.avg("_raw").over(g)).drop("_raw")
