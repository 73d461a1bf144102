"""Min-max scaling with bounds taken from training rows only."""

from pyspark.sql import DataFrame, functions as F

from brimline.functions.numeric import scale, unscale
from brimline.operators.splits import KEYS, cells, in_train, spread_folds


def _bounds(columns):
    return {
        **{f"lo_{c}": F.min(c) for c in columns},
        **{f"hi_{c}": F.max(c) for c in columns},
    }


def fold_bounds(rows: DataFrame, columns, keys=KEYS) -> DataFrame:
    """Lowest and highest training value of each column for each fold, from one pass over the rows."""
    spread = spread_folds(cells(rows, _bounds(columns), keys), keys)
    return spread.filter(in_train()).groupBy(*keys, "fold").agg(
        *[F.min(f"lo_{c}").alias(f"lo_{c}") for c in columns],
        *[F.max(f"hi_{c}").alias(f"hi_{c}") for c in columns],
    )


def long_bounds(bounds: DataFrame, columns, keys=KEYS) -> DataFrame:
    return bounds.select(*keys, "fold", F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"lo_{c}").alias("lo"), F.col(f"hi_{c}").alias("hi"))
        for c in columns])))


def with_packed(rows: DataFrame, table: DataFrame, columns, keys=KEYS, fold="test_fold", name="_m") -> DataFrame:
    """Attach the row of `table` that matches the keys and the fold, as a struct column.

    `table` is packed to one row per entity first, so the join is on the entity the rows are already
    partitioned by and the rows do not move again. A pack holds one entry per fold and horizon.
    """
    names = [*keys[1:], "fold", *columns]
    packed = table.groupBy("entity").agg(F.collect_list(F.struct(*names)).alias("_pack"))

    def matches(m):
        hit = m["fold"] == F.col(fold)
        for k in keys[1:]:
            hit = hit & m[k].eqNullSafe(F.col(k))
        return hit

    return (
        rows.join(packed, "entity")
        .withColumn(name, F.get(F.filter("_pack", matches), F.lit(0)))
        .drop("_pack").filter(F.col(name).isNotNull())
    )


def scale_rows(rows: DataFrame, bounds: DataFrame, columns, keys=KEYS) -> DataFrame:
    """Test rows scaled with the bounds of their fold; values outside the training range leave [0, 1]."""
    names = [f"{side}_{c}" for c in columns for side in ("lo", "hi")]
    out = with_packed(rows.filter("test_fold is not null"), bounds, names, keys)
    return out.withColumns({
        f"scaled_{c}": scale(F.col(c), F.col(f"_m.lo_{c}"), F.col(f"_m.hi_{c}")) for c in columns})


def unscale_rows(scaled: DataFrame, columns) -> DataFrame:
    return scaled.withColumns({
        f"restored_{c}": unscale(F.col(f"scaled_{c}"), F.col(f"_m.lo_{c}"), F.col(f"_m.hi_{c}"))
        for c in columns})
