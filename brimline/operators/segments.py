"""Long series in segments: one entity's features computed by many tasks.

A window over an entity runs in one task, so the entities bound the parallelism. Here a series is numbered and cut into segments of equally
many rows. A segment's task also gets its halo: as many rows before it as the longest frame looks back at, and as many after it as the
farthest target looks ahead. What reaches back without bound is carried: rows are numbered from the counts of the parts before, and
a fill takes the last known values of the segments before. Those are small tables, of a row for each part of a series.

The result equals `features.feature_frame`; only the last digits of long means may differ, as running totals begin with the halo.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from brimline.operators import features as X
from brimline.settings import DEFAULT_LAGS, HORIZONS
from brimline.sources.writers import materialize

#: Calendar days of a part in which rows are first put in order, and rows of a segment.
PART_DAYS, SEGMENT_ROWS = 1024, 2048


def _before(keys, part: str):
    return Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)


def carried(rows: DataFrame, part: str, order: str, columns, keys=("entity",)) -> DataFrame:
    """(keys, part, _{column}) with the last value of each column that is not null in the parts before, from a row for each part.

    Parts are combined before the shuffle, so a long part sends one row a task.
    """
    last = rows.groupBy(*keys, part).agg(*[
        F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns])
    return last.select(*keys, part, *[F.last(c, ignorenulls=True).over(_before(keys, part)).alias(f"_{c}") for c in columns])


def numbered(panel: DataFrame, filled=(), part_days: int = PART_DAYS, keys=("entity",)) -> DataFrame:
    """Adds `row_no` (from 1) in each series, and for each column of `filled` its value carried forward, as `{column}_filled`.

    Rows are put in order within parts of the calendar, whose size the calendar bounds; the counts and the last values of the parts
    before a part are joined to it. Rows without a date come into the first part, where the features find and refuse them.
    """
    parts = panel.withColumn("_part", F.coalesce(F.floor(F.unix_date("date") / part_days), F.lit(0)).cast("int"))
    counts = parts.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n")).select(
        *keys, "_part", F.coalesce(F.sum("_n").over(_before(keys, "_part")), F.lit(0)).alias("_earlier"))
    side = carried(parts, "_part", "date", filled, keys).join(counts, [*keys, "_part"]) if filled else counts
    w = X.by_date(*keys, "_part")
    fills = {f"{c}_filled": F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)) for c in filled}
    out = parts.withColumns({"row_no": F.row_number().over(w), **fills}).join(side, [*keys, "_part"])
    return out.withColumns({
        "row_no": F.col("row_no") + F.col("_earlier"), **{f"{c}_filled": F.coalesce(f"{c}_filled", f"_{c}") for c in filled},
    }).drop("_part", "_earlier", *[f"_{c}" for c in filled])


def with_halo(rows: DataFrame, segment_rows: int, back: int, ahead: int) -> DataFrame:
    """Rows with `row_no`, once for each segment that needs them: `segment`, and `core` for the one that they belong to.

    A row goes to its own segment, to those that look back at it and to those that look ahead to it.
    """
    at = F.col("row_no") - 1
    segments = F.sequence(F.floor((at - ahead) / segment_rows), F.floor((at + back) / segment_rows))
    out = rows.withColumn("segment", F.explode(F.filter(segments, lambda s: s >= 0)))
    return out.withColumn("core", F.col("segment") == F.floor((F.col("row_no") - 1) / segment_rows))


def feature_frame(panel: DataFrame, lag_rows=DEFAULT_LAGS, horizons=HORIZONS, production=("demand",), rain="rain", temp="temp",
                  segment_rows: int = SEGMENT_ROWS, part_days: int = PART_DAYS) -> DataFrame:
    """`features.feature_frame` with the windows of a segment instead of a whole series in a task.

    The features are stored once, filled within their segments, and read again when the values carried from earlier segments are known.
    """
    keys, kept = ("entity", "segment"), ("segment", "core", "row_no", "level_filled")
    rows = numbered(panel, ("level",), part_days)
    df = X.raw_features(with_halo(rows, segment_rows, X.look_back(lag_rows), max(horizons)), lag_rows, production, rain, temp, keys, kept)
    w = X.by_date(*keys)
    features = [c for c in df.columns if c not in ("entity", "date", *kept)]
    filled = {c: F.last(F.when(F.col("core"), F.col(c)), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
              for c in features}
    ahead = {f"target_{h}": F.lead("level_filled", h).over(w) for h in horizons}
    df = materialize(df.select("entity", "date", *kept, *[c.alias(n) for n, c in (filled | ahead).items()]).filter("core"))
    early = carried(df, "segment", "row_no", features)
    df = df.join(early, ["entity", "segment"]).select(
        "entity", "date", *[F.coalesce(c, f"_{c}").alias(c) for c in features], *ahead)
    return X.complete_rows(X.add_seasonal(df), horizons)
