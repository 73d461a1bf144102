"""Train and test roles: fixed split with embargo, and expanding walk-forward folds.

Expanding folds overlap: the rows before 2023 train every fold. Instead of copying rows into folds, a row
gets two numbers, `train_after` (it trains every fold above it) and `test_fold` (the one fold it tests).
Rows are aggregated once per pair of numbers, and folds are put together from those few cells.
"""

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from brimline.functions.calendar import fold_of, fold_start
from brimline.operators.features import by_date
from brimline.settings import (
    DEFAULT_SEQ_LENS, FOLD_MONTHS, HORIZONS, MIN_EXTRA_ROWS, MIN_FOLD_TRAIN_ROWS, SPLIT_DATE, STRATEGIES,
    VALIDATION_SHARE,
)

BASELINE, WALK_FORWARD = STRATEGIES


def number_rows(frame: DataFrame, split=SPLIT_DATE) -> DataFrame:
    """Row number in the series and in its test part, and the last date of the series."""
    w = by_date()
    early = F.sum((F.col("date") < F.lit(dt.date.fromisoformat(split))).cast("int")).over(
        w.rowsBetween(Window.unboundedPreceding, 0))
    return frame.withColumns({
        "row_no": F.row_number().over(w),
        "test_row_no": F.row_number().over(w) - early,
        "last_date": F.max("date").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    })


def by_horizon(frame: DataFrame, horizons=HORIZONS, seq_lens=DEFAULT_SEQ_LENS) -> DataFrame:
    """One row per horizon with its sequence length and target.

    `seq_lens` is a list for all entities, or the name of an array column with one list per entity.
    """
    if not isinstance(seq_lens, str) and len(seq_lens) != len(horizons):
        raise ValueError(f"{len(horizons)} horizons but {len(seq_lens)} sequence lengths")
    lens = [F.get(F.col(seq_lens), i) for i in range(len(horizons))] if isinstance(seq_lens, str) else [
        F.lit(n) for n in seq_lens]
    pairs = [
        F.struct(F.lit(h).alias("horizon"), n.cast("int").alias("seq_len"), F.col(f"target_{h}").alias("target"))
        for h, n in zip(horizons, lens)
    ]
    kept = [c for c in frame.columns if c not in {f"target_{h}" for h in horizons}]
    out = frame.select(*kept, F.inline(F.array(*pairs)))
    return out.filter("seq_len is not null") if isinstance(seq_lens, str) else out


def with_strategies(frame: DataFrame, strategies=STRATEGIES) -> DataFrame:
    """Run every row under each of the named strategies."""
    if len(strategies) == 1:
        return frame.withColumn("strategy", F.lit(strategies[0]))
    return frame.withColumn("strategy", F.explode(F.array(*[F.lit(s) for s in strategies])))


def with_roles(rows: DataFrame, split=SPLIT_DATE, months=FOLD_MONTHS, embargo=False) -> DataFrame:
    """Add `train_after` and `test_fold` to rows with `strategy`, `horizon` and `last_date`.

    Baseline training stops where the target date reaches the split. Walk-forward training runs up to the
    day before the fold, unless `embargo` asks for the same care there.
    """
    first = F.lit(dt.date.fromisoformat(split))
    target_date = F.date_add("date", F.col("horizon"))
    walk = F.col("strategy") == WALK_FORWARD
    fold = fold_of(F.col("date"), split, months)
    train_walk = fold_of(target_date, split, months) if embargo else fold
    return rows.withColumns({
        "train_after": F.when(walk, train_walk).when(target_date < first, F.lit(-1)),
        "test_fold": F.when(
            walk, F.when((fold >= 0) & (fold_start(fold, split, months) < F.col("last_date")), fold)
        ).when(F.col("date") >= first, F.lit(0)),
    }).filter("train_after is not null or test_fold is not null")


def has_sequence() -> Column:
    """Whether a test row has a full sequence: walk-forward borrows context from training, baseline does not."""
    return F.when(F.col("strategy") == WALK_FORWARD, F.col("row_no")).otherwise(
        F.col("test_row_no")) >= F.col("seq_len")


KEYS = ("entity", "strategy", "horizon", "seq_len")


def cells(rows: DataFrame, sums: dict[str, Column] | None = None, keys=KEYS, extra=()) -> DataFrame:
    """Counts and the given aggregates per (key, train_after, test_fold)."""
    sample = (F.col("row_no") >= F.col("seq_len")) if "seq_len" in keys else F.lit(True)
    return rows.groupBy(*keys, "train_after", "test_fold", *extra).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(sample).alias("n_samples"),
        F.max("date").alias("last_day"),
        *[c.alias(n) for n, c in (sums or {}).items()],
    )


def in_train() -> Column:
    return F.coalesce(F.col("train_after") < F.col("fold"), F.lit(False))


def spread_folds(cell_rows: DataFrame, keys=KEYS) -> DataFrame:
    """Pair every cell with the folds of its key, and add the last training day of each fold.

    Works on cells, whose number per key is bounded by the folds of the calendar, never on rows.
    """
    folds = F.collect_set("test_fold").over(Window.partitionBy(*keys))
    out = cell_rows.withColumn("_folds", folds).withColumn("fold", F.explode("_folds")).drop("_folds")
    return out.withColumn("latest", F.max(F.when(in_train(), F.col("last_day"))).over(
        Window.partitionBy(*keys, "fold")))


def enough_train(strategy="strategy", seq_len="seq_len") -> Column:
    """Guards on the training size; a fold that is too short gives no model instead of an error."""
    rows = F.col("train_rows")
    walk = F.col(strategy) == WALK_FORWARD
    return (rows >= F.col(seq_len) + MIN_EXTRA_ROWS) & (~walk | (rows > MIN_FOLD_TRAIN_ROWS))


def fold_counts() -> list[Column]:
    return [
        F.sum(F.when(in_train(), F.col("n_rows")).otherwise(0)).alias("train_rows"),
        F.sum(F.when(in_train(), F.col("n_samples")).otherwise(0)).alias("train_samples"),
        F.sum(F.when(F.col("test_fold") == F.col("fold"), F.col("n_rows")).otherwise(0)).alias("test_rows"),
    ]


def fold_table(rows: DataFrame, keys=KEYS) -> DataFrame:
    """Train and test sizes of every fold that has test rows."""
    return spread_folds(cells(rows, keys=keys), keys).groupBy(*keys, "fold").agg(
        *fold_counts(), F.max("latest").alias("latest"))


def usable_folds(rows: DataFrame, keys=KEYS) -> DataFrame:
    """Folds with test rows and enough training rows for a model."""
    return fold_table(rows, keys).filter((F.col("test_rows") > 0) & enough_train())


def walk_forward_folds(frame: DataFrame, split=SPLIT_DATE, months=FOLD_MONTHS) -> DataFrame:
    """Expanding folds of each entity with their dates; folds need test rows and more than 60 training rows."""
    rows = with_roles(
        number_rows(frame.select("entity", "date"), split)
        .withColumns({"strategy": F.lit(WALK_FORWARD), "horizon": F.lit(0)}), split, months)
    return (
        fold_table(rows, ("entity",))
        .filter(F.col("train_rows") > MIN_FOLD_TRAIN_ROWS)
        .select(
            "entity", "fold",
            fold_start(F.col("fold"), split, months).alias("test_start"),
            fold_start(F.col("fold") + 1, split, months).alias("test_end"),
            "train_rows", "test_rows",
        )
    )


def _with_folds(rows: DataFrame, folds: DataFrame, keys, wanted, carry) -> DataFrame:
    """Pair each row with the folds of its entity that `wanted` accepts."""
    packed = folds.groupBy("entity").agg(F.collect_list(F.struct(
        *keys[1:], "fold", *carry)).alias("_folds"))

    def own(f):
        hit = wanted(f)
        for k in keys[1:]:
            hit = hit & f[k].eqNullSafe(F.col(k))
        return hit

    return (
        rows.join(packed, "entity")
        .withColumn("_f", F.explode(F.filter("_folds", own)))
        .withColumns({c: F.col(f"_f.{c}") for c in ("fold", *carry)})
        .drop("_f", "_folds")
    )


def training_rows(rows: DataFrame, folds: DataFrame, keys=KEYS) -> DataFrame:
    """Every (row, fold) the row trains. The result repeats rows by design; fits work on cells instead."""
    return _with_folds(
        rows.filter("train_after is not null"), folds, keys, lambda f: F.col("train_after") < f["fold"],
        ("train_samples", "latest"))


def context_rows(rows: DataFrame, folds: DataFrame, keys=KEYS) -> DataFrame:
    """Test rows of each fold, preceded by the last L-1 training rows, so that every test row gets a sequence."""
    tail = _with_folds(
        rows.filter("train_after is not null"), folds, keys,
        lambda f: (F.col("train_after") < f["fold"])
        & (F.col("row_no") <= f["train_rows"]) & (F.col("row_no") > f["train_rows"] - (F.col("seq_len") - 1)),
        ("train_rows",)).withColumn("is_context", F.lit(True))
    test = _with_folds(
        rows.filter("test_fold is not null"), folds, keys, lambda f: F.col("test_fold") == f["fold"],
        ("train_rows",)).withColumn("is_context", F.lit(False))
    return tail.unionByName(test)


def validation_cut(samples="train_samples") -> Column:
    """Number of training samples before the validation tail."""
    return F.floor(F.col(samples) * F.lit(1 - VALIDATION_SHARE))


def validation_tail(train: DataFrame) -> DataFrame:
    """Mark the last fifth of each fold's training samples."""
    sample_no = F.col("row_no") - F.col("seq_len") + 1
    return (
        train.withColumn("sample_no", sample_no).filter("sample_no >= 1")
        .withColumn("is_val", F.col("sample_no") > validation_cut())
    )


def time_interpolate(df: DataFrame, level="level") -> DataFrame:
    """Fill inner gaps of the level on a straight line over days; the tail keeps the last value."""
    w = by_date()
    before = w.rowsBetween(Window.unboundedPreceding, 0)
    after = w.rowsBetween(0, Window.unboundedFollowing)
    known = F.when(F.col(level).isNotNull(), F.col("date"))
    df = df.withColumns({
        "_v0": F.last(level, ignorenulls=True).over(before), "_d0": F.last(known, ignorenulls=True).over(before),
        "_v1": F.first(level, ignorenulls=True).over(after), "_d1": F.first(known, ignorenulls=True).over(after),
    })
    share = F.datediff("date", "_d0") / F.nullif(F.datediff("_d1", "_d0"), F.lit(0))
    line = F.col("_v0") + (F.col("_v1") - F.col("_v0")) * share
    return df.withColumn(level, F.coalesce(F.col(level), line, F.col("_v0"))).drop("_v0", "_d0", "_v1", "_d1")


def fill_test_levels(test: DataFrame, level="level") -> DataFrame:
    """Forward fill inside the test part, then drop rows still without a level."""
    so_far = by_date().rowsBetween(Window.unboundedPreceding, 0)
    return test.withColumn(level, F.last(level, ignorenulls=True).over(so_far)).filter(F.col(level).isNotNull())
