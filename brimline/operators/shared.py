"""Ridge fits of all strategies, horizons and folds of an entity from one set of product sums.

A fold trains on the first rows of a series, whatever its strategy and horizon: it fits on rows (a, b] and validates on (b, c]. The
numbers a, b and c of all folds cut a series into parts, and each fold's sums are those of some whole parts. So a row is read and
multiplied once, not once per strategy, horizon and fold, and what is shuffled is a matrix for each part. Sequence lengths shift b by a
few rows from horizon to horizon: the short parts between send their rows instead.

Inputs are a vector `x` for each row, of the entity's own length, and may differ by horizon: `wx` then has a vector for each (means
and slopes over its sequence), and there is a matrix for each distinct one. A matrix covers (1, inputs, all targets), plain and
weighted for each half-life, of values less those of the entity's first full row, so that large values keep their digits.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from brimline.functions.solve import ridge_solver
from brimline.operators.models import PENALTIES
from brimline.operators.scaling import with_packed
from brimline.operators.splits import KEYS, has_sequence, validation_cut
from brimline.settings import HORIZONS

VECTOR = "array<double>"
#: Of a part: the row it ends with, which vector of wx it covers, its last day, bounds, and flat upper triangles; or, where they are
#: fewer numbers, its rows and their days.
CELL = (f"upto int, part_of int, last_day int, lo {VECTOR}, hi {VECTOR}, plain {VECTOR}, weighted array<{VECTOR}>, "
        f"rows {VECTOR}, days array<int>")


def with_vectors(frame: DataFrame, inputs, windows=(), seq_lens=(), kinds=("mean", "slope")) -> DataFrame:
    """Adds `x` from input columns and `wx` from `{column}_{kind}_{L}`, a vector for the sequence length of each horizon, null
    before the first full sequence."""
    def of(n: int) -> Column:
        return F.when(F.col("row_no") >= n, F.array(*[F.col(f"`{c}_{k}_{n}`") for k in kinds for c in windows]))

    x = F.array(*[F.col(f"`{c}`").cast("double") for c in inputs])
    return frame.withColumns({"x": x, "wx": F.array(*[of(n) for n in seq_lens]) if windows else F.array().cast(f"array<{VECTOR}>")})


def of_length(n: Column, lengths, vector) -> Column:
    """The vector for length n among those of all lengths that occur."""
    return reduce(lambda out, k: F.when(n == k, vector(k)).otherwise(out), lengths, F.lit(None).cast(VECTOR))


def _specs(folds: DataFrame, keys) -> DataFrame:
    """Folds with the rows that they fit on, (a, b], and validate on, (b, c]."""
    return folds.select(
        *keys, "fold", "train_rows", "test_rows", F.unix_date("latest").alias("latest"),
        (F.col("seq_len") - 1).cast("int").alias("a"), (F.col("seq_len") - 1 + validation_cut()).cast("int").alias("b"),
        F.col("train_rows").cast("int").alias("c"))


def _sorted_set(column) -> Column:
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list(column))))


def part_sums(frame: DataFrame, specs: DataFrame, horizons=HORIZONS, halflife=None, around_first=True) -> DataFrame:
    """CELL rows of each entity: tasks send one for each part that a batch of theirs touches.

    frame has entity, date, row_no, x, wx and the targets, a row once. halflife names a column of specs, or is a number or None.
    Without around_first the sums are of the values themselves.
    """
    own = F.collect_set(halflife) if isinstance(halflife, str) else F.array(*([] if halflife is None else [F.lit(halflife)]))
    bounds = specs.groupBy("entity").agg(
        _sorted_set(F.array("a", "b", "c")).alias("cuts"), F.array_sort(own.cast(VECTOR)).alias("halflives"),
        F.max("a").alias("longest"))
    y = F.array(*[F.col(f"target_{h}") for h in horizons])
    rows = frame.select("entity", "row_no", F.unix_date("date").alias("day"), "x", "wx", y.alias("y"))
    first = rows.join(bounds.select("entity", "longest"), "entity").where(F.col("row_no") == F.col("longest") + 1).select(
        "entity", F.col("x").alias("x0"), F.col("wx").alias("wx0"), F.col("y").alias("y0"), F.lit(around_first).alias("move"))
    rows = rows.join(bounds.join(first, "entity", "left"), "entity").withColumn(
        "upto", F.get(F.filter("cuts", lambda c: c >= F.col("row_no")), 0)).where("upto is not null")
    kind = frame.schema["entity"].dataType.simpleString()
    return rows.select("entity", "upto", "day", "x", "wx", "y", "x0", "wx0", "y0", "move", "halflives").mapInArrow(
        _multiply, f"entity {kind}, {CELL}, first {VECTOR}")


def _multiply(batches):
    """One row for each (entity, part, vector of wx) that a batch touches."""
    lists = pa.list_(pa.float64())
    kinds = {"upto": pa.int32(), "part_of": pa.int32(), "last_day": pa.int32(), "lo": lists, "hi": lists, "plain": lists,
             "weighted": pa.list_(lists), "rows": lists, "days": pa.list_(pa.int32()), "first": lists}
    for batch in batches:
        if not batch.num_rows:
            continue
        kinds = {"entity": batch.schema.field("entity").type} | kinds
        batch = batch.sort_by([("entity", "ascending"), ("upto", "ascending")])
        key = list(zip(batch["entity"].to_pylist(), batch["upto"].to_pylist()))
        edges = [0, *[i for i in range(1, len(key)) if key[i] != key[i - 1]], len(key)]
        out = [row for a, b in zip(edges, edges[1:]) for row in _part(batch.slice(a, b - a), *key[a])]
        yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in out], k) for n, k in kinds.items()], list(kinds))


def _part(rows: pa.RecordBatch, entity, upto):
    x, y, day = _table(rows["x"]), _table(rows["y"]), rows["day"].to_numpy()
    x0, y0, wx0, halves = (rows[n][0].as_py() for n in ("x0", "y0", "wx0", "halflives"))
    n, m = len(day), len(rows["wx"][0])
    inner = rows["wx"].flatten()
    for i in range(max(1, m)):
        w0 = (wx0[i] if m and wx0 else None) or []
        if m and not w0:
            continue  # a longer sequence than any fold of the entity has
        w = _nested(inner.take(pa.array(np.arange(i, n * m, m))), len(w0)) if m else np.zeros((n, 0))
        z = np.column_stack([np.ones(n), x, w, y])
        first = np.concatenate([[0.0], x0 or np.zeros(x.shape[1]), w0, y0 or np.zeros(y.shape[1])]).astype(float)
        first *= bool(rows["move"][0].as_py())
        use = ~np.isnan(z).any(1)  # rows with a full sequence
        d, days = z[use] - first, day[use]
        last = int(days.max()) if len(days) else 0
        few = 2 * len(d) < d.shape[1]
        yield {"entity": entity, "upto": upto, "part_of": i, "last_day": last, "lo": np.fmin.reduce(z, 0), "hi": np.fmax.reduce(z, 0),
               "first": first} | ({"plain": None, "weighted": None, "rows": d.ravel(), "days": days} if few else {
                   "plain": _products(d), "weighted": [_products(d, np.exp2((days - last) / h)) for h in halves], "rows": None, "days": None})


def _products(d: np.ndarray, w: np.ndarray | None = None) -> np.ndarray:
    """The upper triangle of d'd, weighted."""
    return ((d if w is None else d * w[:, None]).T @ d)[np.triu_indices(d.shape[1])]


def _table(column: pa.Array) -> np.ndarray:
    """Vectors of equal length as the rows of a table."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def _nested(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as the rows of a table; a null one is a row of NaN."""
    there = column.is_valid().to_numpy(zero_copy_only=False)
    out = np.full((len(column), width), np.nan)
    if there.any():
        out[there] = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)
    return out


def _combine(keys, horizons, halflife, windows: bool):
    """Per entity: each fold's sums from those of its parts."""
    def combine(cells: pd.DataFrame, specs: pd.DataFrame) -> pd.DataFrame:
        out = []
        halves = sorted(set(float(h) for h in specs[halflife].dropna())) if isinstance(halflife, str) else (
            [] if halflife is None else [float(halflife)])
        stacked = {i: _stacked(g, halves) for i, g in cells.groupby("part_of")}
        for s in specs.to_dict("records"):
            h = s[halflife] if isinstance(halflife, str) else halflife
            at = horizons.index(s["horizon"])
            part = stacked.get(at if windows else 0)
            if part is None:
                continue
            fit, val = (part["upto"] > s["a"]) & (part["upto"] <= s["b"]), (part["upto"] > s["b"]) & (part["upto"] <= s["c"])
            train = part["upto"] <= s["c"]
            if h is None or pd.isna(h):
                fitted = part["plain"][fit].sum(0)
            else:
                factor = np.exp2((part["day"][fit] - s["latest"]) / float(h))
                fitted = (part["weighted"][halves.index(float(h))][fit] * factor[:, None]).sum(0)
            n = len(part["first"])
            keep = [*range(n - len(horizons)), n - len(horizons) + at]
            square = lambda flat: _square(flat, n)[np.ix_(keep, keep)].ravel()  # noqa: B023,E731
            out.append({
                **{k: s[k] for k in keys}, "fold": s["fold"], "train_rows": s["train_rows"], "test_rows": s["test_rows"],
                "first": part["first"][keep][1:], "lo": np.fmin.reduce(part["lo"][train], 0)[keep],
                "hi": np.fmax.reduce(part["hi"][train], 0)[keep], "fit_sums": square(fitted), "val_sums": square(part["plain"][val].sum(0))})
        return pd.DataFrame(out, columns=[*keys, "fold", "train_rows", "test_rows", "first", "lo", "hi", "fit_sums", "val_sums"])

    return combine


def _stacked(cells: pd.DataFrame, halves) -> dict:
    """The matrices of an entity's parts, one above the other; those of short parts are made of their rows."""
    first = cells["first"].iloc[0]
    plain, weighted = [], [[] for _ in halves]
    for p, w, rows, days, last in zip(cells["plain"], cells["weighted"], cells["rows"], cells["days"], cells["last_day"]):
        d = None if rows is None else np.asarray(rows).reshape(-1, len(first))
        plain.append(p if d is None else _products(d))
        for j, h in enumerate(halves):
            weighted[j].append(w[j] if d is None else _products(d, np.exp2((np.asarray(days) - last) / h)))
    return {"plain": np.stack(plain), "weighted": [np.stack(w) for w in weighted], "lo": np.stack(cells["lo"]),
            "hi": np.stack(cells["hi"]), "upto": cells["upto"].to_numpy(), "day": cells["last_day"].to_numpy(), "first": first}


def _square(upper, n):
    out = np.zeros((n, n))
    out[np.triu_indices(n)] = upper
    return np.where(out == 0, out.T, out)


def _schema(specs: DataFrame, keys, more) -> T.StructType:
    return T.StructType([*specs.select(*keys, "fold", "train_rows", "test_rows").schema, *more])


def fold_sums(frame: DataFrame, folds: DataFrame, halflife=None, horizons=HORIZONS, keys=KEYS, windows=False,
              around_first=False) -> DataFrame:
    """The sums of `models.ridge_sums`, for folds of a fold table with their keys: flat matrices over (1, inputs, target)."""
    specs = _specs(folds, keys)
    numbers = T.ArrayType(T.DoubleType())
    schema = _schema(specs, keys, [T.StructField(n, numbers) for n in ("first", "lo", "hi", "fit_sums", "val_sums")])
    cells = part_sums(frame, specs, horizons, halflife, around_first)
    return cells.groupBy("entity").cogroup(specs.groupBy("entity")).applyInPandas(_combine(keys, list(horizons), halflife, windows), schema)


def fit_ridge(frame: DataFrame, folds: DataFrame, halflife=None, horizons=HORIZONS, keys=KEYS, windows=False,
              penalties=PENALTIES) -> DataFrame:
    """`models.fit_ridge` for every fold of the table; matrices are put together and solved in the same task."""
    specs = _specs(folds, keys)
    schema = _schema(specs, keys, [T.StructField("coef", T.ArrayType(T.DoubleType())), *[
        T.StructField(n, T.DoubleType()) for n in ("intercept", "penalty", "val_rmse")]])
    combine = _combine(keys, list(horizons), halflife, windows)
    names = schema.names

    def solve(cells: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(cells) or not len(own):
            return pd.DataFrame(columns=names)
        sums = combine(cells, own)
        parts = [next(ridge_solver(int(n) - 2, tuple(penalties))(iter([g]))) for n, g in sums.groupby(sums["lo"].map(len))]
        return pd.concat(parts)[names] if parts else pd.DataFrame(columns=names)

    cells = part_sums(frame, specs, horizons, halflife)
    return cells.groupBy("entity").cogroup(specs.groupBy("entity")).applyInPandas(solve, schema)


def predict_ridge(rows: DataFrame, models: DataFrame, vector: Column, keys=KEYS) -> DataFrame:
    """Predictions of test rows from an input vector of the entity's own length."""
    test = rows.withColumn("_v", vector).filter(F.col("test_fold").isNotNull() & has_sequence())
    out = with_packed(test, models, ["coef", "intercept"], keys)
    products = F.zip_with(F.col("_m.coef"), F.col("_v"), lambda a, b: a * b)
    return out.select(
        *keys, F.col("test_fold").alias("fold"), "date", F.lit("ridge").alias("model"), F.col("target").alias("y"),
        (F.col("_m.intercept") + F.aggregate(products, F.lit(0.0), lambda a, b: a + b)).alias("yhat"))
