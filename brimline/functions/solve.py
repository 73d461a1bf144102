"""Small dense algebra inside tasks: product sums of a batch of rows, and one k x k solve per fitted model.

The functions travel to the workers by value, so executors need numpy and pandas but not this package.
"""

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def product_sums(keys, columns, halflife):
    """Map over batches: one row of product sums over (1, columns) for each cell a batch touches, the upper triangle only;
    `plain` is NULL where it equals `weighted`.

    Weights count back from the newest day of the row set they are summed over, so they neither overflow nor
    vanish together. `halflife` is a key column, a number, or None for equal weights.
    """
    cell = [*keys, "train_after", "part"]

    def sums(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            z = np.column_stack([np.ones(len(pdf)), pdf[list(columns)].to_numpy(float)])
            upper = np.triu_indices(z.shape[1])
            day = pdf["day"].to_numpy()
            sample = pdf["sample_no"].to_numpy()
            out = []
            for key, at in pdf.groupby(cell, dropna=False, sort=False).indices.items():
                key = key if isinstance(key, tuple) else (key,)
                block, newest = z[at], day[at].max()
                use = at[sample[at] >= 1]
                zs = z[use]
                row = dict(zip(cell, key))
                h = row[halflife] if isinstance(halflife, str) else halflife
                if h is None or pd.isna(h):
                    weighted, plain = (zs.T @ zs)[upper], None
                else:
                    w = np.exp2((day[use] - newest) / float(h))
                    weighted, plain = ((zs * w[:, None]).T @ zs)[upper], (zs.T @ zs)[upper]
                out.append({
                    **row, "last_day": newest, "last_sample": sample[at].max(), "first": pdf["first"].iloc[at[0]],
                    "lo": np.fmin.reduce(block, 0), "hi": np.fmax.reduce(block, 0), "weighted": weighted, "plain": plain})
            yield pd.DataFrame(out)

    return sums


def fold_sums(keys, halflife):
    """Per key: add up the cells of every fold, before the validation cut weighted, after it plain."""

    def combine(pdf):
        first = pdf.iloc[0]
        h = first[halflife] if isinstance(halflife, str) else halflife
        weighted = np.stack(pdf["weighted"])
        plain = np.stack([w if p is None else p for w, p in zip(pdf["weighted"], pdf["plain"])])
        lo, hi = np.stack(pdf["lo"]), np.stack(pdf["hi"])
        after, last = pdf["train_after"].to_numpy(), pdf["last_sample"].to_numpy()
        day = pdf["last_day"].to_numpy()
        out = []
        for fold, cut, latest, train_rows, test_rows in zip(
                first["folds"], first["cuts"], first["latests"], first["trains"], first["tests"]):
            own = after < fold
            if not own.any():
                continue
            fit = own & (last <= cut)
            val = own & (last > cut)
            factor = 1.0 if h is None or pd.isna(h) else np.exp2((day[fit] - latest) / float(h))[:, None]
            out.append({
                **{k: first[k] for k in keys}, "fold": fold, "train_rows": train_rows, "test_rows": test_rows,
                "first": first["first"], "lo": np.fmin.reduce(lo[own], 0), "hi": np.fmax.reduce(hi[own], 0),
                "fit_sums": _whole((weighted[fit] * factor).sum(0)), "val_sums": _whole(plain[val].sum(0))})
        return pd.DataFrame(out, columns=[
            *keys, "fold", "train_rows", "test_rows", "first", "lo", "hi", "fit_sums", "val_sums"])

    return combine


def _whole(upper):
    """The flat symmetric matrix of an upper triangle."""
    n = int((np.sqrt(8 * len(upper) + 1) - 1) / 2)
    out = np.zeros((n, n))
    out[np.triu_indices(n)] = upper
    return np.where(out == 0, out.T, out).ravel()


def _moments(flat, k):
    """Count, means and centred products from stacked flat sums over (1, inputs, target)."""
    sums = flat.reshape(-1, k + 1, k + 1)
    n = sums[:, 0, 0]
    mean_all = sums / np.where(n > 0, n, 1.0)[:, None, None]
    mean = mean_all[:, 0, 1:]
    return n, mean, mean_all[:, 1:, 1:] - mean[:, :, None] * mean[:, None, :]


def ridge_solver(k_inputs, penalties):
    """Solver over batches of combined sums: fit each penalty, keep the one with the least validation error."""
    k = k_inputs + 1

    def solve(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            lo, hi = np.stack(pdf["lo"])[:, 1:], np.stack(pdf["hi"])[:, 1:]
            span = np.where(hi > lo, hi - lo, 1.0)
            n, mean, cov = _moments(np.stack(pdf["fit_sums"]), k)
            m, vmean, vcov = _moments(np.stack(pdf["val_sums"]), k)
            unit = span[:, :, None] * span[:, None, :]
            a = cov / unit
            best = np.full(len(pdf), np.inf)
            coef = np.zeros((len(pdf), k_inputs))
            chosen = np.full(len(pdf), np.nan)
            for p in penalties:
                left = a[:, :-1, :-1] + p * np.eye(k_inputs)
                scaled = np.linalg.solve(left, a[:, :-1, -1:])[:, :, 0]
                raw = scaled * span[:, -1:] / span[:, :-1]
                bias = mean[:, -1] - (raw * mean[:, :-1]).sum(1)
                off = vmean[:, -1] - bias - (raw * vmean[:, :-1]).sum(1)
                mse = (vcov[:, -1, -1] - 2 * (raw * vcov[:, :-1, -1]).sum(1)
                       + np.einsum("bi,bij,bj->b", raw, vcov[:, :-1, :-1], raw) + off ** 2)
                mse = np.where(m > 0, mse, 0.0)
                better = mse < best
                best, chosen = np.where(better, mse, best), np.where(better, p, chosen)
                coef = np.where(better[:, None], raw, coef)
            out = pdf[[c for c in pdf.columns if c not in ("first", "lo", "hi", "fit_sums", "val_sums")]].copy()
            out["coef"] = list(coef)
            first = np.stack(pdf["first"])
            out["intercept"] = first[:, -1] + mean[:, -1] - (coef * (first[:, :-1] + mean[:, :-1])).sum(1)
            out["penalty"] = chosen
            out["val_rmse"] = np.sqrt(np.maximum(best, 0.0))
            yield out

    return solve
