"""Whittaker smoothing of series with missing steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def penalty(n: int, lam: float, d: int = 2) -> np.ndarray:
    """lam D'D of the d-th difference matrix D."""
    diff = np.diff(np.eye(n), d, axis=0) if n > d else np.zeros((0, n))
    return lam * diff.T @ diff


def smooth_rows(y: np.ndarray, lam: float, d: int = 2) -> np.ndarray:
    """Solve (W + lam D'D) z = W y for each row, W marking valid steps; rows without any stay missing.

    Rows with the same missing steps share one factorisation.
    """
    ok = np.isfinite(y)
    out, p = np.full(y.shape, np.nan), penalty(y.shape[1], lam, d)
    masks, of = np.unique(ok, axis=0, return_inverse=True)
    for k, mask in enumerate(masks):
        rows = np.nonzero(of.ravel() == k)[0]
        if not mask.any():
            continue
        a, b = np.diag(mask.astype(float)) + p, np.where(mask, y[rows], 0.0).T
        try:
            out[rows] = np.linalg.solve(a, b).T
        except np.linalg.LinAlgError:
            out[rows] = np.linalg.lstsq(a, b, rcond=None)[0].T
    return out


def whittaker(lam: float = 0.5, d: int = 2, clip: tuple[float, float] | None = None):
    """Arrow function array<double> -> array<double>; an all-missing series is returned unchanged."""

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            out: list = [None] * len(series)
            sizes: dict[int, list[int]] = {}
            for i, s in enumerate(series):
                if s is not None:
                    sizes.setdefault(len(s), []).append(i)
            for n, rows in sizes.items():
                y = np.array([np.asarray(series.iloc[i], float) for i in rows]).reshape(len(rows), n)
                z = smooth_rows(y, lam, d) if n else y
                if clip:
                    z = np.clip(z, *clip)
                for i, x in zip(rows, z):
                    out[i] = [None if np.isnan(v) else float(v) for v in x]
            yield pd.Series(out)

    return run


def full_valid_matrix(n: int, lam: float, d: int = 2) -> list[list[float]]:
    """(I + lam D'D)^-1: the smoother of series without gaps, as a constant."""
    return np.linalg.inv(np.eye(n) + penalty(n, lam, d)).tolist()


def smooth_full(s: Column, matrix: list[list[float]]) -> Column:
    """The smoother of a gap-free series as a column expression over a constant matrix."""
    rows = [F.aggregate(F.zip_with(s, F.array(*map(F.lit, row)), lambda x, w: x * w), F.lit(0.0), lambda a, x: a + x) for row in matrix]
    return F.array(*rows)


def smooth_split(s: Column, n: int, lam: float) -> Column:
    """Series of ``n`` steps: the constant matrix where no step is missing, a solve per series elsewhere."""
    whole = F.forall(s, lambda x: x.isNotNull() & ~F.isnan(x)) & (F.size(s) == n)
    matrix = F.lit(full_valid_matrix(n, lam))
    full = F.transform(matrix, lambda row: F.aggregate(F.zip_with(s, row, lambda x, w: x * w), F.lit(0.0), lambda a, x: a + x))
    return F.when(whole, full).otherwise(whittaker(lam)(F.when(~whole, s)))
