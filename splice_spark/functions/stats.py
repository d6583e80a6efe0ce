"""Small vectorised statistics that Spark's functions lack."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql.pandas.functions import pandas_udf


def _lgamma(half: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function of positive halves, by the distinct ones."""
    values, at = np.unique(half, return_inverse=True)
    return np.array([math.lgamma(v) for v in values.tolist()])[at]


def chi2_tails(x: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(X > x) for chi-square with ``df`` degrees of freedom: a finite sum for even ones, the error function and a sum for odd ones; NaN where it isn't defined."""
    x, df = np.asarray(x, np.float64), np.asarray(df, np.float64)
    out = np.full(len(x), np.nan)
    out[(df > 0) & (x <= 0)] = 1.0
    k = np.flatnonzero((df > 0) & (x > 0))
    if not len(k):
        return out
    h, n = x[k] / 2, df[k].astype(np.int64)
    odd = n % 2 == 1
    root = np.sqrt(np.minimum(h, 1e4))
    total = np.where(odd, [math.erfc(r) if o else 0.0 for r, o in zip(root.tolist(), odd.tolist(), strict=True)], 0.0)
    for j in range(int((n // 2).max())):  # one term a pair of degrees, for all values at once
        more = j < n // 2
        place = j + np.where(odd, 0.5, 0.0)
        total += np.where(more, np.exp(place * np.log(h) - h - _lgamma(place + 1)), 0.0)
    out[k] = np.minimum(total, 1.0)
    return out


def chi2_tail(x: float, df: int) -> float:
    return float(chi2_tails(np.array([x]), np.array([df]))[0])


def _tails(x: pd.Series, df: pd.Series) -> pd.Series:
    found = chi2_tails(x.to_numpy(np.float64, na_value=np.nan), df.to_numpy(np.float64, na_value=np.nan))
    return pd.Series(found, dtype="Float64").mask(np.isnan(found))


def chi2_sf(x: Column, df: Column) -> Column:
    """Upper tail for each row; null where either is."""
    return pandas_udf(_tails, "double")(x, df)


#: A prime below 2^31, so that products fit 64 bits.
PRIME = 2_147_483_647


def permutation_keys(n: int, seed: int, perms: np.ndarray, cells: np.ndarray | None = None) -> np.ndarray:
    """A number under ``PRIME`` for each permutation (row) and cell (column); cells stand in its order, equal ones by their own.

    Of the first ``n`` cells, or of those in ``cells``.  Whole-number arithmetic only, so that SQL gives the same.
    """
    i, r = (np.arange(n, dtype=np.int64) if cells is None else cells)[None, :], np.asarray(perms, np.int64)[:, None]
    a = (seed * 48_271 + r * 1_566_083_941 + 1) % PRIME
    x = (i % PRIME * 1_103_515_245 + a) % PRIME
    x = (x * x + a) % PRIME
    x = (x * 69_621 + r + i) % PRIME
    x = (x * x + a) % PRIME
    return (x * 48_271 + i) % PRIME


def permuted_statistics(z: np.ndarray, sizes: np.ndarray, var_add: float, seed: int, perms: np.ndarray, at_once: int = 2_000_000) -> np.ndarray:
    """The statistic of permutations of ``z`` over groups of ``sizes``, in the order of ``perms``: variance-weighted spread of the groups' medians."""
    ends = np.cumsum(sizes)
    out = []
    step = max(1, at_once // max(len(z), 1))
    for k in range(0, len(perms), step):
        placed = permutation_keys(len(z), seed, perms[k : k + step]) << 32 | np.arange(len(z))  # all different, and equal keys by place
        placed.sort(axis=1)
        v = z[placed & 0xFFFFFFFF]
        weights, middles = [], []
        for lo, hi in zip(ends - sizes, ends, strict=True):
            group = v[:, lo:hi]
            ordered, last = np.sort(group, axis=1), hi - lo - 1
            middles.append((ordered[:, last // 2] + ordered[:, (last + 1) // 2]) / 2)
            with np.errstate(divide="ignore", invalid="ignore"):
                weights.append((hi - lo) / (group.var(axis=1, ddof=1) + var_add) if hi - lo > 1 else np.full(len(v), np.nan))
        w, mid = np.stack(weights, axis=1), np.stack(middles, axis=1)
        mean = (w * mid).sum(1) / w.sum(1)
        out.append((w * (mid - mean[:, None]) ** 2).sum(1))
    return np.concatenate(out) if out else np.zeros(0)
