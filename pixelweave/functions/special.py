"""Tail probabilities that Spark has no function for, vectorised with numpy in pandas UDFs."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


def _erfc(x: np.ndarray) -> np.ndarray:
    return np.array([math.erfc(v) if v == v else np.nan for v in x])


def normal_two_sided(z: np.ndarray) -> np.ndarray:
    return _erfc(np.abs(z) / math.sqrt(2))


def log_gamma(x: np.ndarray) -> np.ndarray:
    return np.array([math.lgamma(v) for v in np.ravel(x)]).reshape(np.shape(x))


def incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function by Lentz's continued fraction."""
    a, b, x = (np.asarray(v, float) for v in np.broadcast_arrays(a, b, x))
    swap = x > (a + 1) / (a + b + 2)
    p, q, t = np.where(swap, b, a), np.where(swap, a, b), np.clip(np.where(swap, 1 - x, x), 0, 1)
    with np.errstate(all="ignore"):
        front = np.exp(log_gamma(p + q) - log_gamma(p) - log_gamma(q) + p * np.log(t) + q * np.log1p(-t)) / p
        tiny = 1e-300
        c, d = np.ones_like(t), 1 / np.where(np.abs(1 - (p + q) * t / (p + 1)) < tiny, tiny, 1 - (p + q) * t / (p + 1))
        f = d.copy()
        for m in range(1, 300):
            for num in (m * (q - m) * t / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * t / ((p + 2 * m) * (p + 2 * m + 1))):
                d = 1 + num * d
                d = 1 / np.where(np.abs(d) < tiny, tiny, d)
                c = 1 + num / c
                c = np.where(np.abs(c) < tiny, tiny, c)
                f *= c * d
            if np.all(np.abs(c * d - 1)[np.isfinite(c * d)] < 1e-14):
                break
        part = np.where(t <= 0, 0.0, front * f)
    return np.where(swap, 1 - part, part)


def student_two_sided(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    t, df = np.asarray(t, float), np.asarray(df, float)
    ok = np.isfinite(t) & np.isfinite(df) & (df > 0)
    out = np.full(t.shape, np.nan)
    out[ok] = incomplete_beta(df[ok] / 2, np.full(ok.sum(), 0.5), df[ok] / (df[ok] + t[ok] ** 2))
    return out


def f_upper(f: np.ndarray, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
    f, d1, d2 = np.asarray(f, float), np.asarray(d1, float), np.asarray(d2, float)
    return incomplete_beta(d2 / 2, d1 / 2, d2 / (d2 + d1 * np.maximum(f, 0)))


def hypergeometric_upper(k: int, good: int, bad: int, draws: int) -> float:
    """P(X >= k)."""
    choose = lambda n, r: math.lgamma(n + 1) - math.lgamma(r + 1) - math.lgamma(n - r + 1)
    whole = choose(good + bad, draws)
    return min(1.0, math.fsum(math.exp(choose(good, x) + choose(bad, draws - x) - whole) for x in range(max(k, draws - bad, 0), min(good, draws) + 1)))


@pandas_udf(DoubleType())
def normal_p(z: pd.Series) -> pd.Series:
    return pd.Series(normal_two_sided(z.to_numpy(float))).where(z.notna().to_numpy(), None)


@pandas_udf(DoubleType())
def student_p(t: pd.Series, df: pd.Series) -> pd.Series:
    p = student_two_sided(t.to_numpy(float), df.to_numpy(float))
    return pd.Series(p).astype(object).where(~np.isnan(p), None)


@pandas_udf(DoubleType())
def f_p(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series(f_upper(f.to_numpy(float), d1.to_numpy(float), d2.to_numpy(float)))


@pandas_udf(DoubleType())
def hypergeometric_p(k: pd.Series, good: pd.Series, bad: pd.Series, draws: pd.Series) -> pd.Series:
    return pd.Series([hypergeometric_upper(*map(int, r)) for r in zip(k, good, bad, draws, strict=True)])
