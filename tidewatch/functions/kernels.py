"""Arrow-batched kernels for what SQL functions cannot express."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def indel_ratio(a: str, b: str) -> float:
    """2 LCS / (len a + len b), by the bit-parallel LCS of Hyyro."""
    if not a and not b:
        return 1.0
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        u = row & masks.get(c, 0)
        row = (row + u | row - u) & full
    return 2 * (len(a) - bin(row).count("1")) / (len(a) + len(b))


@F.pandas_udf(DoubleType())
def fuzzy_score(a: pd.Series, b: pd.Series) -> pd.Series:
    """Indel ratio of the upper-cased texts; null counts 0."""
    return pd.Series([indel_ratio(x.upper(), y.upper()) if isinstance(x, str) and isinstance(y, str) else 0.0 for x, y in zip(a, b, strict=True)], dtype="float64")


def gamma_upper(s: float, z: float) -> float:
    """The regularised upper incomplete gamma function."""
    if z <= 0:
        return 1.0
    scale = math.exp(s * math.log(z) - z - math.lgamma(s))
    if z < s + 1:
        term = total = 1 / s
        k = s
        while abs(term) > 1e-16 * abs(total):
            k += 1
            term *= z / k
            total += term
        return max(0.0, 1 - total * scale)
    b, c, d = z + 1 - s, 1e300, 1 / (z + 1 - s)
    h = d
    for i in range(1, 100_000):
        an = -i * (i - s)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return scale * h


def poisson_cdf(k: int, rate: float) -> float:
    """P(X <= k); the number of steps does not grow with the count itself."""
    return 0.0 if k < 0 else min(1.0, gamma_upper(k + 1, rate))


@F.pandas_udf(DoubleType())
def poisson_upper(count: pd.Series, rate: pd.Series) -> pd.Series:
    """``1 - cdf(count - 1)``, at least 1e-300; 1 for a count of zero.  It cancels as the plain difference does."""
    return pd.Series([1.0 if c <= 0 else max(1 - poisson_cdf(int(c) - 1, r), 1e-300) for c, r in zip(count, rate, strict=True)], dtype="float64")


def fisher_exact(a: int, b: int, c: int, d: int) -> float:
    """Two-sided p of a 2 x 2 table: tables no more likely than this one.

    The law has one mode, so these are two tails; each is found by bisection
    and summed until its terms vanish, whatever the counts are.
    """
    n, row, col = a + b + c + d, a + b, a + c
    choose = lambda x, y: math.lgamma(x + 1) - math.lgamma(y + 1) - math.lgamma(x - y + 1)
    log_p = lambda k: choose(col, k) + choose(n - col, row - k) - choose(n, row)
    low, high = max(0, row + col - n), min(row, col)
    mode = min(max((row + 1) * (col + 1) // (n + 2), low), high)
    bound = log_p(a) + 1e-7
    if log_p(mode) <= bound:
        return 1.0

    def tail(end: int, step: int) -> float:
        if log_p(end) > bound:
            return 0.0
        inside, outside = mode, end  # more likely than the table, and not
        while abs(outside - inside) > 1:
            middle = (inside + outside) // 2
            inside, outside = (inside, middle) if log_p(middle) <= bound else (middle, outside)
        k, term, total = outside, 1.0, 0.0
        while term > 1e-17 * total:
            total += term
            if k == end:
                break
            up = (row - k) * (col - k) / ((k + 1) * (n - row - col + k + 1)) if step > 0 else k * (n - row - col + k) / ((row - k + 1) * (col - k + 1))
            term *= up
            k += step
        return math.exp(log_p(outside)) * total

    return min(1.0, tail(low, -1) + tail(high, 1))


@F.pandas_udf(DoubleType())
def fisher_p(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    return pd.Series([fisher_exact(*map(int, t)) for t in zip(a, b, c, d, strict=True)], dtype="float64")


def chi2_upper(x: float, df: int) -> float:
    """Survival function of the chi-square law: the regularised upper incomplete gamma function."""
    if df <= 0 or x is None or math.isnan(x):
        return float("nan")
    return gamma_upper(df / 2, x / 2)


@F.pandas_udf(DoubleType())
def chi2_p(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([chi2_upper(float(v), int(k)) if pd.notna(v) else None for v, k in zip(x, df, strict=True)], dtype="float64")


def register_udfs(spark) -> list[str]:
    """Register the scalar functions by name for SQL."""
    return sorted(name for name, status in deploy_udfs(spark).items() if status == "ok")


def deploy_udfs(spark, more: dict | None = None) -> dict[str, str]:
    """Register every function and say how each went: ``ok`` or the error's text."""
    found = {"fuzzy_match_score": fuzzy_score, "poisson_upper": poisson_upper, "fisher_p": fisher_p, "chi2_p": chi2_p} | (more or {})
    status = {}
    for name, f in found.items():
        try:
            spark.udf.register(name, f)
            status[name] = "ok"
        except Exception as error:  # one function that cannot be registered leaves the others
            status[name] = str(error).splitlines()[0]
    for name, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(t STRING) RETURNS STRING RETURN {body}")
        status[name] = "ok"
    return status


# Text functions for SQL, as expressions of their argument: they need no Python.
SQL_FUNCTIONS = {
    "clean_text": r"nullif(trim(regexp_replace(regexp_replace(t, '[\\p{Cc}&&[^\\s]]', ''), '\\s+', ' ')), '')",
    "first_word": r"nullif(regexp_extract(t, '^\\s*(\\S+)', 1), '')",
}
