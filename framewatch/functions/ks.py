"""Two-sample Kolmogorov–Smirnov pieces.

Statistic (K1), all integer arithmetic so ties and rounding cannot move it:
for a window W (n1 values) against a baseline B (n2 values), with per-point
counts ``w_le = #W <= x``, ``w_lt = #W < x``, ``b_le = #B <= x``,
``b_lt = #B < x`` evaluated at every window point,

    ks_num = max_x max(|w_le*n2 - b_le*n1|, |w_lt*n2 - b_lt*n1|),   D = ks_num / (n1*n2)

Both empirical CDFs are step functions, so the supremum is reached at a
window point or just left of one (the left limit covers every baseline point
between two window points).  The window is sorted once and merged with the
baseline ranks its points carry: in sorted order the window counts are places, ``w_lt``
that of the first and ``w_le`` one beyond that of the last of equal values.  That is
O(W log W) in Spark SQL.  Infinite values rank like any other; a NaN or
null value in the window or the baseline makes the statistic null, and a null
statistic never flags drift.

Exact two-sided p-value (K2): the probability that a uniformly random
monotone lattice path from (0,0) to (n1,n2) touches a point with
``|i*n2 - j*n1| >= ks_num``.  With ``v(i,j)`` the probability for paths ending
at (i,j): ``v = 1`` on such points, otherwise
``v(i,j) = i/(i+j) v(i-1,j) + j/(i+j) v(i,j-1)``; ``p = v(n1,n2)``.
The recursion walks the anti-diagonals ``i+j`` inside the band
``|i*n2 - j*n1| < ks_num`` only, at most ``2*ks_num/(n1+n2) + 1`` points each, in numpy
(a pandas UDF); triples of one small shape are walked together.  Workers keep the
values they have computed for a shape (``MEMO`` of them at most), so the cost follows the
distinct statistics, not the rows.

Large-sample p-value (K3), used when a sample exceeds ``exact_ks_max_n``: the
*finite-n* distribution of the one-sample statistic at
``n = round(n1 n2 / (n1 + n2))``.  For ``n d^2 < 4`` by the Durbin matrix: with ``k = floor(nD)+1``
and ``h = k - nD``, ``P(D_n < D) = n!/n^n (H^n)[k,k]`` for a banded matrix H of
order ``2k-1`` (Marsaglia, Tsang and Wang 2003); H^n by repeated squaring, each power
scaled by a power of two that is counted apart.  From there on by the tail: twice the
exact one-sided probability (Smirnov; Birnbaum and Tingey 1951), which counts samples
that pass on both sides twice: a relative error below exp(-6 n d^2), 4e-11, of p-values below 7e-4.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..session import share_package

#: Shapes (n1, n2) that are walked together, by their smaller size, and p-values kept per worker.
SMALL = 64
MEMO = 1 << 20
#: n d^2 from which on the tail is used.
TAIL = 4.0


def ks_num_expr(win: str, feature: str, n2: int) -> Column:
    """``ks_num`` of one feature for a window array column ``win`` whose
    structs carry ``{feature}``, ``{feature}_ble`` and ``{feature}_blt``."""
    f, n2 = feature, int(n2)
    points = f"array_sort(transform({win}, e -> struct(e.{f} AS x, e.{f}_ble AS le, e.{f}_blt AS lt)))"
    last = "get(s, i + 1).x IS NULL OR get(s, i + 1).x > s[i].x"
    first = "i = 0 OR get(s, i - 1).x < s[i].x"
    return F.expr(f"""CASE WHEN size({win}) = 0 OR exists({win}, e -> e.{f} IS NULL OR isnan(e.{f}) OR e.{f}_ble IS NULL) THEN NULL
          ELSE transform(array({points}), s -> aggregate(sequence(0, size(s) - 1), 0L, (m, i) -> greatest(m,
            IF({last}, abs((i + 1L) * {n2} - s[i].le * size(s)), 0L),
            IF({first}, abs(i * {n2}L - s[i].lt * size(s)), 0L))))[0] END""")


def exact_pvalues(n1: int, n2: int, ks_nums: np.ndarray) -> np.ndarray:
    """K2 for the given ``ks_num`` of one shape."""
    a, b = sorted((int(n1), int(n2)))
    h = np.asarray(ks_nums, np.int64)
    out = np.ones(len(h))
    todo = np.flatnonzero(h > 0)
    if a <= SMALL:
        for at in range(0, len(todo), 4096):
            some = todo[at:at + 4096]
            out[some] = _walk_together(a, b, h[some])
    else:
        for k in todo:
            out[k] = _walk_band(a, b, int(h[k]))
    return out


def _walk_together(a: int, b: int, h: np.ndarray) -> np.ndarray:
    """Whole anti-diagonals, one row a statistic: the smaller sample is short."""
    i = np.arange(a + 1)
    v = np.zeros((len(h), a + 1))
    for t in range(1, a + b + 1):
        before = np.zeros_like(v)
        before[:, 1:] = v[:, :-1]
        v = i / t * before + (t - i) / t * v
        v[np.abs(i * b - (t - i) * a)[None, :] >= h[:, None]] = 1.0
        v[:, (t - i < 0) | (t - i > b)] = 0.0
    return v[:, a]


def _walk_band(a: int, b: int, h: int) -> float:
    """Only points of an anti-diagonal inside the band; beside it the value is one."""
    if h > a * b:
        return 0.0
    v, lo = np.zeros(1), 0                      # diagonal t - 1: points lo .. lo + len(v) - 1
    for t in range(1, a + b + 1):
        # i (a + b) strictly between t a - h and t a + h, and both coordinates in range
        new_lo = max(0, t - b, (t * a - h) // (a + b) + 1)
        new_hi = min(a, t, -((-t * a - h) // (a + b)) - 1)
        if new_hi < new_lo:
            return 1.0                          # no path gets through
        i = np.arange(new_lo, new_hi + 1)
        padded = np.ones(len(v) + 4)            # outside the band every path has touched
        padded[2:-2] = v
        at = np.clip(i - lo + 2, 0, len(padded) - 1)
        v = i / t * padded[np.clip(at - 1, 0, None)] + (t - i) / t * padded[at]
        lo = new_lo
    return float(v[a - lo]) if lo <= a < lo + len(v) else 1.0


def large_sample_pvalue(n: int, d: float) -> float:
    """K3: P(D_n >= d) of the one-sample statistic."""
    if d <= 0 or n <= 0:
        return 1.0
    if d >= 1:
        return 0.0
    return one_sided_tail(n, d) if n * d * d >= TAIL else min(1.0, max(0.0, 1.0 - durbin(n, d)))


def durbin(n: int, d: float) -> float:
    """P(D_n < d) by the Durbin matrix."""
    k = int(n * d) + 1
    m, h = 2 * k - 1, k - n * d
    inverse = np.ones(m + 1)
    for t in range(1, m + 1):
        inverse[t] = inverse[t - 1] / t
    gap = np.arange(m)[:, None] - np.arange(m)[None, :] + 1
    entry = np.where(gap < 0, 0.0, inverse[np.maximum(gap, 0)])
    # the first column and the last row are corrected for the parts of the band that are cut off
    entry[:, 0] -= h ** np.arange(1, m + 1) * inverse[1:]
    entry[-1] -= h ** np.arange(m, 0, -1) * inverse[m:0:-1]
    if 2 * h - 1 > 0:
        entry[-1, 0] += (2 * h - 1) ** m * inverse[m]
    # row k of H^n with powers of two taken out
    row, row_exp, power, power_exp, left = np.eye(m)[k - 1], 0, entry, 0, n
    while left:
        if left & 1:
            row, row_exp = row @ power, row_exp + power_exp
            row, e = _scaled(row)
            row_exp += e
        left >>= 1
        if left:
            power, power_exp = power @ power, 2 * power_exp
            power, e = _scaled(power)
            power_exp += e
    # n!/n^n in logarithms
    log = math.lgamma(n + 1) - n * math.log(n) + row_exp * math.log(2)
    return float(row[k - 1]) * math.exp(log) if row[k - 1] > 0 and log < 700 else 0.0


def _scaled(m: np.ndarray) -> tuple[np.ndarray, int]:
    e = math.frexp(float(np.abs(m).max()))[1]
    return np.ldexp(m, -e), e


def one_sided_tail(n: int, d: float) -> float:
    """2 P(D_n+ >= d), the sum of positive terms in logarithms."""
    j = np.arange(int(n * (1 - d)) + 1)
    rest = 1 - d - j / n
    j, rest = j[rest > 0], rest[rest > 0]
    log_factorial = np.concatenate(([0.0], np.cumsum(np.log(np.arange(1, n + 1)))))
    terms = (log_factorial[n] - log_factorial[j] - log_factorial[n - j] + (j - 1) * np.log(d + j / n) + (n - j) * np.log(rest))
    top = terms.max()
    return min(1.0, 2 * d * math.exp(top) * float(np.exp(terms - top).sum()))


_memo: dict[tuple[int, int], dict[int, float]] = {}


def _known(n1: int, n2: int, ks: np.ndarray) -> np.ndarray:
    """Exact p-values, each statistic of a shape once per worker."""
    if sum(map(len, _memo.values())) > MEMO:
        _memo.clear()
    have = _memo.setdefault((n1, n2), {})
    new = np.array([k for k in np.unique(ks).tolist() if k not in have], np.int64)
    have.update(zip(new.tolist(), exact_pvalues(n1, n2, new).tolist()))
    return np.array([have[k] for k in ks.tolist()])


def _exact_udf(n1: pd.Series, n2: pd.Series, ks: pd.Series) -> pd.Series:
    out = pd.Series(np.nan, index=ks.index, dtype="float64").astype(object)
    out[:] = None
    d = pd.DataFrame({"a": n1, "b": n2, "k": ks}).dropna()
    for (a, b), part in d.groupby(["a", "b"]):
        out[part.index] = _known(int(a), int(b), part["k"].to_numpy(np.int64))
    return out.astype("float64")


def _large_udf(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    seen: dict[tuple[int, float], float] = {}

    def one(x: float, a: float, b: float) -> float:
        if x is None or math.isnan(x):
            return math.nan
        key = (math.floor(a * b / (a + b) + 0.5), x)
        if key not in seen:
            seen[key] = large_sample_pvalue(*key)
        return seen[key]
    return pd.Series([one(*r) for r in zip(d, n1, n2)], index=d.index, dtype="float64")


def _once(f, *args: Column) -> Column:
    """A pandas UDF that the optimizer neither moves nor copies: a condition on the p-value, pushed
    down with the function in it, would run it twice or leave it where Spark cannot evaluate it."""
    return F.pandas_udf(f, "double").asNondeterministic()(*args)


def exact_pvalue_expr(n1: str = "n1", n2: str = "n2", kn: str = "ks_num") -> Column:
    """K2: exact two-sided p-value for columns (n1, n2, ks_num); null without a statistic."""
    share_package()
    p = _once(_exact_udf, F.col(n1).cast("long"), F.col(n2).cast("long"), F.col(kn).cast("long"))
    return F.when(F.col(kn).isNotNull(), p)


def large_sample_pvalue_expr(d: str = "ks_statistic", n1: str = "n1", n2: str = "n2") -> Column:
    """K3: P(D_n >= d) of the one-sample statistic at n = round(n1 n2 / (n1 + n2)); null without a statistic."""
    share_package()
    a, b = (F.expr(x).cast("double") for x in (n1, n2))
    return F.when(F.col(d).isNotNull(), _once(_large_udf, F.col(d).cast("double"), a, b))
