"""numpy interpolating splines used inside ``applyInPandas`` (one sensor's grid per call)."""

from __future__ import annotations

import numpy as np
import pandas as pd


def knots(x: np.ndarray, k: int) -> np.ndarray:
    """Not-a-knot knots of degree ``k`` through the points ``x``: the points for an odd degree, the middles between
    them for an even one, so a polynomial of this degree is reproduced."""
    n = len(x)
    inner = x[(k + 1) // 2:n - (k + 1) // 2] if k % 2 else ((x[1:] + x[:-1]) / 2)[k // 2:n - 1 - k // 2]
    return np.concatenate((np.full(k + 1, x[0]), inner, np.full(k + 1, x[-1])))


def basis(t: np.ndarray, k: int, xq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the first basis function, values of the k + 1 that are not zero) at each ``xq``; outside the
    knots the end pieces go on."""
    at = np.clip(np.searchsorted(t, xq, side="right") - 1, k, len(t) - k - 2)
    out = np.zeros((len(xq), k + 1))
    out[:, 0] = 1.0
    for d in range(1, k + 1):
        carried = np.zeros(len(xq))
        for r in range(d):
            hi, lo = t[at + r + 1], t[at + r + 1 - d]
            share = out[:, r] / (hi - lo)
            out[:, r] = carried + (hi - xq) * share
            carried = (xq - lo) * share
        out[:, d] = carried
    return at - k, out


def coefficients(t: np.ndarray, k: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Spline coefficients through (x, y). The collocation matrix is banded and totally positive, so
    elimination needs no pivots: time and memory are linear in the points."""
    n = len(x)
    first, values = basis(t, k, x)
    band = np.zeros((n, 2 * k + 1))  # column k is the diagonal
    for c in range(k + 1):
        band[np.arange(n), first + c - np.arange(n) + k] = values[:, c]
    y = y.astype(float).copy()
    for i in range(n):
        for r in range(i + 1, min(i + k, n - 1) + 1):
            f = band[r, k + i - r] / band[i, k]
            if f:
                band[r, k + i - r:2 * k + 1 + i - r] -= f * band[i, k:]
                y[r] -= f * y[i]
    out = np.zeros(n + k)
    for i in range(n - 1, -1, -1):
        out[i] = (y[i] - band[i, k + 1:] @ out[i + 1:i + k + 1]) / band[i, k]
    return out[:n]


def spline_values(x: np.ndarray, y: np.ndarray, xq: np.ndarray, order: int, residual: float = 0.0) -> np.ndarray:
    """The spline of degree ``order`` (fewer points than order + 1: the polynomial through them) at ``xq``; through the points, or
    the smoothest one whose squared residuals sum to at most ``residual``."""
    k = min(order, len(x) - 1)
    t = knots(x, k)
    c = smoothing_coefficients(t, k, x, y, residual) if residual > 0 else coefficients(t, k, x, y)
    first, values = basis(t, k, xq)
    return (c[first[:, None] + np.arange(k + 1)] * values).sum(axis=1)


def _banded_solve(A: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x with A x = b for a symmetric positive definite A of bandwidth w, given as rows of diagonal and w upper diagonals."""
    n, w = A.shape[0], A.shape[1] - 1
    A, b = A.copy(), b.astype(float).copy()
    for i in range(n):
        m = min(w, n - 1 - i)
        f = A[i, 1:m + 1] / A[i, 0]
        for r in range(1, m + 1):
            A[i + r, :m - r + 1] -= f[r - 1] * A[i, r:m + 1]
        b[i + 1:i + m + 1] -= f * b[i]
    x = np.zeros(n + w)
    for i in range(n - 1, -1, -1):
        x[i] = (b[i] - A[i, 1:] @ x[i + 1:i + w + 1]) / A[i, 0]
    return x[:n]


def _gram(first: np.ndarray, values: np.ndarray, n: int, w: int) -> np.ndarray:
    """M'M as diagonal and w upper diagonals, for rows of M with ``values`` from column ``first`` on."""
    out = np.zeros((n, w + 1))
    k = values.shape[1]
    for i in range(k):
        for j in range(i, k):
            np.add.at(out[:, j - i], first + i, values[:, i] * values[:, j])
    return out


def jumps(t: np.ndarray, k: int) -> np.ndarray:
    """Rows of k + 2 factors: the jump of the k-th derivative at each interior knot is row . coefficients[j : j + k + 2]."""
    n = len(t) - k - 1
    # row i: the d-th derivative's coefficient i in terms of the coefficients i - d .. i
    rows = np.ones((n, 1))
    for d in range(1, k + 1):
        new = np.zeros((n, d + 1))
        for i in range(d, n):
            step = (k - d + 1) / (t[i + k - d + 1] - t[i])
            new[i, 1:] += step * rows[i]
            new[i, :-1] -= step * rows[i - 1]
        rows = new
    out = np.zeros((n - k - 1, k + 2))
    for j in range(k + 1, n):
        out[j - k - 1, 1:] += rows[j]
        out[j - k - 1, :-1] -= rows[j - 1]
    return out


def smoothing_coefficients(t: np.ndarray, k: int, x: np.ndarray, y: np.ndarray, residual: float) -> np.ndarray:
    """Coefficients of the smoothest spline with sum of squared residuals at most ``residual``: the squared jumps of its k-th derivative
    are least. The weight of the jumps is found by bisection of its logarithm; a polynomial that keeps the bound is taken as it is."""
    n = len(x)
    first, values = basis(t, k, x)
    fit = _gram(first, values, n, k + 1)
    rough = jumps(t, k)
    if not len(rough):
        return coefficients(t, k, x, y)
    rough = rough / np.abs(rough).max()
    penalty = _gram(np.arange(len(rough)), rough, n, k + 1)
    rhs = np.zeros(n)
    for c in range(k + 1):
        np.add.at(rhs, first + c, values[:, c] * y)

    def solved(log_weight: float) -> tuple[np.ndarray, float]:
        c = _banded_solve(fit + np.exp(log_weight) * penalty, rhs)
        return c, float(((y - (c[first[:, None] + np.arange(k + 1)] * values).sum(axis=1)) ** 2).sum())

    scale = np.log(fit[:, 0].max() / max(penalty[:, 0].max(), 1e-300))
    low, high = scale - 30.0, scale + 30.0
    best, found = solved(high)
    if found <= residual:
        return best
    best = coefficients(t, k, x, y)
    for _ in range(40):
        middle = (low + high) / 2
        c, found = solved(middle)
        if found <= residual:
            best, low = c, middle
            if found >= 0.999 * residual:
                break
        else:
            high = middle
    return best


def allowed(known: np.ndarray, direction: str, limit: int | None) -> np.ndarray:
    """Positions that ``direction`` and ``limit`` (rows from the nearest known point on that side) let be filled."""
    i, n = np.arange(len(known)), len(known)
    prev = np.maximum.accumulate(np.where(known, i, -1))
    nxt = np.minimum.accumulate(np.where(known, i, n)[::-1])[::-1]
    reach = n if limit is None else limit
    ahead, behind = (prev >= 0) & (i - prev <= reach), (nxt < n) & (nxt - i <= reach)
    return {"forward": ahead, "backward": behind, "both": ahead | behind}[direction]


def spline_fill(pdf: pd.DataFrame, cols: list[str], order: int = 3, extrapolate: bool = True,
                direction: str = "forward", limit: int | None = None, residual_per_point: float = 0.0) -> pd.DataFrame:
    pdf = pdf.sort_values("bin").reset_index(drop=True)
    t = pd.to_datetime(pdf["bin"])
    x_all = ((t - t.iloc[0]).dt.total_seconds() / 86400.0).to_numpy(dtype=float)
    y_all = pdf["value"].to_numpy(dtype=float)
    known = ~np.isnan(y_all)
    out = y_all.copy()
    if known.sum() >= 2:
        x, y = x_all[known], y_all[known]
        target = ~known & allowed(known, direction, limit)
        if not extrapolate:
            target &= (x_all > x[0]) & (x_all < x[-1])
        if target.any():
            out[target] = spline_values(x, y, x_all[target], order, residual_per_point * len(x))
    pdf["value"] = out
    return pdf[cols]
