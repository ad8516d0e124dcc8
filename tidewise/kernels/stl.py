"""Seasonal-trend decomposition by LOESS (Cleveland, Cleveland, McRae & Terpenning, 1990).

Vectorised numpy implementation of the published algorithm: unit-spaced points, tricube
weights, local degree 1, inner loop (detrend -> cycle-subseries smoothing extended one
period each side -> low-pass (MA p, MA p, MA 3, LOESS) -> deseasonalise -> trend LOESS)
and an outer robustness loop with bisquare weights at 6 x median |residual|.

Every LOESS is evaluated for all query points at once: windows have a common length,
so the weights are a (points x window) matrix; subseries of equal length are stacked.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np

#: points smoothed in step: more would leave the cache
BLOCK_POINTS = 40_000


def _odd_at_least(x: int) -> int:
    x = int(x)
    return x if x % 2 == 1 else x + 1


def default_spans(period: int, seasonal: int = 7) -> tuple[int, int, int]:
    """(seasonal, trend, low_pass) spans: trend = smallest odd >= ceil(1.5 p / (1 - 1.5/ns)),
    low pass = smallest odd > p."""
    trend = _odd_at_least(math.ceil(1.5 * period / (1.0 - 1.5 / seasonal)))
    low = _odd_at_least(period + 1)
    return seasonal, trend, low


def _loess(Y: np.ndarray, RW: np.ndarray | None, span: int, xs: np.ndarray, nleft: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Local linear fits of rows of Y (B x n) at positions xs (1-based, Q) with windows
    [nleft, nleft + L - 1]; returns (B x Q values, B x Q ok-mask)."""
    B, n = Y.shape
    L = min(span, n)
    j = nleft[:, None] + np.arange(L)[None, :]            # Q x L, 1-based positions
    xs_f = xs.astype(float)
    h = np.maximum(xs_f - nleft, nleft + L - 1 - xs_f)
    if span > n:
        h = h + (span - n) // 2
    r = np.abs(j - xs_f[:, None])
    hh = h[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        w = np.where(r <= 0.999 * hh, np.where(r <= 0.001 * hh, 1.0, (1.0 - (r / hh) ** 3) ** 3), 0.0)
    W = np.broadcast_to(w, (B,) + w.shape).copy()
    if RW is not None:
        W *= RW[:, j - 1]
    a = W.sum(axis=2)
    ok = a > 0
    with np.errstate(divide="ignore", invalid="ignore"):
        W = W / np.where(ok, a, 1.0)[:, :, None]
        jf = j.astype(float)[None, :, :]
        mean_j = (W * jf).sum(axis=2)
        c = (W * (jf - mean_j[:, :, None]) ** 2).sum(axis=2)
        rng = n - 1
        adj = (h[None, :] > 0) & (np.sqrt(c) > 0.001 * rng)
        b = np.where(adj, (xs_f[None, :] - mean_j) / np.where(adj, c, 1.0), 0.0)
        W = W * (b[:, :, None] * (jf - mean_j[:, :, None]) + 1.0)
    ys = (W * Y[:, j - 1]).sum(axis=2)
    return ys, ok


@lru_cache(maxsize=256)
def _fft_size(n: int) -> int:
    """The smallest number from n on whose only prime factors are 2, 3 and 5."""
    while True:
        m = n
        for f in (2, 3, 5):
            while m % f == 0:
                m //= f
        if m == 1:
            return n
        n += 1


@lru_cache(maxsize=64)
def _interior_kernels(span: int, size: int):
    """Tricube weights of a full window times 1, d and d^2 (d: offset from its middle), and their transforms of ``size``."""
    h = (span - 1) / 2.0
    d = np.arange(span) - h
    k = _tricube(np.abs(d), np.full(span, h)) * np.stack([np.ones(span), d, d * d])
    return k, np.fft.rfft(k[:, ::-1], size)


def _correlate(X: np.ndarray, span: int, powers: int) -> list[np.ndarray]:
    """Correlations of every row of X with the first ``powers`` interior kernels, where the window fits. Long kernels go
    by FFT; a circular one of n points will do, as it only spoils places that are not asked for."""
    n = X.shape[1]
    size = _fft_size(n)
    k, spectra = _interior_kernels(span, size)
    if span <= 12:
        q = n - span + 1
        out = [np.zeros((X.shape[0], q)) for _ in range(powers)]
        for j in range(span):
            part = X[:, j:j + q]
            for p in range(powers):
                out[p] += k[p, j] * part
        return out
    f = np.fft.rfft(X, size)
    return [np.fft.irfft(f * spectra[p], size)[:, span - 1:n] for p in range(powers)]


def _interior(Y: np.ndarray, RW: np.ndarray | None, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Symmetric-window points of every row: all windows share one tricube kernel, so the five weighted sums of the local
    linear fit are correlations with fixed kernels. Without weights the first three are the same for all rows."""
    n = Y.shape[1]
    h = (span - 1) / 2.0
    s0, s1, s2 = _correlate(np.ones((1, n)) if RW is None else RW, span, 3)
    t0, t1 = _correlate(Y if RW is None else RW * Y, span, 2)
    scale = np.maximum(np.abs(s0).max(axis=1, keepdims=True), 1.0) if s0.size else 1.0
    ok = s0 > 1e-12 * scale
    with np.errstate(divide="ignore", invalid="ignore"):
        s0s = np.where(ok, s0, 1.0)
        md = s1 / s0s
        c = s2 / s0s - md * md
        adj = (h > 0) & (np.sqrt(np.maximum(c, 0.0)) > 0.001 * (n - 1))
        b = np.where(adj, -md / np.where(adj, c, 1.0), 0.0)
        ys = t0 / s0s + b * (t1 / s0s - md * t0 / s0s)
    return ys, np.broadcast_to(ok, ys.shape)


def _tricube(r: np.ndarray, h: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(r <= 0.999 * h, np.where(r <= 0.001 * h, 1.0, (1.0 - (r / h) ** 3) ** 3), 0.0)


@lru_cache(maxsize=256)
def _common_window_weights(n: int, span: int, start: int, stop: int, first: int, length: int):
    """Tricube weights for query points start..stop-1 (1-based) sharing window [first, first+length-1]."""
    xs = np.arange(start, stop, dtype=float)
    pos = np.arange(length, dtype=float)                  # j - first
    xr = xs - first
    h = np.maximum(xr, (length - 1) - xr)
    if span > n:
        h = h + (span - n) // 2
    w = _tricube(np.abs(pos[None, :] - xr[:, None]), h[:, None])
    return xr, pos, w, h


def _fit_common(Y: np.ndarray, V: np.ndarray, n: int, span: int, start: int, stop: int, first: int, length: int):
    """Local linear fits of every row at points start..stop-1 that share one window: five
    matrix products with the cached weights. Returns (B x Q values, B x Q ok)."""
    xr, pos, w, h = _common_window_weights(n, span, start, stop, first, length)
    yy = Y[:, first - 1:first - 1 + length]
    vv = V[:, first - 1:first - 1 + length]
    s0 = vv @ w.T
    s1 = (vv * pos) @ w.T
    s2 = (vv * pos * pos) @ w.T
    t0 = (vv * yy) @ w.T
    t1 = (vv * pos * yy) @ w.T
    ok = s0 > 0
    with np.errstate(divide="ignore", invalid="ignore"):
        s0s = np.where(ok, s0, 1.0)
        m = s1 / s0s
        c = s2 / s0s - m * m
        adj = (h[None, :] > 0) & (np.sqrt(np.maximum(c, 0.0)) > 0.001 * (n - 1))
        b = np.where(adj, (xr[None, :] - m) / np.where(adj, c, 1.0), 0.0)
        ys = t0 / s0s + b * (t1 / s0s - m * t0 / s0s)
    return ys, ok


def _smooth(Y: np.ndarray, RW: np.ndarray | None, span: int) -> np.ndarray:
    """LOESS at every point 1..n of every row (the stless window rule); where no weight, the data."""
    B, n = Y.shape
    V = np.ones((1, n)) if RW is None else RW
    if span >= n:
        ys, ok = _fit_common(Y, V, n, span, 1, n + 1, 1, n)
        return np.where(ok, ys, Y)
    if span % 2 == 0:
        xs = np.arange(1, n + 1)
        nleft = np.clip(xs - (span + 1) // 2 + 1, 1, n - span + 1)
        ys, ok = _loess(Y, RW, span, xs, nleft)
        return np.where(ok, ys, Y)
    nsh = (span + 1) // 2
    out = np.empty_like(Y)
    okv = np.empty(Y.shape, dtype=bool)
    lo, hi = nsh - 1, n - nsh + 1          # 0-based interior slice [lo, hi)
    out[:, lo:hi], okv[:, lo:hi] = _interior(Y, RW, span)
    if lo > 0:
        out[:, :lo], okv[:, :lo] = _fit_common(Y, V, n, span, 1, nsh, 1, span)
    if hi < n:
        out[:, hi:], okv[:, hi:] = _fit_common(Y, V, n, span, hi + 1, n + 1, n - span + 1, span)
    return np.where(okv, out, Y)


def _cycle_subseries(D: np.ndarray, RW: np.ndarray | None, period: int, ns: int) -> np.ndarray:
    """Smooth each cycle-subseries of every row and extend it one point on each side -> length n + 2p.
    Subseries of equal length, of all rows, are smoothed together."""
    B, n = D.shape
    C = np.empty((B, n + 2 * period))
    lengths: dict[int, list[int]] = {}
    for j in range(period):
        lengths.setdefault((n - j - 1) // period + 1, []).append(j)
    for k, js in lengths.items():
        idx = np.array(js)[:, None] + period * np.arange(k)[None, :]   # J x k, 0-based
        Y = D[:, idx].reshape(-1, k)
        V = RW[:, idx].reshape(-1, k) if RW is not None else None
        inner = _smooth(Y, V, ns)
        weights = np.ones_like(Y) if V is None else V
        L = min(ns, k)
        left_ys, left_ok = _fit_common(Y, weights, k, ns, 0, 1, 1, L)
        right_ys, right_ok = _fit_common(Y, weights, k, ns, k + 1, k + 2, k - L + 1, L)
        left = np.where(left_ok[:, 0], left_ys[:, 0], inner[:, 0])
        right = np.where(right_ok[:, 0], right_ys[:, 0], inner[:, -1])
        ext = np.concatenate([left[:, None], inner, right[:, None]], axis=1)   # (B J) x (k + 2)
        C[:, np.array(js)[:, None] + period * np.arange(k + 2)[None, :]] = ext.reshape(B, len(js), k + 2)
    return C


def _ma(X: np.ndarray, w: int) -> np.ndarray:
    c = np.cumsum(np.concatenate([np.zeros((X.shape[0], 1)), X], axis=1), axis=1)
    return (c[:, w:] - c[:, :-w]) / w


def stl_stack(Y: np.ndarray, period: int, seasonal: int = 7, robust: bool = True,
              trend: int | None = None, low_pass: int | None = None) -> dict[str, np.ndarray]:
    """The decomposition of every row of Y (series x n), a block of rows in step."""
    Y = np.asarray(Y, dtype=float)
    B, n = Y.shape
    rows = max(1, BLOCK_POINTS // max(n, 1))
    if B > rows:
        parts = [stl_stack(Y[i:i + rows], period, seasonal, robust, trend, low_pass) for i in range(0, B, rows)]
        return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
    if period < 2:
        raise ValueError("period must be >= 2")
    if n < 2 * period:
        raise ValueError("insufficient_data")
    ns, nt, nl = default_spans(period, seasonal)
    nt = trend or nt
    nl = low_pass or nl
    inner, outer = (2, 15) if robust else (5, 0)
    T = np.zeros((B, n))
    S = np.zeros((B, n))
    RW = None
    for it in range(outer + 1):
        for _ in range(inner):
            C = _cycle_subseries(Y - T, RW, period, ns)
            low = _ma(_ma(_ma(C, period), period), 3)
            S = C[:, period:period + n] - _smooth(low, None, nl)
            T = _smooth(Y - S, RW, nt)
        if it >= outer:
            break
        r = np.abs(Y - S - T)
        cmad = 6.0 * np.median(r, axis=1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            u = np.where(cmad > 0, r / cmad, 0.0)
        RW = np.where((cmad <= 0) | (r <= 0.001 * cmad), 1.0, np.where(r <= 0.999 * cmad, (1 - u**2) ** 2, 0.0))
    return {"trend": T, "seasonal": S, "resid": Y - S - T, "observed": Y}


def stl(y: np.ndarray, period: int, seasonal: int = 7, robust: bool = True,
        trend: int | None = None, low_pass: int | None = None) -> dict[str, np.ndarray]:
    """The decomposition of one series."""
    r = stl_stack(np.asarray(y, dtype=float)[None, :], period, seasonal, robust, trend, low_pass)
    return {k: v[0] for k, v in r.items()}


def strengths(part: np.ndarray, resid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(F, F/(F+1)) of every row with population variances; 0 where var(resid) = 0."""
    vr = np.var(resid, axis=1)
    some = vr > 0
    f = np.where(some, np.var(part, axis=1) / np.where(some, vr, 1.0), 0.0)
    return f, f / (f + 1.0)


def strength(part: np.ndarray, resid: np.ndarray) -> tuple[float, float]:
    """(F, F/(F+1)) with population variances; 0 when var(resid) = 0."""
    vr = float(np.var(resid))
    if vr > 0:
        f = float(np.var(part)) / vr
        return f, f / (f + 1.0)
    return 0.0, 0.0
