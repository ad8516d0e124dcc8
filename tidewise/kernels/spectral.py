"""numpy kernels for spectral tables of stacks of sensors (used inside Arrow maps)."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np

#: rows of one transform: more would leave the cache
STACK_ROWS = 16


def acf_stack(Y: np.ndarray, nlags: int) -> np.ndarray:
    """Biased autocorrelations 0..nlags of every row; NaN for a row without variance."""
    n = Y.shape[1]
    d = Y - Y.mean(axis=1, keepdims=True)
    m = 1 << int(math.ceil(math.log2(max(2 * n - 1, 2))))
    f = np.fft.rfft(d, m)
    ac = np.fft.irfft(f * np.conjugate(f), m)[:, : nlags + 1]
    den = ac[:, :1]
    some = (den > 0) & (Y.max(axis=1, keepdims=True) > Y.min(axis=1, keepdims=True))
    return np.where(some, ac / np.where(some, den, 1.0), np.nan)


def pacf_stack(R: np.ndarray) -> np.ndarray:
    """Partial autocorrelations of every row of autocorrelations 0..p (Levinson-Durbin); zeros where a row isn't finite."""
    B, p = R.shape[0], R.shape[1] - 1
    out = np.zeros((B, p + 1))
    out[:, 0] = 1.0
    fine = np.isfinite(R).all(axis=1)
    if p < 1:
        return out
    R = np.where(fine[:, None], R, 0.0)
    phi = np.zeros((B, p + 1))  # of the order before
    phi[:, 1] = R[:, 1]
    out[:, 1] = R[:, 1]
    v = 1.0 - R[:, 1] ** 2
    for k in range(2, p + 1):
        num = R[:, k] - np.einsum("ij,ij->i", phi[:, 1:k], R[:, k - 1:0:-1])
        new = np.where(v != 0, num / np.where(v != 0, v, 1.0), 0.0)
        phi[:, 1:k] = phi[:, 1:k] - new[:, None] * phi[:, k - 1:0:-1]
        phi[:, k] = new
        v = v * (1.0 - new**2)
        out[:, k] = new
    out[~fine, 1:] = 0.0
    return out


@lru_cache(maxsize=32)
def _chirp_plan(M: int, T: int, K: int, step: int):
    """Chirps and the transformed kernel for given (M, T, K, step); shared by sensors of equal span."""
    two_m = 2 * M

    def chirp(j, sign):
        r = (step * (j.astype(np.int64) ** 2)) % two_m
        return np.exp(sign * 1j * np.pi * r / M)

    L = 1 << int(np.ceil(np.log2(T + K - 1)))
    v = chirp(np.arange(-(T - 1), K), 1.0)
    vv = np.zeros(L, dtype=complex)
    vv[: len(v)] = v
    return chirp(np.arange(T), -1.0), np.fft.fft(vv), chirp(np.arange(K), -1.0), L


def chirp_dft(ti: np.ndarray, A: np.ndarray, M: int, K: int, step: int = 1) -> np.ndarray:
    """X_k = sum_j a_j exp(-2 pi i step k t_j / M) for k < K (integer t_j >= 0) of every row of A, by the chirp-z
    identity k t = (k^2 + t^2 - (k - t)^2) / 2 and power-of-two FFTs (M need not be smooth).
    Chirp angles are reduced with integer arithmetic, so precision does not decay with k."""
    T = int(ti.max()) + 1 if len(ti) else 1
    U = np.zeros((A.shape[0], T), dtype=complex)
    np.add.at(U.T, ti, A.T)  # equal times add up
    pre, vf, post, L = _chirp_plan(int(M), T, int(K), int(step))
    conv = np.fft.ifft(np.fft.fft(U * pre, L) * vf)
    return post * conv[:, T - 1 : T - 1 + K]


def periodogram_stack(t: np.ndarray, Y: np.ndarray, fmin: float, df: float, nf: int) -> np.ndarray:
    """Standard Lomb-Scargle power with a fitted mean at f_k = fmin + k df, k < nf, of every row of Y.

    ``t`` are whole days, and 1/df = 10 * span is a whole number M, so
    exp(-2 pi i f_k t) = exp(-2 pi i fmin t) exp(-2 pi i k t / M): every trig sum is an exact
    DFT at bins k / M (chirp-z, so M may have large prime factors). Power = R^2 of
    y ~ 1 + sin + cos (same closed form as the harmonic detector). The sums that hold no value are computed once.
    """
    t = np.asarray(t, dtype=float)
    n = len(t)
    M = int(round(1.0 / df))
    ti = np.rint(t).astype(np.int64)
    shift = np.exp(-2j * np.pi * fmin * t)
    e1 = chirp_dft(ti, shift[None], M, nf, 1)[0]                                        # sum exp(-i theta)
    e2 = chirp_dft(ti, np.exp(-2j * np.pi * 2 * fmin * t)[None], M, nf, 2)[0]           # sum exp(-2 i theta)
    ms, mc = -e1.imag / n, e1.real / n
    vss = (n - e2.real) / (2 * n) - ms * ms
    vcc = (n + e2.real) / (2 * n) - mc * mc
    vsc = -e2.imag / (2 * n) - ms * mc
    d = vss * vcc - vsc * vsc
    out = np.zeros((Y.shape[0], nf))
    for lo in range(0, Y.shape[0], STACK_ROWS):
        y = np.asarray(Y[lo:lo + STACK_ROWS], dtype=float)
        yc = y - y.mean(axis=1, keepdims=True)
        ey = chirp_dft(ti, yc * shift, M, nf, 1)                                        # sum y exp(-i theta)
        vsy, vcy, vyy = -ey.imag / n, ey.real / n, np.mean(yc * yc, axis=1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            r2 = (vsy * vsy * vcc - 2 * vsy * vcy * vsc + vcy * vcy * vss) / (d * vyy)
        out[lo:lo + STACK_ROWS] = np.where((d > 1e-12) & (vyy > 0), r2, 0.0)
    return out
