"""1-D isolation forest (Liu, Ting & Zhou 2008) for one sensor's grid inside ``applyInPandas``."""

from __future__ import annotations

import numpy as np
import pandas as pd

EULER = 0.5772156649015329


def _c(n: np.ndarray | float) -> np.ndarray:
    n = np.asarray(n, dtype=float)
    out = np.where(n > 2, 2.0 * (np.log(np.maximum(n - 1, 1)) + EULER) - 2.0 * (n - 1) / np.maximum(n, 1), 0.0)
    return np.where(n == 2, 1.0, out)


def _path_lengths(sample: np.ndarray, x: np.ndarray, rng: np.random.Generator, limit: int) -> np.ndarray:
    depth = np.zeros(len(x))
    # iterative build+query: (lo, hi, data, index of queries inside, current depth)
    stack = [(sample, np.arange(len(x)), 0)]
    while stack:
        data, qi, d = stack.pop()
        if len(qi) == 0:
            continue
        if d >= limit or len(data) <= 1 or data.min() == data.max():
            depth[qi] = d + _c(len(data))
            continue
        split = rng.uniform(data.min(), data.max())
        left = x[qi] < split
        stack.append((data[data < split], qi[left], d + 1))
        stack.append((data[data >= split], qi[~left], d + 1))
    return depth


def anomaly_scores(x: np.ndarray, n_trees: int = 100, max_samples: int = 256, seed: int = 42) -> np.ndarray:
    x = np.asarray(x, dtype=float)
    n = len(x)
    psi = min(max_samples, n)
    rng = np.random.default_rng(seed)
    limit = int(np.ceil(np.log2(max(psi, 2))))
    total = np.zeros(n)
    for _ in range(n_trees):
        sample = x[rng.choice(n, psi, replace=False)]
        total += _path_lengths(sample, x, rng, limit)
    return 2.0 ** (-(total / n_trees) / _c(psi))


def iforest_group(pdf: pd.DataFrame, cols: list[str], contamination: float, seed: int, n_trees: int, max_samples: int = 256) -> pd.DataFrame:
    v = pdf["value"].to_numpy(dtype=float)
    ok = ~np.isnan(v)
    flag = np.zeros(len(v), dtype=bool)
    if ok.sum() > 1:
        s = anomaly_scores(v[ok], n_trees=n_trees, max_samples=max_samples, seed=seed)
        thr = np.percentile(s, 100.0 * (1.0 - contamination))
        flag[np.flatnonzero(ok)] = s > thr
    out = pdf[cols].copy()
    out["is_outlier"] = flag
    return out
