"""PELT changepoints (Killick, Fearnhead & Eckley 2012) with l2 / l1 / normal / rbf segment costs.

Candidate breakpoints are multiples of ``jump`` (5) at least ``min_size`` apart, as in the
widely used open-source implementations. Returns breakpoints as end-exclusive indices.
"""

from __future__ import annotations

import numpy as np


def median_square_distance(x: np.ndarray) -> float:
    """Exact median of (x_i - x_j)^2 over all pairs, by counting on the sorted values: O(n) memory."""
    xs = np.sort(x)
    n, own = len(xs), np.arange(len(xs)) + 1
    pairs = n * (n - 1) // 2

    def kth(k: int) -> float:
        # non-negative doubles are ordered as their bits, so halving the bits ends at the exact distance
        lo, hi = 0, int(np.float64(xs[-1] - xs[0]).view(np.int64))
        while lo < hi:
            mid = (lo + hi) // 2
            reach = xs + np.int64(mid).view(np.float64)
            if int((np.searchsorted(xs, reach, side="right") - own).sum()) >= k:
                hi = mid
            else:
                lo = mid + 1
        return float(np.int64(lo).view(np.float64))

    if pairs % 2:
        return kth(pairs // 2 + 1) ** 2
    return (kth(pairs // 2) ** 2 + kth(pairs // 2 + 1) ** 2) / 2


class Cost:
    def __init__(self, x: np.ndarray, model: str):
        self.x = np.asarray(x, dtype=float)
        self.model = model
        if model in ("l2", "normal"):
            self.c1 = np.concatenate([[0.0], np.cumsum(self.x)])
            self.c2 = np.concatenate([[0.0], np.cumsum(self.x * self.x)])
        elif model != "l1":  # l1: single segments; a search over starts takes L1Cost
            raise ValueError(f"Unknown cost model: {model}")

    def error(self, s: int, e: int) -> float:
        m = e - s
        if self.model == "l2":
            s1 = self.c1[e] - self.c1[s]
            return float(self.c2[e] - self.c2[s] - s1 * s1 / m)
        if self.model == "normal":
            s1 = self.c1[e] - self.c1[s]
            var = (self.c2[e] - self.c2[s]) / m - (s1 / m) ** 2
            return float(m * np.log(max(var, 1e-12)))
        seg = self.x[s:e]
        return float(np.abs(seg - np.median(seg)).sum())

    def errors(self, starts: np.ndarray, e: int) -> np.ndarray:
        return np.array([self.error(int(s), e) for s in starts])


class L1Cost:
    """Costs sum |x - median| with order statistics kept for every start: the points of a segment are counted in buckets of
    neighbouring ranks, for all starts at once. A new point is one addition per start; the median is found by the buckets' running
    counts and inside one bucket, so a cost takes O(sqrt n) instead of a sort of the segment."""

    def __init__(self, x: np.ndarray):
        self.x = np.asarray(x, dtype=float)
        n = len(self.x)
        self.order = np.argsort(self.x, kind="stable")  # position of each rank
        self.width = max(1, int(np.sqrt(n)))
        rank = np.empty(n, dtype=np.int64)
        rank[self.order] = np.arange(n)
        self.bucket = rank // self.width
        self.buckets = (n + self.width - 1) // self.width
        self.padded = np.concatenate((self.order, np.full(self.buckets * self.width - n, n)))
        self.values = np.concatenate((self.x, [0.0]))
        self.rows: dict[int, int] = {}  # start -> row of the two tables
        self.counts, self.sums, self.end = np.zeros((0, self.buckets), dtype=np.int64), np.zeros((0, self.buckets)), 0

    def errors(self, starts: np.ndarray, e: int) -> np.ndarray:
        """Costs of [s, e) for ascending ``starts``; the ends of successive calls rise."""
        keep = np.array([self.rows.get(int(s), -1) for s in starts], dtype=np.int64)
        known = keep >= 0
        counts, sums = np.zeros((len(starts), self.buckets), dtype=np.int64), np.zeros((len(starts), self.buckets))
        counts[known], sums[known] = self.counts[keep[known]], self.sums[keep[known]]
        new = np.arange(self.end, e)
        counts[known] += np.bincount(self.bucket[new], minlength=self.buckets)
        sums[known] += np.bincount(self.bucket[new], weights=self.x[new], minlength=self.buckets)
        for i in np.flatnonzero(~known):
            seg = slice(int(starts[i]), e)
            counts[i] = np.bincount(self.bucket[seg], minlength=self.buckets)
            sums[i] = np.bincount(self.bucket[seg], weights=self.x[seg], minlength=self.buckets)
        self.counts, self.sums, self.end = counts, sums, e
        self.rows = {int(s): i for i, s in enumerate(starts)}
        return self.medians(starts, e, counts, sums)

    def medians(self, starts: np.ndarray, e, counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
        m = e - starts
        k = (m - 1) // 2  # rank of the lower median inside the segment
        upto = counts.cumsum(axis=1)
        b = (upto <= k[:, None]).sum(axis=1)
        i = np.arange(len(starts))
        before = upto[i, b] - counts[i, b]
        places = self.padded[b[:, None] * self.width + np.arange(self.width)]
        inside = (places >= starts[:, None]) & (places < np.reshape(e, (-1, 1)))
        taken = inside & (inside.cumsum(axis=1) <= (k - before + 1)[:, None])
        last = self.width - 1 - taken[:, ::-1].argmax(axis=1)
        median = self.values[places[i, last]]
        below = np.where(np.arange(self.buckets) < b[:, None], sums, 0.0).sum(axis=1) + np.where(taken, self.values[places], 0.0).sum(axis=1)
        return sums.sum(axis=1) - 2.0 * below + median * (2 * (k + 1) - m)


class RbfCost:
    """Segment costs under the clipped Gaussian kernel without the n x n matrix: one running kernel sum per
    start, to which the rows of the points between two ends are added."""

    DIAGONAL = float(np.exp(-1e-2))

    def __init__(self, x: np.ndarray):
        self.x = np.asarray(x, dtype=float)
        med = median_square_distance(self.x) if len(self.x) > 1 else 1.0
        self.gamma = 1.0 / med if med > 0 else 1.0
        self.starts, self.sums, self.end = np.empty(0, dtype=int), np.empty(0), 0

    def kernel(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        d = a[..., :, None] - b[..., None, :]
        return np.exp(-np.clip(self.gamma * d * d, 1e-2, 1e2))

    def errors(self, starts: np.ndarray, e: int) -> np.ndarray:
        """Costs of [s, e) for ascending ``starts``; the ends of successive calls rise."""
        old, new = self.end, self.x[self.end:e]
        sums = np.zeros(len(starts))
        known = np.isin(starts, self.starts)
        if known.any():
            kept = starts[known]
            rows = self.kernel(new, self.x[kept[0]:old]).sum(axis=0)
            tail = rows[::-1].cumsum()[::-1]
            before = self.sums[np.searchsorted(self.starts, kept)]
            sums[known] = before + 2.0 * tail[kept - kept[0]] + self.kernel(new, new).sum()
        for i in np.flatnonzero(~known):
            seg = self.x[starts[i]:e]
            sums[i] = self.kernel(seg, seg).sum()
        self.starts, self.sums, self.end = starts, sums, e
        m = e - starts
        return self.DIAGONAL * m - sums / m

    def window_gains(self, inds: np.ndarray, half: int) -> np.ndarray:
        """Split gains of the windows of 2 * half points around ``inds``, a block of windows at a time."""
        gains = []
        for at in range(0, len(inds), 256):
            w = self.x[inds[at:at + 256, None] + np.arange(-half, half)]
            k = self.kernel(w, w)
            inner = k[:, :half, :half].sum(axis=(1, 2)) + k[:, half:, half:].sum(axis=(1, 2))
            gains.append(inner / half - k.sum(axis=(1, 2)) / (2 * half))
        return np.concatenate(gains) if gains else np.empty(0)


def pelt(x: np.ndarray, model: str = "rbf", min_size: int = 30, pen: float = 10.0, jump: int = 5) -> list[int]:
    n = len(x)
    cost = RbfCost(x) if model == "rbf" else L1Cost(x) if model == "l1" else Cost(x, model)
    total = np.full(n + 1, np.nan)   # end -> cost with penalties
    total[0] = 0.0
    came: dict[int, int] = {}        # end -> start of its last segment
    starts = np.empty(0, dtype=int)
    for e in [k for k in range(0, n, jump) if k >= min_size] + [n]:
        s = (e - min_size) // jump * jump
        if s >= 0 and not np.isnan(total[s]):
            starts = np.union1d(starts, [s])
        if not len(starts):
            continue
        tot = total[starts] + cost.errors(starts, e) + pen
        j = int(np.argmin(tot))
        total[e], came[e] = tot[j], int(starts[j])
        starts = starts[tot <= tot[j] + pen]
    if n not in came:
        return [n]
    out, e = [], n
    while e > 0:
        out.append(e)
        e = came[e]
    return out[::-1]


def window_scores(x: np.ndarray, model: str = "rbf", width: int = 50, jump: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Split gain cost(t-w/2, t+w/2) - cost(t-w/2, t) - cost(t, t+w/2) at candidates t (multiples of
    ``jump``, full windows only)."""
    n = len(x)
    half = width // 2
    inds = np.array([t for t in range(0, n, jump) if half <= t < n - half], dtype=int)
    if model == "rbf":
        return inds, RbfCost(x).window_gains(inds, half)
    cost = Cost(x, model)
    gains = np.array([cost.error(t - half, t + half) - cost.error(t - half, t) - cost.error(t, t + half) for t in inds])
    return inds, gains


def window_changepoints(x: np.ndarray, model: str = "rbf", width: int = 50, min_size: int = 30, pen: float = 10.0,
                        jump: int = 5) -> list[int]:
    """Breakpoints (end-exclusive indices) whose gain exceeds ``pen`` and every other candidate
    gain within +/- order candidates, order = max(width, 2 min_size) // (2 jump)."""
    inds, gains = window_scores(x, model, width, jump)
    order = max(max(width, 2 * min_size) // (2 * jump), 1)
    out = []
    for j, (t, g) in enumerate(zip(inds, gains)):
        lo, hi = max(0, j - order), min(len(gains), j + order + 1)
        others = np.r_[gains[lo:j], gains[j + 1:hi]]
        if g > pen and (len(others) == 0 or g > others.max()):
            out.append(int(t))
    return out + [len(x)]
