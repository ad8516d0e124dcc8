"""Property tests: fills and gap reports against pandas on random series with random gaps."""

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import collect_values, to_grid
from tidewise.operators import impute

series = st.lists(st.one_of(st.none(), st.floats(-1e3, 1e3, allow_nan=False)), min_size=3, max_size=40)


def close(a, b):
    return all((x is None and (y is None or np.isnan(y))) or (x is not None and y is not None and abs(x - y) < 1e-9)
               for x, y in zip(a, b))


@settings(max_examples=8, deadline=None, derandomize=True)
@given(series)
def test_linear_matches_pandas(spark, vals):
    s = pd.Series([np.nan if v is None else v for v in vals], dtype=float)
    g = to_grid(spark, vals)
    assert close(collect_values(impute.interpolate_linear(g, "both")), list(s.interpolate("linear", limit_direction="both")))
    assert close(collect_values(impute.interpolate_linear(g, "forward")), list(s.interpolate("linear")))


@settings(max_examples=6, deadline=None, derandomize=True)
@given(series, st.integers(1, 3))
def test_limits_match_pandas(spark, vals, k):
    s = pd.Series([np.nan if v is None else v for v in vals], dtype=float)
    g = to_grid(spark, vals)
    assert close(collect_values(impute.forward_fill(g, k)), list(s.ffill(limit=k)))
    assert close(collect_values(impute.backward_fill(g, k)), list(s.bfill(limit=k)))
    assert close(collect_values(impute.interpolate_linear(g, "both", k)),
                 list(s.interpolate("linear", limit=k, limit_direction="both")))


@settings(max_examples=6, deadline=None, derandomize=True)
@given(series)
def test_gap_report_matches_loop(spark, vals):
    r = impute.missing_report(to_grid(spark, vals)).collect()[0]
    gaps, run = [], 0
    for v in vals:
        if v is None:
            run += 1
        elif run:
            gaps.append(run)
            run = 0
    if run:
        gaps.append(run)
    assert (r["missing_count"], r["num_gaps"], r["max_gap"]) == (sum(gaps), len(gaps), max(gaps) if gaps else 0)


readings_st = st.lists(st.tuples(st.integers(0, 10 * 24 * 60), st.one_of(st.none(), st.floats(-100, 100, allow_nan=False))),
                       min_size=1, max_size=30, unique_by=lambda x: x[0])


def _frame(spark, rows):
    base = pd.Timestamp("2024-01-01")
    ts = [base + pd.Timedelta(minutes=m) for m, _ in rows]
    df = spark.createDataFrame([("a", t.to_pydatetime(), v) for t, (_, v) in zip(ts, rows)],
                               "sensor string, ts timestamp_ntz, value double")
    s = pd.Series([np.nan if v is None else v for _, v in rows], index=pd.DatetimeIndex(ts), dtype=float).sort_index()
    return df, s


@settings(max_examples=6, deadline=None, derandomize=True)
@given(readings_st)
def test_daily_mean_and_ffill_match_pandas(spark, rows):
    from tidewise.operators import resample
    df, s = _frame(spark, rows)
    mean = resample.resample(df, "D", "mean").orderBy("bin").collect()
    exp = s.resample("D").mean()
    assert [str(r["bin"]) for r in mean] == [str(d.date()) for d in exp.index]
    assert close([r["value"] for r in mean], list(exp))
    ff = [r["value"] for r in resample.resample(df, "D", "ffill").orderBy("bin").collect()]
    assert close(ff, list(s.resample("D").ffill()))


@settings(max_examples=4, deadline=None, derandomize=True)
@given(readings_st.filter(lambda r: len(r) >= 2))
def test_weekly_and_monthly_match_pandas(spark, rows):
    from tidewise.operators import resample
    df, s = _frame(spark, [(m * 6, v) for m, v in rows])  # spread over ~60 days
    for freq, pfreq in (("W", "W"), ("M", "ME")):
        got = resample.resample(df, freq, "mean").orderBy("bin").collect()
        exp = s.resample(pfreq).mean()
        assert [str(r["bin"]) for r in got] == [str(d.date()) for d in exp.index]
        assert close([r["value"] for r in got], list(exp))


@settings(max_examples=5, deadline=None, derandomize=True)
@given(series, st.integers(2, 9))
def test_rolling_zscore_matches_pandas(spark, vals, w):
    from tidewise.operators import outliers
    s = pd.Series([np.nan if v is None else v for v in vals], dtype=float)
    mean = s.rolling(w, center=True, min_periods=1).mean()
    sd = s.rolling(w, center=True, min_periods=1).std().replace(0, np.nan)
    exp = list(((s - mean) / sd).abs() > 1.0)
    got = [r["is_outlier"] for r in outliers.flag_rolling(to_grid(spark, vals), w, 1.0).orderBy("bin").collect()]
    assert got == exp


@settings(max_examples=4, deadline=None, derandomize=True)
@given(st.lists(st.one_of(st.none(), st.floats(-50, 50, allow_nan=False)), min_size=12, max_size=60), st.sampled_from([3, 7, 11]))
def test_harmonic_matches_lstsq_with_gaps(spark, vals, p):
    from tidewise.operators import harmonic
    y = np.array([np.nan if v is None else v for v in vals])
    keep = ~np.isnan(y)
    if keep.sum() < 4 or np.nanvar(y) < 1e-6:
        return
    t = np.flatnonzero(keep).astype(float)
    t = t - t[0]
    yy = y[keep]
    X = np.column_stack([np.ones_like(t), np.sin(2 * np.pi * t / p), np.cos(2 * np.pi * t / p)])
    b, *_ = np.linalg.lstsq(X, yy, rcond=None)
    r2 = 1 - np.sum((yy - X @ b) ** 2) / np.sum((yy - yy.mean()) ** 2)
    got = harmonic.harmonic_fit(to_grid(spark, vals), (p,)).collect()[0]
    assert abs(got["r2"] - r2) < 1e-8


@settings(max_examples=4, deadline=None, derandomize=True)
@given(st.lists(st.one_of(st.none(), st.floats(-50, 50, allow_nan=False)), min_size=24, max_size=80))
def test_acf_detect_matches_numpy(spark, vals):
    from tidewise.operators import acf
    y = np.array([v for v in vals if v is not None], dtype=float)
    n = len(y)
    max_lag = min(400, n // 2 - 1)
    rows = {r["period"]: r for r in acf.acf_detect(to_grid(spark, vals), (7, 30)).collect()}
    if max_lag < 10 or np.var(y) == 0:
        return
    d = y - y.mean()
    ac = np.array([np.sum(d[: n - k] * d[k:]) for k in range(max_lag + 1)]) / np.sum(d * d)
    for p in (7, 30):
        r = rows[p]
        if p > max_lag:
            assert r["score"] == 0.0 and r["error"] == "period_exceeds_max_lag"
            continue
        lags = range(max(1, p - 3), min(max_lag, p + 3) + 1)
        best = max(lags, key=lambda k: (abs(ac[k]), -k))
        assert r["actual_lag"] == best and abs(r["score"] - abs(ac[best])) < 1e-10


@settings(max_examples=4, deadline=None, derandomize=True)
@given(series, st.sampled_from([7, 30]))
def test_seasonal_fill_matches_python(spark, vals, p):
    from tidewise.operators import impute
    days = pd.date_range("2024-01-01", periods=len(vals), freq="D")
    pos = [d.dayofweek for d in days] if p == 7 else [i % p for i in range(len(vals))]
    means = {}
    for k in set(pos):
        xs = [v for v, q in zip(vals, pos) if q == k and v is not None]
        means[k] = sum(xs) / len(xs) if xs else None
    exp = [v if v is not None else means[q] for v, q in zip(vals, pos)]
    got = collect_values(impute.fill_seasonal_mean(to_grid(spark, vals), p))
    assert all((a is None and b is None) or (a is not None and b is not None and abs(a - b) < 1e-9) for a, b in zip(got, exp))


@settings(max_examples=4, deadline=None, derandomize=True)
@given(st.lists(st.floats(-100, 100, allow_nan=False), min_size=5, max_size=40))
def test_describe_matches_pandas(spark, vals):
    from tidewise.operators import quality
    s = pd.Series(vals, dtype=float)
    if s.std() < 1e-6:
        return
    r = quality.describe(to_grid(spark, vals)).collect()[0]
    exp = {"count": s.count(), "mean": s.mean(), "std": s.std(), "min": s.min(), "q25": s.quantile(0.25),
           "median": s.median(), "q75": s.quantile(0.75), "max": s.max(), "skewness": s.skew(), "kurtosis": s.kurt()}
    for k, v in exp.items():
        assert abs(r[k] - v) <= 1e-7 * max(1.0, abs(v)), k
