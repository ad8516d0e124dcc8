import os
import sys

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidewise.session import get_session

    s = get_session(master="local[4]", shuffle_partitions=8, app="tidewise-tests")
    yield s
    s.stop()


def make_series(spark, values, start="2024-01-01", freq="D", sensor="s1", extra=None):
    """Long readings frame from a list of values (None/NaN -> NULL)."""
    ts = pd.date_range(start, periods=len(values), freq=freq)
    rows = [(sensor, t.to_pydatetime(), None if v is None or (isinstance(v, float) and np.isnan(v)) else float(v))
            for t, v in zip(ts, values)]
    if extra:
        rows += extra
    return spark.createDataFrame(rows, "sensor string, ts timestamp_ntz, value double")


def to_grid(spark, values, start="2024-01-01", sensor="s1"):
    """A daily grid (sensor, bin DATE, value) straight from values."""
    ds = pd.date_range(start, periods=len(values), freq="D")
    rows = [(sensor, d.date(), None if v is None or (isinstance(v, float) and np.isnan(v)) else float(v))
            for d, v in zip(ds, values)]
    return spark.createDataFrame(rows, "sensor string, bin date, value double")


def seasonal_values(n=365, periods=(7, 30), amplitude=10.0, noise=0.1, seed=42, trend=0.01):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    y = 100.0 + trend * t
    for p in periods:
        y = y + amplitude * np.sin(2 * np.pi * t / p)
    return y + rng.normal(0, noise * amplitude, n)


def collect_values(df, order="bin"):
    return [r["value"] for r in df.orderBy(order).collect()]
