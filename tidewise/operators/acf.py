"""Autocorrelation detector (DT-4), full ACF table (DT-5) and PACF (DT-12).

r_k = sum_i (x_i - mu)(x_{i+k} - mu) / sum_i (x_i - mu)^2 (biased, positional after dropping NULLs), for all lags from one
FFT per stack of sensors. The PACF follows from the same lags by Levinson-Durbin.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame

from tidewise.config import DetectionConfig
from tidewise.operators.detect_common import as_detection, register
from tidewise.operators.spectra import kernel_scores
from tidewise.operators.stacked import run_stacks


def acf_detect(grid: DataFrame, periods=(7, 30, 365), cfg: DetectionConfig = DetectionConfig()) -> DataFrame:
    """Per (sensor, period): peak |acf| within p +/- tolerance clipped to [1, max_lag].

    max_lag = min(cfg.acf_max_lag, n // 2 - 1); sensors with max_lag < 10 yield no rows;
    p > max_lag gives score 0 with ``period_exceeds_max_lag``; ties go to the smallest lag.
    """
    return kernel_scores(grid, periods, cfg, ("acf",)).select(
        "sensor", "period", "score", "significant", "error", "peak_value", "actual_lag", "conf_int", "max_lag")


@register("acf", kernel=True)
def detect_acf(grid: DataFrame, periods, cfg: DetectionConfig = DetectionConfig()) -> DataFrame:
    return as_detection(acf_detect(grid, periods, cfg), "acf")


def acf_full(grid: DataFrame, max_lag: int = 400) -> DataFrame:
    """DT-5: ACF for lags 0..min(max_lag, n//2 - 1) with +/-1.96/sqrt(n); a sensor that failed has one row with ``error``."""
    from tidewise.kernels.spectral import acf_stack

    def run(names, t, Y, bins):
        last, ci = min(max_lag, Y.shape[1] // 2 - 1), 1.96 / math.sqrt(Y.shape[1])
        lags = np.arange(last + 1)
        values = acf_stack(Y, last).ravel() if last >= 0 else np.zeros(0)
        rows = len(values)
        return {"sensor": np.repeat(np.array(names, dtype=object), len(lags)), "lag": np.tile(lags, len(names)), "acf": values,
                "conf_int_upper": np.full(rows, ci), "conf_int_lower": np.full(rows, -ci), "error": [None] * rows}

    return run_stacks(grid, run, "sensor string, lag long, acf double, conf_int_upper double, conf_int_lower double, error string")


def pacf(grid: DataFrame, nlags: int = 50) -> DataFrame:
    """DT-12: partial autocorrelations by Levinson-Durbin on the biased ACF (Yule-Walker, 'ywm'), lags 0..min(nlags, n//2 - 1)."""
    from tidewise.kernels.spectral import acf_stack, pacf_stack

    def run(names, t, Y, bins):
        last = min(nlags, Y.shape[1] // 2 - 1)
        lags = np.arange(last + 1)
        values = pacf_stack(acf_stack(Y, last)).ravel() if last >= 0 else np.zeros(0)
        return {"sensor": np.repeat(np.array(names, dtype=object), len(lags)), "lag": np.tile(lags, len(names)), "pacf": values, "error": [None] * len(values)}

    return run_stacks(grid, run, "sensor string, lag long, pacf double, error string")
