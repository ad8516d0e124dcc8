"""STL seasonal / trend strength (DT-1, DT-2) and components (DT-3).

The decomposition is iterative LOESS, which has no DataFrame form: it runs in numpy on stacks of sensors with equal
points (``operators.stacked``), all requested periods in one call. A failure of one sensor becomes an ``error`` row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewise.config import DetectionConfig
from tidewise.functions.columns import BIN
from tidewise.operators.acf import pacf  # noqa: F401  (DT-12 lived here)
from tidewise.operators.detect_common import as_detection, register
from tidewise.operators.spectra import kernel_scores
from tidewise.operators.stacked import run_stacks


def stl_strength(grid: DataFrame, periods=(7, 30, 365), cfg: DetectionConfig = DetectionConfig()) -> DataFrame:
    """Per (sensor, period): F = var(seasonal)/var(resid), score = F/(F+1), trend strength; ``insufficient_data`` with
    fewer points than two periods."""
    return kernel_scores(grid, periods, cfg, ("stl",)).select(
        "sensor", "period", "score", "significant", "error", "f_season", "var_seasonal", "var_residual", "trend_strength")


@register("stl", kernel=True)
def detect_stl(grid: DataFrame, periods, cfg: DetectionConfig = DetectionConfig()) -> DataFrame:
    return as_detection(stl_strength(grid, periods, cfg), "stl")


def stl_components(grid: DataFrame, period: int = 7, cfg: DetectionConfig = DetectionConfig(), long_period: int | None = None) -> DataFrame:
    """DT-3: one row per non-null point with trend, seasonal, residual (none when n < 2 period). With ``long_period``, a
    sensor of at least twice as many points is decomposed by that one instead. A sensor that failed has one row with ``error``."""
    from tidewise.kernels.stl import stl_stack

    def run(names, t, Y, bins):
        p = long_period if long_period and Y.shape[1] >= 2 * long_period else period
        if Y.shape[1] < 2 * p:
            return {c: [] for c in ("sensor", "period", "bin", "observed", "trend", "seasonal", "residual", "error")}
        r = stl_stack(Y, p, seasonal=cfg.stl_seasonal, robust=cfg.stl_robust)
        return {"sensor": np.repeat(np.array(names, dtype=object), Y.shape[1]), "period": np.full(Y.size, p), "bin": pa.concat_arrays(bins),
                "observed": Y.ravel(), "trend": r["trend"].ravel(), "seasonal": r["seasonal"].ravel(), "residual": r["resid"].ravel(),
                "error": [None] * Y.size}

    schema = f"sensor string, period long, bin {dict(grid.dtypes)[BIN]}, observed double, trend double, seasonal double, residual double, error string"
    return run_stacks(grid, run, schema)
