"""One pass of the per-sensor kernels: STL strength, autocorrelation and Lomb-Scargle peaks of a stack of sensors together.

``kernel_scores`` gives one row per (sensor, method, period) with the columns of every method's detail table, so
``detect_all`` reads the grid once for all three, and each detector by itself takes the same way.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewise.config import DetectionConfig
from tidewise.functions.columns import lgamma_sql
from tidewise.operators.stacked import run_stacks

KERNEL_METHODS = ("stl", "acf", "periodogram")

SCORES = (
    "sensor string, method string, period long, score double, significant boolean, error string, "
    "f_season double, var_seasonal double, var_residual double, trend_strength double, "  # stl
    "peak_value double, actual_lag long, conf_int double, max_lag long, "  # acf
    "n long, span double, var_t double, power double, actual_period double"  # periodogram
)
_FIELDS = [c.split()[0] for c in SCORES.split(", ")]


def frequency_grid(span: float, cfg: DetectionConfig) -> tuple[float, float, int]:
    """(first frequency, step, number) of the automatic grid for a span of whole days > 0."""
    fmin = 1.0 / cfg.periodogram_max_period
    df = 1.0 / (float(cfg.periodogram_samples_per_peak) * span)
    return fmin, df, int(np.rint((1.0 / cfg.periodogram_min_period - fmin) / df)) + 1


def _stl_rows(names, t, Y, periods, cfg):
    from tidewise.kernels.stl import stl_stack, strengths

    for p in periods:
        if Y.shape[1] < 2 * p:
            yield from ({"sensor": s, "method": "stl", "period": p, "score": 0.0, "significant": False, "error": "insufficient_data"} for s in names)
            continue
        r = stl_stack(Y, p, seasonal=cfg.stl_seasonal, robust=cfg.stl_robust)
        f, score = strengths(r["seasonal"], r["resid"])
        _, trend = strengths(r["trend"], r["resid"])
        vs, vr = np.var(r["seasonal"], axis=1), np.var(r["resid"], axis=1)
        for i, s in enumerate(names):
            yield {"sensor": s, "method": "stl", "period": p, "score": score[i], "significant": bool(score[i] > cfg.stl_strength_threshold),
                   "f_season": f[i], "var_seasonal": vs[i], "var_residual": vr[i], "trend_strength": trend[i]}


def _acf_rows(names, t, Y, periods, cfg):
    """Per period the largest |acf| within p +/- tolerance, clipped to [1, max_lag], the smallest lag on ties; no rows
    where max_lag = min(cfg.acf_max_lag, n // 2 - 1) < 10."""
    from tidewise.kernels.spectral import acf_stack

    n = Y.shape[1]
    max_lag = min(cfg.acf_max_lag, n // 2 - 1)
    if max_lag < 10:
        return
    R = acf_stack(Y, max_lag)
    conf = 1.96 / math.sqrt(n)
    for p in periods:
        lags = np.arange(max(1, p - cfg.acf_tolerance), min(max_lag, p + cfg.acf_tolerance) + 1)
        for s, r in zip(names, R):
            row = {"sensor": s, "method": "acf", "period": p, "score": 0.0, "significant": False, "conf_int": conf, "max_lag": max_lag}
            flat = not np.isfinite(r[0])
            if p > max_lag:
                row["error"] = "period_exceeds_max_lag"
            elif flat:
                row |= {"error": "zero_variance", "actual_lag": int(lags[0])}
            else:
                lag = int(lags[np.argmax(np.abs(r[lags]))])
                peak = float(r[lag])
                row |= {"score": abs(peak), "peak_value": peak, "actual_lag": lag,
                        "significant": abs(peak) > conf and abs(peak) > cfg.acf_peak_threshold}
            yield row


def _periodogram_rows(names, t, Y, periods, cfg):
    """Per period the highest power among the frequencies whose period lies strictly inside (0.8 p, 1.2 p)."""
    from tidewise.kernels.spectral import periodogram_stack

    n, span, var_t = len(t), float(t.max()), float(np.var(t))
    base = {"method": "periodogram", "n": n, "span": span, "var_t": var_t}
    if span > 0:
        fmin, df, nf = frequency_grid(span, cfg)
        power, per = periodogram_stack(t, Y, fmin, df, nf), 1.0 / (fmin + np.arange(nf) * df)
    for p in periods:
        band = np.flatnonzero((per > p * 0.8) & (per < p * 1.2)) if span > 0 else []
        for i, s in enumerate(names):
            row = base | {"sensor": s, "period": p}
            if len(band):
                j = band[int(np.argmax(power[i, band]))]
                row |= {"power": float(power[i, j]), "actual_period": float(per[j])}
            yield row


_ROWS = {"stl": _stl_rows, "acf": _acf_rows, "periodogram": _periodogram_rows}


def fap_baluev_sql(z: str = "power", n: str = "n", span: str = "span", var_t: str = "var_t") -> str:
    """SQL text of the Baluev (2008) false-alarm probability for standard-normalised power.

    f_max is the automatic limit of the original call (samples_per_peak 5, nyquist_factor 5)."""
    nd = f"CAST({n} AS DOUBLE)"
    nh, nk = f"({nd} - 1.0D)", f"({nd} - 3.0D)"
    df5 = f"(1.0D / (5.0D * {span}))"
    fmin5 = f"(0.5D * {df5})"
    fmax_raw = f"(2.5D * {nd} / {span})"
    nf5 = f"(rint(({fmax_raw} - {fmin5}) / {df5}) + 1.0D)"
    fmax = f"({fmin5} + {df5} * ({nf5} - 1.0D))"
    w = f"({fmax} * sqrt({4.0 * math.pi!r}D * {var_t}))"
    gamma = f"(sqrt(2.0D / {nh}) * exp({lgamma_sql(f'{nh} / 2.0D')} - {lgamma_sql(f'({nh} - 1.0D) / 2.0D')}))"
    om = f"greatest(1.0D - {z}, 0.0D)"
    tau = f"({gamma} * {w} * power({om}, ({nk} - 1.0D) / 2.0D) * sqrt({nh} * {z} / 2.0D))"
    return f"(1.0D - (1.0D - power({om}, {nk} / 2.0D)) * exp(-{tau}))"


def kernel_scores(grid: DataFrame, periods, cfg: DetectionConfig = DetectionConfig(), methods=KERNEL_METHODS) -> DataFrame:
    """One row per (sensor, method, period) with the columns of ``SCORES`` and ``fap``. The methods fail apart: one that
    fails for a sensor gives an error row for each period, the others keep theirs.

    Periodogram: score = min(power, 1), significant when the FAP (a native expression) is below the threshold; an empty band
    gives score 0 with ``period_out_of_range``."""
    wanted, ps = [m for m in KERNEL_METHODS if m in methods], [int(p) for p in periods]

    def run(names, t, Y, bins):
        rows: list[dict] = []
        for m in wanted:
            try:
                rows += _ROWS[m](names, t, Y, ps, cfg)
            except Exception:  # noqa: BLE001
                for i, s in enumerate(names):  # find the sensor that failed
                    try:
                        rows += _ROWS[m]([s], t, Y[i:i + 1], ps, cfg)
                    except Exception as e:  # noqa: BLE001
                        rows += [{"sensor": s, "method": m, "period": p, "score": 0.0, "significant": False, "error": str(e) or type(e).__name__} for p in ps]
        return {f: [r.get(f) for r in rows] for f in _FIELDS}

    k = run_stacks(grid, run, SCORES, cfg.time_unit)
    spectral, has = F.col("method") == "periodogram", F.col("power").isNotNull()
    fap = F.when(has, F.expr(fap_baluev_sql()))
    k = k.withColumn("fap", fap)
    return k.withColumns({
        "score": F.when(spectral & has, F.least(F.col("power"), F.lit(1.0))).otherwise(F.coalesce("score", F.lit(0.0))),
        "significant": F.when(spectral & has, F.col("fap") < cfg.fap_threshold).otherwise(F.coalesce("significant", F.lit(False))),
        "error": F.when(spectral & ~has & F.col("error").isNull(), F.lit("period_out_of_range")).otherwise(F.col("error")),
    })
