"""Harmonic (Fourier) regression detector (DT-6..DT-9).

R^2 of ``y ~ 1 + sin(2 pi t / p) + cos(2 pi t / p)`` in closed form from population
(co)variances; the constant-only baseline has R^2 = 0 so delta R^2 = R^2. Every
period is one set of partial aggregates in a single ``groupBy(sensor)``: no UDF,
no join, map-side combined.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewise.config import DetectionConfig
from tidewise.functions.columns import BIN, SENSOR
from tidewise.operators.detect_common import as_detection, clean, register

TWO_PI = 2.0 * math.pi
EPS = 1e-12


def _sc(t: Column, p: float) -> tuple[Column, Column]:
    ang = F.lit(TWO_PI) * t / F.lit(float(p))
    return F.sin(ang), F.cos(ang)


def r2_sql(vsy: str, vcy: str, vss: str, vcc: str, vsc: str, vyy: str) -> tuple[str, str, str]:
    """SQL text of (r2, b_sin, b_cos) of the two-regressor least squares; degenerate designs
    (sin or cos constant) fall back to the single-term fit."""
    d = f"({vss} * {vcc} - {vsc} * {vsc})"
    r2 = (f"CASE WHEN {vyy} <= 0.0 THEN 0.0 "
          f"WHEN {d} > {EPS!r} THEN ({vsy} * {vsy} * {vcc} - 2.0D * {vsy} * {vcy} * {vsc} + {vcy} * {vcy} * {vss}) / ({d} * {vyy}) "
          f"WHEN {vss} > {EPS!r} THEN {vsy} * {vsy} / ({vss} * {vyy}) "
          f"WHEN {vcc} > {EPS!r} THEN {vcy} * {vcy} / ({vcc} * {vyy}) ELSE 0.0 END")
    bs = f"CASE WHEN {d} > {EPS!r} THEN ({vsy} * {vcc} - {vcy} * {vsc}) / {d} WHEN {vss} > {EPS!r} THEN {vsy} / {vss} ELSE 0.0 END"
    bc = (f"CASE WHEN {d} > {EPS!r} THEN ({vcy} * {vss} - {vsy} * {vsc}) / {d} "
          f"WHEN NOT ({vss} > {EPS!r}) AND {vcc} > {EPS!r} THEN {vcy} / {vcc} ELSE 0.0 END")
    return r2, bs, bc


def r2_from_moments(vsy: Column, vcy: Column, vss: Column, vcc: Column, vsc: Column, vyy: Column):
    """Column form of :func:`r2_sql` for callers holding Columns."""
    d = vss * vcc - vsc * vsc
    full_ok = d > F.lit(EPS)
    r2 = (
        F.when(vyy <= F.lit(0.0), F.lit(0.0))
        .when(full_ok, (vsy * vsy * vcc - F.lit(2.0) * vsy * vcy * vsc + vcy * vcy * vss) / (d * vyy))
        .when(vss > F.lit(EPS), vsy * vsy / (vss * vyy))
        .when(vcc > F.lit(EPS), vcy * vcy / (vcc * vyy))
        .otherwise(F.lit(0.0))
    )
    return r2, None, None


def harmonic_fit(grid: DataFrame, periods=(7, 30, 365), delta_r2_threshold: float = 0.1,
                 time_unit: str = "day") -> DataFrame:
    """Per (sensor, period): r2, delta_r2, sin_coef, cos_coef, score = clip(10 delta_r2, 0, 1)."""
    c = clean(grid, time_unit)
    aggs = [F.expr("var_pop(value) AS vyy"), F.expr("count(value) AS n")]
    for i, p in enumerate(periods):
        ang = f"({TWO_PI!r}D * t / {float(p)!r}D)"
        aggs += [
            F.expr(f"covar_pop(sin({ang}), value) AS vsy{i}"),
            F.expr(f"covar_pop(cos({ang}), value) AS vcy{i}"),
            F.expr(f"var_pop(sin({ang})) AS vss{i}"),
            F.expr(f"var_pop(cos({ang})) AS vcc{i}"),
            F.expr(f"covar_pop(sin({ang}), cos({ang})) AS vsc{i}"),
        ]
    m = c.groupBy(SENSOR).agg(*aggs)
    structs = []
    for i, p in enumerate(periods):
        r2, bs, bc = r2_sql(f"vsy{i}", f"vcy{i}", f"vss{i}", f"vcc{i}", f"vsc{i}", "vyy")
        structs.append(f"named_struct('period', {int(p)}L, 'r2', {r2}, 'sin_coef', {bs}, 'cos_coef', {bc})")
    out = m.select(SENSOR, "vyy", F.expr(f"explode(array({', '.join(structs)})) AS h")).select(SENSOR, "vyy", "h.*")
    return out.select(
        SENSOR,
        F.col("period").cast("long").alias("period"),
        F.col("r2"),
        F.col("r2").alias("delta_r2"),
        F.col("sin_coef"),
        F.col("cos_coef"),
        F.expr("least(greatest(r2 * 10.0D, 0.0D), 1.0D)").alias("score"),
        F.expr(f"r2 > {delta_r2_threshold!r}D").alias("significant"),
        F.expr("CASE WHEN vyy <= 0.0D THEN 'zero_variance' END").alias("error"),
    )


@register("fourier")
def detect_fourier(grid: DataFrame, periods, cfg: DetectionConfig = DetectionConfig()) -> DataFrame:
    return as_detection(harmonic_fit(grid, periods, cfg.fourier_delta_r2_threshold, cfg.time_unit), "fourier")


# --- joint model with all periods (DT-7, DT-8, DT-9) --------------------------------------------


def _design(t: Column, periods) -> list[Column]:
    cols = []
    for p in periods:
        s, c = _sc(t, p)
        cols += [s, c]
    return cols


def joint_moments(grid: DataFrame, periods=(7, 30, 365), time_unit: str = "day") -> DataFrame:
    """Native partial aggregates: means and the full covariance matrix of (x_1..x_2k, y)."""
    c = clean(grid, time_unit)
    xs = _design(F.col("t"), periods)
    y = F.col("value")
    k = len(xs)
    aggs = [F.count(y).alias("n"), F.avg(y).alias("my"), F.var_pop(y).alias("vyy")]
    for i in range(k):
        aggs.append(F.avg(xs[i]).alias(f"m{i}"))
        aggs.append(F.covar_pop(xs[i], y).alias(f"cy{i}"))
        for j in range(i, k):
            aggs.append(F.covar_pop(xs[i], xs[j]).alias(f"c{i}_{j}"))
    return c.groupBy(SENSOR).agg(*aggs)


def joint_fit(grid: DataFrame, periods=(7, 30, 365), time_unit: str = "day") -> DataFrame:
    """DT-7: per sensor r2 and delta_r2 of the model with every period, plus coefficients.

    The moments are native partial aggregates; the (2k x 2k) systems of an Arrow batch of sensors are solved at once by
    their pseudo-inverses, so collinear designs give the minimum-norm fit like the original.
    """
    import numpy as np
    import pandas as pd

    from tidewise.session import ship_package

    k = 2 * len(periods)
    mom = joint_moments(grid, periods, time_unit)
    ship_package(grid.sparkSession)
    coef_fields = ", ".join(f"b{i} double" for i in range(k))
    schema = f"sensor string, n long, r2 double, delta_r2 double, intercept double, {coef_fields}"

    def solve(batches):
        for pdf in batches:
            cxx = np.empty((len(pdf), k, k))
            for i in range(k):
                for j in range(i, k):
                    cxx[:, i, j] = cxx[:, j, i] = pdf[f"c{i}_{j}"]
            cxy = pdf[[f"cy{i}" for i in range(k)]].to_numpy(dtype=float)
            b = np.einsum("sij,sj->si", np.linalg.pinv(cxx, rcond=k * np.finfo(float).eps, hermitian=True), cxy)
            vyy = pdf["vyy"].to_numpy(dtype=float)
            r2 = np.where(vyy > 0, np.einsum("si,si->s", b, cxy) / np.where(vyy > 0, vyy, 1.0), 0.0)
            means = pdf[[f"m{i}" for i in range(k)]].to_numpy(dtype=float)
            out = {"sensor": pdf["sensor"], "n": pdf["n"], "r2": r2, "delta_r2": r2, "intercept": pdf["my"] - np.einsum("si,si->s", b, means)}
            yield pd.DataFrame(out | {f"b{i}": b[:, i] for i in range(k)})

    return mom.mapInPandas(solve, schema=schema)


def fit_and_predict(grid: DataFrame, periods=(7, 30, 365), time_unit: str = "day") -> DataFrame:
    """DT-8: fitted values of the joint model on every non-null grid point, in one scan: sensors with equal points share the
    design, and one least-squares solution (minimum-norm) fits and predicts the whole stack. A sensor that failed has one row with ``error``."""
    import numpy as np
    import pyarrow as pa

    from tidewise.operators.stacked import run_stacks

    ps = [float(p) for p in periods]

    def run(names, t, Y, bins):
        X = np.column_stack([f(TWO_PI * t / p) for p in ps for f in (np.sin, np.cos)])
        X = X - X.mean(axis=0)
        my = Y.mean(axis=1, keepdims=True)
        fitted = (X @ np.linalg.lstsq(X, (Y - my).T, rcond=None)[0]).T + my
        return {"sensor": np.repeat(np.array(names, dtype=object), Y.shape[1]), "bin": pa.concat_arrays(bins),
                "value": Y.ravel(), "fitted": fitted.ravel(), "error": [None] * Y.size}

    return run_stacks(grid, run, f"sensor string, bin {dict(grid.dtypes)[BIN]}, value double, fitted double, error string", time_unit)


def delta_r2_map(grid: DataFrame, periods=(7, 30, 365), time_unit: str = "day") -> DataFrame:
    """DT-9: rows (sensor, key, delta_r2) with keys ``period_p`` and ``full``."""
    per = harmonic_fit(grid, periods, time_unit=time_unit).select(
        SENSOR, F.concat(F.lit("period_"), F.col("period").cast("string")).alias("key"), "delta_r2"
    )
    full = joint_fit(grid, periods, time_unit).select(SENSOR, F.lit("full").alias("key"), "delta_r2")
    return per.unionByName(full)
