"""Outlier flags and replacement on a grid (OU-1..OU-6).

Per-sensor statistics are window aggregates over ``partitionBy(sensor)`` (no join back);
they share the sensor exchange with the fills. Inputs are grids, bounded per sensor, so
the exact percentile buffers are bounded too. Flags are row-level (NULL -> False).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewise.functions.columns import by_sensor, BIN, SENSOR
from tidewise.functions.quantiles import aggregate_with_quantiles
from tidewise.operators.stacked import run_guarded


def _whole() -> Window:
    return Window.partitionBy(SENSOR)


def flag_iqr(grid: DataFrame, k: float = 1.5) -> DataFrame:
    """OU-1: value < Q1 - k IQR or > Q3 + k IQR (linear-interpolated quantiles)."""
    q = F.percentile(F.col("value"), F.array(F.lit(0.25), F.lit(0.75))).over(_whole())
    g = grid.withColumn("_q", q)
    q1, q3 = F.col("_q")[0], F.col("_q")[1]
    iqr = q3 - q1
    flag = (F.col("value") < q1 - k * iqr) | (F.col("value") > q3 + k * iqr)
    return g.withColumn("is_outlier", F.coalesce(flag, F.lit(False))).drop("_q")


def flag_zscore(grid: DataFrame, threshold: float = 3.0) -> DataFrame:
    """OU-2: |value - mean| / population std > threshold; constant sensor -> no flags."""
    z = F.abs(F.try_divide(F.col("value") - F.avg("value").over(_whole()), F.stddev_pop("value").over(_whole())))
    sd = F.stddev_pop("value").over(_whole())
    flag = F.when(sd > 0, z > threshold)
    return grid.withColumn("is_outlier", F.coalesce(flag, F.lit(False)))


def flag_rolling(grid: DataFrame, window: int = 30, threshold: float = 3.0) -> DataFrame:
    """OU-6: centred rolling z-score, min_periods 1, sample std (0 -> no flag).

    Frame rows -w/2 .. w/2-1 for even w, +/-(w-1)/2 for odd w (centred pandas windows).
    """
    lo = -(window // 2)
    hi = window // 2 - 1 if window % 2 == 0 else window // 2
    w = Window.partitionBy(SENSOR).orderBy(BIN).rowsBetween(lo, hi)
    mean = F.avg("value").over(w)
    sd = F.stddev_samp("value").over(w)
    z = F.abs(F.try_divide(F.col("value") - mean, F.when(sd != 0, sd)))
    return grid.withColumn("is_outlier", F.coalesce(z > threshold, F.lit(False)))


def flag_iforest(grid: DataFrame, contamination: float = 0.05, seed: int = 42, n_trees: int = 100,
                 max_samples: int = 256) -> DataFrame:
    """OU-3: 1-D isolation forest per sensor (grouped map); flags the top ``contamination`` share. Each tree
    is grown on ``max_samples`` points (the published default), all points are scored. A sensor for which this fails has no flags."""
    from tidewise.kernels.iforest import iforest_group

    from pyspark.sql import types as T

    cols = list(grid.columns)
    schema = T.StructType(list(grid.schema.fields) + [T.StructField("is_outlier", T.BooleanType())])

    def run(pdf):
        return iforest_group(pdf, cols, contamination, seed, n_trees, max_samples)

    return run_guarded(by_sensor(grid), run, schema, lambda pdf, message: pdf[cols].assign(is_outlier=False))


def detect_outliers(grid: DataFrame, method: str = "iqr", threshold: float | None = None, **kw) -> DataFrame:
    """OU-4: dispatcher; ``threshold`` is k / z / contamination depending on the method."""
    if method == "iqr":
        return flag_iqr(grid, 1.5 if threshold is None else threshold)
    if method == "zscore":
        return flag_zscore(grid, 3.0 if threshold is None else threshold)
    if method == "iforest":
        return flag_iforest(grid, 0.05 if threshold is None else threshold, **kw)
    if method == "rolling":
        return flag_rolling(grid, kw.get("window", 30), 3.0 if threshold is None else threshold)
    raise ValueError(f"Unknown outlier detection method: {method}")


def remove_outliers(grid: DataFrame, method: str = "iqr", threshold: float | None = None, replace_with: str = "nan",
                    buffer_rows: int | None = None, **kw) -> DataFrame:
    """OU-5: flagged values -> NULL, the sensor median (computed with the outliers), or linear fill. A grid is bounded by the
    calendar, so its median is a window; with ``buffer_rows`` (raw readings) it is joined, larger sensors' by selection."""
    from tidewise.operators.impute import interpolate_linear

    f = detect_outliers(grid, method, threshold, **kw)
    cols = grid.columns
    if replace_with == "nan":
        return f.select(*[c for c in cols if c != "value"], F.when(~F.col("is_outlier"), F.col("value")).alias("value"))
    if replace_with == "median":
        med = F.median("value").over(_whole())
        if buffer_rows is not None:
            m = aggregate_with_quantiles(grid, [SENSOR], [], "value", [0.5], buffer_rows).select(SENSOR, F.col("_q")[0].alias("_median"))
            f, med = f.join(m, SENSOR, "left"), F.col("_median")
        return f.select(*[c for c in cols if c != "value"], F.when(F.col("is_outlier"), med).otherwise(F.col("value")).alias("value"))
    if replace_with == "interpolate":
        nulled = f.select(*[c for c in cols if c != "value"], F.when(~F.col("is_outlier"), F.col("value")).alias("value"))
        return interpolate_linear(nulled, direction="forward")
    raise ValueError(f"Unknown replace_with value: {replace_with}")
