"""Synthetic readings (SRC-9, SRC-10) generated by Spark from ``range``: scales to any size.

Values are not bit-equal to numpy's random streams; each sensor's parameters come from a
hash of (sensor, seed) so generation needs no driver-side state and no join.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def seasonal_series(spark: SparkSession, n_days: int = 365, periods=(7, 30), trend: str = "linear",
                    noise_level: float = 0.1, outlier_rate: float = 0.01, missing_rate: float = 0.005,
                    changepoints=(), base_value: float = 100.0, amplitudes=None, seed: int = 42,
                    start: str = "2024-01-01", sensor: str = "sensor_1") -> DataFrame:
    """SRC-9: base + trend + sum amp sin(2 pi t / p) + level shifts + N(0, noise * base) + outliers + missing."""
    amplitudes = amplitudes or [10.0 / (i + 1) for i in range(len(periods))]
    t = F.col("id").cast("double")
    y = F.lit(base_value)
    if trend == "linear":
        y = y + t * (0.1 * base_value / n_days)
    elif trend == "quadratic":
        y = y + (t / n_days) * (t / n_days) * (0.2 * base_value)
    for p, a in zip(periods, amplitudes):
        y = y + F.lit(a) * F.sin(F.lit(2 * math.pi / p) * t)
    for i, cp in enumerate(changepoints):
        y = y + F.when(F.col("id") >= cp, F.lit(0.2 * base_value * (1 if i % 2 == 0 else -1))).otherwise(0.0)
    y = y + F.randn(seed) * (noise_level * base_value)
    u = F.rand(seed + 1)
    y = F.when(u < outlier_rate, y + F.lit(5 * noise_level * base_value) * F.signum(F.randn(seed + 2))).otherwise(y)
    y = F.when(F.rand(seed + 3) < missing_rate, F.lit(None).cast("double")).otherwise(y)
    return spark.range(n_days).select(
        F.lit(sensor).alias("sensor"),
        F.expr(f"CAST(timestamp_ntz'{start} 00:00:00' + make_dt_interval(id, 0, 0, 0) AS TIMESTAMP_NTZ)").alias("ts"),
        y.alias("value"),
    )


def multi_sensor(spark: SparkSession, n_days: int = 730, n_sensors: int = 10, n_seasonal: int | None = None,
                 periods=(7, 30, 365), seed: int = 42, missing_rate: float = 0.02, start: str = "2024-01-01",
                 partitions: int | None = None) -> DataFrame:
    """SRC-10: sensors x days readings; the first ``n_seasonal`` sensors carry periods with a
    per-sensor amplitude and phase from ``xxhash64(sensor, seed)``; the rest are noise.

    Generated as one ``range(n_sensors * n_days)`` (no join), split into ``partitions``."""
    n_seasonal = n_sensors // 2 if n_seasonal is None else n_seasonal
    total = n_sensors * n_days
    df = spark.range(0, total, 1, partitions or spark.sparkContext.defaultParallelism)
    s = (F.col("id") / n_days).cast("long")
    d = F.col("id") % n_days
    name = F.format_string("sensor_%d", s + 1)
    h = F.xxhash64(name, F.lit(seed))
    base = F.lit(50.0) + F.pmod(h, F.lit(100)).cast("double")
    y = base
    for i, p in enumerate(periods):
        amp = (F.pmod(F.shiftright(h, 8 * (i + 1)), F.lit(10)) + 2).cast("double")
        phase = F.pmod(F.shiftright(h, 8 * (i + 4)), F.lit(628)).cast("double") / 100.0
        y = y + F.when(s < n_seasonal, amp * F.sin(F.lit(2 * math.pi / p) * d.cast("double") + phase)).otherwise(0.0)
    y = y + F.randn(seed) * 2.0
    y = F.when(F.rand(seed + 1) < missing_rate, F.lit(None).cast("double")).otherwise(y)
    return df.select(
        name.alias("sensor"),
        F.expr(f"timestamp_ntz'{start} 00:00:00' + make_dt_interval(id % {n_days}, 0, 0, 0)").cast("timestamp_ntz").alias("ts"),
        y.alias("value"),
    )
