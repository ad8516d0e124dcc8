"""Shared detector plumbing: cleaning, the long detection schema and the method registry (DT-15)."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewise.functions.columns import BIN, SENSOR, days_between

DETECTION_COLUMNS = ["sensor", "method", "period", "score", "significant", "error"]

REGISTRY: dict[str, Callable[..., DataFrame]] = {}
_UNITS = {"day": "DAY", "hour": "HOUR"}


def register(name: str, kernel: bool = False):
    """DT-15: a detector is ``fn(grid, periods, cfg) -> DataFrame[DETECTION_COLUMNS]``. The library's ``kernel`` detectors share
    one pass in ``detect_all``; one registered anew under such a name is called as it is."""

    def deco(fn):
        fn.kernel = kernel
        REGISTRY[name] = fn
        return fn

    return deco


def clean(grid: DataFrame, time_unit: str = "day") -> DataFrame:
    """Drop NULLs, then index the remaining points by position (``pos`` 1..n) and by whole days
    since the sensor's first remaining point (``t``); ``n`` is the point count."""
    g = grid.filter(F.col("value").isNotNull())
    return g.select(
        "*",
        F.expr("CAST(row_number() OVER (PARTITION BY sensor ORDER BY bin) AS BIGINT)").alias("pos"),
        F.expr("count(1) OVER (PARTITION BY sensor)").alias("n"),
        F.expr(f"CAST(timestampdiff({_UNITS[time_unit]}, CAST(min(bin) OVER (PARTITION BY sensor) AS TIMESTAMP_NTZ), "
               "CAST(bin AS TIMESTAMP_NTZ)) AS DOUBLE)").alias("t"),
    )


def as_detection(df: DataFrame, method: str) -> DataFrame:
    return df.selectExpr(
        "sensor", f"'{method}' AS method", "CAST(period AS BIGINT) AS period", "CAST(score AS DOUBLE) AS score",
        "CAST(significant AS BOOLEAN) AS significant", "CAST(error AS STRING) AS error",
    )


def periods_rows(df: DataFrame, periods) -> DataFrame:
    """One row per (row of df, period): explode of a literal array, not a join."""
    return df.withColumn("period", F.explode(F.array(*[F.lit(int(p)) for p in periods])))
