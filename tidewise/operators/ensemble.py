"""Ensemble over detectors (DT-13), batch over sensors (DT-14), accessors (DT-16).

Every method produces rows ``(sensor, method, period, score, significant, error)``; the
union is combined with one ``groupBy(sensor, period)``: combined(p) = sum of scores over the
methods run / number of methods (a missing row counts as 0, so a failed method only lowers
the mean). Sensors with fewer than ``min_points`` non-null grid points are skipped before any
detector runs (``left_semi``), so the expensive kernels only see eligible sensors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewise.config import DetectionConfig
from tidewise.functions.columns import SENSOR, by_sensor
from tidewise.operators import acf, harmonic, periodogram, stl  # noqa: F401  (registers detectors)
from tidewise.operators.detect_common import DETECTION_COLUMNS, REGISTRY
from tidewise.operators.spectra import KERNEL_METHODS, kernel_scores


def eligible(grid: DataFrame, min_points: int = 100) -> tuple[DataFrame, DataFrame]:
    """DT-14 gate: (grid of sensors with >= min_points non-null points, skipped sensors with counts).

    The gate is a window count on the sensor partitioning the grid already has, so the grid
    plan is not duplicated by a semi-join and no extra shuffle is added.
    """
    n = F.count("value").over(Window.partitionBy(SENSOR))
    ok = grid.withColumn("_n_points", n).filter(F.col("_n_points") >= min_points).drop("_n_points")
    counts = grid.groupBy(SENSOR).agg(F.count("value").alias("n_points"))
    skipped = counts.filter(F.col("n_points") < min_points)
    return ok, skipped


def detect_all(grid: DataFrame, cfg: DetectionConfig = DetectionConfig(), methods=None, gate: bool = True) -> DataFrame:
    """Long detection table for every method in ``methods`` (default: cfg.methods)."""
    methods = list(methods or cfg.methods)
    # One sensor exchange for every detector: the windows of the native detectors and the
    # kernels' own (identical) repartition reuse it.
    g = by_sensor(grid)
    g = eligible(g, cfg.min_points)[0] if gate else g
    kernels = [m for m in methods if m in KERNEL_METHODS and getattr(REGISTRY[m], "kernel", False)]
    parts = [REGISTRY[m](g, cfg.periods, cfg) for m in methods if m not in kernels]
    if kernels:  # one Python pass for all of them
        parts.append(kernel_scores(g, cfg.periods, cfg, kernels).select(*DETECTION_COLUMNS))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def wide_scores(detections: DataFrame, periods, methods) -> DataFrame:
    """One row per sensor with ``{m}_{p}`` scores (absent -> 0): a single pivot with an
    explicit key list, so the detections are read once and the schema is fixed."""
    keys = [f"{m}_{p}" for m in methods for p in periods]
    wide = (
        detections.withColumn("key", F.concat_ws("_", "method", F.col("period").cast("string")))
        .groupBy(SENSOR)
        .pivot("key", keys)
        .agg(F.first("score"))
    )
    return wide.select(SENSOR, *[F.coalesce(F.col(k), F.lit(0.0)).alias(k) for k in keys])


def combined_columns(periods, methods) -> list:
    """combined_{p} = sum over methods of {m}_{p} / number of methods (absent counted as 0)."""
    n = float(len(methods))
    out = []
    for p in periods:
        tot = F.lit(0.0)
        for m in methods:
            tot = tot + F.col(f"{m}_{p}")
        out.append((tot / n).alias(f"combined_{p}"))
    return out


def best_period_columns(periods) -> list:
    """Highest combined score and its period, first in the requested order on ties."""
    best = F.struct(*[F.lit(None).cast("double").alias("s"), F.lit(None).cast("long").alias("p")])
    for p in periods:
        c = F.col(f"combined_{p}")
        best = F.when(best["s"].isNull() | (c > best["s"]), F.struct(c.alias("s"), F.lit(int(p)).cast("long").alias("p"))).otherwise(best)
    return [best["p"].alias("best_period"), best["s"].alias("max_combined_score")]


def combine(detections: DataFrame, periods, methods) -> DataFrame:
    """Per (sensor, period): combined score = sum of scores over the methods run / number of
    methods (a missing row counts as 0), plus the sensor's best period and its score."""
    w = wide_scores(detections, periods, methods).select(SENSOR, *combined_columns(periods, methods))
    w = w.select("*", *best_period_columns(periods))
    rows = F.explode(F.array(*[F.struct(F.lit(int(p)).cast("long").alias("period"), F.col(f"combined_{p}").alias("combined_score"))
                               for p in periods])).alias("x")
    return w.select(SENSOR, rows, "best_period", "max_combined_score").select(
        SENSOR, "x.period", "x.combined_score", "best_period", "max_combined_score")


def get_score(detections: DataFrame, method: str, period: int) -> DataFrame:
    """DT-16: score / significance of one (method, period) per sensor, default 0.0 / False."""
    one = (F.col("method") == method) & (F.col("period") == period)
    return detections.groupBy(SENSOR).agg(
        F.coalesce(F.max(F.when(one, F.col("score"))), F.lit(0.0)).alias("score"),
        F.coalesce(F.max(F.when(one, F.col("significant"))), F.lit(False)).alias("significant"))


def _sorted(entries):
    """Map entries (k, v) by key; the values may hold maps, which have no order."""
    return F.array_sort(entries, lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0))


def result_json(detections: DataFrame, periods, methods) -> DataFrame:
    """DT-16: each sensor's whole result as one JSON text: best period and its score, combined scores, and per method its
    best period and score and every period's score, significance and error (a missing one is left out)."""
    per_period = F.struct("score", "significant", "error")
    by_method = detections.groupBy(SENSOR, "method").agg(
        F.map_from_entries(_sorted(F.collect_list(F.struct(F.col("period").cast("string").alias("k"), per_period.alias("v"))))).alias("periods"),
        F.max(F.struct("score", (-F.col("period")).alias("p"))).alias("best"))
    result = F.struct("method", F.col("best.score").alias("max_score"), (-F.col("best.p")).alias("best_period"), "periods")
    results = by_method.groupBy(SENSOR).agg(
        F.map_from_entries(_sorted(F.collect_list(F.struct(F.col("method").alias("k"), result.alias("v"))))).alias("method_results"))
    w = wide_scores(detections, periods, methods).select(SENSOR, *combined_columns(periods, methods))
    w = w.select("*", *best_period_columns(periods))
    combined = F.map_from_arrays(F.array(*[F.lit(str(p)) for p in periods]), F.array(*[f"combined_{p}" for p in periods])).alias("combined_scores")
    return w.join(results, SENSOR).select(SENSOR, F.to_json(F.struct(SENSOR, "best_period", "max_combined_score", combined, "method_results")).alias("json"))
