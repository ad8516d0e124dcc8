"""Changepoints and segments (CP-1..CP-5) on a grid.

* CP-2 (window, l2 cost) is native: windowed sums of x and x^2 give the split gain
  cost(u,v) - cost(u,t) - cost(t,v) at every candidate t; a changepoint is a candidate whose
  gain exceeds the penalty and every other candidate gain within +/- order candidates.
* CP-1 (PELT) is a numpy kernel per sensor (grouped map over the bounded grid).
* CP-4 segments are inclusive on both ends: a changepoint row closes segment k and opens
  k+1. The segment number is a running count of changepoints (window), no range join needed.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewise.functions.columns import by_sensor, BIN, SENSOR
from tidewise.functions.quantiles import aggregate_with_quantiles
from tidewise.operators.detect_common import clean
from tidewise.operators.stacked import run_guarded

CP_SCHEMA = "sensor string, cp_bin {bt}"


def window_l2_marks(grid: DataFrame, width: int = 50, min_size: int = 30, penalty: float = 10.0,
                    jump: int = 5) -> DataFrame:
    """CP-2 for the l2 cost on every cleaned grid row: ``gain`` at candidates and ``is_cp`` on the
    last point of the left segment. All window expressions over one sensor ordering."""
    half = width // 2
    order = max(max(width, 2 * min_size) // (2 * jump), 1)
    span = order * jump
    c = clean(grid).select(SENSOR, BIN, "value", "pos", "n")
    w = "PARTITION BY sensor ORDER BY pos"
    c = c.select(
        "*",
        F.expr(f"sum(value) OVER ({w} ROWS BETWEEN {half} PRECEDING AND 1 PRECEDING)").alias("_sl"),
        F.expr(f"sum(value * value) OVER ({w} ROWS BETWEEN {half} PRECEDING AND 1 PRECEDING)").alias("_ql"),
        F.expr(f"sum(value) OVER ({w} ROWS BETWEEN CURRENT ROW AND {half - 1} FOLLOWING)").alias("_sr"),
        F.expr(f"sum(value * value) OVER ({w} ROWS BETWEEN CURRENT ROW AND {half - 1} FOLLOWING)").alias("_qr"),
    )
    cand = f"(pos - 1) % {jump} = 0 AND pos - 1 >= {half} AND pos - 1 < n - {half} AND n >= {2 * min_size}"
    gain = (f"CASE WHEN {cand} THEN ((_ql + _qr) - (_sl + _sr) * (_sl + _sr) / {2 * half}) "
            f"- (_ql - _sl * _sl / {half}) - (_qr - _sr * _sr / {half}) END")
    c = c.select(SENSOR, BIN, "value", "pos", "n", F.expr(gain).alias("gain"))
    c = c.select(
        "*",
        F.expr(f"max(gain) OVER ({w} ROWS BETWEEN {span} PRECEDING AND 1 PRECEDING)").alias("_lm"),
        F.expr(f"max(gain) OVER ({w} ROWS BETWEEN 1 FOLLOWING AND {span} FOLLOWING)").alias("_rm"),
    )
    peak = (f"gain > coalesce(_lm, CAST('-inf' AS DOUBLE)) AND gain > coalesce(_rm, CAST('-inf' AS DOUBLE)) "
            f"AND gain > {float(penalty)!r}D")
    c = c.select(SENSOR, BIN, "value", "pos", "gain", F.expr(f"coalesce({peak}, false)").alias("_peak"))
    return c.select(SENSOR, BIN, "value", "pos", "gain",
                    F.expr(f"coalesce(lead(_peak, 1) OVER ({w}), false)").alias("is_cp"))


def changepoints_window_l2(grid: DataFrame, width: int = 50, min_size: int = 30, penalty: float = 10.0,
                           jump: int = 5) -> DataFrame:
    """CP-2 for the l2 cost -> (sensor, cp_bin = last point of the left segment)."""
    return window_l2_marks(grid, width, min_size, penalty, jump).filter("is_cp").select(SENSOR, F.col(BIN).alias("cp_bin"))


def segments_from_marks(marked: DataFrame) -> DataFrame:
    """CP-4 without a join: ``marked`` carries ``is_cp``; segment = 1 + changepoints before the row,
    changepoint rows are emitted twice (closing k, opening k+1)."""
    seg = F.expr("1 + coalesce(sum(CAST(is_cp AS INT)) OVER (PARTITION BY sensor ORDER BY bin "
                 "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    g = marked.withColumn("_seg", seg)
    g = g.withColumn("segment", F.explode(F.expr("CASE WHEN is_cp THEN array(_seg, _seg + 1) ELSE array(_seg) END")))
    return g.drop("is_cp", "_seg").withColumn("segment", F.col("segment").cast("long"))


def changepoints_pelt(grid: DataFrame, model: str = "rbf", min_size: int = 30, penalty: float = 10.0,
                      jump: int = 5, method: str = "pelt", width: int = 50) -> DataFrame:
    """CP-1 (and CP-2 for the non-l2 costs, ``method='window'``) per sensor in a grouped map ->
    (sensor, cp_bin, error); a failure of one sensor becomes an error row."""
    from tidewise.kernels.pelt import pelt, window_changepoints

    c = clean(by_sensor(grid)).select(SENSOR, BIN, "pos", "value")
    bt = dict(grid.dtypes)[BIN]
    schema = f"sensor string, cp_bin {bt}, error string"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        x = pdf["value"].to_numpy(dtype=float)
        name = pdf["sensor"].iloc[0]
        if len(x) < 2 * min_size:
            return pd.DataFrame(columns=["sensor", "cp_bin", "error"])
        if method == "window":
            bk = window_changepoints(x, model, width, min_size, penalty, jump)
        else:
            bk = pelt(x, model, min_size, penalty, jump)
        idx = [i - 1 for i in bk[:-1] if i < len(x)]
        bins = pdf[BIN].to_numpy()[idx]
        return pd.DataFrame({"sensor": name, "cp_bin": bins, "error": None})

    return run_guarded(c, run, schema, lambda pdf, message: pd.DataFrame({"sensor": pdf["sensor"].iloc[:1], "cp_bin": None, "error": message}))


def detect_changepoints(grid: DataFrame, method: str = "pelt", model: str = "rbf", min_size: int = 30,
                        penalty: float = 10.0, width: int = 50) -> DataFrame:
    """CP-3: dispatcher -> (sensor, cp_bin, error); a sensor that failed has an error row without a bin."""
    if method == "pelt":
        return changepoints_pelt(grid, model, min_size, penalty)
    if method == "window":
        if model == "l2":
            return changepoints_window_l2(grid, width, min_size, penalty).withColumn("error", F.lit(None).cast("string"))
        return changepoints_pelt(grid, model, min_size, penalty, method="window", width=width)
    raise ValueError(f"Unknown changepoint method: {method}")


def segments(grid: DataFrame, cps: DataFrame) -> DataFrame:
    """CP-4 for changepoints given as a table: mark them with an equi-join on (sensor, bin)."""
    marks = cps.filter(F.col("cp_bin").isNotNull()).select(SENSOR, F.col("cp_bin").alias(BIN), F.lit(True).alias("is_cp")).distinct()
    g = grid.join(marks, [SENSOR, BIN], "left").withColumn("is_cp", F.coalesce("is_cp", F.lit(False)))
    return segments_from_marks(g)


def segment_statistics(grid: DataFrame, cps: DataFrame | None = None, segmented: DataFrame | None = None,
                       buffer_rows: int | None = None) -> DataFrame:
    """CP-5: per (sensor, segment) start, end, n_points (NULL rows counted), mean, sample std, min, max, median. A grid's segments
    are bounded by the calendar; with ``buffer_rows``, the median of a larger one is selected over several tasks."""
    s = segmented if segmented is not None else segments(grid, cps)
    m = aggregate_with_quantiles(s, [SENSOR, "segment"], [
        F.min(BIN).alias("start"),
        F.max(BIN).alias("end"),
        F.count(F.lit(1)).cast("long").alias("n_points"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    ], "value", [0.5], buffer_rows)
    return m.withColumn("median", F.col("_q")[0]).drop("_q")
