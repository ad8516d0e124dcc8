"""Tables behind the report figures (RP-1..RP-8); drawing is not part of the engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewise.functions.columns import BIN, SENSOR
from tidewise.operators.scoring import top_sensors

# fixed values: the report's priority column order
PRIORITY_COLUMNS = [
    "rank", "composite_score", "confidence_strict", "confidence_exploratory",
    "stl_max", "acf_max", "fourier_max", "periodogram_max", "best_period",
]


def overview_series(filled: DataFrame, scores: DataFrame) -> DataFrame:
    """RP-1: resampled + interpolated series with label and composite attached (left join)."""
    s = scores.select(SENSOR, "confidence_strict", "composite_score")
    return filled.join(s, SENSOR, "left")


def heatmap(scores: DataFrame, methods, periods, n: int = 20) -> DataFrame:
    """RP-4: top-n sensors by composite x (method, period) score matrix."""
    cols = [f"{m}_{p}" for m in methods for p in periods]
    return top_sensors(scores, n=n, min_confidence="None").select(SENSOR, "composite_score", *cols)


def residual_histogram(components: DataFrame, bins: int = 50) -> DataFrame:
    """RP-5: per (sensor, period) equal-width histogram of STL residuals; the maximum lands in
    the last bin (``width_bucket`` puts it in bins+1)."""
    from pyspark.sql import Window

    w = Window.partitionBy(SENSOR, "period")
    lo, hi = F.min("residual").over(w), F.max("residual").over(w)
    b = F.when(hi > lo, F.least(F.width_bucket(F.col("residual"), lo, hi, F.lit(bins)), F.lit(bins))).otherwise(F.lit(1))
    return components.withColumn("bucket", b.cast("long")).groupBy(SENSOR, "period", "bucket").agg(
        F.count(F.lit(1)).cast("long").alias("count"), F.min("residual").alias("lo"), F.max("residual").alias("hi")
    )


def report_table(ranking: DataFrame, max_rows: int = 100, max_columns: int = 15) -> DataFrame:
    """RP-7: priority columns first, then the rest up to ``max_columns``, first ``max_rows`` by rank."""
    cols = [c for c in PRIORITY_COLUMNS if c in ranking.columns]
    for c in ranking.columns:
        if c not in cols and c != SENSOR and len(cols) < max_columns:
            cols.append(c)
    return ranking.orderBy("rank").limit(max_rows).select(SENSOR, *cols)


def summary_cards(scores: DataFrame) -> DataFrame:
    """RP-8: one row: total, H/M/L per mode, max and mean composite."""
    aggs = [F.count(F.lit(1)).cast("long").alias("total_sensors")]
    for mode in ("strict", "exploratory"):
        for lab in ("High", "Medium", "Low"):
            aggs.append(F.count_if(F.col(f"confidence_{mode}") == lab).cast("long").alias(f"{mode}_{lab.lower()}"))
    aggs += [F.max("composite_score").alias("max_composite"), F.avg("composite_score").alias("mean_composite")]
    return scores.agg(*aggs)


#: lags of the detail ACF and PACF, and the periods that the two periodogram slices show: fixed values
DETAIL_LAGS, DETAIL_PACF_LAGS, MIN_DETAIL_LAGS = 200, 50, 10
SLICE_PERIODS = (100, 400)


def detail_tables(grid: DataFrame, scores: DataFrame, periods=(7, 30, 365), n: int = 5, min_points: int = 100) -> dict:
    """RP-2: per-sensor detail tables for the top-n sensors by composite (>= min_points points): STL components (2nd requested
    period where there are two of them, else the 1st), ACF to 200 lags and PACF to 50 (sensors with more than 10 lags), joint-model
    fit, and the periodogram up to a period of 100. Sensors are selected by a semi-join with the n-row top list, which Spark broadcasts
    only where it measures it as small, and by a window, so each table reads the grid once."""
    from tidewise.operators import acf, harmonic, periodogram, stl
    from tidewise.operators.ensemble import eligible

    top = top_sensors(scores, n=n, min_confidence="None").select(SENSOR)
    g = eligible(grid.join(top, SENSOR, "left_semi"), min_points)[0]
    lags = eligible(g, 2 * (MIN_DETAIL_LAGS + 2))[0]  # n // 2 - 1 > 10
    p1 = int(periods[0])
    p2 = int(periods[1]) if len(periods) > 1 else p1
    return {
        "components": stl.stl_components(g, p1, long_period=p2),
        "acf": acf.acf_full(lags, DETAIL_LAGS),
        "fit": harmonic.fit_and_predict(g, periods),
        "periodogram": periodogram.periodogram_full(g, max_period=SLICE_PERIODS[0]),
        "pacf": acf.pacf(lags, DETAIL_PACF_LAGS),
    }
