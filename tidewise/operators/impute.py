"""Gap filling on the grid (IM-1..IM-9).

All fills are window functions over ``partitionBy(sensor).orderBy(bin)``; they share
one exchange on ``sensor`` and one sort. Inputs are grids (bounded per sensor).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewise.functions.columns import by_sensor, BIN, SENSOR, days_between
from tidewise.operators.stacked import run_guarded

_UNB = Window.unboundedPreceding
_UNF = Window.unboundedFollowing


def _w() -> Window:
    return Window.partitionBy(SENSOR).orderBy(BIN)


def _neighbours(df: DataFrame, x: Column) -> DataFrame:
    """Previous/next non-null value and their abscissae (positions or times).

    One ``last(struct(value, x, i), ignorenulls)`` per direction (Spark's window operator is
    interpreted, so fewer window functions is faster). "Next" uses a descending running frame:
    ``UNBOUNDED FOLLOWING`` frames are re-evaluated per row (quadratic), a running frame is linear.
    """
    back = _w().rowsBetween(_UNB, 0)
    fwd = Window.partitionBy(SENSOR).orderBy(F.col(BIN).desc()).rowsBetween(_UNB, 0)
    v = F.col("value")
    d = df.withColumn("_x", x).withColumn("_i", F.row_number().over(_w()))
    rec = F.when(v.isNotNull(), F.struct(v.alias("v"), F.col("_x").alias("x"), F.col("_i").alias("i")))
    d = d.withColumn("_p", F.last(rec, ignorenulls=True).over(back)).withColumn("_n", F.last(rec, ignorenulls=True).over(fwd))
    return d.select(
        "*",
        F.col("_p.v").alias("_pv"), F.col("_p.x").alias("_px"), F.col("_p.i").alias("_pi"),
        F.col("_n.v").alias("_nv"), F.col("_n.x").alias("_nx"), F.col("_n.i").alias("_ni"),
    ).drop("_p", "_n")


def _interp_value(direction: str, limit: int | None) -> Column:
    v, pv, nv = F.col("value"), F.col("_pv"), F.col("_nv")
    inner = pv + (nv - pv) * F.try_divide(F.col("_x") - F.col("_px"), F.col("_nx") - F.col("_px"))
    if direction == "forward":
        filled = F.coalesce(inner, pv)
    elif direction == "backward":
        filled = F.coalesce(inner, nv)
    elif direction == "both":
        filled = F.coalesce(inner, pv, nv)
    else:
        raise ValueError(f"Unknown limit_direction: {direction}")
    if limit is not None:
        near_prev = (F.col("_i") - F.col("_pi")) <= limit
        near_next = (F.col("_ni") - F.col("_i")) <= limit
        ok = {"forward": near_prev, "backward": near_next, "both": near_prev | near_next}[direction]
        filled = F.when(F.coalesce(ok, F.lit(False)), filled)
    return F.when(v.isNotNull(), v).otherwise(filled)


def _finish(df: DataFrame, value: Column) -> DataFrame:
    cols = [c for c in df.columns if not c.startswith("_") and c != "value"]
    return df.select(*cols, value.cast("double").alias("value"))


def interpolate_linear(grid: DataFrame, direction: str = "both", limit: int | None = None) -> DataFrame:
    """IM-1/IM-2: positional linear interpolation.

    direction 'forward' (the resample path): leading NULLs stay, trailing repeat the last value;
    'both' (interpolate_missing default): leading take the first value too.
    ``limit`` fills at most k NULLs counted from each allowed side.
    """
    n = _neighbours(grid, F.row_number().over(_w()).cast("double"))
    return _finish(n, _interp_value(direction, limit))


def _time_number(b: Column) -> Column:
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), b.cast("timestamp_ntz")).cast(
        "double"
    )


def interpolate_time(grid: DataFrame, direction: str = "both", limit: int | None = None) -> DataFrame:
    """IM-3: linear in elapsed time rather than position."""
    n = _neighbours(grid, _time_number(F.col(BIN)))
    return _finish(n, _interp_value(direction, limit))


def interpolate_missing(grid: DataFrame, method: str = "linear", limit: int | None = None,
                        limit_direction: str = "both", order: int = 3) -> DataFrame:
    if method == "linear":
        return interpolate_linear(grid, limit_direction, limit)
    if method == "time":
        return interpolate_time(grid, limit_direction, limit)
    if method == "spline":
        return interpolate_spline(grid, order, True, limit_direction, limit)
    if method == "polynomial":
        return interpolate_spline(grid, order, False, limit_direction, limit)
    raise ValueError(f"Unknown interpolation method: {method}")


def forward_fill(grid: DataFrame, limit: int | None = None) -> DataFrame:
    """IM-6: last non-null within the previous ``limit`` rows (or all previous rows)."""
    lo = _UNB if limit is None else -int(limit)
    val = F.last("value", ignorenulls=True).over(_w().rowsBetween(lo, 0))
    return _finish(grid, val)


def backward_fill(grid: DataFrame, limit: int | None = None) -> DataFrame:
    """IM-7: first non-null within the next ``limit`` rows."""
    if limit is None:
        desc = Window.partitionBy(SENSOR).orderBy(F.col(BIN).desc()).rowsBetween(_UNB, 0)
        return _finish(grid, F.last("value", ignorenulls=True).over(desc))
    val = F.first("value", ignorenulls=True).over(_w().rowsBetween(0, int(limit)))
    return _finish(grid, val)


def seasonal_position(period: int) -> Column:
    """Mon=0 weekday for period 7, else whole days since the sensor's first bin mod period."""
    if period == 7:
        return F.weekday(F.col(BIN))
    first = F.min(BIN).over(Window.partitionBy(SENSOR))
    return F.pmod(days_between(F.col(BIN), first), F.lit(period))


def fill_seasonal_mean(grid: DataFrame, period: int = 7) -> DataFrame:
    """IM-8: NULL -> mean of the sensor's values at the same seasonal position (stays NULL if none)."""
    g = grid.withColumn("_season", seasonal_position(period))
    mean = F.avg("value").over(Window.partitionBy(SENSOR, "_season"))
    return _finish(g, F.coalesce(F.col("value"), mean))


def interpolate_spline(grid: DataFrame, order: int = 3, extrapolate: bool = True,
                       direction: str = "forward", limit: int | None = None, residual_per_point: float = 0.0) -> DataFrame:
    """IM-4/IM-5: spline of any ``order`` >= 1 through the known points, per sensor in a grouped map (the grid is bounded
    per sensor). ``extrapolate`` extends the end polynomials to outer gaps: trailing ones in direction 'forward', leading ones in
    'backward', either in 'both'. ``limit`` fills at most k NULLs counted from each allowed side.

    With ``residual_per_point`` > 0 the smoothest spline whose squared residuals at the known points sum to at most that
    many times their number takes its place (1.0 is the bound of the original); known points keep their values.
    A sensor for which this fails keeps its gaps.
    """
    from tidewise.kernels.spline import spline_fill

    if order < 1:
        raise ValueError(f"Spline order must be at least 1: {order}")
    if direction not in ("forward", "backward", "both"):
        raise ValueError(f"Unknown limit_direction: {direction}")
    cols = grid.columns

    def fill(pdf):
        return spline_fill(pdf, cols, order, extrapolate, direction, limit, residual_per_point)

    return run_guarded(by_sensor(grid), fill, grid.schema, lambda pdf, message: pdf[cols])


def impute_missing(grid: DataFrame, method: str = "linear", limit: int | None = None, **kw) -> DataFrame:
    """IM-9: dispatcher; ``limit`` holds for every method that fills from a neighbour."""
    if method == "none":
        return grid
    if method == "linear":
        return interpolate_linear(grid, "both", limit)
    if method == "spline":
        return interpolate_spline(grid, kw.get("order", 3), True, kw.get("direction", "both"), limit, kw.get("residual_per_point", 0.0))
    if method == "ffill":
        return forward_fill(grid, limit)
    if method == "seasonal":
        return fill_seasonal_mean(grid, kw.get("period", 7))
    raise ValueError(f"Unknown imputation method: {method}")


def missing_report(grid: DataFrame) -> DataFrame:
    """DQ-8: per sensor total, missing, rate, number of gaps, max and mean gap (gaps-and-islands). Runs of NULL and of
    known values are counted alike, so one pass over the grid gives the totals, too."""
    isnull = F.col("value").isNull()
    g = grid.withColumn("_null", isnull).withColumn("_i", F.row_number().over(_w())).withColumn(
        "_j", F.row_number().over(Window.partitionBy(SENSOR, "_null").orderBy(BIN))
    )
    runs = g.groupBy(SENSOR, "_null", (F.col("_i") - F.col("_j")).alias("_island")).agg(F.count(F.lit(1)).alias("_len"))
    gap = F.when(F.col("_null"), F.col("_len"))
    out = runs.groupBy(SENSOR).agg(
        F.sum("_len").alias("total_count"), F.coalesce(F.sum(gap), F.lit(0)).alias("missing_count"),
        F.count(gap).alias("num_gaps"), F.max(gap).alias("max_gap"), F.avg(gap).alias("mean_gap"),
    )
    return out.select(
        SENSOR,
        F.col("total_count").cast("long").alias("total_count"),
        F.col("missing_count").cast("long").alias("missing_count"),
        F.coalesce(F.try_divide(F.col("missing_count"), F.col("total_count")), F.lit(0.0)).alias("missing_rate"),
        F.coalesce(F.col("num_gaps"), F.lit(0)).cast("long").alias("num_gaps"),
        F.coalesce(F.col("max_gap"), F.lit(0)).cast("long").alias("max_gap"),
        F.coalesce(F.col("mean_gap"), F.lit(0.0)).cast("double").alias("mean_gap"),
    )
