"""Resampling onto a regular grid (RS-1..RS-6).

Raw readings are reduced with a partially aggregated ``groupBy(sensor, bin)``: a
sensor holding a large share of all rows is combined map-side in every task, so
no task ever sees more than one row per (sensor, bin) per input partition. The
calendar is generated per sensor with ``explode(sequence(lo, hi))`` from the
bin-level bounds, and the aggregates are left-joined onto it. After this step a
sensor has at most ``span / freq`` rows, which is what bounds every later window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewise.functions.columns import BIN, SENSOR
from tidewise.functions.quantiles import BUFFER_ROWS, aggregate_with_quantiles

FREQS = ("D", "W", "H", "M")
METHODS = ("mean", "median", "median_approx", "ffill")


def bin_label(ts: Column, freq: str = "D") -> Column:
    """Bin label of a reading: day, week ending Sunday (labelled Sunday), month end, or hour start."""
    freq = freq.upper()
    d = F.to_date(ts)
    if freq == "D":
        return d
    if freq == "W":
        return F.date_add(d, F.lit(6) - F.weekday(d))
    if freq == "M":
        return F.last_day(d)
    if freq == "H":
        return F.window(ts, "1 hour").start.cast("timestamp_ntz")
    raise ValueError(f"Unknown resample frequency: {freq}")


def label_time(b: Column, freq: str) -> Column:
    """The instant a label stands for (used by the as-of fill)."""
    return b.cast("timestamp_ntz") if freq.upper() != "H" else b


def _step(freq: str):
    return {"D": F.expr("INTERVAL 1 DAY"), "W": F.expr("INTERVAL 7 DAYS"), "H": F.expr("INTERVAL 1 HOUR"),
            "M": F.expr("INTERVAL 1 MONTH")}[freq.upper()]


def _next_label(b: Column, freq: str) -> Column:
    freq = freq.upper()
    if freq == "D":
        return F.date_add(b, 1)
    if freq == "W":
        return F.date_add(b, 7)
    if freq == "M":
        return F.last_day(F.add_months(F.trunc(b, "MM"), 1))
    return b + F.expr("INTERVAL 1 HOUR")


def _prev_label(b: Column, freq: str) -> Column:
    freq = freq.upper()
    if freq == "D":
        return F.date_sub(b, 1)
    if freq == "W":
        return F.date_sub(b, 7)
    if freq == "M":
        return F.last_day(F.add_months(F.trunc(b, "MM"), -1))
    return b - F.expr("INTERVAL 1 HOUR")


def labels_between(lo: Column, hi: Column, freq: str) -> Column:
    """Array of bin labels lo..hi inclusive (empty when hi < lo)."""
    freq = freq.upper()
    if freq == "M":
        seq = F.transform(F.sequence(F.trunc(lo, "MM"), F.trunc(hi, "MM"), _step("M")), lambda x: F.last_day(x))
    else:
        seq = F.sequence(lo, hi, _step(freq))
    return F.when(hi >= lo, seq).otherwise(F.slice(F.array(lo), 1, 0))


def calendar(bounds: DataFrame, freq: str = "D") -> DataFrame:
    """``(sensor, lo, hi)`` -> one row per bin label from lo to hi."""
    return bounds.select(SENSOR, F.explode(labels_between(F.col("lo"), F.col("hi"), freq)).alias(BIN))


def _aggregate(readings: DataFrame, freq: str, method: str, buffer_rows: int) -> DataFrame:
    """One row per present bin, with the number of its non-null readings ``_known``."""
    b = bin_label(F.col("ts"), freq)
    binned = readings.withColumn(BIN, b)
    known = F.count("value").alias("_known")
    if method == "median":
        q = aggregate_with_quantiles(binned, [SENSOR, BIN], [known], "value", [0.5], buffer_rows)
        return q.select(SENSOR, BIN, "_known", F.col("_q")[0].alias("value"))
    g = binned.groupBy(SENSOR, BIN)
    if method == "mean":
        return g.agg(known, F.avg("value").alias("value"))
    if method == "median_approx":
        # bounded-memory mergeable sketch: for sensor-bins too hot for an exact per-bin median
        return g.agg(known, F.percentile_approx("value", 0.5, 10000).cast("double").alias("value"))
    if method == "ffill":
        lt = label_time(F.col(BIN), freq)
        rec = F.struct(F.col("ts"), F.col("value"))
        return g.agg(
            known,
            F.max(F.when(F.col("ts") <= lt, rec)).alias("_le"),
            F.max(rec).alias("_all"),
        )
    raise ValueError(f"Unknown resample method: {method}")


def on_calendar(agg: DataFrame, freq: str, payload: list[str], shared_range: bool = False) -> DataFrame:
    """Rows (sensor, bin, payload) of present bins -> one row per bin from each sensor's first to last (``shared_range``: of the
    whole frame), payload NULL in the added ones. One window: a present bin is followed by the empty ones before the next."""
    w = Window.partitionBy(SENSOR).orderBy(BIN)
    g = agg.withColumn("_nxt", F.lead(BIN, 1).over(w))
    stop = F.coalesce(_prev_label(F.col("_nxt"), freq), F.col(BIN))
    start = F.col(BIN)
    if shared_range:
        # One scalar subquery (a struct of both bounds, reused for both uses): Catalyst runs the
        # one-row aggregate once (a pruned, partially aggregated scan) and inlines it.
        bounds = agg.select(F.struct(F.min(BIN).alias("lo"), F.max(BIN).alias("hi"))).scalar()
        is_first = F.row_number().over(w) == 1
        start = F.when(is_first, bounds.getField("lo")).otherwise(F.col(BIN))
        stop = F.when(F.col("_nxt").isNull(), bounds.getField("hi")).otherwise(stop)
    g = g.withColumn("_lab", labels_between(start, stop, freq))
    rec = F.struct(*[F.col(c) for c in payload])
    empty = F.struct(*[F.lit(None).cast(dict(agg.dtypes)[c]).alias(c) for c in payload])
    cells = F.transform("_lab", lambda d: F.struct(d.alias(BIN), F.when(d == F.col(BIN), rec).otherwise(empty).alias("p")))
    return g.select(SENSOR, F.explode(cells).alias("c")).select(SENSOR, F.col(f"c.{BIN}").alias(BIN), "c.p.*")


def resample(
    readings: DataFrame,
    freq: str = "D",
    method: str = "mean",
    shared_range: bool = False,
    min_records: int | None = None,
    buffer_rows: int = BUFFER_ROWS,
) -> DataFrame:
    """RS-1/2/3/4/6: ``(sensor, ts, value)`` -> ``(sensor, bin, value)`` on a regular grid.

    * every bin from the sensor's first to last bin (NULL-valued readings count for the range),
      or the whole frame's range with ``shared_range`` (RS-6);
    * mean / median skip NULL readings, empty bins are NULL;
    * ffill is an as-of join at the label instant: last *reading* (a NULL reading stays NULL)
      with ``ts <= label``. Equal timestamps resolve to the largest value (deterministic);
    * ``min_records`` keeps only sensors with as many non-null readings (DQ-7), by a window over the bin rows:
      no join and no second scan;
    * the median of a bin of more than ``buffer_rows`` readings is selected over several tasks.

    Plan: scan -> partial aggregate -> exchange(sensor, bin) -> final aggregate -> exchange(sensor)
    of the (bounded) bin rows -> one window pass that emits each present bin followed by the
    empty bins up to the next present one (``lead`` + ``explode(sequence)``). No calendar join and
    no second scan of the readings.
    """
    if method not in METHODS:
        raise ValueError(f"Unknown resample_method: {method}")
    freq = freq.upper()
    agg = _aggregate(readings, freq, method, buffer_rows)
    if min_records is not None:
        agg = agg.withColumn("_records", F.sum("_known").over(Window.partitionBy(SENSOR))).filter(F.col("_records") >= min_records).drop("_records")
    agg = agg.drop("_known")
    grid = on_calendar(agg, freq, ["value"] if method != "ffill" else ["_le", "_all"], shared_range)
    if method != "ffill":
        return grid.select(SENSOR, BIN, F.col("value").cast("double").alias("value"))
    w = Window.partitionBy(SENSOR).orderBy(BIN)
    prev = F.last(F.col("_all"), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    val = F.when(F.col("_le").isNotNull(), F.col("_le.value")).otherwise(prev.getField("value"))
    return grid.select(SENSOR, BIN, val.cast("double").alias("value"))


def resample_and_interpolate(
    readings: DataFrame,
    freq: str = "D",
    method: str = "mean",
    interp: str | None = "linear",
    shared_range: bool = False,
    spline_order: int = 3,
) -> DataFrame:
    """RS-5: resample then interpolate (linear default direction / spline / ffill / None)."""
    from tidewise.operators import impute

    grid = resample(readings, freq, method, shared_range)
    if interp is None or interp == "none":
        return grid
    if interp == "linear":
        return impute.interpolate_linear(grid, direction="forward")
    if interp == "ffill":
        return impute.forward_fill(grid)
    if interp == "spline":
        return impute.interpolate_spline(grid, order=spline_order)
    raise ValueError(f"Unknown interp_method: {interp}")
