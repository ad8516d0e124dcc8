"""Data-quality operators (DQ-1..DQ-7, DQ-9..DQ-11) over long readings ``(sensor, ts, value)``.

A record is one reading row; the missing rate is NULL readings / readings (for a long
frame unpivoted from a wide file this is missing cells / (rows x sensors)). All of it is
partial aggregation; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewise.functions.columns import BIN, SENSOR
from tidewise.functions.quantiles import aggregate_with_quantiles
from tidewise.operators.resample import on_calendar

# fixed values: texts and formats of the original health report, warnings and checks
REPORT_TITLE = "=== Data Health Report ==="
WARN_NO_RECORDS = "No records in data"
WARN_HIGH_MISSING = "High missing rate: %.1f%%"
WARN_ALL_MISSING = "Sensors with all missing values: %d"
WARN_SHORT_RANGE = "Short date range: %d days (recommended: >30 days)"
WARN_ANNUAL = "Date range (%d days) may be insufficient for annual seasonality detection"
HIGH_MISSING_RATE = 0.1
SHORT_RANGE_DAYS = 30
ANNUAL_DAYS = 365
CHECK_LOADED = "Loaded %d records"
CHECK_MISSING = "Missing rate: %.2f%%"
CHECK_PREPROCESSED = "Preprocessed %d sensors"
CHECK_DETECTED = "Detected seasonality in %d sensors"
CHECK_SCORED = "Scored %d sensors"


def health_summary(readings: DataFrame, periods=(7, 30, 365)) -> DataFrame:
    """DQ-1/2/3/5/6 in one row: records, range, sensors, missing rate, observations per present
    day (min/max/mean), span in whole days, warning count, healthy flag and summary text."""
    # One scan: a (sensor, day) rollup with map-side combine (bounded by sensors x days), then
    # grouping sets (day) and (sensor) over it in one Expand + aggregate, then one global row.
    daily = readings.groupBy(SENSOR, F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("c"), F.count("value").alias("nn"),
        F.min("ts").alias("lo"), F.max("ts").alias("hi"),
    )
    sets = daily.groupingSets([["day"], [SENSOR]], "day", SENSOR).agg(
        F.sum("c").alias("c"), F.sum("nn").alias("nn"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.grouping("day").alias("by_sensor"),
    )
    d, sn = F.col("by_sensor") == 0, F.col("by_sensor") == 1
    row = sets.agg(
        F.coalesce(F.sum(F.when(d, F.col("c"))), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum(F.when(d, F.col("c") - F.col("nn"))), F.lit(0)).alias("missing"),
        F.min(F.when(d, F.col("lo"))).alias("start"),
        F.max(F.when(d, F.col("hi"))).alias("end"),
        F.count_if(sn).alias("sensor_count"),
        F.count_if(sn & (F.col("nn") == 0)).alias("all_missing"),
        F.min(F.when(d, F.col("c"))).cast("double").alias("obs_min"),
        F.max(F.when(d, F.col("c"))).cast("double").alias("obs_max"),
        F.avg(F.when(d, F.col("c"))).alias("obs_mean"),
    )
    return _report(row.withColumn("cells", F.col("total_records")), periods)


def _report(row: DataFrame, periods) -> DataFrame:
    """The one report row from its totals: total_records, cells, missing, start, end, sensor_count, all_missing, obs_*."""
    rate = F.coalesce(F.try_divide(F.col("missing").cast("double"), F.col("cells").cast("double")), F.lit(0.0))
    span = F.timestamp_diff("DAY", F.col("start"), F.col("end"))
    row = row.withColumn("missing_rate", rate).withColumn("span_days", span)
    w = warnings_array(row, periods)
    row = row.withColumn("warnings", w)
    healthy = (F.size("warnings") == 0) & (F.col("total_records") > 0)
    text = F.concat_ws(
        "\n",
        F.lit(REPORT_TITLE),
        F.concat(F.lit("Total records: "), F.format_number(F.col("total_records"), 0)),
        F.concat(F.lit("Date range: "), F.col("start").cast("string"), F.lit(" to "), F.col("end").cast("string")),
        F.concat(F.lit("Sensor count: "), F.col("sensor_count").cast("string")),
        F.concat(F.lit("Overall missing rate: "), F.format_string("%.2f%%", F.col("missing_rate") * 100)),
        F.format_string("Observations per day: min=%.1f, max=%.1f, mean=%.1f", F.coalesce("obs_min", F.lit(0.0)),
                        F.coalesce("obs_max", F.lit(0.0)), F.coalesce("obs_mean", F.lit(0.0))),
    )
    text = F.when(F.size("warnings") > 0, F.concat(text, F.lit("\n\nWarnings:\n"),
                                                   F.array_join(F.transform("warnings", lambda x: F.concat(F.lit("  - "), x)), "\n"))).otherwise(text)
    return row.select(
        F.col("total_records").cast("long").alias("total_records"),
        F.col("start").alias("start_ts"),
        F.col("end").alias("end_ts"),
        F.col("sensor_count").cast("long").alias("sensor_count"),
        F.col("missing").cast("long").alias("missing_count"),
        F.col("missing_rate"),
        F.coalesce("obs_min", F.lit(0.0)).alias("obs_per_day_min"),
        F.coalesce("obs_max", F.lit(0.0)).alias("obs_per_day_max"),
        F.coalesce("obs_mean", F.lit(0.0)).alias("obs_per_day_mean"),
        F.col("span_days").cast("long").alias("span_days"),
        F.size("warnings").cast("long").alias("n_warnings"),
        healthy.alias("healthy"),
        F.col("warnings"),
        text.alias("summary"),
        *[c for c in row.columns if c == "sensors"],
    )


def wide_health(wide: DataFrame, sensors: list[str], periods=(7, 30, 365)) -> DataFrame:
    """DQ-1..DQ-6 of a wide frame (``ts`` and a column per sensor), where a record is a row of the file: the report row, and
    ``sensors``, the missing count of each sensor column. One scan, one aggregate over all columns per day, one over the days."""
    days = wide.groupBy(F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("c"), F.min("ts").alias("lo"), F.max("ts").alias("hi"),
        *[F.count(F.col(f"`{s}`")).alias(f"_{i}") for i, s in enumerate(sensors)])
    present = F.when(F.col("day").isNotNull(), F.col("c"))
    total = F.coalesce(F.sum("c"), F.lit(0))
    row = days.agg(
        total.alias("total_records"), F.min("lo").alias("start"), F.max("hi").alias("end"),
        F.min(present).cast("double").alias("obs_min"), F.max(present).cast("double").alias("obs_max"), F.avg(present).alias("obs_mean"),
        F.array(*[F.struct(F.lit(s).alias("sensor"), (total - F.coalesce(F.sum(f"_{i}"), F.lit(0))).alias("missing_count")) for i, s in enumerate(sensors)]).alias("sensors"))
    row = row.withColumns({
        "sensor_count": F.lit(len(sensors)).cast("long"), "cells": F.col("total_records") * len(sensors),
        "missing": F.aggregate("sensors", F.lit(0).cast("long"), lambda n, s: n + s["missing_count"]),
        "all_missing": F.size(F.filter("sensors", lambda s: s["missing_count"] == F.col("total_records"))).cast("long")})
    return _report(row, periods)


def wide_health_by_sensor(health: DataFrame) -> DataFrame:
    """DQ-2/DQ-4 rows of ``wide_health``: (sensor, missing_count, missing_rate, all_missing)."""
    s = health.select("total_records", F.explode("sensors").alias("s"))
    return s.select("s.sensor", "s.missing_count", F.coalesce(F.try_divide(F.col("s.missing_count").cast("double"), F.col("total_records").cast("double")), F.lit(0.0)).alias("missing_rate"),
                    (F.col("s.missing_count") == F.col("total_records")).alias("all_missing"))


def warnings_array(row: DataFrame, periods) -> Column:
    """DQ-5 warning texts (NULL entries filtered out)."""
    span = F.col("span_days")
    n = F.col("total_records")
    long_period = any(p >= ANNUAL_DAYS for p in periods)
    items = [
        F.when(n == 0, F.lit(WARN_NO_RECORDS)),
        F.when(F.col("missing_rate") > HIGH_MISSING_RATE, F.format_string(WARN_HIGH_MISSING, F.col("missing_rate") * 100)),
        F.when(F.col("all_missing") > 0, F.format_string(WARN_ALL_MISSING, F.col("all_missing"))),
        F.when((n > 0) & (span < SHORT_RANGE_DAYS), F.format_string(WARN_SHORT_RANGE, span)),
    ]
    if long_period:
        items.append(
            F.when((n > 0) & (span < ANNUAL_DAYS), F.format_string(WARN_ANNUAL, span))
        )
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def health_warnings(readings: DataFrame, periods=(7, 30, 365)) -> DataFrame:
    """DQ-5 as rows (position, warning)."""
    s = health_summary(readings, periods)
    return s.select(F.posexplode("warnings").alias("position", "warning")).select(
        F.col("position").cast("long").alias("position"), "warning"
    )


def health_by_sensor(readings: DataFrame) -> DataFrame:
    """DQ-2/DQ-4 per sensor: readings, NULL count, missing rate, first/last ts, all-missing flag."""
    return readings.groupBy(SENSOR).agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_if(F.col("value").isNull()).alias("missing_count"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.count("value").alias("non_null"),
    ).select(
        SENSOR,
        F.col("n_records").cast("long").alias("n_records"),
        F.col("missing_count").cast("long").alias("missing_count"),
        (F.col("missing_count") / F.col("n_records")).alias("missing_rate"),
        "first_ts",
        "last_ts",
        (F.col("non_null") == 0).alias("all_missing"),
    )


def obs_per_day(readings: DataFrame) -> DataFrame:
    """DQ-3 detail: readings per present day."""
    return readings.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).cast("long").alias("n_obs"))


def valid_sensors(readings: DataFrame, min_records: int = 100) -> DataFrame:
    """DQ-7: per sensor non-null count and whether it reaches ``min_records``."""
    return readings.groupBy(SENSOR).agg(F.count("value").cast("long").alias("non_null")).select(
        SENSOR, "non_null", (F.col("non_null") >= min_records).alias("valid")
    )


def keep_valid(readings: DataFrame, min_records: int = 100) -> DataFrame:
    v = valid_sensors(readings, min_records).filter("valid").select(SENSOR)
    return readings.join(v, SENSOR, "left_semi")


def describe(series: DataFrame, buffer_rows: int | None = None) -> DataFrame:
    """DQ-9 per sensor: count, mean, std (sample), min, q25, median, q75, max, skewness and
    excess kurtosis (bias-corrected, as pandas), cv = std/mean. A grid is bounded by the calendar, so one buffer per sensor holds its
    percentiles; give raw readings ``buffer_rows`` (``quantiles.BUFFER_ROWS``), beyond which a sensor's are selected over several tasks."""
    v = F.col("value")
    m = aggregate_with_quantiles(series, [SENSOR], [
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.skewness(v).alias("g1"), F.kurtosis(v).alias("g2"),
    ], "value", [0.25, 0.5, 0.75], buffer_rows)
    m = m.withColumns({name: F.col("_q")[i] for i, name in enumerate(("q25", "median", "q75"))})
    n = F.col("count").cast("double")
    skew = F.when(n > 2, F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n > 3, ((n + 1) * F.col("g2") + 6) * (n - 1) / ((n - 2) * (n - 3)))
    return m.select(
        SENSOR, F.col("count").cast("long").alias("count"), "mean", "std", "min", "q25", "median", "q75", "max",
        skew.alias("skewness"), kurt.alias("kurtosis"), F.try_divide(F.col("std"), F.col("mean")).alias("cv"),
    )


def missing_matrix(readings: DataFrame, shared_range: bool = True) -> DataFrame:
    """DQ-10 on the daily grid: (sensor, day) -> NULL readings, readings, and whether the day lacks a value. Days without any
    reading are rows, too: from the first to the last day of the whole frame (``shared_range``), or of each sensor."""
    days = readings.groupBy(SENSOR, F.to_date("ts").alias(BIN)).agg(
        F.count_if(F.col("value").isNull()).cast("long").alias("n_missing"), F.count(F.lit(1)).cast("long").alias("n_total"))
    g = on_calendar(days.filter(F.col(BIN).isNotNull()), "D", ["n_missing", "n_total"], shared_range).na.fill(0, ["n_missing", "n_total"])
    return g.select(SENSOR, F.col(BIN).alias("day"), "n_missing", "n_total", (F.col("n_total") == F.col("n_missing")).alias("is_missing"))


def health_checks(readings: DataFrame, grid: DataFrame | None = None, detections: DataFrame | None = None,
                  scores: DataFrame | None = None) -> DataFrame:
    """DQ-11: (check_name, passed, message) rows: data and missing rate, then the steps of a run whose tables are given."""
    s = readings.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("value").isNull()).alias("m")
    ).withColumn("rate", F.coalesce(F.try_divide(F.col("m").cast("double"), F.col("n").cast("double")), F.lit(0.0)))
    data = F.inline(F.array(
        F.struct(F.lit("data_loaded").alias("check_name"), (F.col("n") > 0).alias("passed"), F.format_string(CHECK_LOADED, F.col("n")).alias("message")),
        F.struct(F.lit("missing_rate").alias("check_name"), (F.col("rate") < HIGH_MISSING_RATE).alias("passed"), F.format_string(CHECK_MISSING, F.col("rate") * 100).alias("message"))))
    out = s.select(data)
    for name, table, passed, text in (("preprocessing", grid, F.lit(True), CHECK_PREPROCESSED), ("detection", detections, F.col("k") > 0, CHECK_DETECTED),
                                      ("scoring", scores, F.lit(True), CHECK_SCORED)):
        if table is not None:
            k = table.agg(F.count_distinct(SENSOR).alias("k"))
            out = out.unionByName(k.select(F.lit(name).alias("check_name"), passed.alias("passed"), F.format_string(text, F.col("k")).alias("message")))
    return out


def run_checks(readings: DataFrame, grid: DataFrame, detections: DataFrame, scores: DataFrame) -> DataFrame:
    """DQ-11: the five checks of a whole run."""
    return health_checks(readings, grid, detections, scores)
