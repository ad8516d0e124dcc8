"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` plus their DuckDB oracles.

Every query reads the driver tables in full (through the bindings in ``sources.tables``) and
returns a DataFrame whose floats are rounded to 6 digits and whose dates/timestamps are text,
so results hash identically to the SQL oracle. ``ORACLE`` has no entry for iterative or
randomised operators (rows-only check).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewise.config import DetectionConfig, ScoringConfig, Thresholds
from tidewise.functions.columns import r6
from tidewise.operators import (acf, harmonic, impute, outliers, periodogram, quality, resample, scoring,
                                segments, stl)
from tidewise.operators.ensemble import combine, detect_all
from tidewise.plans import model_oracle as M
from tidewise.plans import oracle as O
from tidewise.plans.stl_oracle import stl_ctes
from tidewise.session import cut_lineage, ship_package
from tidewise.sources.tables import readings

PERIODS = (7, 30, 365)
METHODS = DetectionConfig().methods


def fin(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = r6(c.cast("double"))
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ---- shared inputs ------------------------------------------------------------------------------

def orders(spark, sf):
    return readings(spark, sf, "orders")


def orders_grid(spark, sf):
    return resample.resample(orders(spark, sf), "D", "mean")


def orders_filled(spark, sf):
    return impute.interpolate_linear(orders_grid(spark, sf), direction="forward")


def orders_eligible(spark, sf):
    from tidewise.operators.ensemble import eligible
    return eligible(orders_filled(spark, sf), 100)[0]


def orders_detections(spark, sf):
    return detect_all(orders_eligible(spark, sf), DetectionConfig(), METHODS, gate=False)


def orders_scores(spark, sf):
    return scoring.scores_table(orders_detections(spark, sf), DetectionConfig(), methods=METHODS)


Q: dict = {}
ORACLE: dict = {}


def _run(fn, spark, sf):
    ship_package(spark)
    return fin(fn(spark, sf))


def q(name, sql=None):
    def deco(fn):
        Q[name] = lambda spark, sf: _run(fn, spark, sf)
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---- sources / quality ----------------------------------------------------------------------------

@q("ingest_long", O.with_(f"r AS ({O.readings_sql('orders')})",
   "names AS (SELECT sensor, row_number() OVER (ORDER BY sensor) AS i FROM (SELECT DISTINCT sensor FROM r))",
   "m AS (SELECT ts, sensor, avg(value) AS value FROM r GROUP BY ts, sensor)")
   + "SELECT 'sensor_' || i AS sensor, CAST(t.ts AS VARCHAR) AS ts, ROUND(m.value, 6) + 0.0 AS value "
   "FROM (SELECT DISTINCT ts FROM r) t CROSS JOIN names LEFT JOIN m ON m.ts = t.ts AND m.sensor = names.sensor")
def _ingest_long(spark, sf):
    from tidewise.sources.readers import to_long
    wide = orders(spark, sf).groupBy("ts").pivot("sensor").agg(F.avg("value"))
    names = [f"sensor_{i + 1}" for i in range(len(wide.columns) - 1)]
    return to_long(wide.toDF("ts", *names), names)


_HS_B2 = """b2 AS (SELECT *, COALESCE(CAST(missing AS DOUBLE) / NULLIF(CAST(total_records AS DOUBLE), 0), 0.0) AS missing_rate,
                    CAST(floor((epoch(end_ts) - epoch(start_ts)) / 86400) AS BIGINT) AS span_days FROM b)"""
_HS_B3 = """b3 AS (SELECT *, list_filter([CASE WHEN total_records = 0 THEN 'No records in data' END,
                    CASE WHEN missing_rate > 0.1 THEN printf('High missing rate: %.1f%%', missing_rate * 100) END,
                    CASE WHEN all_missing > 0 THEN printf('Sensors with all missing values: %d', all_missing) END,
                    CASE WHEN total_records > 0 AND span_days < 30 THEN printf('Short date range: %d days (recommended: >30 days)', span_days) END,
                    CASE WHEN total_records > 0 AND span_days < 365 THEN printf('Date range (%d days) may be insufficient for annual seasonality detection', span_days) END],
                    lambda x: x IS NOT NULL) AS warnings FROM b2)"""
_SUMMARY_TEXT = """'=== Data Health Report ===' || chr(10) || format('Total records: {:,}', total_records) || chr(10)
    || 'Date range: ' || CAST(start_ts AS VARCHAR) || ' to ' || CAST(end_ts AS VARCHAR) || chr(10) || 'Sensor count: ' || sensor_count || chr(10)
    || printf('Overall missing rate: %.2f%%', missing_rate * 100) || chr(10)
    || printf('Observations per day: min=%.1f, max=%.1f, mean=%.1f', COALESCE(obs_min, 0.0), COALESCE(obs_max, 0.0), COALESCE(obs_mean, 0.0))
    || CASE WHEN len(warnings) > 0 THEN chr(10) || chr(10) || 'Warnings:' || chr(10) || array_to_string(list_transform(warnings, lambda x: '  - ' || x), chr(10)) ELSE '' END AS summary"""
_HS = O.with_(f"r AS ({O.readings_sql('orders')})",
              "pd AS (SELECT CAST(ts AS DATE) AS day, count(*) AS c FROM r GROUP BY 1)",
              "ss AS (SELECT sensor, count(value) AS nn FROM r GROUP BY 1)",
              """b AS (SELECT count(*) AS total_records, count(*) FILTER (WHERE value IS NULL) AS missing,
                    min(ts) AS start_ts, max(ts) AS end_ts,
                    (SELECT count(*) FROM ss) AS sensor_count, (SELECT count(*) FILTER (WHERE nn = 0) FROM ss) AS all_missing,
                    (SELECT CAST(min(c) AS DOUBLE) FROM pd) AS obs_min, (SELECT CAST(max(c) AS DOUBLE) FROM pd) AS obs_max,
                    (SELECT avg(c) FROM pd) AS obs_mean FROM r)""",
              _HS_B2, _HS_B3)


@q("health_summary", _HS + """SELECT total_records, CAST(start_ts AS VARCHAR) AS start_ts, CAST(end_ts AS VARCHAR) AS end_ts,
    sensor_count, missing AS missing_count, ROUND(missing_rate, 6) + 0.0 AS missing_rate,
    ROUND(COALESCE(obs_min, 0.0), 6) + 0.0 AS obs_per_day_min, ROUND(COALESCE(obs_max, 0.0), 6) + 0.0 AS obs_per_day_max,
    ROUND(COALESCE(obs_mean, 0.0), 6) + 0.0 AS obs_per_day_mean, span_days, CAST(len(warnings) AS BIGINT) AS n_warnings,
    (len(warnings) = 0 AND total_records > 0) AS healthy, array_to_string(warnings, ' | ') AS warnings, """ + _SUMMARY_TEXT + " FROM b3")
def _health_summary(spark, sf):
    return quality.health_summary(orders(spark, sf)).withColumn("warnings", F.array_join("warnings", " | "))


@q("wide_health", O.with_(f"r AS ({O.readings_sql('orders')})",
   "names AS (SELECT DISTINCT sensor FROM r)", "times AS (SELECT DISTINCT ts FROM r)",
   "w AS (SELECT t.ts, n.sensor, m.value FROM times t CROSS JOIN names n LEFT JOIN (SELECT ts, sensor, avg(value) AS value FROM r GROUP BY 1, 2) m ON m.ts = t.ts AND m.sensor = n.sensor)",
   "pd AS (SELECT CAST(ts AS DATE) AS day, count(*) AS c FROM times GROUP BY 1)",
   "ss AS (SELECT sensor, count(value) AS nn FROM w GROUP BY 1)",
   """b AS (SELECT (SELECT count(*) FROM times) AS total_records, (SELECT count(*) - count(value) FROM w) AS missing, (SELECT count(*) FROM w) AS cells,
        (SELECT min(ts) FROM times) AS start_ts, (SELECT max(ts) FROM times) AS end_ts, (SELECT count(*) FROM ss) AS sensor_count,
        (SELECT count(*) FILTER (WHERE nn = 0) FROM ss) AS all_missing, (SELECT CAST(min(c) AS DOUBLE) FROM pd) AS obs_min,
        (SELECT CAST(max(c) AS DOUBLE) FROM pd) AS obs_max, (SELECT avg(c) FROM pd) AS obs_mean)""",
   _HS_B2.replace("CAST(total_records AS DOUBLE)", "CAST(cells AS DOUBLE)"), _HS_B3)
   + """SELECT total_records, CAST(start_ts AS VARCHAR) AS start_ts, CAST(end_ts AS VARCHAR) AS end_ts, sensor_count, missing AS missing_count,
    ROUND(missing_rate, 6) + 0.0 AS missing_rate, ROUND(COALESCE(obs_min, 0.0), 6) + 0.0 AS obs_per_day_min, ROUND(COALESCE(obs_max, 0.0), 6) + 0.0 AS obs_per_day_max,
    ROUND(COALESCE(obs_mean, 0.0), 6) + 0.0 AS obs_per_day_mean, span_days, CAST(len(warnings) AS BIGINT) AS n_warnings,
    (len(warnings) = 0 AND total_records > 0) AS healthy, array_to_string(warnings, ' | ') AS warnings, (SELECT string_agg((SELECT total_records FROM b3) - nn, ',' ORDER BY sensor) FROM ss) AS missing_by_sensor, """
   + _SUMMARY_TEXT + " FROM b3")
def _wide_health(spark, sf):
    """DQ-1..DQ-6 of the wide frame: one row per timestamp, a column per order priority."""
    wide = orders(spark, sf).groupBy("ts").pivot("sensor").agg(F.avg("value"))
    h = quality.wide_health(wide, sorted(wide.columns[1:]))
    return h.withColumns({"warnings": F.array_join("warnings", " | "),
                          "missing_by_sensor": F.array_join(F.transform("sensors", lambda s: s["missing_count"].cast("string")), ",")}).drop("sensors")


@q("health_warnings", _HS + "SELECT CAST(generate_subscripts(warnings, 1) - 1 AS BIGINT) AS position, unnest(warnings) AS warning FROM b3")
def _health_warnings(spark, sf):
    return quality.health_warnings(orders(spark, sf))


@q("health_by_sensor", O.with_(f"r AS ({O.readings_sql('lineitem')})") + """SELECT sensor, count(*) AS n_records,
    count(*) FILTER (WHERE value IS NULL) AS missing_count, ROUND(count(*) FILTER (WHERE value IS NULL) / count(*), 6) + 0.0 AS missing_rate,
    CAST(min(ts) AS VARCHAR) AS first_ts, CAST(max(ts) AS VARCHAR) AS last_ts, count(value) = 0 AS all_missing FROM r GROUP BY sensor""")
def _health_by_sensor(spark, sf):
    return quality.health_by_sensor(readings(spark, sf, "lineitem"))


@q("obs_per_day", O.with_(f"r AS ({O.readings_sql('events')})")
   + "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n_obs FROM r GROUP BY 1")
def _obs_per_day(spark, sf):
    return quality.obs_per_day(readings(spark, sf, "events"))


@q("valid_sensors", O.with_(f"r AS ({O.readings_sql('lineitem')})")
   + "SELECT sensor, count(value) AS non_null, count(value) >= 100 AS valid FROM r GROUP BY sensor")
def _valid_sensors(spark, sf):
    return quality.valid_sensors(readings(spark, sf, "lineitem"), 100)


@q("missing_report", O.with_(*O.grid_ctes("orders"),
   "g1 AS (SELECT *, row_number() OVER (PARTITION BY sensor ORDER BY bin) AS i, "
   "row_number() OVER (PARTITION BY sensor, value IS NULL ORDER BY bin) AS j FROM grid)",
   "runs AS (SELECT sensor, i - j AS isl, count(*) AS len FROM g1 WHERE value IS NULL GROUP BY 1, 2)",
   "rs AS (SELECT sensor, count(*) AS num_gaps, max(len) AS max_gap, avg(len) AS mean_gap FROM runs GROUP BY 1)",
   "tot AS (SELECT sensor, count(*) AS total_count, count(*) FILTER (WHERE value IS NULL) AS missing_count FROM grid GROUP BY 1)")
   + """SELECT tot.sensor, total_count, missing_count, ROUND(COALESCE(missing_count / total_count, 0.0), 6) + 0.0 AS missing_rate,
   COALESCE(num_gaps, 0) AS num_gaps, COALESCE(max_gap, 0) AS max_gap, ROUND(COALESCE(mean_gap, 0.0), 6) + 0.0 AS mean_gap
   FROM tot LEFT JOIN rs ON rs.sensor = tot.sensor""")
def _missing_report(spark, sf):
    return impute.missing_report(orders_grid(spark, sf))


@q("describe", O.with_(*O.grid_ctes("orders"),
   "m AS (SELECT sensor, avg(value) AS mu FROM grid GROUP BY 1)",
   """d AS (SELECT g.sensor, count(value) AS n, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS mn,
        quantile_cont(value, 0.25) AS q25, median(value) AS median, quantile_cont(value, 0.75) AS q75, max(value) AS mx,
        avg(power(value - mu, 2)) AS m2, avg(power(value - mu, 3)) AS m3, avg(power(value - mu, 4)) AS m4
      FROM grid g JOIN m ON m.sensor = g.sensor GROUP BY g.sensor)""")
   + """SELECT sensor, n AS count, ROUND(mean, 6) + 0.0 AS mean, ROUND(std, 6) + 0.0 AS std, ROUND(mn, 6) + 0.0 AS min,
   ROUND(q25, 6) + 0.0 AS q25, ROUND(median, 6) + 0.0 AS median, ROUND(q75, 6) + 0.0 AS q75, ROUND(mx, 6) + 0.0 AS max,
   ROUND(m3 / power(m2, 1.5) * sqrt(n * (n - 1.0)) / (n - 2.0), 6) + 0.0 AS skewness,
   ROUND(((n + 1.0) * (m4 / (m2 * m2) - 3.0) + 6.0) * (n - 1.0) / ((n - 2.0) * (n - 3.0)), 6) + 0.0 AS kurtosis,
   ROUND(std / mean, 6) + 0.0 AS cv FROM d""")
def _describe(spark, sf):
    return quality.describe(orders_grid(spark, sf))


@q("missing_matrix", O.with_(f"r AS ({O.readings_sql('events')})",
   "d AS (SELECT sensor, CAST(ts AS DATE) AS day, count(*) - count(value) AS n_missing, count(*) AS n_total FROM r GROUP BY 1, 2)",
   "cal AS (SELECT s.sensor, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT DISTINCT sensor FROM d) s, "
   "(SELECT min(day)::TIMESTAMP AS lo, max(day)::TIMESTAMP AS hi FROM d))")
   + "SELECT cal.sensor, CAST(cal.day AS VARCHAR) AS day, COALESCE(n_missing, 0) AS n_missing, COALESCE(n_total, 0) AS n_total, "
   "COALESCE(n_missing, 0) = COALESCE(n_total, 0) AS is_missing FROM cal LEFT JOIN d ON d.sensor = cal.sensor AND d.day = cal.day")
def _missing_matrix(spark, sf):
    return quality.missing_matrix(readings(spark, sf, "events"))


@q("health_checks", O.with_(f"r AS ({O.readings_sql('orders')})",
   "s AS (SELECT count(*) AS n, count(*) FILTER (WHERE value IS NULL) AS m, "
   "COALESCE(CAST(count(*) FILTER (WHERE value IS NULL) AS DOUBLE) / NULLIF(CAST(count(*) AS DOUBLE), 0), 0.0) AS rate FROM r)")
   + "SELECT 'data_loaded' AS check_name, n > 0 AS passed, printf('Loaded %d records', n) AS message FROM s "
   "UNION ALL SELECT 'missing_rate', rate < 0.1, printf('Missing rate: %.2f%%', rate * 100) FROM s")
def _health_checks(spark, sf):
    return quality.health_checks(orders(spark, sf))


# ---- resampling ------------------------------------------------------------------------------------

def _grid_sql(table, freq="D", method="mean", shared=False):
    return O.with_(*O.grid_ctes(table, freq, method, shared)) + \
        f"SELECT sensor, CAST(bin AS VARCHAR) AS bin, ROUND(value, 6) + 0.0 AS value FROM grid"


@q("resample_mean", _grid_sql("orders"))
def _resample_mean(spark, sf):
    return orders_grid(spark, sf)


@q("resample_median", _grid_sql("lineitem", "D", "median"))
def _resample_median(spark, sf):
    return resample.resample(readings(spark, sf, "lineitem"), "D", "median")


@q("resample_ffill_asof", _grid_sql("orders", "D", "ffill"))
def _resample_ffill(spark, sf):
    return resample.resample(orders(spark, sf), "D", "ffill")


@q("resample_ffill_hourly", _grid_sql("events", "H", "ffill"))
def _resample_ffill_hourly(spark, sf):
    return resample.resample(readings(spark, sf, "events"), "H", "ffill")


@q("resample_weekly", _grid_sql("orders", "W"))
def _resample_weekly(spark, sf):
    return resample.resample(orders(spark, sf), "W", "mean")


@q("resample_monthly", _grid_sql("lineitem", "M"))
def _resample_monthly(spark, sf):
    return resample.resample(readings(spark, sf, "lineitem"), "M", "mean")


@q("resample_hourly", _grid_sql("events", "H"))
def _resample_hourly(spark, sf):
    return resample.resample(readings(spark, sf, "events"), "H", "mean")


@q("shared_grid", _grid_sql("orders", "D", "mean", shared=True))
def _shared_grid(spark, sf):
    return resample.resample(orders(spark, sf), "D", "mean", shared_range=True)


# ---- imputation ------------------------------------------------------------------------------------

def _fill_sql(direction="forward", limit=None, x=None):
    nb = O.neighbours_cte("grid", "nb") if x is None else O.neighbours_cte("grid", "nb", x)
    return O.with_(*O.grid_ctes("orders"), *nb) + \
        f"SELECT sensor, CAST(bin AS VARCHAR) AS bin, ROUND({O.fill_expr(direction, limit)}, 6) + 0.0 AS value FROM nb"


@q("interp_linear", _fill_sql("forward"))
def _interp_linear(spark, sf):
    return orders_filled(spark, sf)


@q("interp_linear_both", _fill_sql("both"))
def _interp_linear_both(spark, sf):
    return impute.interpolate_linear(orders_grid(spark, sf), direction="both")


@q("interp_limit", _fill_sql("both", 1))
def _interp_limit(spark, sf):
    return impute.interpolate_linear(orders_grid(spark, sf), direction="both", limit=1)


@q("interp_limit_backward", _fill_sql("backward", 2))
def _interp_limit_backward(spark, sf):
    return impute.interpolate_linear(orders_grid(spark, sf), direction="backward", limit=2)


@q("interp_time", _fill_sql("both", None, "CAST(epoch(CAST(bin AS TIMESTAMP)) AS DOUBLE)"))
def _interp_time(spark, sf):
    return impute.interpolate_time(orders_grid(spark, sf), direction="both")


@q("ffill_limit", O.with_(*O.grid_ctes("orders")) + """SELECT sensor, CAST(bin AS VARCHAR) AS bin,
   ROUND(last_value(value IGNORE NULLS) OVER (PARTITION BY sensor ORDER BY bin ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) + 0.0 AS value FROM grid""")
def _ffill_limit(spark, sf):
    return impute.forward_fill(orders_grid(spark, sf), limit=2)


@q("bfill_limit", O.with_(*O.grid_ctes("orders")) + """SELECT sensor, CAST(bin AS VARCHAR) AS bin,
   ROUND(first_value(value IGNORE NULLS) OVER (PARTITION BY sensor ORDER BY bin ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING), 6) + 0.0 AS value FROM grid""")
def _bfill_limit(spark, sf):
    return impute.backward_fill(orders_grid(spark, sf), limit=2)


@q("seasonal_fill", O.with_(*O.grid_ctes("orders")) + """SELECT sensor, CAST(bin AS VARCHAR) AS bin,
   ROUND(COALESCE(value, avg(value) OVER (PARTITION BY sensor, isodow(bin) - 1)), 6) + 0.0 AS value FROM grid""")
def _seasonal_fill(spark, sf):
    return impute.fill_seasonal_mean(orders_grid(spark, sf), 7)


@q("seasonal_fill_30", O.with_(*O.grid_ctes("orders"),
   "gs AS (SELECT *, date_diff('day', min(bin) OVER (PARTITION BY sensor), bin) % 30 AS season FROM grid)")
   + """SELECT sensor, CAST(bin AS VARCHAR) AS bin,
   ROUND(COALESCE(value, avg(value) OVER (PARTITION BY sensor, season)), 6) + 0.0 AS value FROM gs""")
def _seasonal_fill_30(spark, sf):
    return impute.fill_seasonal_mean(orders_grid(spark, sf), 30)


# ---- outliers --------------------------------------------------------------------------------------

_OUT_SEL = "SELECT sensor, CAST(bin AS VARCHAR) AS bin, ROUND(value, 6) + 0.0 AS value, "


@q("outlier_iqr", O.with_(*O.grid_ctes("orders"),
   "qs AS (SELECT sensor, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM grid GROUP BY 1)")
   + _OUT_SEL + "COALESCE(value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1), false) AS is_outlier "
   "FROM grid JOIN qs USING (sensor)")
def _outlier_iqr(spark, sf):
    return outliers.flag_iqr(orders_grid(spark, sf), 1.5)


@q("outlier_zscore", O.with_(*O.grid_ctes("orders"),
   "zs AS (SELECT sensor, avg(value) AS mu, stddev_pop(value) AS sd FROM grid GROUP BY 1)")
   + _OUT_SEL + "COALESCE(CASE WHEN sd > 0 THEN abs((value - mu) / sd) > 2.0 END, false) AS is_outlier FROM grid JOIN zs USING (sensor)")
def _outlier_zscore(spark, sf):
    return outliers.flag_zscore(orders_grid(spark, sf), 2.0)


@q("outlier_rolling", O.with_(*O.grid_ctes("orders"),
   """rz AS (SELECT *, avg(value) OVER w AS mu, stddev_samp(value) OVER w AS sd FROM grid
       WINDOW w AS (PARTITION BY sensor ORDER BY bin ROWS BETWEEN 15 PRECEDING AND 14 FOLLOWING))""")
   + _OUT_SEL + "COALESCE(abs((value - mu) / NULLIF(sd, 0)) > 2.0, false) AS is_outlier FROM rz")
def _outlier_rolling(spark, sf):
    return outliers.flag_rolling(orders_grid(spark, sf), 30, 2.0)


@q("outlier_replace", O.with_(*O.grid_ctes("orders"),
   "qs AS (SELECT sensor, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3, median(value) AS med FROM grid GROUP BY 1)")
   + "SELECT sensor, CAST(bin AS VARCHAR) AS bin, ROUND(CASE WHEN COALESCE(value < q1 - 1.0 * (q3 - q1) OR value > q3 + 1.0 * (q3 - q1), false) "
   "THEN med ELSE value END, 6) + 0.0 AS value FROM grid JOIN qs USING (sensor)")
def _outlier_replace(spark, sf):
    return outliers.remove_outliers(orders_grid(spark, sf), "iqr", 1.0, replace_with="median")


# ---- detectors -------------------------------------------------------------------------------------

_DET_BASE = O.filled_ctes("orders") + O.clean_ctes("filled", gate=True)


@q("harmonic_fit", O.with_(*_DET_BASE, *O.harmonic_ctes(PERIODS))
   + "SELECT sensor, period, ROUND(r2, 6) + 0.0 AS r2, ROUND(r2, 6) + 0.0 AS delta_r2, ROUND(sin_coef, 6) + 0.0 AS sin_coef, ROUND(cos_coef, 6) + 0.0 AS cos_coef, "
   "ROUND(score, 6) + 0.0 AS score, significant, error FROM det_fourier")
def _harmonic_fit(spark, sf):
    return harmonic.harmonic_fit(orders_eligible(spark, sf), PERIODS)


@q("acf_detect", O.with_(*_DET_BASE, *O.acf_ctes(PERIODS))
   + "SELECT sensor, period, ROUND(score, 6) + 0.0 AS score, significant, error, ROUND(peak_value, 6) + 0.0 AS peak_value, "
   "CAST(actual_lag AS BIGINT) AS actual_lag, ROUND(conf_int, 6) + 0.0 AS conf_int, CAST(max_lag AS BIGINT) AS max_lag FROM det_acf")
def _acf_detect(spark, sf):
    return acf.acf_detect(orders_eligible(spark, sf), PERIODS)


@q("acf_full", O.with_(*_DET_BASE,
   "cx AS (SELECT sensor, pos, n, value - avg(value) OVER (PARTITION BY sensor) AS dx FROM c)",
   "dn AS (SELECT sensor, max(n) AS n, sum(dx * dx) AS den, least(400, max(n) // 2 - 1) AS L FROM cx GROUP BY 1)",
   "lg AS (SELECT sensor, n, den, unnest(generate_series(0, L)) AS lag FROM dn)",
   "sm AS (SELECT lg.sensor, lg.lag, sum(a.dx * b.dx) AS s FROM lg JOIN cx a ON a.sensor = lg.sensor "
   "JOIN cx b ON b.sensor = a.sensor AND b.pos = a.pos + lg.lag GROUP BY 1, 2)")
   + """SELECT lg.sensor, CAST(lg.lag AS BIGINT) AS lag, ROUND(COALESCE(sm.s, 0.0) / lg.den, 6) + 0.0 AS acf,
   ROUND(1.96 / sqrt(CAST(lg.n AS DOUBLE)), 6) + 0.0 AS conf_int_upper, ROUND(-1.96 / sqrt(CAST(lg.n AS DOUBLE)), 6) + 0.0 AS conf_int_lower, CAST(NULL AS VARCHAR) AS error
   FROM lg LEFT JOIN sm ON sm.sensor = lg.sensor AND sm.lag = lg.lag""")
def _acf_full(spark, sf):
    return acf.acf_full(orders_eligible(spark, sf), 400)


@q("periodogram_band", O.with_(*_DET_BASE, *O.periodogram_ctes(PERIODS))
   + "SELECT sensor, period, ROUND(score, 6) + 0.0 AS score, significant, error, ROUND(power, 6) + 0.0 AS power, "
   "ROUND(actual_period, 6) + 0.0 AS actual_period, ROUND(fap, 6) + 0.0 AS fap FROM det_periodogram")
def _periodogram_band(spark, sf):
    return periodogram.periodogram_detect(orders_eligible(spark, sf), PERIODS)


_EV_DAILY = O.grid_ctes("events") + O.neighbours_cte("grid", "nb") + [
    f"filled AS (SELECT sensor, bin, {O.fill_expr('forward')} AS value FROM nb)"] + O.clean_ctes("filled", gate=False)


def _events_filled(spark, sf):
    return impute.interpolate_linear(resample.resample(readings(spark, sf, "events"), "D", "mean"), direction="forward")


@q("periodogram_full", O.with_(*_EV_DAILY,
   "st AS (SELECT sensor, max(t) AS span, avg(value) AS mean_y, var_pop(value) AS vyy FROM c GROUP BY 1)",
   "fr AS (SELECT sensor, k, 0.002 + k * (1.0 / (10.0 * span)) AS f FROM (SELECT *, unnest(generate_series(0, "
   "CAST(round_even(0.498 / (1.0 / (10.0 * span)), 0) AS BIGINT))) AS k FROM st WHERE span > 0))",
   f"""pw AS (SELECT fr.sensor, fr.k, fr.f, covar_pop(sin({O.TWO_PI} * fr.f * c.t), c.value - st.mean_y) AS vsy,
        covar_pop(cos({O.TWO_PI} * fr.f * c.t), c.value - st.mean_y) AS vcy, var_pop(sin({O.TWO_PI} * fr.f * c.t)) AS vss,
        var_pop(cos({O.TWO_PI} * fr.f * c.t)) AS vcc, covar_pop(sin({O.TWO_PI} * fr.f * c.t), cos({O.TWO_PI} * fr.f * c.t)) AS vsc,
        max(st.vyy) AS vyy FROM fr JOIN c ON c.sensor = fr.sensor JOIN st ON st.sensor = fr.sensor GROUP BY 1, 2, 3)""")
   + f"SELECT sensor, CAST(k AS BIGINT) AS k, ROUND(f, 6) + 0.0 AS frequency, ROUND({O.r2_case()}, 6) + 0.0 AS power, "
   "ROUND(1.0 / f, 6) + 0.0 AS period, CAST(NULL AS VARCHAR) AS error FROM pw")
def _periodogram_full(spark, sf):
    return periodogram.periodogram_full(_events_filled(spark, sf))


@q("periodogram_slice", None)
def _periodogram_slice(spark, sf):
    """RP-6: the detail slice of the full periodogram (period <= 100)."""
    return periodogram.periodogram_full(_events_filled(spark, sf), max_period=100)


ORACLE["periodogram_slice"] = ORACLE["periodogram_full"].replace(
    " AS error FROM pw", " AS error FROM pw WHERE 1.0 / f <= 100")


# ---- ensemble, scores, ranking -----------------------------------------------------------------------

_SC = O.scores_ctes(METHODS, PERIODS)
_SCOLS = O.score_columns(METHODS, PERIODS)


@q("ensemble_combine", O.with_(*O.detections_ctes(METHODS, PERIODS), *O.combine_ctes(METHODS, PERIODS))
   + "SELECT comb.sensor, comb.period, ROUND(combined_score, 6) + 0.0 AS combined_score, CAST(best_period AS BIGINT) AS best_period, "
   "ROUND(max_combined_score, 6) + 0.0 AS max_combined_score FROM comb JOIN best ON best.sensor = comb.sensor")
def _ensemble_combine(spark, sf):
    return combine(orders_detections(spark, sf), PERIODS, METHODS)


@q("detections", O.with_(*O.detections_ctes(METHODS, PERIODS))
   + "SELECT sensor, method, period, ROUND(score, 6) + 0.0 AS score, significant, error FROM det")
def _detections(spark, sf):
    return orders_detections(spark, sf)


def _scores_sql(extra_sel="", where="", src="scores"):
    return O.with_(*_SC) + "SELECT sensor, " + ", ".join(f"ROUND({c}, 6) + 0.0 AS {c}" for c in _SCOLS) + \
        ", CAST(best_period AS BIGINT) AS best_period, confidence_strict, confidence_exploratory" + extra_sel + f" FROM {src} {where}"


@q("scores_table", _scores_sql())
def _scores_table(spark, sf):
    return orders_scores(spark, sf)


@q("classify_strict", O.with_(*_SC) + "SELECT sensor, confidence_strict FROM scores")
def _classify_strict(spark, sf):
    return orders_scores(spark, sf).select("sensor", "confidence_strict")


@q("classify_exploratory", O.with_(*_SC) + "SELECT sensor, confidence_exploratory FROM scores")
def _classify_exploratory(spark, sf):
    return orders_scores(spark, sf).select("sensor", "confidence_exploratory")


@q("ranking", O.with_(*_SC, "rk AS (SELECT *, row_number() OVER (ORDER BY composite_score DESC NULLS LAST, sensor) AS rank FROM scores)")
   + "SELECT CAST(rank AS BIGINT) AS rank, sensor, " + ", ".join(f"ROUND({c}, 6) + 0.0 AS {c}" for c in _SCOLS)
   + ", CAST(best_period AS BIGINT) AS best_period, confidence_strict, confidence_exploratory FROM rk")
def _ranking(spark, sf):
    # the global sort samples its input first: rank a materialised scores table, not the plan
    return scoring.ranking(cut_lineage(orders_scores(spark, sf)))


@q("top_sensors", O.with_(*_SC, "lv AS (SELECT *, CASE confidence_strict WHEN 'High' THEN 3 WHEN 'Medium' THEN 2 "
   "WHEN 'Low' THEN 1 ELSE 0 END AS lvl FROM scores)")
   + "SELECT sensor, " + ", ".join(f"ROUND({c}, 6) + 0.0 AS {c}" for c in _SCOLS)
   + ", CAST(best_period AS BIGINT) AS best_period, confidence_strict, confidence_exploratory FROM lv WHERE lvl >= 1 "
   "ORDER BY composite_score DESC, sensor LIMIT 3")
def _top_sensors(spark, sf):
    return scoring.top_sensors(orders_scores(spark, sf), n=3, min_confidence="Low")


@q("label_distribution", O.with_(*_SC) + "SELECT confidence_strict AS label, count(*) AS count, "
   "ROUND(count(*) * 100.0 / (SELECT count(*) FROM scores), 6) + 0.0 AS percentage FROM scores GROUP BY 1")
def _label_distribution(spark, sf):
    return scoring.label_distribution(orders_scores(spark, sf), "strict")


@q("label_distribution_exploratory", O.with_(*_SC) + "SELECT confidence_exploratory AS label, count(*) AS count, "
   "ROUND(count(*) * 100.0 / (SELECT count(*) FROM scores), 6) + 0.0 AS percentage FROM scores GROUP BY 1")
def _label_distribution_x(spark, sf):
    return scoring.label_distribution(orders_scores(spark, sf), "exploratory")


@q("period_filter", _scores_sql(where="WHERE combined_7 >= 0.1"))
def _period_filter(spark, sf):
    return scoring.filter_by_period(orders_scores(spark, sf), 7, 0.1)


@q("period_agreement", O.with_(*O.detections_ctes(METHODS, PERIODS))
   + "SELECT sensor, period, COALESCE(array_to_string(list_sort(list(method) FILTER (WHERE significant)), ','), '') AS significant_methods, "
   "count(*) FILTER (WHERE significant) AS num_significant, ROUND(sum(score) / 4.0, 6) + 0.0 AS combined_score, "
   "ROUND(count(*) FILTER (WHERE significant) / 4.0, 6) + 0.0 AS agreement, "
   + ", ".join(f"ROUND(COALESCE(max(score) FILTER (WHERE method = '{m}'), 0.0), 6) + 0.0 AS {m}_score" for m in METHODS)
   + " FROM det GROUP BY sensor, period")
def _period_agreement(spark, sf):
    return scoring.period_agreement(orders_detections(spark, sf), METHODS)


_SUM_METHODS = ("stl", "acf", "fourier", "periodogram")


def _summary_sql():
    parts = ["SELECT 'overall' AS section, 'total_sensors' AS key, CAST(count(*) AS DOUBLE) AS value FROM scores"]
    for k, e in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"), ("median", "median")):
        parts.append(f"SELECT 'composite_score_stats', '{k}', {e}(composite_score) FROM scores")
    for m in _SUM_METHODS:
        for k, e in (("mean", "avg"), ("std", "stddev_samp"), ("max", "max")):
            parts.append(f"SELECT '{m}_stats', '{k}', {e}({m}_max) FROM scores")
    for sec, col in (("confidence_distribution_strict", "confidence_strict"),
                     ("confidence_distribution_exploratory", "confidence_exploratory"),
                     ("best_period_distribution", "best_period")):
        parts.append(f"SELECT '{sec}', CAST({col} AS VARCHAR), CAST(count(*) AS DOUBLE) FROM scores GROUP BY {col}")
    return O.with_(*_SC, "sm AS (" + " UNION ALL ".join(parts) + ")") + \
        "SELECT section, key, ROUND(value, 6) + 0.0 AS value FROM sm"


@q("summary_stats", _summary_sql())
def _summary_stats(spark, sf):
    return scoring.summary_statistics(cut_lineage(orders_scores(spark, sf)), _SUM_METHODS)


@q("heatmap", O.with_(*_SC) + "SELECT sensor, ROUND(composite_score, 6) + 0.0 AS composite_score, "
   + ", ".join(f"ROUND({m}_{p}, 6) + 0.0 AS {m}_{p}" for m in METHODS for p in PERIODS)
   + " FROM scores ORDER BY composite_score DESC, sensor LIMIT 3")
def _heatmap(spark, sf):
    from tidewise.operators.report import heatmap
    return heatmap(orders_scores(spark, sf), METHODS, PERIODS, n=3)


@q("summary_cards", O.with_(*_SC) + "SELECT count(*) AS total_sensors, "
   + ", ".join(f"count(*) FILTER (WHERE confidence_{m} = '{lab}') AS {m}_{lab.lower()}" for m in ("strict", "exploratory")
               for lab in ("High", "Medium", "Low"))
   + ", ROUND(max(composite_score), 6) + 0.0 AS max_composite, ROUND(avg(composite_score), 6) + 0.0 AS mean_composite FROM scores")
def _summary_cards(spark, sf):
    from tidewise.operators.report import summary_cards
    return summary_cards(orders_scores(spark, sf))


@q("report_table", O.with_(*_SC, "rk AS (SELECT *, row_number() OVER (ORDER BY composite_score DESC NULLS LAST, sensor) AS rank FROM scores)")
   + "SELECT sensor, CAST(rank AS BIGINT) AS rank, ROUND(composite_score, 6) + 0.0 AS composite_score, confidence_strict, "
   "confidence_exploratory, ROUND(stl_max, 6) + 0.0 AS stl_max, ROUND(acf_max, 6) + 0.0 AS acf_max, "
   "ROUND(fourier_max, 6) + 0.0 AS fourier_max, ROUND(periodogram_max, 6) + 0.0 AS periodogram_max, "
   "CAST(best_period AS BIGINT) AS best_period, " + ", ".join(f"ROUND({m}_{p}, 6) + 0.0 AS {m}_{p}" for m in METHODS[:2] for p in PERIODS) + " "
   "FROM rk ORDER BY rank LIMIT 100")
def _report_table(spark, sf):
    from tidewise.operators.report import report_table
    return report_table(scoring.ranking(cut_lineage(orders_scores(spark, sf))))


@q("overview_series", O.with_(*_SC)
   + "SELECT f.sensor, CAST(f.bin AS VARCHAR) AS bin, ROUND(f.value, 6) + 0.0 AS value, s.confidence_strict, "
   "ROUND(s.composite_score, 6) + 0.0 AS composite_score FROM filled f LEFT JOIN scores s ON s.sensor = f.sensor")
def _overview_series(spark, sf):
    from tidewise.operators.report import overview_series
    grid = cut_lineage(orders_filled(spark, sf))  # one scan: the scores read the written grid
    return overview_series(grid, scoring.scores_table(detect_all(grid, DetectionConfig(), METHODS), DetectionConfig(), methods=METHODS))


def _median_scores(spark, sf):
    g = impute.interpolate_linear(resample.resample(orders(spark, sf), "D", "median"), direction="forward")
    from tidewise.operators.ensemble import eligible
    det = detect_all(eligible(g, 100)[0], DetectionConfig(), METHODS, gate=False)
    return scoring.scores_table(det, DetectionConfig(), methods=METHODS)


def _median_sc():
    return [x.replace("avg(value) AS value FROM r GROUP BY 1, 2", "median(value) AS value FROM r GROUP BY 1, 2") for x in _SC]


@q("run_compare", O.with_(*_SC, "ra AS (SELECT sensor, row_number() OVER (ORDER BY composite_score DESC NULLS LAST, sensor) AS rank, "
   "composite_score, confidence_strict FROM scores)")
   .replace("WITH RECURSIVE ", "WITH RECURSIVE runb AS (" + O.with_(*_median_sc()) + "SELECT sensor, row_number() OVER (ORDER BY composite_score DESC NULLS LAST, sensor) AS rank, composite_score, confidence_strict FROM scores), ", 1)
   + """SELECT COALESCE(ra.sensor, runb.sensor) AS sensor, CAST(ra.rank AS BIGINT) AS rank_a, CAST(runb.rank AS BIGINT) AS rank_b,
   CAST(runb.rank - ra.rank AS BIGINT) AS rank_delta, ROUND(ra.composite_score, 6) + 0.0 AS score_a,
   ROUND(runb.composite_score, 6) + 0.0 AS score_b, ROUND(runb.composite_score - ra.composite_score, 6) + 0.0 AS score_delta,
   ra.confidence_strict AS label_a, runb.confidence_strict AS label_b,
   ra.confidence_strict IS DISTINCT FROM runb.confidence_strict AS label_changed
   FROM ra FULL OUTER JOIN runb ON ra.sensor = runb.sensor""")
def _run_compare(spark, sf):
    return scoring.compare_runs(scoring.ranking(cut_lineage(orders_scores(spark, sf))),
                                scoring.ranking(cut_lineage(_median_scores(spark, sf))))


@q("variant_compare", None)
def _variant_compare(spark, sf):
    return scoring.compare_variants({"mean": orders_scores(spark, sf), "median": _median_scores(spark, sf)})


ORACLE["variant_compare"] = (
    O.with_(*_SC).replace("WITH RECURSIVE ", "WITH RECURSIVE vb AS (" + O.with_(*_median_sc()) + "SELECT 'median' AS variant, sensor, composite_score, confidence_strict FROM scores), ", 1)
    + ", u AS (SELECT 'mean' AS variant, sensor, composite_score, confidence_strict FROM scores UNION ALL SELECT * FROM vb) "
    "SELECT variant, count(*) AS n_sensors, ROUND(avg(composite_score), 6) + 0.0 AS mean_composite, "
    "ROUND(max(composite_score), 6) + 0.0 AS max_composite, count(*) FILTER (WHERE confidence_strict = 'High') AS n_high FROM u GROUP BY variant"
)


# ---- changepoints / segments -------------------------------------------------------------------------

CP_PEN = 1e10
_CPW = O.filled_ctes("orders") + O.clean_ctes("filled", gate=False)
_CP_SQL = [
    """cw0 AS (SELECT *, pos - 1 AS k, lag(bin) OVER w AS prev_bin,
        sum(value) OVER (w ROWS BETWEEN 25 PRECEDING AND 1 PRECEDING) AS sl, sum(value * value) OVER (w ROWS BETWEEN 25 PRECEDING AND 1 PRECEDING) AS ql,
        sum(value) OVER (w ROWS BETWEEN CURRENT ROW AND 24 FOLLOWING) AS sr, sum(value * value) OVER (w ROWS BETWEEN CURRENT ROW AND 24 FOLLOWING) AS qr
      FROM c WINDOW w AS (PARTITION BY sensor ORDER BY pos))""",
    """cw1 AS (SELECT *, CASE WHEN k % 5 = 0 AND k >= 25 AND k < n - 25 AND n >= 60 THEN
        ((ql + qr) - (sl + sr) * (sl + sr) / 50) - (ql - sl * sl / 25) - (qr - sr * sr / 25) END AS gain FROM cw0)""",
    """cw2 AS (SELECT *, max(gain) OVER (PARTITION BY sensor ORDER BY pos ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS lm,
        max(gain) OVER (PARTITION BY sensor ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND 30 FOLLOWING) AS rm FROM cw1)""",
    "cps AS (SELECT sensor, prev_bin AS cp_bin, gain FROM cw2 WHERE gain > COALESCE(lm, '-inf'::DOUBLE) AND gain > COALESCE(rm, '-inf'::DOUBLE) AND gain > " + repr(CP_PEN) + ")",
]
def _orders_cps(spark, sf):
    return segments.changepoints_window_l2(orders_filled(spark, sf), penalty=CP_PEN)


@q("cp_window_l2", O.with_(*_CPW, *_CP_SQL) + "SELECT sensor, CAST(cp_bin AS VARCHAR) AS cp_bin FROM cps")
def _cp_window(spark, sf):
    return _orders_cps(spark, sf).select("sensor", "cp_bin")


_SEG_SQL = [
    "mk AS (SELECT f.*, (cps.cp_bin IS NOT NULL) AS is_cp FROM filled f LEFT JOIN (SELECT DISTINCT sensor, cp_bin FROM cps) cps "
    "ON cps.sensor = f.sensor AND cps.cp_bin = f.bin)",
    "sg0 AS (SELECT *, 1 + COALESCE(sum(CAST(is_cp AS INTEGER)) OVER (PARTITION BY sensor ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s0 FROM mk)",
    "seg AS (SELECT sensor, bin, value, CAST(unnest(CASE WHEN is_cp THEN [s0, s0 + 1] ELSE [s0] END) AS BIGINT) AS segment FROM sg0)",
]


def _orders_segmented(spark, sf):
    marked = segments.window_l2_marks(orders_filled(spark, sf), penalty=CP_PEN)
    return segments.segments_from_marks(marked.select("sensor", "bin", "value", "is_cp"))


@q("segments", O.with_(*_CPW, *_CP_SQL, *_SEG_SQL)
   + "SELECT sensor, CAST(bin AS VARCHAR) AS bin, ROUND(value, 6) + 0.0 AS value, segment FROM seg")
def _segments(spark, sf):
    return _orders_segmented(spark, sf)


@q("segment_stats", O.with_(*_CPW, *_CP_SQL, *_SEG_SQL)
   + "SELECT sensor, segment, CAST(min(bin) AS VARCHAR) AS start, CAST(max(bin) AS VARCHAR) AS \"end\", count(*) AS n_points, "
   "ROUND(avg(value), 6) + 0.0 AS mean, ROUND(stddev_samp(value), 6) + 0.0 AS std, ROUND(min(value), 6) + 0.0 AS min, "
   "ROUND(max(value), 6) + 0.0 AS max, ROUND(median(value), 6) + 0.0 AS median FROM seg GROUP BY sensor, segment")
def _segment_stats(spark, sf):
    return segments.segment_statistics(None, segmented=_orders_segmented(spark, sf))


# ---- text ------------------------------------------------------------------------------------------------

@q("name_dictionary", "SELECT name, printf('SENSOR_%03d', n) AS alias, CAST(n AS BIGINT) AS ordinal FROM "
   "(SELECT name, row_number() OVER (ORDER BY name) AS n FROM (SELECT DISTINCT source AS name FROM documents WHERE source IS NOT NULL))")
def _name_dictionary(spark, sf):
    from tidewise.operators.textops import name_dictionary
    from tidewise.sources.tables import table
    return name_dictionary(table(spark, sf, "documents"), "source")


def _mask_sql(c):
    out = c
    for p in (r"[A-Za-z]:\\[^\s\"']+", r"/[^\s\"']+(?:/[^\s\"']+)+", r"~[^\s\"']+"):
        lit = p.replace("'", "''")
        out = f"regexp_replace({out}, '{lit}', '[PATH_MASKED]', 'g')"
    return out


@q("mask_paths", f"SELECT page_id, {_mask_sql('url')} AS url_masked, {_mask_sql('html')} AS html_masked FROM pages")
def _mask_paths(spark, sf):
    from tidewise.operators.textops import mask_paths
    from tidewise.sources.tables import table
    p = table(spark, sf, "pages")
    return p.select("page_id", mask_paths(F.col("url")).alias("url_masked"), mask_paths(F.col("html")).alias("html_masked"))


_LINES_SQL = ("entries AS (SELECT *, printf('%s %s %s', CAST(ts AS VARCHAR), CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END, event_type) AS head, "
              "printf('value=%.2f event=%d', value, event_id) AS body, CASE WHEN event_type = 'error' THEN event_id % 4 ELSE 0 END AS kind FROM events)",
              "texts AS (SELECT user_id, ts, event_id, CASE kind WHEN 1 THEN head || ' ' || body WHEN 2 THEN head || ': ' || body || chr(10) || '  caused by event ' || event_id "
              "WHEN 3 THEN head || ': ' || body || ' seen ' || CAST(CAST(ts AS DATE) AS VARCHAR) || ' again: yes' ELSE head || ': ' || body END AS entry FROM entries)")


def _errors_sql(file: str) -> str:
    return O.with_(*_LINES_SQL, f"files AS (SELECT {file} AS file, string_agg(entry, chr(10) ORDER BY ts, event_id) AS t FROM texts GROUP BY 1)",
                   "found AS (SELECT file, regexp_extract_all(t, '(?s)ERROR.*?:(.*?)(?:\\d{4}-\\d{2}-\\d{2}|$)', 1)[:10] AS m FROM files)") + \
        "SELECT file, n, substring(trim(m[n], ' ' || chr(9) || chr(10) || chr(13)), 1, 500) AS message FROM (SELECT *, unnest(range(1, len(m) + 1)) AS n FROM found)"


@q("error_extract", _errors_sql("printf('user_%d.log', user_id)"))
def _error_extract(spark, sf):
    from tidewise.operators.logs import error_extract
    from tidewise.operators.textops import event_log_lines
    from tidewise.sources.tables import table
    return error_extract(event_log_lines(table(spark, sf, "events")))


@q("error_extract_one_file", _errors_sql("'all.log'"))
def _error_extract_one_file(spark, sf):
    """TXT-6 on one long log, written in parts, in order, and read back in splits as one file; its chunks are scanned by many tasks."""
    import uuid

    from tidewise.operators.logs import error_extract
    from tidewise.operators.textops import event_log_lines
    from tidewise.session import run_folder
    from tidewise.sources.readers import read_log_lines
    from tidewise.sources.tables import table
    folder = f"{run_folder(spark)}/log-{uuid.uuid4().hex}"
    events = table(spark, sf, "events").withColumn("user_id", F.lit(0))
    event_log_lines(events).orderBy("line_no").select("line").write.text(folder)  # no task holds the whole log
    return error_extract(read_log_lines(spark, folder, parts=True), chunk_lines=500).withColumn("file", F.lit("all.log"))


@q("log_tail", O.with_("sp AS (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)",
   "ln AS (SELECT doc_id, s[i] AS line, i AS line_no FROM sp, generate_series(1, len(s)) g(i))",
   "lt AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no DESC) AS r FROM ln)")
   + "SELECT doc_id, count(*) AS n_lines, string_agg(line, chr(10) ORDER BY line_no) AS excerpt FROM lt WHERE r <= 100 GROUP BY doc_id")
def _log_tail(spark, sf):
    from tidewise.operators.textops import text_tail
    from tidewise.sources.tables import table
    return text_tail(table(spark, sf, "documents"), "doc_id", "text", 100)


@q("step_shares", "SELECT user_id, event_type, ROUND(d, 6) + 0.0 AS duration, ROUND(sum(d) OVER (PARTITION BY user_id), 6) + 0.0 AS total, "
   "ROUND(d * 100.0 / sum(d) OVER (PARTITION BY user_id), 6) + 0.0 AS percent FROM (SELECT user_id, event_type, sum(value) AS d FROM events GROUP BY 1, 2)")
def _step_shares(spark, sf):
    from tidewise.operators.textops import step_shares
    from tidewise.sources.tables import table
    return step_shares(table(spark, sf, "events"), "user_id", "event_type", "value")


@q("bundle_counts", """SELECT c.user_id, c.n_errors, c.n_warnings, f.first_errors FROM
   (SELECT user_id, count(*) FILTER (WHERE event_type = 'error') AS n_errors, count(*) FILTER (WHERE event_type = 'signup') AS n_warnings
    FROM events GROUP BY user_id) c LEFT JOIN
   (SELECT user_id, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY r) AS first_errors FROM
     (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events WHERE event_type = 'error')
    WHERE r <= 5 GROUP BY user_id) f ON f.user_id = c.user_id""")
def _bundle_counts(spark, sf):
    from tidewise.operators.textops import bundle_counts
    from tidewise.sources.tables import table
    return bundle_counts(table(spark, sf, "events"))


_JSON_SQL = """SELECT src, id, CASE WHEN ok THEN COALESCE(json_extract_string(CASE WHEN ok THEN b END, '$.summary'), 'No summary provided') ELSE substring(t, 1, 500) END AS summary,
   CAST(CASE WHEN ok THEN COALESCE(json_array_length(CASE WHEN ok THEN b END, '$.issues'), 0) ELSE 0 END AS BIGINT) AS n_issues,
   CAST(CASE WHEN ok THEN COALESCE(json_array_length(CASE WHEN ok THEN b END, '$.recommendations'), 0) ELSE 0 END AS BIGINT) AS n_recommendations,
   CASE WHEN ok THEN COALESCE(json_extract_string(CASE WHEN ok THEN b END, '$.confidence'), 'medium') ELSE 'low' END AS confidence
   FROM (SELECT *, COALESCE(b <> '' AND json_valid(b) AND json_type(CASE WHEN b <> '' AND json_valid(b) THEN b END) = 'OBJECT', false) AS ok FROM (
     SELECT 'events' AS src, event_id AS id, props AS t, regexp_extract(props, '(?s)(\\{.*\\})', 1) AS b FROM events
     UNION ALL SELECT 'conversations', conv_id * 1000 + turn, text, regexp_extract(text, '(?s)(\\{.*\\})', 1) FROM conversations))"""


@q("json_extract", _JSON_SQL)
def _json_extract(spark, sf):
    from tidewise.operators.textops import parse_response
    from tidewise.sources.tables import table
    ev = table(spark, sf, "events").select(F.lit("events").alias("src"), F.col("event_id").alias("id"), F.col("props").alias("t"))
    cv = table(spark, sf, "conversations").select(F.lit("conversations").alias("src"),
                                                  (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("text").alias("t"))
    u = ev.unionByName(cv).withColumn("r", parse_response(F.col("t")))
    return u.select("src", "id", "r.summary", F.size("r.issues").cast("long").alias("n_issues"),
                    F.size("r.recommendations").cast("long").alias("n_recommendations"), "r.confidence")


def _named(c: str) -> str:
    """``c`` with the names replaced, the longest first (no alias holds a name)."""
    return f"list_reduce(list_prepend({{'name': '', 'alias': {c}}}, names), lambda a, x: {{'name': '', 'alias': replace(a.alias, x.name, x.alias)}}).alias"


@q("anonymize_text", O.with_("d AS (SELECT name, printf('SENSOR_%03d', row_number() OVER (ORDER BY name)) AS alias FROM (SELECT DISTINCT source AS name FROM documents WHERE source IS NOT NULL))",
   "l AS (SELECT list({'name': name, 'alias': alias} ORDER BY length(name) DESC) AS names FROM d)")
   + f"SELECT doc_id, {_named("concat_ws(' ', source, lang)")} AS label, {_named('source')} AS m_key, {_named('text')} AS text FROM documents, l")
def _anonymize_text(spark, sf):
    """TXT-3/TXT-4: the sources as names, replaced in a plain column, a map's keys and whole texts."""
    from tidewise.operators.textops import anonymize, name_dictionary
    from tidewise.sources.tables import table
    docs = table(spark, sf, "documents")
    out = docs.select("doc_id", F.concat_ws(" ", "source", "lang").alias("label"), F.map_from_arrays(F.array("source"), F.array("lang")).alias("m"), "text")
    out = anonymize(out, ["label", "m", "text"], name_dictionary(docs, "source"))
    return out.select("doc_id", "label", F.map_keys("m")[0].alias("m_key"), "text")


# ---- rows-only (iterative / randomised kernels) ----------------------------------------------------------

_STL_SQL = O.with_(*_DET_BASE, *stl_ctes(PERIODS))
_COMPONENTS_SQL = [*_DET_BASE, *stl_ctes((7,)),
                   "comps AS (SELECT r.sensor, r.period, c.bin, r.y, r.trend, r.seasonal, r.residual FROM stl_rows r JOIN c ON c.sensor = r.sensor AND c.pos = r.i)"]


@q("stl_strength", _STL_SQL + "SELECT sensor, period, ROUND(score, 6) + 0.0 AS score, score > 0.5 AS significant, error, ROUND(f_season, 6) + 0.0 AS f_season, "
   "ROUND(vs, 0) + 0.0 AS var_seasonal, ROUND(vr, 0) + 0.0 AS var_residual, ROUND(trend_strength, 6) + 0.0 AS trend_strength FROM stl")
def _stl_strength(spark, sf):
    s = stl.stl_strength(orders_eligible(spark, sf), PERIODS)
    return s.withColumns({c: F.round(c, 0) for c in ("var_seasonal", "var_residual")})  # about 1e9: the last digits are noise


def _rounded_components(c):
    """Values of about 1e5 after 32 passes of smoothing: three digits are sure."""
    return c.withColumns({x: F.round(x, 3) + 0.0 for x in ("trend", "seasonal", "residual")})


_COMPONENTS_SEL = ("SELECT sensor, period, CAST(bin AS VARCHAR) AS bin, " + ", ".join(
    f"ROUND({x}, {d}) + 0.0 AS {n}" for x, n, d in (("y", "observed", 6), ("trend", "trend", 3), ("seasonal", "seasonal", 3), ("residual", "residual", 3)))
    + ", CAST(NULL AS VARCHAR) AS error FROM comps")


@q("stl_components", O.with_(*_COMPONENTS_SQL) + _COMPONENTS_SEL)
def _stl_components(spark, sf):
    return _rounded_components(stl.stl_components(orders_eligible(spark, sf), 7))


@q("residual_histogram", O.with_(*_COMPONENTS_SQL, "edges AS (SELECT sensor, period, min(residual) AS lo, max(residual) AS hi FROM comps GROUP BY 1, 2)",
   "hist AS (SELECT c.sensor, c.period, c.residual, CASE WHEN hi > lo THEN least(CAST(floor((residual - lo) * 50 / (hi - lo)) AS BIGINT) + 1, 50) ELSE 1 END AS bucket "
   "FROM comps c JOIN edges e ON e.sensor = c.sensor AND e.period = c.period)")
   + "SELECT sensor, period, bucket, count(*) AS count, ROUND(min(residual), 3) + 0.0 AS lo, ROUND(max(residual), 3) + 0.0 AS hi FROM hist GROUP BY 1, 2, 3")
def _residual_histogram(spark, sf):
    from tidewise.operators.report import residual_histogram
    return residual_histogram(stl.stl_components(orders_eligible(spark, sf), 7)).withColumns({c: F.round(c, 3) + 0.0 for c in ("lo", "hi")})


_JOINT = [*_DET_BASE, *M.joint_ctes(PERIODS)]
_FITTED = "intercept + " + " + ".join(f"b{2 * i + j} * {f}({O.TWO_PI} * t / {float(p)!r})" for i, p in enumerate(PERIODS) for j, f in enumerate(("sin", "cos")))


@q("joint_fit", O.with_(*_JOINT) + "SELECT sensor, n, ROUND(r2, 6) + 0.0 AS r2, ROUND(r2, 6) + 0.0 AS delta_r2, ROUND(intercept, 6) + 0.0 AS intercept, "
   + ", ".join(f"ROUND(b{i}, 6) + 0.0 AS b{i}" for i in range(2 * len(PERIODS))) + " FROM joint")
def _joint_fit(spark, sf):
    return harmonic.joint_fit(orders_eligible(spark, sf), PERIODS)


@q("joint_delta_r2", O.with_(*_JOINT, *O.harmonic_ctes(PERIODS)) + "SELECT sensor, 'period_' || period AS key, ROUND(r2, 6) + 0.0 AS delta_r2 FROM det_fourier "
   "UNION ALL SELECT sensor, 'full', ROUND(r2, 6) + 0.0 FROM joint")
def _joint_delta(spark, sf):
    return harmonic.delta_r2_map(orders_eligible(spark, sf), PERIODS)


@q("joint_predict", O.with_(*_JOINT) + f"SELECT c.sensor, CAST(c.bin AS VARCHAR) AS bin, ROUND(c.value, 6) + 0.0 AS value, ROUND({_FITTED}, 4) + 0.0 AS fitted, "
   "CAST(NULL AS VARCHAR) AS error FROM c JOIN joint ON joint.sensor = c.sensor")
def _joint_predict(spark, sf):
    return harmonic.fit_and_predict(orders_eligible(spark, sf), PERIODS).withColumn("fitted", F.round("fitted", 4) + 0.0)


@q("pacf", O.with_(*_DET_BASE, *M.pacf_ctes(50)) + "SELECT sensor, lag, ROUND(pacf, 6) + 0.0 AS pacf, CAST(NULL AS VARCHAR) AS error FROM pacf")
def _pacf(spark, sf):
    return acf.pacf(orders_eligible(spark, sf), 50)


@q("cp_pelt", O.with_(*_CPW, *M.pelt_l2_ctes(CP_PEN)) + "SELECT sensor, CAST(cp_bin AS VARCHAR) AS cp_bin, CAST(NULL AS VARCHAR) AS error FROM cps")
def _cp_pelt(spark, sf):
    return segments.changepoints_pelt(orders_filled(spark, sf), model="l2", min_size=30, penalty=CP_PEN)


@q("cp_pelt_rbf", O.with_(*_CPW, *M.pelt_rbf_ctes(1.0)) + "SELECT sensor, CAST(cp_bin AS VARCHAR) AS cp_bin, CAST(NULL AS VARCHAR) AS error FROM cps")
def _cp_pelt_rbf(spark, sf):
    return segments.changepoints_pelt(orders_filled(spark, sf), model="rbf", min_size=30, penalty=1.0)


@q("outlier_iforest")
def _outlier_iforest(spark, sf):
    return outliers.flag_iforest(orders_grid(spark, sf), 0.05, 42, 100)


_SPLINE_SEL = "SELECT sensor, CAST(bin AS VARCHAR) AS bin, ROUND(value, 6) + 0.0 AS value FROM filled"


@q("interp_spline", O.with_(*O.grid_ctes("orders"), *M.cubic_spline_ctes()) + _SPLINE_SEL)
def _interp_spline(spark, sf):
    return impute.interpolate_spline(orders_grid(spark, sf), order=3)


@q("interp_polynomial", O.with_(*O.grid_ctes("orders"), *M.quadratic_spline_ctes()) + _SPLINE_SEL)
def _interp_polynomial(spark, sf):
    return impute.interpolate_missing(orders_grid(spark, sf), "polynomial", order=2)


@q("ensemble_all_methods", _scores_sql())
def _ensemble_all(spark, sf):
    """The whole run with its tables written: grid, detections and scores, each read back by the next step."""
    from tidewise.plans.run import analyze
    return analyze(orders(spark, sf), materialize=True)["scores"]


@q("run_checks", O.with_(*_SC, "k AS (SELECT (SELECT count(*) FROM r) AS n, (SELECT count(*) - count(value) FROM r) AS m, (SELECT count(DISTINCT sensor) FROM ge) AS g, "
   "(SELECT count(DISTINCT sensor) FROM det) AS d, (SELECT count(*) FROM scores) AS s)")
   + """SELECT unnest(['data_loaded', 'missing_rate', 'preprocessing', 'detection', 'scoring']) AS check_name, unnest([n > 0, m / n < 0.1, true, d > 0, true]) AS passed,
   unnest([printf('Loaded %d records', n), printf('Missing rate: %.2f%%', 100.0 * m / n), printf('Preprocessed %d sensors', g), printf('Detected seasonality in %d sensors', d),
   printf('Scored %d sensors', s)]) AS message FROM k""")
def _run_checks(spark, sf):
    """DQ-11: the five checks of a whole run."""
    from tidewise.plans.run import analyze
    return analyze(orders(spark, sf), materialize=True)["checks"]


#: below what the noise of these tables reaches, so that every label occurs
_LOW = Thresholds(stl_strength=0.4, acf_peak=0.04, delta_r2=0.02)


@q("classify_thresholds", O.with_(*O.scores_ctes(METHODS, PERIODS, thresholds=(_LOW.stl_strength, _LOW.acf_peak, _LOW.delta_r2)))
   + "SELECT sensor, ROUND(stl_max, 6) + 0.0 AS stl_max, ROUND(acf_max, 6) + 0.0 AS acf_max, ROUND(fourier_max, 6) + 0.0 AS fourier_max, "
   "ROUND(composite_score, 6) + 0.0 AS composite_score, confidence_strict, confidence_exploratory FROM scores")
def _classify_thresholds(spark, sf):
    """SC-6/SC-7 with the user's own strict thresholds."""
    s = scoring.scores_table(orders_detections(spark, sf), DetectionConfig(), ScoringConfig(strict=_LOW))
    return s.select("sensor", "stl_max", "acf_max", "fourier_max", "composite_score", "confidence_strict", "confidence_exploratory")


# ---- accessors and detail tables -------------------------------------------------------------------------

@q("score_lookup", O.with_(*O.detections_ctes(METHODS, PERIODS))
   + "SELECT s.sensor, ROUND(COALESCE(d.score, 0.0), 6) + 0.0 AS score, COALESCE(d.significant, false) AS significant "
   "FROM (SELECT DISTINCT sensor FROM det) s LEFT JOIN (SELECT * FROM det WHERE method = 'acf' AND period = 30) d ON d.sensor = s.sensor")
def _score_lookup(spark, sf):
    from tidewise.operators.ensemble import get_score
    return get_score(orders_detections(spark, sf), "acf", 30)


@q("score_normalize", O.with_(*_DET_BASE, *O.harmonic_ctes(PERIODS))
   + "SELECT sensor, period, ROUND(CASE WHEN isnan(sin_coef) THEN 0.0 ELSE greatest(0.0, least(1.0, (sin_coef - (-5000.0)) / 10000.0)) END, 6) + 0.0 AS normalized "
   "FROM det_fourier")
def _score_normalize(spark, sf):
    return harmonic.harmonic_fit(orders_eligible(spark, sf), PERIODS).select(
        "sensor", "period", scoring.normalize_score(F.col("sin_coef"), -5000.0, 5000.0).alias("normalized"))


def _details(spark, sf, table):
    """The grid is written once: the scores and the detail tables read that."""
    from tidewise.operators.report import detail_tables
    grid = cut_lineage(orders_filled(spark, sf))
    scores = cut_lineage(scoring.scores_table(detect_all(grid, DetectionConfig(), METHODS), DetectionConfig(), methods=METHODS))
    return detail_tables(grid, scores, PERIODS, n=2)[table]


_TOP2 = "top2 AS (SELECT sensor FROM scores ORDER BY composite_score DESC, sensor LIMIT 2)"


@q("detail_components", O.with_(*_SC, _TOP2, "comps AS (SELECT r.sensor, CAST(r.period AS BIGINT) AS period, c.bin, r.y, r.trend, r.seasonal, r.residual FROM stl_rows r "
   "JOIN c ON c.sensor = r.sensor AND c.pos = r.i WHERE r.period = 30 AND r.sensor IN (SELECT sensor FROM top2))") + _COMPONENTS_SEL)
def _detail_components(spark, sf):
    return _rounded_components(_details(spark, sf, "components"))


@q("detail_acf", O.with_(*_SC, _TOP2, "cxs AS (SELECT * FROM cx WHERE sensor IN (SELECT sensor FROM top2))",
   "dls AS (SELECT sensor, max(n) AS n, sum(dx * dx) AS d, unnest(generate_series(0, least(200, max(n) // 2 - 1))) AS lag FROM cxs GROUP BY sensor)",
   "sms AS (SELECT dls.sensor, dls.lag, sum(a.dx * b.dx) AS s FROM dls JOIN cxs a ON a.sensor = dls.sensor JOIN cxs b ON b.sensor = a.sensor AND b.pos = a.pos + dls.lag GROUP BY 1, 2)")
   + "SELECT dls.sensor, CAST(dls.lag AS BIGINT) AS lag, ROUND(s / d, 6) + 0.0 AS acf, ROUND(1.96 / sqrt(CAST(n AS DOUBLE)), 6) + 0.0 AS conf_int_upper, "
   "ROUND(-1.96 / sqrt(CAST(n AS DOUBLE)), 6) + 0.0 AS conf_int_lower, CAST(NULL AS VARCHAR) AS error FROM dls JOIN sms ON sms.sensor = dls.sensor AND sms.lag = dls.lag")
def _detail_acf(spark, sf):
    return _details(spark, sf, "acf")


@q("detail_pacf", O.with_(*_SC, _TOP2, "ct AS (SELECT * FROM c WHERE sensor IN (SELECT sensor FROM top2))", *M.pacf_ctes(50, "ct"))
   + "SELECT sensor, lag, ROUND(pacf, 6) + 0.0 AS pacf, CAST(NULL AS VARCHAR) AS error FROM pacf")
def _detail_pacf(spark, sf):
    return _details(spark, sf, "pacf")


@q("detail_periodogram", O.with_(*_SC, _TOP2, "dst AS (SELECT sensor, max(t) AS span, avg(value) AS mean_y, var_pop(value) AS vyy FROM c WHERE sensor IN (SELECT sensor FROM top2) GROUP BY 1)",
   "dfr AS (SELECT * FROM (SELECT *, 0.002 + k * (1.0 / (10.0 * span)) AS f FROM (SELECT *, unnest(generate_series(0, CAST(round_even(0.498 / (1.0 / (10.0 * span)), 0) AS BIGINT))) AS k FROM dst)) WHERE 1.0 / f <= 100)",
   f"""dpw AS (SELECT fr.sensor, fr.k, fr.f, covar_pop(sin({O.TWO_PI} * fr.f * c.t), c.value - fr.mean_y) AS vsy, covar_pop(cos({O.TWO_PI} * fr.f * c.t), c.value - fr.mean_y) AS vcy,
        var_pop(sin({O.TWO_PI} * fr.f * c.t)) AS vss, var_pop(cos({O.TWO_PI} * fr.f * c.t)) AS vcc, covar_pop(sin({O.TWO_PI} * fr.f * c.t), cos({O.TWO_PI} * fr.f * c.t)) AS vsc, max(fr.vyy) AS vyy
      FROM dfr fr JOIN c ON c.sensor = fr.sensor GROUP BY 1, 2, 3)""")
   + f"SELECT sensor, CAST(k AS BIGINT) AS k, ROUND(f, 6) + 0.0 AS frequency, ROUND({O.r2_case()}, 6) + 0.0 AS power, ROUND(1.0 / f, 6) + 0.0 AS period, CAST(NULL AS VARCHAR) AS error FROM dpw")
def _detail_periodogram(spark, sf):
    return _details(spark, sf, "periodogram")


@q("detail_fit", O.with_(*_SC, _TOP2, *M.joint_ctes(PERIODS)) + f"SELECT c.sensor, CAST(c.bin AS VARCHAR) AS bin, ROUND(c.value, 6) + 0.0 AS value, ROUND({_FITTED}, 4) + 0.0 AS fitted, "
   "CAST(NULL AS VARCHAR) AS error FROM c JOIN joint ON joint.sensor = c.sensor WHERE c.sensor IN (SELECT sensor FROM top2)")
def _detail_fit(spark, sf):
    return _details(spark, sf, "fit").withColumn("fitted", F.round("fitted", 4) + 0.0)


@q("periodogram_slice_400")
def _periodogram_slice_400(spark, sf):
    """RP-6: the display slice of the full periodogram (period <= 400)."""
    return periodogram.periodogram_full(_events_filled(spark, sf), max_period=400)


ORACLE["periodogram_slice_400"] = ORACLE["periodogram_full"].replace(" AS error FROM pw", " AS error FROM pw WHERE 1.0 / f <= 400")


@q("result_json", O.with_(*O.detections_ctes(METHODS, PERIODS), *O.combine_ctes(METHODS, PERIODS), "mb AS (SELECT sensor, period, score, row_number() OVER (PARTITION BY sensor ORDER BY score DESC, period) AS i FROM det WHERE method = 'stl')")
   + """SELECT b.sensor, CAST(b.best_period AS BIGINT) AS best_period, ROUND(b.max_combined_score, 6) + 0.0 AS max_combined_score,
   (SELECT ROUND(combined_score, 6) + 0.0 FROM comb c WHERE c.sensor = b.sensor AND c.period = 30) AS combined_30,
   (SELECT ROUND(score, 6) + 0.0 FROM det d WHERE d.sensor = b.sensor AND method = 'acf' AND period = 365) AS acf_365,
   (SELECT significant FROM det d WHERE d.sensor = b.sensor AND method = 'periodogram' AND period = 7) AS periodogram_7_significant,
   mb.period AS stl_best_period, ROUND(mb.score, 6) + 0.0 AS stl_max_score FROM best b JOIN mb ON mb.sensor = b.sensor AND mb.i = 1""")
def _result_json(spark, sf):
    """DT-16: the JSON text of each sensor's result, read back by path."""
    from tidewise.operators.ensemble import result_json
    j = result_json(orders_detections(spark, sf), PERIODS, METHODS)
    at = lambda path, kind: F.get_json_object("json", path).cast(kind)
    return j.select("sensor", at("$.best_period", "long").alias("best_period"), at("$.max_combined_score", "double").alias("max_combined_score"),
                    at("$.combined_scores.30", "double").alias("combined_30"), at("$.method_results.acf.periods.365.score", "double").alias("acf_365"),
                    at("$.method_results.periodogram.periods.7.significant", "boolean").alias("periodogram_7_significant"),
                    at("$.method_results.stl.best_period", "long").alias("stl_best_period"), at("$.method_results.stl.max_score", "double").alias("stl_max_score"))


@q("cp_window_rbf", O.with_(*_CPW, *M.window_rbf_ctes(1.0)) + "SELECT sensor, CAST(cp_bin AS VARCHAR) AS cp_bin, CAST(NULL AS VARCHAR) AS error FROM cps")
def _cp_window_rbf(spark, sf):
    return segments.changepoints_pelt(orders_filled(spark, sf), model="rbf", min_size=30, penalty=1.0, method="window")



@q("stream_hourly_grid", "SELECT event_type AS sensor, CAST(date_trunc('hour', ts) AS VARCHAR) AS bin, "
   "ROUND(sum(value) / count(value), 6) + 0.0 AS value FROM events GROUP BY 1, 2")
def _stream_hourly_grid(spark, sf):
    """Structured Streaming ingest of the whole events table (file source, partials of each batch)."""
    from tidewise.streaming.ingest import run_stream_grid
    return run_stream_grid(spark, f"{sf.rstrip('/')}/events.parquet", "event_type", "ts", "value", "1 hour")



# ---- hourly grids: detectors with an hour time axis ----------------------------------------------------

HOURLY = (24, 168)
_HOUR_BASE = O.filled_ctes("events", "H") + O.clean_ctes("filled", gate=True, unit="hour")
_HOUR_CFG = DetectionConfig(periods=HOURLY, time_unit="hour")


def _events_hourly(spark, sf):
    from tidewise.operators.ensemble import eligible
    g = resample.resample_and_interpolate(readings(spark, sf, "events"), "H", "mean", "linear")
    return eligible(g, 100)[0]


@q("hourly_harmonic", O.with_(*_HOUR_BASE, *O.harmonic_ctes(HOURLY))
   + "SELECT sensor, period, ROUND(r2, 6) + 0.0 AS r2, ROUND(r2, 6) + 0.0 AS delta_r2, ROUND(sin_coef, 6) + 0.0 AS sin_coef, "
   "ROUND(cos_coef, 6) + 0.0 AS cos_coef, ROUND(score, 6) + 0.0 AS score, significant, error FROM det_fourier")
def _hourly_harmonic(spark, sf):
    return harmonic.harmonic_fit(_events_hourly(spark, sf), HOURLY, time_unit="hour")


@q("hourly_periodogram", O.with_(*_HOUR_BASE, *O.periodogram_ctes(HOURLY))
   + "SELECT sensor, period, ROUND(score, 6) + 0.0 AS score, significant, error, ROUND(power, 6) + 0.0 AS power, "
   "ROUND(actual_period, 6) + 0.0 AS actual_period, ROUND(fap, 6) + 0.0 AS fap FROM det_periodogram")
def _hourly_periodogram(spark, sf):
    return periodogram.periodogram_detect(_events_hourly(spark, sf), HOURLY, _HOUR_CFG)


@q("hourly_acf", O.with_(*_HOUR_BASE, *O.acf_ctes(HOURLY))
   + "SELECT sensor, period, ROUND(score, 6) + 0.0 AS score, significant, error, ROUND(peak_value, 6) + 0.0 AS peak_value, "
   "CAST(actual_lag AS BIGINT) AS actual_lag, ROUND(conf_int, 6) + 0.0 AS conf_int, CAST(max_lag AS BIGINT) AS max_lag FROM det_acf")
def _hourly_acf(spark, sf):
    return acf.acf_detect(_events_hourly(spark, sf), HOURLY, _HOUR_CFG)
