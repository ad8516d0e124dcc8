"""Lomb-Scargle detector (DT-10) and full periodogram (DT-11).

Frequency grid (the published automatic grid rule with the original limits): f_k = fmin + k df,
fmin = 1/max_period, df = 1/(samples_per_peak * span), Nf = 1 + round((1/min_period - fmin)/df),
t = whole days since the first point. Standard power with a fitted mean equals the R^2 of
``y ~ 1 + sin(2 pi f t) + cos(2 pi f t)``, i.e. the harmonic closed form at p = 1/f.

Exact FFTs over stacks of sensors evaluate every grid frequency in O(M log M), M = samples_per_peak x span. The native
band join (``periodogram_band_power``: the frequencies whose period lies strictly inside (0.8 p, 1.2 p), joined to the
points and reduced by partial aggregates) says the same without a kernel; tests compare the two.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewise.config import DetectionConfig
from tidewise.functions.columns import SENSOR
from tidewise.operators.detect_common import as_detection, clean, register
from tidewise.operators.harmonic import r2_from_moments
from tidewise.operators.spectra import frequency_grid, kernel_scores
from tidewise.operators.stacked import run_stacks

TWO_PI = 2.0 * math.pi


def sensor_stats(c: DataFrame) -> DataFrame:
    return c.groupBy(SENSOR).agg(
        F.count("value").alias("n"),
        F.max("t").alias("span"),
        F.avg("value").alias("mean_y"),
        F.var_pop("value").alias("vyy"),
        F.var_pop("t").alias("var_t"),
    )


def band_frequencies(stats: DataFrame, periods, cfg: DetectionConfig) -> DataFrame:
    """(sensor, period, k, f) for every grid frequency whose period is strictly inside (0.8p, 1.2p)."""
    fmin = 1.0 / cfg.periodogram_max_period
    fmax = 1.0 / cfg.periodogram_min_period
    df = 1.0 / (F.lit(float(cfg.periodogram_samples_per_peak)) * F.col("span"))
    nf = F.rint((F.lit(fmax - fmin)) / df).cast("long") + 1
    s = stats.filter(F.col("span") > 0).select(SENSOR, "span", df.alias("df"), nf.alias("nf"))
    s = s.withColumn("period", F.explode(F.array(*[F.lit(int(p)) for p in periods])))
    lo_f = F.lit(1.0) / (F.col("period") * 1.2)
    hi_f = F.lit(1.0) / (F.col("period") * 0.8)
    k_lo = F.greatest(F.floor((lo_f - fmin) / F.col("df")) - 1, F.lit(0))
    k_hi = F.least(F.ceil((hi_f - fmin) / F.col("df")) + 1, F.col("nf") - 1)
    s = s.withColumn("k_lo", k_lo.cast("long")).withColumn("k_hi", k_hi.cast("long")).filter(F.col("k_hi") >= F.col("k_lo"))
    k = s.withColumn("k", F.explode(F.sequence("k_lo", "k_hi")))
    k = k.withColumn("f", F.lit(fmin) + F.col("k") * F.col("df"))
    per = F.lit(1.0) / F.col("f")
    return k.filter((per > F.col("period") * 0.8) & (per < F.col("period") * 1.2)).select(SENSOR, "period", "k", "f")


def periodogram_band_power(grid: DataFrame, periods=(7, 30, 365), cfg: DetectionConfig = DetectionConfig()) -> DataFrame:
    """(sensor, period, k, f, power) for the band frequencies of each period."""
    c = clean(grid, cfg.time_unit).select(SENSOR, "t", "value")
    st = sensor_stats(c)
    freqs = band_frequencies(st, periods, cfg)
    pts = c.join(st.select(SENSOR, "mean_y"), SENSOR).select(SENSOR, "t", (F.col("value") - F.col("mean_y")).alias("yc"))
    j = freqs.join(pts, SENSOR)
    ang = F.lit(TWO_PI) * F.col("f") * F.col("t")
    s, co, y = F.sin(ang), F.cos(ang), F.col("yc")
    m = j.groupBy(SENSOR, "period", "k", "f").agg(
        F.covar_pop(s, y).alias("vsy"),
        F.covar_pop(co, y).alias("vcy"),
        F.var_pop(s).alias("vss"),
        F.var_pop(co).alias("vcc"),
        F.covar_pop(s, co).alias("vsc"),
    )
    m = m.join(st.select(SENSOR, "vyy"), SENSOR)
    r2, _, _ = r2_from_moments(F.col("vsy"), F.col("vcy"), F.col("vss"), F.col("vcc"), F.col("vsc"), F.col("vyy"))
    return m.select(SENSOR, "period", "k", "f", r2.alias("power"))


def periodogram_detect(grid: DataFrame, periods=(7, 30, 365), cfg: DetectionConfig = DetectionConfig()) -> DataFrame:
    """Per (sensor, period): peak power in the band, the period at the peak, Baluev FAP.

    score = min(power, 1); significant when FAP < threshold; an empty band gives score 0
    with ``period_out_of_range``. Ties go to the lowest frequency (first in grid order).
    """
    return kernel_scores(grid, periods, cfg, ("periodogram",)).select(
        SENSOR, "period", "score", "significant", "error", "power", "actual_period", "fap")


@register("periodogram", kernel=True)
def detect_periodogram(grid: DataFrame, periods, cfg: DetectionConfig = DetectionConfig()) -> DataFrame:
    return as_detection(periodogram_detect(grid, periods, cfg), "periodogram")


def periodogram_full(grid: DataFrame, cfg: DetectionConfig = DetectionConfig(), max_period: float | None = None) -> DataFrame:
    """DT-11: (sensor, k, frequency, power, period, error) over the whole grid by exact FFTs; with ``max_period`` only the
    frequencies of at most this period (RP-6). A sensor without a span has no rows, one that failed has one with ``error``."""
    from tidewise.kernels.spectral import periodogram_stack

    def run(names, t, Y, bins):
        span = float(t.max())
        k, f, power = np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros((len(names), 0))
        if span > 0:
            fmin, df, nf = frequency_grid(span, cfg)
            k = np.arange(nf, dtype=np.int64)
            f = fmin + k * df
            power = periodogram_stack(t, Y, fmin, df, nf)
            if max_period is not None:
                kept = 1.0 / f <= max_period
                k, f, power = k[kept], f[kept], power[:, kept]
        rows = len(k) * len(names)
        return {"sensor": np.repeat(np.array(names, dtype=object), len(k)), "k": np.tile(k, len(names)), "frequency": np.tile(f, len(names)),
                "power": power.ravel(), "period": np.tile(1.0 / f, len(names)), "error": [None] * rows}

    return run_stacks(grid, run, "sensor string, k long, frequency double, power double, period double, error string", cfg.time_unit)
