"""tidewise: periodicity analytics on Spark DataFrames.

Canonical data is a long table ``readings(sensor STRING, ts TIMESTAMP_NTZ,
value DOUBLE)``. Raw readings are first reduced onto a regular grid with a
partially aggregated ``groupBy(sensor, bin)``; every per-sensor window,
exact percentile or numpy kernel then runs on the grid, whose size per sensor
is bounded by the calendar span, never by the raw row count.
"""

from tidewise.config import (  # noqa: F401
    DataConfig,
    DetectionConfig,
    PreprocessingConfig,
    ScoringConfig,
    RunConfig,
)

__version__ = "0.1.0"
