"""Plain frozen dataclasses carrying the defaults of the original tool."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class DataConfig:
    date_column: str = "date"
    time_column: str | None = "time"
    sensor_columns: tuple[str, ...] | None = None
    sensor_prefix: str = "sensor_"


@dataclass(frozen=True)
class PreprocessingConfig:
    resample_freq: str = "D"
    resample_method: str = "mean"          # mean | median | ffill
    outlier_method: str = "none"           # iqr | zscore | iforest | none (off by default, as in the run)
    outlier_threshold: float | None = None  # None: the method's own default
    impute_method: str = "linear"          # linear | spline | ffill | none
    changepoint_method: str = "none"       # pelt | window | none
    changepoint_penalty: float = 10.0
    min_segment_size: int = 30


@dataclass(frozen=True)
class DetectionConfig:
    periods: tuple[int, ...] = (7, 30, 365)
    methods: tuple[str, ...] = ("stl", "acf", "periodogram", "fourier")
    stl_seasonal: int = 7
    stl_robust: bool = True
    stl_strength_threshold: float = 0.5
    acf_max_lag: int = 400
    acf_tolerance: int = 3
    acf_peak_threshold: float = 0.3
    periodogram_min_period: int = 2
    periodogram_max_period: int = 500
    periodogram_samples_per_peak: int = 10
    fap_threshold: float = 0.05
    fourier_delta_r2_threshold: float = 0.1
    min_points: int = 100
    # whole-unit time axis of the harmonic / Lomb-Scargle models: "day" (the original; sub-daily
    # grids collapse onto whole days) or "hour" (for hourly grids, periods then count hours)
    time_unit: str = "day"


@dataclass(frozen=True)
class Thresholds:
    stl_strength: float
    acf_peak: float
    delta_r2: float


@dataclass(frozen=True)
class ScoringConfig:
    mode: str = "strict"
    # fixed values: default thresholds and weights of the original tool
    strict: Thresholds = Thresholds(stl_strength=0.5, acf_peak=0.3, delta_r2=0.1)
    exploratory: Thresholds = Thresholds(stl_strength=0.2, acf_peak=0.15, delta_r2=0.05)
    weights: tuple[tuple[str, float], ...] = (("stl", 0.3), ("acf", 0.3), ("fourier", 0.4))
    labels: tuple[str, ...] = ("High", "Medium", "Low", "None")

    def weight(self, method: str) -> float:
        return dict(self.weights).get(method, 0.0)


@dataclass(frozen=True)
class RunConfig:
    data: DataConfig = field(default_factory=DataConfig)
    preprocessing: PreprocessingConfig = field(default_factory=PreprocessingConfig)
    detection: DetectionConfig = field(default_factory=DetectionConfig)
    scoring: ScoringConfig = field(default_factory=ScoringConfig)
