"""The batch analysis as one Spark plan (the original ``run`` command, minus drawing).

readings -> grid (resample + optional outlier removal + interpolation) -> eligibility gate ->
detectors -> scores -> ranking / summary. The grid and the detection table are reused by
several consumers, so ``materialize=True`` writes each once into the shared checkpoint folder
(``spark.checkpoint.dir``): reuse without recomputation and lineage that survives lost executors.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from tidewise.config import DetectionConfig, PreprocessingConfig, RunConfig
from tidewise.operators import impute, outliers, resample, segments
from tidewise.operators.ensemble import detect_all, eligible
from tidewise.operators.quality import run_checks
from tidewise.operators.scoring import ranked_scores, ranking, scores_table, summary_statistics
from tidewise.session import cut_lineage


class Tables(Mapping):
    """The tables of a run, each planned when it is first asked for (some run a job for that)."""

    def __init__(self, **made: Callable[[], DataFrame]):
        self._made, self._known = made, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._known:
            self._known[name] = self._made[name]()
        return self._known[name]

    def __iter__(self):
        return iter(self._made)

    def __len__(self):
        return len(self._made)


def preprocess(readings: DataFrame, cfg: PreprocessingConfig = PreprocessingConfig(), shared_range: bool = False,
               remove_outliers: bool = False, min_records: int | None = None) -> DataFrame:
    grid = resample.resample(readings, cfg.resample_freq, cfg.resample_method, shared_range, min_records)
    if remove_outliers and cfg.outlier_method != "none":
        grid = outliers.remove_outliers(grid, cfg.outlier_method, cfg.outlier_threshold, replace_with="nan")
    m = cfg.impute_method
    if m == "linear":
        return impute.interpolate_linear(grid, direction="forward")
    if m == "spline":
        return impute.interpolate_spline(grid)
    if m == "ffill":
        return impute.forward_fill(grid)
    if m == "none":
        return grid
    raise ValueError(f"Unknown impute method: {m}")


def changepoints(grid: DataFrame, cfg: PreprocessingConfig) -> DataFrame | None:
    """(sensor, cp_bin, error) by the configured method, penalty and smallest segment; None where none is configured."""
    if cfg.changepoint_method == "none":
        return None
    return segments.detect_changepoints(grid, cfg.changepoint_method, min_size=cfg.min_segment_size, penalty=cfg.changepoint_penalty)


def analyze(readings: DataFrame, cfg: RunConfig = RunConfig(), methods=None, materialize: bool = False,
            remove_outliers: bool = False) -> Tables:
    """grid, skipped, detections, scores, ranking, summary, checks (the five health checks of a run) and, with a
    changepoint method configured, changepoints, segments and segment_stats. ``materialize`` writes grid, detections and scores once each."""
    det: DetectionConfig = cfg.detection
    methods = list(methods or det.methods)
    # sensors with too few readings are skipped before gaps are filled, which would hide them
    grid = preprocess(readings, cfg.preprocessing, remove_outliers=remove_outliers, min_records=det.min_points)
    if materialize:
        grid = cut_lineage(grid)
    ok, skipped = eligible(grid, det.min_points)
    detections = detect_all(ok, det, methods, gate=False)
    if materialize:
        detections = cut_lineage(detections)
    scores = scores_table(detections, det, cfg.scoring, methods)
    ranked = []
    if materialize:
        scores, by_rank = ranked_scores(scores)
        ranked.append(by_rank)
    made = {
        "grid": lambda: grid,
        "skipped": lambda: skipped,
        "detections": lambda: detections,
        "scores": lambda: scores,
        "ranking": lambda: ranked[0] if ranked else ranking(scores),
        "summary": lambda: summary_statistics(scores),
        "checks": lambda: run_checks(readings, grid, detections, scores),
    }
    found = changepoints(ok, cfg.preprocessing)
    if found is not None:
        if materialize:
            found = cut_lineage(found)
        parts = segments.segments(ok, found)
        made |= {"changepoints": lambda: found, "segments": lambda: parts, "segment_stats": lambda: segments.segment_statistics(None, segmented=parts)}
    return Tables(**made)
