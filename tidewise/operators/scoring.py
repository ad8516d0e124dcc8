"""Scoring, labels and ranking (SC-1..SC-7, RK-1..RK-8).

The scores table has one row per sensor; its wide layout comes from a ``pivot`` with an
explicit value list, so the schema is fixed by the config and no extra job is run to
discover the keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewise.config import DetectionConfig, ScoringConfig, Thresholds
from tidewise.functions.columns import SENSOR, distributed_row_number, numbered, ordered_parts
from tidewise.functions.quantiles import selected_quantiles
from tidewise.operators.ensemble import wide_scores

LEVELS = {"High": 3, "Medium": 2, "Low": 1, "None": 0}


def normalize_score(value: Column, lo: float = 0.0, hi: float = 1.0) -> Column:
    """SC-1: clip-normalise to [0, 1]; NULL/NaN -> 0; hi <= lo -> 0."""
    if hi <= lo:
        return F.lit(0.0)
    x = (value - F.lit(lo)) / F.lit(hi - lo)
    return F.when(value.isNull() | F.isnan(value), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)))







def _thr(t: Thresholds, scale: float = 1.0) -> list[str]:
    return [f"stl_max > {t.stl_strength * scale!r}D", f"acf_max > {t.acf_peak * scale!r}D",
            f"fourier_max > {t.delta_r2 * scale!r}D"]


def scores_table(detections: DataFrame, det: DetectionConfig = DetectionConfig(), sc: ScoringConfig = ScoringConfig(),
                 methods=None) -> DataFrame:
    """RK-1 (SC-2..SC-4, SC-6, SC-7): one row per sensor with every method/period score, combined
    scores, best period, composite and both labels. One pivot of the detections, then the
    derived columns as SQL text in two projections (cheap to plan): no join, no second pass."""
    methods = list(methods or det.methods)
    periods = [int(p) for p in det.periods]
    w = wide_scores(detections, periods, methods)
    keys = [f"{m}_{p}" for m in methods for p in periods]
    n = float(len(methods))
    maxes = [f"greatest(0.0D, {', '.join(f'{m}_{p}' for p in periods)}) AS {m}_max" for m in methods]
    maxes += [f"0.0D AS {m}_max" for m in ("stl", "acf", "fourier") if m not in methods]
    comb = [f"({' + '.join(f'{m}_{p}' for m in methods)}) / {n!r}D AS combined_{p}" for p in periods]
    t = w.selectExpr("sensor", *keys, *maxes, *comb)
    # best period: highest combined score, first in the requested order on ties
    best = "CAST(NULL AS STRUCT<s: DOUBLE, p: BIGINT>)"
    for p in periods:
        best = (f"CASE WHEN ({best}) IS NULL OR combined_{p} > ({best}).s "
                f"THEN named_struct('s', combined_{p}, 'p', {p}L) ELSE ({best}) END")
    comp = (f"{sc.weight('stl')!r}D * stl_max + {sc.weight('acf')!r}D * acf_max "
            f"+ {sc.weight('fourier')!r}D * least(fourier_max * 10.0D, 1.0D)")
    n_ok = " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for c in _thr(sc.strict))
    sig, strong, weak = (" OR ".join(_thr(sc.exploratory)), " OR ".join(_thr(sc.strict)),
                         " OR ".join(_thr(sc.exploratory, 0.5)))
    lab = list(sc.labels)
    return t.selectExpr(
        "*",
        f"named_struct('b', {best}).b.p AS best_period",
        f"named_struct('b', {best}).b.s AS max_combined_score",
        f"{comp} AS composite_score",
        f"CASE {n_ok} WHEN 3 THEN '{lab[0]}' WHEN 2 THEN '{lab[1]}' WHEN 1 THEN '{lab[2]}' ELSE '{lab[3]}' END AS confidence_strict",
        f"CASE WHEN ({sig}) AND ({strong}) THEN '{lab[0]}' WHEN ({sig}) THEN '{lab[1]}' WHEN ({weak}) THEN '{lab[2]}' "
        f"ELSE '{lab[3]}' END AS confidence_exploratory",
    )


def _rank_order(sort_by: str, ascending: bool) -> list[Column]:
    return [F.col(sort_by).asc_nulls_last() if ascending else F.col(sort_by).desc_nulls_last(), F.col(SENSOR).asc()]


def ranking(scores: DataFrame, sort_by: str = "composite_score", ascending: bool = False) -> DataFrame:
    """RK-2: ``rank`` 1..n first; ties by sensor. Distributed: range-partitioned sort plus
    per-partition offsets (no single-task window over all sensors). Runs its sort when called."""
    r = distributed_row_number(scores, _rank_order(sort_by, ascending), "rank")
    return r.select("rank", *[c for c in scores.columns])


def ranked_scores(scores: DataFrame, sort_by: str = "composite_score", ascending: bool = False) -> tuple[DataFrame, DataFrame]:
    """(scores, ranking) from one written table: the scores are written in rank order, so that ranking needs no sort of its own."""
    from tidewise.session import cut_lineage

    order = _rank_order(sort_by, ascending)
    ordered = cut_lineage(ordered_parts(scores, order), "scores")
    return ordered.drop("_pid"), numbered(ordered, order).select("rank", *scores.columns)


def top_sensors(scores: DataFrame, n: int = 10, min_confidence: str = "Low", mode: str = "strict") -> DataFrame:
    """RK-3: top n by composite among sensors at or above a label (TakeOrderedAndProject)."""
    col = f"confidence_{mode}"
    lvl = F.element_at(F.create_map(*[x for k, v in LEVELS.items() for x in (F.lit(k), F.lit(v))]), F.col(col))
    return (
        scores.filter(lvl >= LEVELS.get(min_confidence, 0))
        .orderBy(F.col("composite_score").desc(), F.col(SENSOR).asc())
        .limit(n)
    )


def label_distribution(scores: DataFrame, mode: str = "strict") -> DataFrame:
    """RK-4 / RP-3: label counts and percentage of all scored sensors."""
    col = f"confidence_{mode}"
    c = scores.groupBy(F.col(col).alias("label")).agg(F.count(F.lit(1)).cast("long").alias("count"))
    total = F.sum("count").over(Window.partitionBy())  # at most four label rows
    return c.select("label", "count", (F.col("count") * 100.0 / total).alias("percentage"))


def filter_by_period(scores: DataFrame, period: int, min_score: float = 0.0) -> DataFrame:
    """RK-5: combined_{p} >= min_score; an unknown period returns the input unchanged."""
    c = f"combined_{period}"
    if c not in scores.columns:
        return scores
    return scores.filter(F.col(c) >= min_score)


def period_agreement(detections: DataFrame, methods) -> DataFrame:
    """SC-5: per (sensor, period) method scores, sorted significant methods, count, combined, share."""
    n = float(len(methods))
    return detections.groupBy(SENSOR, "period").agg(
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("significant"), F.col("method")))), ",").alias("significant_methods"),
        F.count_if(F.col("significant")).cast("long").alias("num_significant"),
        (F.sum("score") / n).alias("combined_score"),
        (F.count_if(F.col("significant")) / n).alias("agreement"),
        *[F.coalesce(F.max(F.when(F.col("method") == m, F.col("score"))), F.lit(0.0)).alias(f"{m}_score") for m in methods],
    )


def summary_statistics(scores: DataFrame, methods=("stl", "acf", "fourier", "periodogram")) -> DataFrame:
    """RK-6 in long form ``(section, key, value)``; one aggregate row unpivoted with ``stack``,
    plus the three distributions (label counts, best-period counts) as grouped counts."""
    present = [m for m in methods if f"{m}_max" in scores.columns]
    aggs = ["CAST(count(1) AS DOUBLE) AS total_sensors", "avg(composite_score) AS composite_mean",
            "stddev_samp(composite_score) AS composite_std", "min(composite_score) AS composite_min",
            "max(composite_score) AS composite_max"]
    for m in present:
        aggs += [f"avg({m}_max) AS {m}_mean", f"stddev_samp({m}_max) AS {m}_std", f"max({m}_max) AS {m}_maxv"]
    # the median is exact but distributed (no single group with every sensor's score)
    med = selected_quantiles(scores, [], "composite_score", [0.5]).agg(F.max(F.col("_q")[0])).scalar()
    row = scores.agg(*[F.expr(a) for a in aggs]).select("*", med.alias("composite_median"))
    entries = [("overall", "total_sensors", "total_sensors")]
    entries += [("composite_score_stats", k, f"composite_{k}") for k in ("mean", "std", "min", "max", "median")]
    for m in present:
        entries += [(f"{m}_stats", k, c) for k, c in (("mean", f"{m}_mean"), ("std", f"{m}_std"), ("max", f"{m}_maxv"))]
    stack = ", ".join(f"'{a}', '{b}', {c}" for a, b, c in entries)
    stats = row.selectExpr(f"stack({len(entries)}, {stack}) AS (section, key, value)")
    out = stats
    for sec, col in (("confidence_distribution_strict", "confidence_strict"),
                     ("confidence_distribution_exploratory", "confidence_exploratory"),
                     ("best_period_distribution", "best_period")):
        out = out.unionByName(scores.groupBy(F.col(col).cast("string").alias("key")).agg(F.count(F.lit(1)).cast("double").alias("value"))
                              .selectExpr(f"'{sec}' AS section", "key", "value"))
    return out


def compare_runs(a: DataFrame, b: DataFrame) -> DataFrame:
    """RK-7: full outer join of two rankings on sensor; rank delta and label change."""
    x = a.select(SENSOR, F.col("rank").alias("rank_a"), F.col("composite_score").alias("score_a"),
                 F.col("confidence_strict").alias("label_a"))
    y = b.select(SENSOR, F.col("rank").alias("rank_b"), F.col("composite_score").alias("score_b"),
                 F.col("confidence_strict").alias("label_b"))
    j = x.join(y, SENSOR, "full_outer")
    return j.select(
        SENSOR, "rank_a", "rank_b", (F.col("rank_b") - F.col("rank_a")).alias("rank_delta"),
        "score_a", "score_b", (F.col("score_b") - F.col("score_a")).alias("score_delta"),
        "label_a", "label_b", (~F.col("label_a").eqNullSafe(F.col("label_b"))).alias("label_changed"),
    )


def compare_variants(variants: dict[str, DataFrame]) -> DataFrame:
    """RK-8: union of scores tables tagged with a ``variant``, summarised per variant."""
    parts = [s.select(F.lit(k).alias("variant"), SENSOR, "composite_score", "confidence_strict") for k, s in variants.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("variant").agg(
        F.count(F.lit(1)).cast("long").alias("n_sensors"),
        F.avg("composite_score").alias("mean_composite"),
        F.max("composite_score").alias("max_composite"),
        F.count_if(F.col("confidence_strict") == "High").cast("long").alias("n_high"),
    )
