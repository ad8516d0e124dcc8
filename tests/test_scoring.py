import pytest

# expected values and inputs: fixed values
from pyspark.sql import functions as F

from tidewise.config import DetectionConfig, ScoringConfig
from tidewise.operators import scoring


def one_row(spark, stl, acf, fourier, cfg=ScoringConfig()):
    """The scores of one sensor with these method scores at one period."""
    rows = [("s", m, 7, v) for m, v in (("stl", stl), ("acf", acf), ("fourier", fourier))]
    found = spark.createDataFrame(rows, "sensor string, method string, period long, score double")
    return scoring.scores_table(found, DetectionConfig(periods=(7,)), cfg, ("stl", "acf", "fourier")).first()


def test_normalize(spark):
    df = spark.createDataFrame([(0.5,), (2.0,), (-1.0,), (float("nan"),), (None,)], "v double")
    got = [r[0] for r in df.select(scoring.normalize_score(F.col("v"))).collect()]
    assert got == [0.5, 1.0, 0.0, 0.0, 0.0]


def test_composite_default_weights(spark):
    r = one_row(spark, 0.6, 0.4, 0.1)["composite_score"]
    assert r == pytest.approx(0.3 * 0.6 + 0.3 * 0.4 + 0.4 * 1.0)


def test_composite_custom_weights(spark):
    cfg = ScoringConfig(weights=(("stl", 0.5), ("acf", 0.5), ("fourier", 0.0)))
    r = one_row(spark, 0.5, 0.5, 0.05, cfg)["composite_score"]
    assert r == pytest.approx(0.5)


@pytest.mark.parametrize("vals,label", [((0.6, 0.4, 0.15), "High"), ((0.6, 0.4, 0.05), "Medium"),
                                        ((0.6, 0.2, 0.05), "Low"), ((0.3, 0.1, 0.01), "None")])
def test_strict_labels(spark, vals, label):
    assert one_row(spark, *vals)["confidence_strict"] == label


def test_exploratory_label(spark):
    assert one_row(spark, 0.3, 0.2, 0.03)["confidence_exploratory"] in ("High", "Medium")


def _scores(spark):
    rows = [("s1", 0.8, "High"), ("s2", 0.5, "High"), ("s3", 0.9, "Medium"), ("s4", 0.3, "Low"), ("s5", 0.1, "None")]
    return spark.createDataFrame(rows, "sensor string, composite_score double, confidence_strict string")


def test_ranking_order(spark):
    r = scoring.ranking(_scores(spark).limit(4)).orderBy("rank").collect()
    assert [x["sensor"] for x in r] == ["s3", "s1", "s2", "s4"] and [x["rank"] for x in r] == [1, 2, 3, 4]
    assert scoring.ranking(_scores(spark)).columns[0] == "rank"


def test_label_distribution(spark):
    d = {r["label"]: r["count"] for r in scoring.label_distribution(_scores(spark)).collect()}
    assert d == {"High": 2, "Medium": 1, "Low": 1, "None": 1}


def test_top_sensors_respects_label_floor(spark):
    t = [r["sensor"] for r in scoring.top_sensors(_scores(spark), n=10, min_confidence="Medium").collect()]
    assert t == ["s3", "s1", "s2"]


def test_filter_by_period_unknown_returns_input(spark):
    s = _scores(spark)
    assert scoring.filter_by_period(s, 99).count() == 5


def test_end_to_end_run(spark):
    import numpy as np
    from conftest import make_series
    from tidewise.plans.run import analyze
    t = np.arange(400)
    y = 100 + 10 * np.sin(2 * np.pi * t / 7) + np.random.default_rng(1).normal(0, 1, 400)
    out = analyze(make_series(spark, list(y)))
    rk = out["ranking"].collect()
    assert len(rk) == 1 and rk[0]["rank"] == 1
    assert rk[0]["confidence_strict"] in ("High", "Medium")
    assert 0.0 <= rk[0]["composite_score"] <= 1.0
    summary = {(r["section"], r["key"]): r["value"] for r in out["summary"].collect()}
    assert summary[("overall", "total_sensors")] == 1.0
