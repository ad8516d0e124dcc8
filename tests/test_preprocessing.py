import math

import numpy as np
import pytest

from conftest import collect_values, make_series, to_grid
from tidewise.operators import impute, outliers, resample, segments

LIST10 = [1, None, 3, None, 5, 6, None, 8, 9, 10]


def test_daily_mean_of_hourly(spark):
    r = make_series(spark, list(range(48)), freq="h")
    g = resample.resample(r, "D", "mean")
    assert collect_values(g) == [11.5, 35.5]


def test_daily_median_two_rows(spark):
    r = make_series(spark, list(range(48)), freq="h")
    g = resample.resample(r, "D", "median")
    assert collect_values(g) == [11.5, 35.5]


def test_resample_then_linear_has_no_nulls(spark):
    r = make_series(spark, LIST10)
    g = resample.resample_and_interpolate(r, "D", "mean", "linear")
    assert all(v is not None for v in collect_values(g))


def test_resample_only_keeps_three_nulls(spark):
    r = make_series(spark, LIST10)
    g = resample.resample(r, "D", "mean")
    assert sum(v is None for v in collect_values(g)) == 3


def test_empty_days_inside_range_are_null(spark):
    from datetime import datetime
    rows = [("a", datetime(2024, 1, 1, 5), 1.0), ("a", datetime(2024, 1, 4, 7), 4.0), ("a", datetime(2024, 1, 4, 9), None)]
    r = spark.createDataFrame(rows, "sensor string, ts timestamp_ntz, value double")
    assert collect_values(resample.resample(r, "D", "mean")) == [1.0, None, None, 4.0]


def test_ffill_is_asof_at_midnight(spark):
    from datetime import datetime
    rows = [("a", datetime(2024, 1, 1, 5), 1.0), ("a", datetime(2024, 1, 2, 0), 2.0), ("a", datetime(2024, 1, 3, 9), None),
            ("a", datetime(2024, 1, 5, 1), 7.0)]
    r = spark.createDataFrame(rows, "sensor string, ts timestamp_ntz, value double")
    # day1: nothing at or before 00:00 -> NULL; day2: reading at 00:00; day3: carries 2.0 (09:00 is after the label);
    # day4: the NULL reading of day 3 is the last row -> NULL; day5: still NULL (01:00 is after midnight)
    assert collect_values(resample.resample(r, "D", "ffill")) == [None, 2.0, 2.0, None, None]


def test_weekly_bins_end_on_sunday(spark):
    r = make_series(spark, list(range(14)), start="2024-01-01")  # Monday
    g = resample.resample(r, "W", "mean").orderBy("bin").collect()
    assert [str(x["bin"]) for x in g] == ["2024-01-07", "2024-01-14"]
    assert [x["value"] for x in g] == [3.0, 10.0]


def test_monthly_and_hourly_labels(spark):
    r = make_series(spark, list(range(60)), start="2024-01-15")
    g = resample.resample(r, "M", "mean").orderBy("bin").collect()
    assert [str(x["bin"]) for x in g] == ["2024-01-31", "2024-02-29", "2024-03-31"]
    h = resample.resample(make_series(spark, [1, 2, 3], freq="30min"), "H", "mean").orderBy("bin").collect()
    assert [x["value"] for x in h] == [1.5, 3.0]


def test_shared_range_extends_every_sensor(spark):
    a = make_series(spark, [1, 2, 3], start="2024-01-01", sensor="a")
    b = make_series(spark, [5], start="2024-01-05", sensor="b")
    g = resample.resample(a.unionByName(b), "D", "mean", shared_range=True)
    counts = {r["sensor"]: r["count"] for r in g.groupBy("sensor").count().collect()}
    assert counts == {"a": 5, "b": 5}


def test_iqr_flags_only_index_6(spark):
    vals = [10, 11, 10, 12, 11, 10, 50, 11, 10, 12]
    f = outliers.flag_iqr(to_grid(spark, vals), 1.5).orderBy("bin").collect()
    assert [i for i, r in enumerate(f) if r["is_outlier"]] == [6]


def test_zscore_flags_index_50(spark):
    rng = np.random.default_rng(42)
    vals = rng.normal(100, 10, 100)
    vals[50] = 200
    f = outliers.flag_zscore(to_grid(spark, list(vals)), 3.0).orderBy("bin").collect()
    assert 50 in [i for i, r in enumerate(f) if r["is_outlier"]]


def test_replace_outlier_by_null_and_median(spark):
    vals = [10, 11, 10, 12, 11, 10, 50, 11, 10, 12]
    g = to_grid(spark, vals)
    nulled = collect_values(outliers.remove_outliers(g, "iqr", 1.5, "nan"))
    assert nulled[6] is None and sum(v is None for v in nulled) == 1
    med = collect_values(outliers.remove_outliers(g, "iqr", 1.5, "median"))
    assert med[6] == 11.0


def test_rolling_zscore_even_window_frame(spark):
    vals = [1.0] * 20 + [30.0] + [1.0] * 20
    f = outliers.flag_rolling(to_grid(spark, vals), window=10, threshold=2.0).orderBy("bin").collect()
    assert [i for i, r in enumerate(f) if r["is_outlier"]] == [20]


def test_linear_fill_values(spark):
    out = collect_values(impute.interpolate_linear(to_grid(spark, LIST10), direction="both"))
    assert out[1] == 2.0 and out[3] == 4.0 and out[6] == 7.0


def test_linear_directions_at_edges(spark):
    vals = [None, 2, None, 4, None]
    fwd = collect_values(impute.interpolate_linear(to_grid(spark, vals), direction="forward"))
    both = collect_values(impute.interpolate_linear(to_grid(spark, vals), direction="both"))
    assert fwd == [None, 2.0, 3.0, 4.0, 4.0]
    assert both == [2.0, 2.0, 3.0, 4.0, 4.0]


def test_limit_fills_from_each_side(spark):
    vals = [1, None, None, None, 5]
    out = collect_values(impute.interpolate_linear(to_grid(spark, vals), direction="both", limit=1))
    assert out == [1.0, 2.0, None, 4.0, 5.0]


def test_ffill_bfill_limits(spark):
    vals = [1, None, None, None, 5]
    assert collect_values(impute.forward_fill(to_grid(spark, vals), limit=2)) == [1.0, 1.0, 1.0, None, 5.0]
    assert collect_values(impute.backward_fill(to_grid(spark, vals), limit=1)) == [1.0, None, None, 5.0, 5.0]
    assert collect_values(impute.backward_fill(to_grid(spark, vals))) == [1.0, 5.0, 5.0, 5.0, 5.0]


def test_seasonal_mean_fill(spark):
    vals = [float(i % 7) for i in range(21)]
    vals[8] = None  # a Tuesday (2024-01-09): weekday 1 -> mean of the other Tuesdays
    out = collect_values(impute.fill_seasonal_mean(to_grid(spark, vals), 7))
    assert out[8] == 1.0


def test_spline_fill_passes_through_points(spark):
    x = np.arange(30, dtype=float)
    vals = list(np.sin(x / 4.0))
    vals[10] = None
    vals[11] = None
    out = collect_values(impute.interpolate_spline(to_grid(spark, vals)))
    assert abs(out[10] - math.sin(10 / 4.0)) < 0.01 and abs(out[11] - math.sin(11 / 4.0)) < 0.01


def test_gap_report(spark):
    vals = [1, None, None, None, 5, 6, None, 8, 9, 10]
    r = impute.missing_report(to_grid(spark, vals)).collect()[0]
    assert (r["total_count"], r["missing_count"], r["missing_rate"], r["max_gap"], r["num_gaps"]) == (10, 4, 0.4, 3, 2)
    assert r["mean_gap"] == 2.0


def test_pelt_finds_a_level_shift(spark):
    rng = np.random.default_rng(42)
    vals = list(np.r_[rng.normal(10, 1, 100), rng.normal(20, 1, 100)])
    for model in ("l2", "rbf"):
        cps = segments.changepoints_pelt(to_grid(spark, vals), model=model, min_size=30, penalty=5.0).collect()
        assert len(cps) >= 1 and all(r["error"] is None for r in cps)


def test_window_l2_finds_the_shift(spark):
    rng = np.random.default_rng(7)
    vals = list(np.r_[rng.normal(10, 1, 100), rng.normal(20, 1, 100)])
    cps = segments.changepoints_window_l2(to_grid(spark, vals), penalty=100.0).collect()
    assert len(cps) == 1
    assert str(cps[0]["cp_bin"]) == "2024-04-09"  # index 99: last point of the left segment


def test_segments_share_the_boundary_row(spark):
    from datetime import date
    g = to_grid(spark, list(range(100)))
    cps = spark.createDataFrame([("s1", date(2024, 2, 20))], "sensor string, cp_bin date")  # day 50
    st = segments.segment_statistics(g, cps).orderBy("segment").collect()
    assert [r["segment"] for r in st] == [1, 2]
    assert [r["n_points"] for r in st] == [51, 50]


def test_iforest_flags_the_spike(spark):
    rng = np.random.default_rng(3)
    vals = list(rng.normal(10, 1, 200))
    vals[77] = 60.0
    g = to_grid(spark, vals)
    f = outliers.flag_iforest(g, contamination=0.01).orderBy("bin").collect()
    flagged = [i for i, r in enumerate(f) if r["is_outlier"]]
    assert 77 in flagged and len(flagged) <= 3
    assert g.columns == ["sensor", "bin", "value"]


def test_window_method_other_costs(spark):
    rng = np.random.default_rng(11)
    vals = list(np.r_[rng.normal(10, 1, 100), rng.normal(20, 1, 100)])
    cps = segments.detect_changepoints(to_grid(spark, vals), method="window", model="rbf", penalty=1.0).collect()
    assert len(cps) >= 1
    assert any(abs((r["cp_bin"] - __import__("datetime").date(2024, 1, 1)).days - 99) <= 5 for r in cps)


def test_spline_orders_reproduce_polynomials(spark):
    x = np.arange(40.0) / 10
    for order in (1, 2, 3, 5):
        full = sum((x - 1.5) ** d for d in range(order + 1))
        vals = [None if i in (0, 5, 6, 17, 18, 19, 30, 38, 39) else float(v) for i, v in enumerate(full)]
        inside = collect_values(impute.interpolate_missing(to_grid(spark, vals), "polynomial", order=order))
        assert inside[0] is None and inside[38] is None and inside[39] is None
        assert inside[1:38] == pytest.approx(full[1:38], abs=1e-8)
        assert collect_values(impute.interpolate_missing(to_grid(spark, vals), "spline", order=order)) == pytest.approx(full, abs=1e-7)


def test_spline_limits_and_short_series(spark):
    vals = [None, 1.0, None, None, None, 9.0, None]
    fill = lambda **kw: collect_values(impute.interpolate_missing(to_grid(spark, vals), "spline", order=3, **kw))
    line = [-1.0, 1.0, 3.0, 5.0, 7.0, 9.0, 11.0]  # two points: the line through them
    for kw, empty in (({}, ()), ({"limit": 1}, (3,)), ({"limit_direction": "forward"}, (0,)), ({"limit_direction": "backward", "limit": 2}, (2, 6))):
        got = fill(**kw)
        assert [i for i, v in enumerate(got) if v is None] == list(empty)
        assert [v for v in got if v is not None] == pytest.approx([v for i, v in enumerate(line) if i not in empty])


def test_missing_report_reads_the_grid_once(spark, tmp_path):
    path = str(tmp_path / "grid")
    to_grid(spark, [1.0, None, None, 4.0]).write.parquet(path)
    report = impute.missing_report(spark.read.parquet(path))
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    r = report.collect()[0]
    assert (r["total_count"], r["missing_count"], r["num_gaps"], r["max_gap"], r["mean_gap"]) == (4, 2, 1, 2, 2.0)
