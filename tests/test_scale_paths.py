"""The paths taken by large groups, long files and many names, against the short way or brute force."""

import datetime as dt
import os
import random
import re
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import make_series, seasonal_values, to_grid
from tidewise.config import DetectionConfig, PreprocessingConfig, RunConfig
from tidewise.functions.quantiles import aggregate_with_quantiles, selected_quantiles
from tidewise.kernels import pelt, spectral, spline, stl as stl_kernel
from tidewise.operators import acf, harmonic, impute, logs, outliers, periodogram, quality, resample, segments, spectra, stl, textops
from tidewise.operators.ensemble import detect_all, result_json
from tidewise.operators.stacked import run_stacks
from tidewise.sources import readers


def tmpdir():
    return tempfile.mkdtemp(prefix="tidewise-test-", dir="/tmp")


def several(spark, n=5, days=200, gap=None):
    out = None
    for i in range(n):
        y = list(seasonal_values(days if i < n - 1 else days - 20, seed=i))
        if gap:
            y[gap + i] = None
        g = to_grid(spark, y, sensor=f"s{i}")
        out = g if out is None else out.unionByName(g)
    return out


# ---- stacks of sensors ---------------------------------------------------------------------------------

def test_stacked_kernels_equal_one_series_at_a_time():
    rng = np.random.default_rng(0)
    Y = 50 + rng.normal(0, 3, (9, 130)).cumsum(axis=1)
    t = np.arange(130.0)
    for p in (5, 7, 30):
        whole = stl_kernel.stl_stack(Y, p)
        for i, y in enumerate(Y):
            one = stl_kernel.stl(y, p)
            assert all(np.allclose(whole[k][i], one[k], atol=1e-9) for k in one)
    R = spectral.acf_stack(np.vstack([Y, np.full((1, 130), 4.2)]), 40)
    for r, y in zip(R, Y):
        d = y - y.mean()
        assert np.allclose(r, [np.sum(d[:len(d) - k] * d[k:]) / np.sum(d * d) for k in range(41)])
    assert np.isnan(R[-1]).all() and list(spectral.pacf_stack(R)[-1]) == [1.0] + [0.0] * 40
    P = spectral.periodogram_stack(t, Y, 1 / 500, 1 / 1290, 300)
    f = 1 / 500 + np.arange(300) / 1290
    for k in (0, 17, 299):
        X = np.column_stack([np.ones(130), np.sin(2 * np.pi * f[k] * t), np.cos(2 * np.pi * f[k] * t)])
        for i, y in enumerate(Y):
            b = np.linalg.lstsq(X, y, rcond=None)[0]
            assert P[i, k] == pytest.approx(1 - np.sum((y - X @ b) ** 2) / np.sum((y - y.mean()) ** 2), abs=1e-8)


def test_stacks_mix_lengths_and_gaps(spark):
    g = several(spark, gap=50).unionByName(to_grid(spark, [None, 1.0, None], sensor="short")).unionByName(to_grid(spark, [None] * 9, sensor="none"))
    got = {(r["sensor"], r["method"], r["period"]): r for r in spectra.kernel_scores(g, (7, 30)).collect()}
    assert {k[0] for k in got} == {f"s{i}" for i in range(5)} | {"short"}
    for s in ("s0", "s4", "short"):
        alone = {(r["sensor"], r["method"], r["period"]): r for r in spectra.kernel_scores(g.filter(F.col("sensor") == s), (7, 30)).collect()}
        for k, r in alone.items():
            assert got[k]["score"] == pytest.approx(r["score"], abs=1e-12) and got[k]["error"] == r["error"]
    assert got["short", "stl", 7]["error"] == "insufficient_data" and ("short", "acf", 7) not in got


def test_one_bad_sensor_gives_an_error_row(spark):
    def kernel(names, t, Y, bins):
        if "s2" in names:
            raise RuntimeError("broken")
        return {"sensor": names, "mean": Y.mean(axis=1), "error": [None] * len(names)}

    rows = {r["sensor"]: r for r in run_stacks(several(spark), kernel, "sensor string, mean double, error string").collect()}
    assert len(rows) == 5 and rows["s2"]["error"] == "broken" and rows["s2"]["mean"] is None
    assert all(rows[f"s{i}"]["error"] is None and rows[f"s{i}"]["mean"] > 0 for i in (0, 1, 3, 4))


def test_every_kernel_survives_failures(spark):
    g = several(spark, gap=50)
    bad = stl.stl_strength(g, (1, 7)).collect()
    assert len(bad) == 10 and {r["error"] for r in bad if r["period"] == 1} == {"period must be >= 2"}
    mixed = {r["method"]: r["error"] for r in detect_all(g, DetectionConfig(periods=(1,)), ("stl", "acf"), gate=False).collect()}
    assert mixed["stl"] == "period must be >= 2" and mixed["acf"] is None  # the methods fail apart
    rows = stl.stl_components(g, 1).collect()
    assert len(rows) == 5 and all(r["error"] and r["observed"] is None for r in rows)
    broken = DetectionConfig(periodogram_min_period=0)
    assert {r["error"] for r in periodogram.periodogram_full(g, broken).collect()} == {"float division by zero"}
    assert {r["error"] for r in periodogram.periodogram_detect(g, (7,), broken).collect()} == {"float division by zero"}
    assert {r["error"] for r in acf.acf_full(g, None).collect()} != {None} and {r["error"] for r in acf.pacf(g, None).collect()} != {None}
    assert {r["error"] for r in harmonic.fit_and_predict(g, (0,)).collect()} != {None}
    assert all("Unknown" in r["error"] for r in segments.changepoints_pelt(g, model="nope").collect())
    flags = outliers.flag_iforest(g, max_samples=-1).collect()
    assert len(flags) == g.count() and not any(r["is_outlier"] for r in flags)
    twice = g.unionByName(g.filter("sensor = 's1'"))  # equal days: no spline through them
    filled = impute.interpolate_spline(twice)
    assert filled.count() == twice.count()
    nulls = {r["sensor"] for r in filled.filter("value is null").collect()}
    assert nulls <= {"s1"}


def test_joint_prediction_is_least_squares_in_one_scan(spark):
    g = several(spark, gap=50)
    fit = harmonic.fit_and_predict(g, (7, 30))
    assert fit._jdf.queryExecution().executedPlan().toString().count("Scan") == 5  # one for each frame of the union
    rows = sorted((r["bin"], r["value"], r["fitted"]) for r in fit.filter("sensor = 's1'").collect())
    t = np.array([(b - rows[0][0]).days for b, _, _ in rows], dtype=float)
    X = np.column_stack([np.ones(len(t))] + [f(2 * np.pi * t / p) for p in (7, 30) for f in (np.sin, np.cos)])
    y = np.array([v for _, v, _ in rows])
    assert np.allclose([f for _, _, f in rows], X @ np.linalg.lstsq(X, y, rcond=None)[0])
    one = harmonic.joint_fit(g, (7, 30)).filter("sensor = 's1'").first()
    assert one["r2"] == pytest.approx(1 - np.sum((y - [f for _, _, f in rows]) ** 2) / np.sum((y - y.mean()) ** 2))


def test_result_as_json(spark):
    import json
    det = detect_all(several(spark), DetectionConfig(periods=(7, 30)), ("stl", "acf", "fourier"))
    got = {r["sensor"]: json.loads(r["json"]) for r in result_json(det, (7, 30), ("stl", "acf", "fourier")).collect()}
    assert set(got) == {f"s{i}" for i in range(5)}
    r = got["s0"]
    assert set(r["method_results"]) == {"stl", "acf", "fourier"} and set(r["combined_scores"]) == {"7", "30"}
    assert r["max_combined_score"] == max(r["combined_scores"].values())
    stl7 = r["method_results"]["stl"]["periods"]["7"]
    assert set(stl7) == {"score", "significant"} and r["method_results"]["stl"]["max_score"] >= stl7["score"]


# ---- exact quantiles without one buffer ----------------------------------------------------------------

@pytest.fixture
def many_partitions(spark):
    """Small data stay in several tasks."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_selected_quantiles_of_a_hot_group(spark, many_partitions):
    rng = np.random.default_rng(1)
    hot = np.round(rng.normal(0, 100, 6000), 1)
    rows = [("hot", float(v)) for v in hot] + [("hot", None)] * 9 + [("ties", 5.0)] * 700 + [("two", 1.0), ("two", 2.0), (None, 3.0), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(16)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {r["k"]: r["_q"] for r in selected_quantiles(df, ["k"], "v", probs).collect()}
    assert np.allclose(got["hot"], np.quantile(hot, probs)) and got["ties"] == [5.0] * 6 and got[None] == [3.0] * 6
    assert np.allclose(got["two"], np.quantile([1, 2], probs)) and "none" not in got
    parts = df.filter("k = 'hot'").groupBy("k", "v").count().repartitionByRange("k", "v").withColumn("p", F.spark_partition_id())
    assert parts.select("p").distinct().count() > 1  # the group's histogram is in several tasks
    everything = selected_quantiles(df, [], "v", [0.5]).collect()
    values = [v for _, v in rows if v is not None]
    assert len(everything) == 1 and everything[0]["_q"][0] == pytest.approx(np.median(values))
    assert selected_quantiles(df.filter("v is null"), [], "v", [0.5]).count() == 0


def test_large_groups_take_the_other_way(spark, many_partitions):
    rng = np.random.default_rng(2)
    start = dt.datetime(2024, 1, 1)
    rows = [("a", start + dt.timedelta(minutes=i), float(round(v, 2))) for i, v in enumerate(rng.normal(0, 1, 3000))]
    rows += [("b", start + dt.timedelta(hours=5 * i), float(i % 3) if i % 4 else None) for i in range(60)]
    r = spark.createDataFrame(rows, "sensor string, ts timestamp_ntz, value double")
    key = lambda d: sorted((x["sensor"], x["bin"], None if x["value"] is None else round(x["value"], 9)) for x in d.collect())
    assert key(resample.resample(r, "D", "median", buffer_rows=100)) == key(resample.resample(r, "D", "median"))
    rounded = lambda d: sorted([None if v is None else round(v, 9) if isinstance(v, float) else v for v in x] for x in d.collect())
    assert rounded(quality.describe(r, buffer_rows=100)) == rounded(quality.describe(r))
    grid = r.select("sensor", F.col("ts").alias("bin"), "value")
    seg = grid.withColumn("segment", F.lit(1).cast("long"))
    assert rounded(segments.segment_statistics(None, segmented=seg, buffer_rows=100)) == rounded(segments.segment_statistics(None, segmented=seg))
    a = outliers.remove_outliers(grid, "iqr", 0.5, "median", buffer_rows=100)
    assert key(a.select("sensor", "bin", "value")) == key(outliers.remove_outliers(grid, "iqr", 0.5, "median"))
    assert aggregate_with_quantiles(r.limit(0), ["sensor"], [], "value", [0.5], 0).count() == 0


def test_sensors_with_few_records_leave_before_the_fill(spark):
    r = make_series(spark, [1.0] * 3, sensor="few").unionByName(make_series(spark, [1.0] * 8, sensor="many")).unionByName(make_series(spark, [None] * 9, sensor="null"))
    assert {x["sensor"] for x in resample.resample(r, min_records=5).collect()} == {"many"}


# ---- health --------------------------------------------------------------------------------------------

def test_missing_matrix_has_the_days_without_readings(spark):
    rows = [("a", dt.datetime(2024, 1, 1, 5), 1.0), ("a", dt.datetime(2024, 1, 5, 5), None), ("b", dt.datetime(2024, 1, 3), 2.0)]
    r = spark.createDataFrame(rows, "sensor string, ts timestamp_ntz, value double")
    got = {(x["sensor"], x["day"].day): (x["n_missing"], x["n_total"], x["is_missing"]) for x in quality.missing_matrix(r).collect()}
    assert len(got) == 10 and got["a", 1] == (0, 1, False) and got["a", 3] == (0, 0, True) and got["a", 5] == (1, 1, True) and got["b", 5] == (0, 0, True)
    assert quality.missing_matrix(r, shared_range=False).count() == 6


def test_wide_health_counts_rows_of_the_file(spark):
    rows = [(dt.datetime(2024, 1, 1 + i // 2, 12 * (i % 2)), float(i), None if i % 2 else 1.0, None) for i in range(14)]
    wide = spark.createDataFrame(rows, "ts timestamp_ntz, sensor_1 double, sensor_2 double, sensor_3 double")
    h = quality.wide_health(wide, ["sensor_1", "sensor_2", "sensor_3"])
    r = h.first()
    assert (r["total_records"], r["sensor_count"], r["missing_count"]) == (14, 3, 21) and r["missing_rate"] == 0.5
    assert (r["obs_per_day_min"], r["obs_per_day_max"], r["obs_per_day_mean"], r["span_days"]) == (2.0, 2.0, 2.0, 6)
    assert len(r["warnings"]) == 4 and not r["healthy"]
    assert {x["sensor"]: (x["missing_count"], x["all_missing"]) for x in quality.wide_health_by_sensor(h).collect()} == {
        "sensor_1": (0, False), "sensor_2": (7, False), "sensor_3": (14, True)}
    e = quality.wide_health(wide.limit(0), ["sensor_1"]).first()
    assert e["total_records"] == 0 and e["warnings"] == ["No records in data", "Sensors with all missing values: 1"]


def test_run_has_five_checks_and_its_changepoints(spark):
    from tidewise.plans.run import analyze
    y = np.r_[np.random.default_rng(1).normal(0, 1, 150), np.random.default_rng(2).normal(9, 1, 150)]
    cfg = RunConfig(preprocessing=PreprocessingConfig(changepoint_method="pelt", changepoint_penalty=5.0, min_segment_size=40))
    out = analyze(make_series(spark, list(y)), cfg, methods=["acf", "fourier"], materialize=True)
    checks = {r["check_name"]: (r["passed"], r["message"]) for r in out["checks"].collect()}
    assert checks == {"data_loaded": (True, "Loaded 300 records"), "missing_rate": (True, "Missing rate: 0.00%"), "preprocessing": (True, "Preprocessed 1 sensors"),
                      "detection": (True, "Detected seasonality in 1 sensors"), "scoring": (True, "Scored 1 sensors")}
    assert [str(r["cp_bin"]) for r in out["changepoints"].collect()] == ["2024-05-29"]  # the 150th day
    assert out["segment_stats"].count() == 2 and "segments" in out
    assert "changepoints" not in analyze(make_series(spark, list(y)), methods=["fourier"])


# ---- names ---------------------------------------------------------------------------------------------

def test_a_hundred_thousand_names(spark):
    d = spark.range(100_000).selectExpr("concat('dev', id) as name", "concat('A', lpad(id, 6, '0')) as alias")
    rows = [(1, "dev7 dev99999! dev100000 xdev12y", ["dev1", None], {"dev2": "q"}), (2, None, None, None), (3, "nothing", [], {}), (4, "nothing", ["dev3dev4"], {"k": "dev5"})]
    df = spark.createDataFrame(rows, "id long, t string, l array<string>, m map<string,string>")
    got = {r["id"]: r for r in textops.anonymize(df, ["t", "l", "m"], d).collect()}
    assert got[1]["t"] == "A000007 A099999! A0100000 xA000012y" and got[1]["l"] == ["A000001", None] and got[1]["m"] == {"A000002": "q"}
    assert got[2]["t"] is None and got[2]["l"] is None and got[3]["t"] == "nothing" and got[4]["l"] == ["A000003A000004"] and got[4]["m"] == {"k": "A000005"}
    assert textops.anonymize(df, ["t"], d.limit(0)).filter("id = 1").first()["t"] == rows[0][1]
    plan = textops.anonymize(df, ["t"], d)._jdf.queryExecution().optimizedPlan().toString()
    assert "dev1" not in plan.replace("dev1 ", "") or "concat(dev" in plan  # no name is in the plan


def test_names_equal_one_pass_over_the_longest(spark, monkeypatch):
    monkeypatch.setattr(textops, "PIECE_CHARS", 7)  # names across the pieces of a text
    rnd = random.Random(3)
    names = ["a", "ab", "abc", "c.d", "[x]", "\\E", "é1", "日本"]
    texts = ["".join(rnd.choice(["a", "b", "c", ".", "d", "[x]", "\\E", "é", "1", "日本", " "]) for _ in range(rnd.choice([0, 5, 60]))) for _ in range(80)]
    alias = {n: f"<{i}>" for i, n in enumerate(names)}
    d = spark.createDataFrame(list(alias.items()), "name string, alias string")
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string")
    pattern = re.compile("|".join(map(re.escape, sorted(names, key=len, reverse=True))))
    want = {i: pattern.sub(lambda m: alias[m[0]], t) for i, t in enumerate(texts)}
    assert {r["id"]: r["t"] for r in textops.anonymize(df, ["t"], d).collect()} == want


@pytest.mark.parametrize("most", [1, 200])
def test_names_are_looked_up_by_their_shapes(spark, monkeypatch, most):
    monkeypatch.setattr(textops, "MOST_CHARACTERS", most)
    names = [chr(c) + "q" + chr(161 - c if 33 < c < 128 else 33) for c in range(1, 128)] + ["\U0001f600é", "src1", "src20"]
    d = spark.createDataFrame([(n, f"<{i}>") for i, n in enumerate(names)], "name string, alias string")
    text = "plain words before " + " ".join(names) + " and after src2 sr"
    df = spark.createDataFrame([(1, text)], "id long, t string")
    pattern = re.compile("|".join(map(re.escape, sorted(names, key=len, reverse=True))), re.DOTALL)
    alias = {n: f"<{i}>" for i, n in enumerate(names)}
    assert textops.anonymize(df, ["t"], d).first()["t"] == pattern.sub(lambda m: alias[m[0]], text)
    few = spark.createDataFrame([("src1", "a"), ("src12", "b")], "name string, alias string")
    one = textops._shapes(few)
    found = spark.createDataFrame([("one src12 among words " * 50,)], "s string").select(one.alias("x"), "s").select(
        F.expr("flatten(transform(x.patterns, p -> regexp_extract_all(s, p, 1)))").alias("w")).first()["w"]
    assert len(found) == (100 if most == 200 else len(found)) and set(found) >= {"src1", "src12"}  # once every window of both lengths


# ---- logs ----------------------------------------------------------------------------------------------

#: the original's pattern: fixed value
PATTERN = r"ERROR.*?:(.*?)(?=\d{4}-\d{2}-\d{2}|$)"


def random_log(seed, lines):
    rnd = random.Random(seed)
    bits = ["2024-01-02", "10:00:01", "INFO", "ERROR", "ERROR", "x: y", "  ", "boom", "see 2024-03-04 now", "ERROR:", "é:", "12024-01-02-03"]
    return "\n".join(" ".join(rnd.choice(bits) for _ in range(rnd.choice([0, 1, 1, 2, 6]))) for _ in range(lines))


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_error_messages_equal_the_pattern(spark, chunk):
    texts = {f"f{i}": random_log(i, n) for i, n in enumerate([0, 1, 5, 40, 40, 300])}
    texts["judge"] = "2024-01-01 ERROR a: boom 2024-01-02 INFO fine\nERROR no colon\n  more\n2024-01-03 INFO b"
    texts["blank"] = "ERROR:\n\n\n\n   " + " " * 700 + "\n\nend" + " " * 600 + "\n2024-01-01"
    texts["long"] = "ERROR: " + "\n".join("word %d" % i for i in range(900))
    rows = [(f, i + 1, line) for f, t in texts.items() for i, line in enumerate(t.split("\n"))]
    lines = spark.createDataFrame(rows, "file string, line_no long, line string")
    got = {}
    for r in logs.error_extract(lines, chunk_lines=chunk).collect():
        got.setdefault(r["file"], {})[r["n"]] = r["message"]
    for f, t in texts.items():
        want = [m.strip()[:500] for m in re.findall(PATTERN, t, re.DOTALL)[:10]]
        assert [got.get(f, {})[i + 1] for i in range(len(got.get(f, {})))] == want, f


def test_many_small_files_run_as_streams(spark, capsys):
    rows = [(f"f{i}", n + 1, line) for i in range(700) for n, line in enumerate([f"ERROR a: one {i}", "2024-01-01 ERROR b:", f" two {i}"])]
    found = logs.error_extract(spark.createDataFrame([*rows, (None, 1, "ERROR: x")], "file string, line_no long, line string"))
    found.explain()
    assert "FlatMapGroups" not in capsys.readouterr().out  # a frame per file and chunk took most of the time
    assert sorted(map(tuple, found.collect())) == sorted(x for i in range(700) for x in ((f"f{i}", 1, f"one {i}"), (f"f{i}", 2, f"two {i}")))


def test_log_lines_are_numbered_over_splits(spark):
    d = tmpdir()
    texts = {"a.log": "".join(f"line {i} é\n" for i in range(3000)), "b.log": "one\r\ntwo\r\n\r\nlast", "c.log": "\n\n", "d.log": ""}
    for f, t in texts.items():
        with open(os.path.join(d, f), "w", newline="") as out:
            out.write(t)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = readers.read_log_lines(spark, d)
        assert lines.rdd.getNumPartitions() > 5
        got = {}
        for r in lines.collect():
            got.setdefault(r["file"].rsplit("/", 1)[1], {})[r["line_no"]] = r["line"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for f, t in texts.items():
        want = t.replace("\r\n", "\n").split("\n") if t else []
        assert [got.get(f, {}).get(i + 1) for i in range(len(want))] == want and len(got.get(f, {})) == len(want)


def test_one_log_in_parts_is_numbered_as_one_file(spark):
    d = tmpdir()
    for f, t in {"part-0": "a\nb é\n", "part-1": "", "part-2": "\n".join(f"line {i}" for i in range(2000)) + "\n", "part-3": "c\n"}.items():
        with open(os.path.join(d, f), "w") as out:
            out.write(t)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = readers.read_log_lines(spark, d, parts=True).orderBy("line_no").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["line"] for r in got] == ["a", "b é", *[f"line {i}" for i in range(2000)], "c", ""]
    assert [r["line_no"] for r in got] == list(range(1, 2005)) and {r["file"] for r in got} == {d}


def test_lines_of_one_log_are_spread_over_tasks(spark):
    rows = [(i, f"2024-01-{i % 28 + 1:02d} 00:00:00", "error" if i % 3 else "click") for i in range(3000)]
    events = spark.createDataFrame(rows, "event_id long, t string, event_type string").select(
        "event_id", F.col("t").cast("timestamp_ntz").alias("ts"), F.lit(0).alias("user_id"), "event_type", F.lit(1.5).alias("value"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = textops.event_log_lines(events).withColumn("task", F.spark_partition_id()).orderBy("line_no").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len({r["task"] for r in got}) > 1
    entries = []
    for i, t, kind in sorted(rows, key=lambda r: (r[1], r[0])):
        head, k = f"{t} {'ERROR' if kind == 'error' else 'INFO'} {kind}", i % 4 if kind == "error" else 0
        body = f"value=1.50 event={i}"
        entries += [f"{head} {body}"] if k == 1 else [f"{head}: {body}", f"  caused by event {i}"] if k == 2 else \
            [f"{head}: {body} seen {t[:10]} again: yes"] if k == 3 else [f"{head}: {body}"]
    assert [(r["file"], r["line_no"], r["line"]) for r in got] == [("user_0.log", n + 1, x) for n, x in enumerate(entries)]


def test_csv_header_with_a_quoted_comma(spark):
    p = os.path.join(tmpdir(), "x.csv")
    with open(p, "w") as f:
        f.write('date,time,"note, free",sensor_1\n2024-01-01,00:00:00,"a, b",1.5\n')
    wide, sensors = readers.read_wide_csv(spark, p)
    assert sensors == ["sensor_1"] and wide.first()["sensor_1"] == 1.5
    assert readers.read_wide_csv(spark, f"file://{p}")[0].count() == 1


# ---- changepoints, splines -----------------------------------------------------------------------------

def test_l1_costs_equal_medians():
    rng = np.random.default_rng(4)
    x = np.round(np.r_[rng.normal(0, 1, 200), rng.normal(3, 1, 150), rng.normal(1, 2, 133)], 1)
    fast, plain = pelt.L1Cost(x), pelt.Cost(x, "l1")
    starts = np.array([0])
    for e in (30, 35, 90, 95, 100, 400, 483):
        starts = np.union1d(starts[::2] if e == 400 else starts, [(e - 30) // 5 * 5])
        assert np.allclose(fast.errors(starts, e), [plain.error(int(s), e) for s in starts])
    best = {0: (0.0, [])}
    for e in [k for k in range(30, len(x), 5)] + [len(x)]:
        found = [(best[s][0] + plain.error(s, e) + 12.0, best[s][1] + [e]) for s in best if e - s >= 30]
        if found:
            best[e] = min(found)
    assert pelt.pelt(x, "l1", 30, 12.0) == best[len(x)][1]


def test_smoothing_spline_keeps_the_residual_bound():
    rng = np.random.default_rng(5)
    x = np.sort(rng.choice(400, 120, replace=False)).astype(float)
    y = np.sin(x / 20) * 5 + rng.normal(0, 1, 120)
    for k in (1, 2, 3, 4):
        t = spline.knots(x, k)
        first, values = spline.basis(t, k, x)
        at = lambda c: (c[first[:, None] + np.arange(k + 1)] * values).sum(axis=1)
        exact = spline.coefficients(t, k, x, y)
        rough = spline.jumps(t, k)
        size = lambda c: sum((row @ c[j:j + k + 2]) ** 2 for j, row in enumerate(rough))
        for bound in (30.0, 120.0):
            c = spline.smoothing_coefficients(t, k, x, y, bound)
            found = ((y - at(c)) ** 2).sum()
            assert 0.95 * bound <= found <= bound and size(c) < size(exact)
            dense = np.zeros((len(x), len(x)))
            for i in range(len(x)):
                dense[i, first[i]:first[i] + k + 1] = values[i]
            jump = np.zeros((len(rough), len(x)))
            for j, row in enumerate(rough):
                jump[j, j:j + k + 2] = row
            # c is a minimiser: the gradients of the two terms are parallel and opposite
            a, b = dense.T @ (dense @ c - y), jump.T @ (jump @ c)
            assert a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) < -0.999
        line = spline.smoothing_coefficients(t, k, x, 3 + 2 * x, 1e-3)
        assert np.allclose(at(line), 3 + 2 * x, atol=1e-2)
    jump3 = spline.jumps(spline.knots(x, 3), 3)
    cubic = spline.coefficients(spline.knots(x, 3), 3, x, x**3)
    assert max(abs(row @ cubic[j:j + 5]) for j, row in enumerate(jump3)) < 1e-5  # a polynomial has no jumps


def test_smoothing_in_the_fill(spark):
    y = list(seasonal_values(120, noise=0.5))
    y[40] = y[41] = None
    g = to_grid(spark, y)
    exact = {r["bin"]: r["value"] for r in impute.interpolate_spline(g).collect()}
    smooth = {r["bin"]: r["value"] for r in impute.interpolate_spline(g, residual_per_point=20.0).collect()}
    assert len(exact) == len(smooth) == 120 and None not in smooth.values()
    changed = [b for b in exact if abs(exact[b] - smooth[b]) > 1e-6]
    assert len(changed) == 2  # known points keep their values
    limited = impute.impute_missing(g, "spline", limit=1).filter("value is null").count()
    assert limited == 0 and impute.impute_missing(g, "spline", limit=1, direction="forward").filter("value is null").count() == 1
