import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tidewise.config import DataConfig
from tidewise.operators import logs, quality, textops
from tidewise.sources import readers, sinks, synthetic
from tidewise.sources.tables import readings

SF = "/root/testdata/sf0.001"


def tmpdir():
    return tempfile.mkdtemp(prefix="tidewise-test-", dir="/tmp")


def test_bindings_prune_columns(spark):
    r = readings(spark, SF, "orders")
    assert r.columns == ["sensor", "ts", "value"]
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>" in plan


def test_wide_csv_roundtrip(spark):
    r = readings(spark, SF, "lineitem").withColumn("sensor", F.concat(F.lit("sensor_"), F.col("sensor")))
    names = sorted(x[0] for x in r.select("sensor").distinct().collect())
    r = r.groupBy("sensor", "ts").agg(F.avg("value").alias("value"))
    d = tmpdir()
    sinks.write_wide_csv(r, d, names, include_time=True)
    wide, sensors = readers.read_wide_csv(spark, d, DataConfig())
    assert sorted(sensors) == names and wide.columns[0] == "ts"
    long = readers.to_long(wide, sensors, dropna=True)
    assert long.count() == r.count()


def test_csv_errors(spark):
    with pytest.raises(FileNotFoundError):
        readers.read_wide_csv(spark, "/tmp/does-not-exist.csv")
    d = tmpdir()
    p = os.path.join(d, "x.csv")
    with open(p, "w") as f:
        f.write("day,a\n2024-01-01,1\n")
    with pytest.raises(ValueError):
        readers.read_wide_csv(spark, p)
    with open(p, "w") as f:
        f.write("date,time,ROLot,a\n2024-01-01,00:00:00,x,1\n")
    with pytest.raises(ValueError, match="No sensor columns"):
        readers.read_wide_csv(spark, p)
    with open(p, "w") as f:
        f.write("ROLot,date,time,sensor_1,sensor_2\nA,2024-01-01,10:00:00,1.5,\nA,2024-01-01,,2.5,3\n")
    wide, sensors = readers.read_wide_csv(spark, p)
    rows = wide.orderBy("sensor_1").collect()
    assert sensors == ["sensor_1", "sensor_2"] and str(rows[0]["ts"]) == "2024-01-01 10:00:00"
    assert rows[1]["ts"] is None  # a NULL time gives a NULL timestamp (concat, not concat_ws)


def test_select_sensors_warns_unknown(spark):
    r = readings(spark, SF, "orders")
    kept, unknown = readers.select_sensors(r, " 1-URGENT, nope ")
    assert {x[0] for x in kept.select("sensor").distinct().collect()} == {"1-URGENT"}
    assert [x[0] for x in unknown.collect()] == ["nope"]


def test_bundles_roundtrip(spark):
    d = tmpdir()
    b = {"bundle_id": "b1", "created_at": "2024-01-01T00:00:00", "version": "0.1.0",
         "health_checks": [{"check_name": "data_loaded", "passed": True, "message": "ok"}],
         "processing_steps": [{"step_name": "load", "status": "ok", "duration_seconds": 2.0},
                              {"step_name": "detect", "status": "ok", "duration_seconds": 6.0}],
         "errors": [{"type": "X", "message": "bad /home/me/data.csv"}], "warnings": ["see C:\\tmp\\a.txt"],
         "log_excerpt": "2024-01-01 ERROR x: y"}
    with open(os.path.join(d, "bundle_b1.json"), "w") as f:
        json.dump(b, f)
    bundles = readers.read_bundles(spark, d)
    row = bundles.collect()[0]
    assert row["config"] is None and row["data_summary"] is None
    assert readers.bundle_health_checks(bundles).count() == 1
    shares = textops.step_shares(readers.bundle_steps(bundles), "bundle_id", "step_name", "duration_seconds").collect()
    assert sorted(r["percent"] for r in shares) == [25.0, 75.0]
    out = tmpdir()
    sinks.save_bundles(bundles, out)
    back = spark.read.json(out).collect()[0]
    assert "[PATH_MASKED]" in back["warnings"][0] and "[PATH_MASKED]" in back["errors"][0]["message"]


def test_log_lines_and_errors(spark):
    d = tmpdir()
    with open(os.path.join(d, "run.log"), "w") as f:
        f.write("2024-01-01 10:00:00 INFO start\n2024-01-01 10:00:01 ERROR loader: file missing\n  detail line\n"
                "2024-01-01 10:00:02 INFO end\n")
    lines = readers.read_log_lines(spark, os.path.join(d, "run.log"))
    assert lines.count() == 5
    errs = logs.error_extract(lines, "file").collect()
    assert [e["message"] for e in errs] == ["file missing\n  detail line"]
    tail = textops.log_tail(lines, "file", 2).collect()[0]
    assert tail["excerpt"] == "2024-01-01 10:00:02 INFO end\n"


def test_name_dictionary_and_replacement(spark):
    names = spark.createDataFrame([("sensor_1",), ("sensor_10",), ("sensor_2",), ("sensor_1",)], "s string")
    d = textops.name_dictionary(names, "s")
    got = {r["name"]: r["alias"] for r in d.collect()}
    assert got == {"sensor_1": "SENSOR_001", "sensor_10": "SENSOR_002", "sensor_2": "SENSOR_003"}
    pairs = [(r["name"], r["alias"]) for r in d.collect()]
    df = spark.createDataFrame([("sensor_10 and sensor_1",)], "t string")
    fixed = df.select(textops.replace_names(F.col("t"), pairs)).collect()[0][0]
    assert textops.anonymize(df, ["t"], d).collect()[0][0] == fixed
    parity = df.select(textops.replace_names(F.col("t"), sorted(pairs), parity=True)).collect()[0][0]
    assert fixed == "SENSOR_002 and SENSOR_001"
    assert parity == "SENSOR_0010 and SENSOR_001"  # the original substring behaviour


def test_mask_paths_patterns(spark):
    df = spark.createDataFrame([(r"open C:\data\x.csv and /home/u/a.csv or ~user/x",)], "t string")
    out = df.select(textops.mask_paths(F.col("t"))).collect()[0][0]
    assert out == "open [PATH_MASKED] and [PATH_MASKED] or [PATH_MASKED]"
    custom = df.select(textops.mask_paths(F.col("t"), [r"C:\\\S+"])).collect()[0][0]
    assert custom.startswith("open [PATH_MASKED] and /home/u/a.csv")


def test_parse_response(spark):
    df = spark.createDataFrame([('text {"summary": "s", "issues": ["a"], "confidence": "high"} tail',), ("no json here",),
                                ("{broken",)], "t string")
    r = df.select(textops.parse_response(F.col("t")).alias("r")).select("r.*").collect()
    assert (r[0]["summary"], r[0]["issues"], r[0]["recommendations"], r[0]["confidence"]) == ("s", ["a"], [], "high")
    assert (r[1]["summary"], r[1]["confidence"]) == ("no json here", "low")
    assert r[2]["confidence"] == "low"


def test_health_summary_on_events(spark):
    s = quality.health_summary(readings(spark, SF, "events")).collect()[0]
    assert s["total_records"] > 0 and s["span_days"] < 30
    assert any("Short date range" in w for w in s["warnings"]) and not s["healthy"]


def test_synthetic_generators(spark):
    s = synthetic.seasonal_series(spark, n_days=400, periods=(7,), missing_rate=0.0, outlier_rate=0.0)
    assert s.count() == 400
    m = synthetic.multi_sensor(spark, n_days=100, n_sensors=6)
    assert m.count() == 600 and m.select("sensor").distinct().count() == 6


def test_save_results(spark):
    from tidewise.plans.run import analyze
    out = analyze(synthetic.multi_sensor(spark, n_days=200, n_sensors=3), materialize=True)
    d = tmpdir()
    from tidewise.config import RunConfig
    paths = sinks.save_results(out, d, run="r1", config=RunConfig())
    assert "periods" in spark.read.text(paths["config"]).collect()[0][0]
    assert spark.read.parquet(paths["ranking"]).filter("run_id = 'r1'").count() == 3
    assert spark.read.text(paths["summary"]).count() == out["summary"].count()


def test_stream_grid_matches_batch_over_many_batches_and_resumes(spark):
    """One file per batch, bins shared by batches, old readings last; a second call takes only the new file."""
    from pyspark.sql import functions as F
    from tidewise.operators import resample
    from tidewise.streaming.ingest import run_stream_grid
    src = spark.read.parquet(f"{SF}/events.parquet")
    d = tmpdir()
    dealt = src.withColumn("_part", F.pmod(F.xxhash64("event_id" if "event_id" in src.columns else src.columns[0]), F.lit(4)))
    for k in (3, 1, 0):
        dealt.filter(F.col("_part") == k).drop("_part").coalesce(1).write.mode("append").parquet(d + "/in")
    values = lambda df: {(r["sensor"], str(r["bin"])): round(r["value"], 9) for r in df.collect()}
    run_stream_grid(spark, d + "/in", "event_type", "ts", "value", folder=d + "/state", max_files=1)
    assert len([x for x in os.listdir(d + "/state/parts") if x.startswith("batch=")]) == 3
    dealt.filter("_part = 2").drop("_part").coalesce(1).write.mode("append").parquet(d + "/in")
    g = run_stream_grid(spark, d + "/in", "event_type", "ts", "value", folder=d + "/state", max_files=1)
    assert len([x for x in os.listdir(d + "/state/parts") if x.startswith("batch=")]) == 4
    assert values(g) == values(resample.resample(readings(spark, SF, "events"), "H", "mean").filter("value IS NOT NULL"))


def test_checkpoint_folder_is_set_once(spark):
    from tidewise.session import checkpoint_root, cut_lineage, run_folder
    root, folder = checkpoint_root(spark), run_folder(spark)
    for _ in range(300):
        assert checkpoint_root(spark) == root and run_folder(spark) == folder
    assert cut_lineage(spark.range(5)).count() == 5


def test_analyze_skips_sensors_with_few_raw_readings(spark):
    from tidewise.plans.run import analyze
    r = spark.sql("""select concat('s', s) sensor, timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, i * if(s = 0, 1, 10)) ts,
                     sin(i * 2 * pi() / 7) value from range(2) t(s), range(150) u(i) where s = 0 or i < 50""")
    out = analyze(r, methods=["fourier"])
    assert [x["sensor"] for x in out["ranking"].collect()] == ["s0"]


def test_lenient_csv_quarantines_bad_timestamps(spark):
    d = tmpdir()
    p = os.path.join(d, "x.csv")
    with open(p, "w") as f:
        f.write("date,time,sensor_1\n2024-01-01,00:00:00,1\nnot-a-date,00:00:00,2\n2024-01-02,00:00:00,3\n")
    good, bad, sensors = readers.read_wide_csv_lenient(spark, p)
    assert good.count() == 2 and [r["_date_raw"] for r in bad.collect()] == ["not-a-date"]


def test_anonymize_bundles_every_text_field(spark):
    d = tmpdir()
    b = {"bundle_id": "b2", "config": {"sensor_10": "on /home/u/cfg.yaml"}, "warnings": ["sensor_1 low"],
         "errors": [{"message": "sensor_10 failed at /var/log/x.log"}],
         "health_checks": [{"check_name": "c", "passed": False, "message": "sensor_1 missing"}],
         "log_excerpt": "sensor_1 and sensor_10"}
    with open(os.path.join(d, "b.json"), "w") as f:
        json.dump(b, f)
    bundles = readers.read_bundles(spark, d)
    names = spark.createDataFrame([("sensor_1",), ("sensor_10",)], "s string")
    pairs = textops.name_dictionary(names, "s")
    r = textops.anonymize_bundles(bundles, pairs).collect()[0]
    assert r["log_excerpt"] == "SENSOR_001 and SENSOR_002"
    assert r["warnings"] == ["SENSOR_001 low"]
    assert r["errors"][0]["message"] == "SENSOR_002 failed at [PATH_MASKED]"
    assert r["config"] == {"SENSOR_002": "on [PATH_MASKED]"}
    assert r["health_checks"][0]["message"] == "SENSOR_001 missing"


def test_wide_csv_to_ranking_end_to_end(spark):
    """The original `run` flow: wide CSV (date, time, sensor_*) -> long -> grid -> detectors -> ranking."""
    from tidewise.plans.run import analyze
    long = synthetic.multi_sensor(spark, n_days=400, n_sensors=4, n_seasonal=2)
    d = tmpdir()
    sinks.write_wide_csv(long, d, [f"sensor_{i}" for i in range(1, 5)], include_time=True)
    wide, sensors = readers.read_wide_csv(spark, d)
    out = analyze(readers.to_long(wide, sensors), methods=["acf", "fourier", "periodogram"], materialize=True)
    rk = out["ranking"].orderBy("rank").collect()
    assert [r["rank"] for r in rk] == [1, 2, 3, 4]
    assert {r["sensor"] for r in rk[:2]} == {"sensor_1", "sensor_2"}  # the seasonal ones rank first


def test_replacing_is_one_pass_and_has_no_name_limit(spark):
    df = spark.createDataFrame([("web S (a.b) 12",), ("no name",), (None,)], "t string")
    pairs = [("S", "SENSOR_001"), ("web", "SENSOR_002"), ("(a.b)", "SENSOR_003"), ("(a", "SENSOR_004")]
    got = [r[0] for r in df.select(textops.replace_names(F.col("t"), pairs)).collect()]
    assert got == ["SENSOR_002 SENSOR_001 SENSOR_003 12", "no name", None]
    many = [(f"sensor_{i}", f"SENSOR_{i:05d}") for i in range(12_000)]
    df = spark.createDataFrame([("sensor_7,sensor_11999;sensor_120000 sensor_x",)], "t string")
    got = df.select(textops.replace_names(F.col("t"), many)).collect()[0][0]
    # the longest listed name at a place: sensor_12000 is not listed, sensor_1200 is
    assert got == "SENSOR_00007,SENSOR_11999;SENSOR_0120000 sensor_x"


def test_saved_bundles_hold_no_name_and_no_path(spark):
    d, out = tmpdir(), tmpdir()
    leak = "sensor_1 and sensor_10 in /home/u/x.csv"
    b = {"bundle_id": "b3", "config": {leak: leak}, "data_summary": {"sensor_columns": ["sensor_1", "sensor_10"], "file": leak},
         "warnings": [leak], "errors": [{leak: leak}], "results_summary": {"top": leak}, "log_excerpt": leak,
         "health_checks": [{"check_name": leak, "passed": False, "message": leak, "details": {leak: leak}}],
         "processing_steps": [{"step_name": leak, "status": "ok", "start_time": "2024-01-01T00:00:00", "end_time": "2024-01-01T00:00:01",
                               "duration_seconds": 1.0, "message": leak, "details": {leak: leak}, "metrics": {leak: leak}}]}
    with open(os.path.join(d, "b.json"), "w") as f:
        json.dump(b, f)
    sinks.save_bundles(readers.read_bundles(spark, d), out)
    text = "".join(r[0] for r in spark.read.text(out).collect())
    assert "sensor_1" not in text and "/home" not in text and "SENSOR_002" in text
    assert "2024-01-01T00:00:01" in text


def test_text_tail_equals_log_tail(spark):
    texts = ["", "a", "a\nb\nc\n", "\n\n", None, "x\ny"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = lambda d: sorted((r["doc_id"], r["n_lines"], r["excerpt"]) for r in d.collect())
    whole = textops.text_tail(df, "doc_id", "text", 2)
    assert rows(whole) == rows(textops.log_tail(textops.text_lines(df, "doc_id", "text"), "doc_id", 2))
    assert "Exchange" not in whole._jdf.queryExecution().executedPlan().toString()
