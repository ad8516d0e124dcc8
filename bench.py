"""Benchmark: headline queries at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}.
Each query is timed from plan construction to a full materialisation (noop sink), so every
row is produced. A warm-up query runs first and is not counted.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tidewise.config import DetectionConfig, RunConfig  # noqa: E402
from tidewise.plans import catalog as C  # noqa: E402
from tidewise.plans.run import analyze  # noqa: E402
from tidewise.session import get_session  # noqa: E402
from tidewise.sources.tables import readings  # noqa: E402


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app="tidewise-bench")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    def run_lineitem():
        out = analyze(readings(spark, sf_dir, "lineitem"), RunConfig(), materialize=True)
        return out["ranking"]

    def run_orders():
        out = analyze(readings(spark, sf_dir, "orders"), RunConfig(), materialize=True)
        return out["ranking"]

    def hourly_events():
        from tidewise.operators import resample
        from tidewise.operators.ensemble import detect_all
        cfg = DetectionConfig(periods=(24, 168), methods=("acf", "periodogram", "fourier"), min_points=100,
                              time_unit="hour")
        g = resample.resample_and_interpolate(readings(spark, sf_dir, "events"), "H", "mean", "linear")
        return detect_all(g, cfg)

    def synthetic(n_sensors, n_days, methods):
        from tidewise.sources.synthetic import multi_sensor
        from tidewise.session import cut_lineage

        def run():
            r = cut_lineage(multi_sensor(spark, n_days=n_days, n_sensors=n_sensors, partitions=int(cpus) * 4), "synthetic")
            return analyze(r, RunConfig(), methods=methods, materialize=True)["ranking"]
        return run

    headline = {
        "resample_lineitem": lambda: C.Q["resample_median"](spark, sf_dir),
        "interp_orders": lambda: C.Q["interp_linear"](spark, sf_dir),
        "health_orders": lambda: C.Q["health_summary"](spark, sf_dir),
        "outliers_orders": lambda: C.Q["outlier_rolling"](spark, sf_dir),
        "acf_orders": lambda: C.Q["acf_detect"](spark, sf_dir),
        "harmonic_orders": lambda: C.Q["harmonic_fit"](spark, sf_dir),
        "periodogram_orders": lambda: C.Q["periodogram_band"](spark, sf_dir),
        "scores_ranking_orders": lambda: C.Q["ranking"](spark, sf_dir),
        "segments_orders": lambda: C.Q["segment_stats"](spark, sf_dir),
        "stl_orders": lambda: C.Q["stl_strength"](spark, sf_dir),
        "run_all_methods_lineitem": run_lineitem,
        "run_all_methods_orders": run_orders,
        "hourly_events": hourly_events,
        "mask_paths_pages": lambda: C.Q["mask_paths"](spark, sf_dir),
        "log_tail_documents": lambda: C.Q["log_tail"](spark, sf_dir),
        "json_extract": lambda: C.Q["json_extract"](spark, sf_dir),
        # scale runs (generated by Spark, 1,500 days per sensor): throughput per sensor
        "synthetic_2000x1500_exact_methods": synthetic(2000, 1500, ["acf", "periodogram", "fourier"]),
        "synthetic_200x1500_all_methods": synthetic(200, 1500, ["stl", "acf", "periodogram", "fourier"]),
    }
    only = [a for a in sys.argv[1:]]
    # warm-up: JVM, codegen and Python workers
    C.Q["resample_mean"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    C.Q["stl_strength"](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    times = {}
    for name, fn in headline.items():
        if only and name not in only:
            continue
        t0 = time.time()
        fn().write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
