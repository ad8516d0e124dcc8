"""Sinks (SNK-1..SNK-5): CSV / Parquet / JSON outputs of a run, partitioned by run id.

Writers are Spark writers into a shared folder; a run id is a partition column rather than a
file-name suffix, so repeated runs append side by side and readers can prune by run.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_id(now: _dt.datetime | None = None) -> str:
    return (now or _dt.datetime.now(_dt.timezone.utc)).strftime("%Y%m%d_%H%M%S")


def save_scores_csv(scores: DataFrame, path: str, run: str | None = None) -> str:
    """SNK-1: header CSV; with a run id the rows land under ``run_id=<id>/``."""
    w = scores
    if run is not None:
        w = scores.withColumn("run_id", F.lit(run))
        w.write.mode("overwrite").partitionBy("run_id").option("header", True).csv(path)
    else:
        w.write.mode("overwrite").option("header", True).csv(path)
    return path


def to_json_safe(df: DataFrame) -> DataFrame:
    """SNK-3: one JSON text column per row (timestamps as ISO text, nested types kept)."""
    cols = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        c = F.col(f"`{f.name}`")
        if t.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        elif t == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(F.to_json(F.struct(*cols)).alias("json"))


def save_results(results: dict[str, DataFrame], output_dir: str, run: str | None = None, config=None) -> dict[str, str]:
    """SNK-2: scores and ranking as Parquet + CSV, summary as JSON lines and the run config as
    JSON, all under one shared run id."""
    run = run or run_id()
    out = {}
    if config is not None and "scores" in results:
        import dataclasses
        import json

        spark = results["scores"].sparkSession
        text = json.dumps(dataclasses.asdict(config), default=str, sort_keys=True)
        p = f"{output_dir.rstrip('/')}/config/run_id={run}"
        spark.createDataFrame([(text,)], "json string").coalesce(1).write.mode("overwrite").text(p)
        out["config"] = p
    for kind in ("scores", "ranking"):
        if kind in results:
            base = f"{output_dir.rstrip('/')}/{kind}"
            results[kind].write.mode("overwrite").parquet(f"{base}/run_id={run}")  # a run that is saved again replaces its rows
            save_scores_csv(results[kind], f"{base}_csv/run_id={run}")
            out[kind] = base
    if "summary" in results:
        p = f"{output_dir.rstrip('/')}/summary/run_id={run}"
        to_json_safe(results["summary"]).write.mode("overwrite").text(p)
        out["summary"] = p
    return out


def save_bundles(bundles: DataFrame, path: str, anonymize: bool = True) -> str:
    """SNK-4: diagnostic bundles as JSON; by default the sensor names listed in ``data_summary.sensor_columns``
    are replaced (TXT-1/3) and paths masked (TXT-2) in every string of every field."""
    from tidewise.operators.textops import anonymize_bundles, name_dictionary

    b = bundles
    if anonymize:
        listed = F.col("data_summary")["sensor_columns"]
        names = b.select(F.explode(F.from_json(listed, "array<string>")).alias("name"))
        b = anonymize_bundles(b, name_dictionary(names, "name"))
    b.write.mode("overwrite").json(path)
    return path


def write_wide_csv(long: DataFrame, path: str, sensors: list[str], include_time: bool = True) -> str:
    """SNK-5: long readings -> wide CSV with ``date[, time], sensor_*`` (pivot with an explicit list), as many part files as tasks."""
    w = long.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("date"), F.date_format("ts", "HH:mm:ss").alias("time")) \
        .pivot("sensor", sensors).agg(F.first("value"))
    cols = ["date"] + (["time"] if include_time else []) + sensors
    w.select(*cols).write.mode("overwrite").option("header", True).csv(path)
    return path
