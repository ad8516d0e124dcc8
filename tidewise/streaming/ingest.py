"""Incremental gridding of a reading stream (Structured Streaming).

Every micro-batch is reduced to (sensor, bin, count, sum) partials and written to a folder of its own; the
grid is the sum of all partials. Partials add up in any order, so old readings, overlapping bins and many
batches give the batch grid exactly, without a watermark that would drop late rows. A batch that is
run again after a failure overwrites its own folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewise.functions.columns import nan_to_null
from tidewise.session import run_folder

PARTS = "sensor string, bin timestamp, n bigint, total double, n_missing bigint"


def partial_grid(readings: DataFrame, sensor: str, ts: str, value: str, bin_size: str = "1 hour") -> DataFrame:
    """(sensor, bin, n, total, n_missing) partials of a batch of readings per tumbling bin."""
    r = readings.select(F.col(sensor).cast("string").alias("sensor"), F.col(ts).cast("timestamp").alias("ts"),
                        nan_to_null(F.col(value)).alias("value"))
    return (
        r.groupBy(F.window("ts", bin_size).alias("w"), "sensor")
        .agg(F.count("value").alias("n"), F.sum("value").alias("total"),
             F.count_if(F.col("value").isNull()).alias("n_missing"))
        .select("sensor", F.col("w.start").alias("bin"), "n", "total", "n_missing")
    )


def grid_from_parts(parts: DataFrame) -> DataFrame:
    """Sum the partials of all batches into a mean grid."""
    g = parts.groupBy("sensor", "bin").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    return g.select("sensor", F.col("bin").cast("timestamp_ntz").alias("bin"),
                    F.try_divide(F.col("total"), F.col("n")).alias("value"))


def _is_file(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isFile()


def run_stream_grid(spark, path: str, sensor: str, ts: str, value: str, bin_size: str = "1 hour",
                    folder: str | None = None, max_files: int | None = None) -> DataFrame:
    """Take all files that are in ``path`` now (available-now trigger) and return the merged grid.

    ``folder`` holds the stream's state and the partials. With the same folder a later call resumes: it takes
    the new files only, and the grid covers all files so far. Default: a new folder of this run."""
    folder = folder or f"{run_folder(spark)}/stream-{uuid.uuid4().hex}"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if _is_file(spark, path):
        # a file source watches a folder: watch the table's folder, admit only this file name
        path, _, name = path.rpartition("/")
        reader = reader.option("pathGlobFilter", name)

    def write(batch: DataFrame, batch_id: int) -> None:
        partial_grid(batch, sensor, ts, value, bin_size).write.mode("overwrite").parquet(f"{folder}/parts/batch={batch_id}")

    q = (reader.parquet(path).writeStream.foreachBatch(write)
         .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start())
    q.awaitTermination()
    return grid_from_parts(spark.read.schema(PARTS).parquet(f"{folder}/parts"))
