"""Scans: wide CSV of sensor readings (SRC-1..6, SRC-11), diagnostic bundles (SRC-7), log text (SRC-8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewise.config import DataConfig
from tidewise.functions.columns import nan_to_null


def _header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the first line, read by the CSV reader (quoted commas stay); the schema is then declared, never inferred."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p):
        raise FileNotFoundError(f"Data file not found: {path}")
    first = spark.read.option("header", False).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path).first()
    if first is None:
        raise ValueError(f"empty input: {path}")
    return [c or "" for c in first]


def detect_sensor_columns(columns: list[str], prefix: str = "sensor_") -> list[str]:
    """SRC-4: sensor columns by name prefix (schema only, no job)."""
    cols = [c for c in columns if c.startswith(prefix)]
    if not cols:
        raise ValueError(f"No sensor columns found with prefix '{prefix}'. Available columns: {columns}")
    return cols


def read_wide_csv_lenient(spark: SparkSession, path: str, cfg: DataConfig = DataConfig()) -> tuple[DataFrame, DataFrame, list[str]]:
    """SRC-2 lenient mode: unparseable timestamps do not fail the job; those rows go to a
    quarantine frame (with the raw date/time text) and the rest load as in :func:`read_wide_csv`."""
    wide, sensors = read_wide_csv(spark, path, cfg, lenient=True)
    bad = wide.filter(F.col("ts").isNull() & F.col("_date_raw").isNotNull())
    good = wide.filter(~(F.col("ts").isNull() & F.col("_date_raw").isNotNull())).drop("_date_raw", "_time_raw")
    return good, bad, sensors


def read_wide_csv(spark: SparkSession, path: str, cfg: DataConfig = DataConfig(), lenient: bool = False) -> tuple[DataFrame, list[str]]:
    """SRC-1/2/3/5: CSV with header -> wide frame ``ts, sensor_*`` (date/time columns dropped).

    The schema is built from the header: STRING for date/time, DOUBLE for sensors,
    STRING for anything else. Timestamp = date || ' ' || time when the time column
    exists (``concat`` keeps a NULL time NULL), else the date alone.
    """
    cols = _header(spark, path)
    if cfg.date_column not in cols:
        raise ValueError(f"Date column '{cfg.date_column}' not found in data")
    if cfg.sensor_columns:
        missing = [c for c in cfg.sensor_columns if c not in cols]
        if missing:
            raise ValueError(f"Sensor columns not found: {missing}")
        sensors = list(cfg.sensor_columns)
    else:
        sensors = detect_sensor_columns(cols, cfg.sensor_prefix)
    schema = T.StructType(
        [T.StructField(c, T.DoubleType() if c in sensors else T.StringType(), True) for c in cols]
    )
    raw = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    has_time = cfg.time_column is not None and cfg.time_column in cols
    text = F.concat(F.col(cfg.date_column), F.lit(" "), F.col(cfg.time_column)) if has_time else F.col(cfg.date_column)
    ts = F.try_to_timestamp(text).cast("timestamp_ntz") if lenient else F.to_timestamp_ntz(text)
    extra = []
    if lenient:
        extra = [F.col(cfg.date_column).alias("_date_raw"),
                 (F.col(cfg.time_column) if has_time else F.lit(None).cast("string")).alias("_time_raw")]
    wide = raw.select(ts.alias("ts"), *[nan_to_null(F.col(f"`{c}`")).alias(c) for c in sensors], *extra)
    return wide, sensors


def to_long(wide: DataFrame, sensor_cols: list[str], dropna: bool = False) -> DataFrame:
    """SRC-6: wide -> long ``(sensor, ts, value)`` with ``unpivot`` (NULL rows kept unless dropna)."""
    long = wide.unpivot(["ts"], sensor_cols, "sensor", "value").select(
        "sensor", "ts", nan_to_null(F.col("value")).alias("value")
    )
    return long.filter(F.col("value").isNotNull()) if dropna else long


def select_sensors(readings: DataFrame, names: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """SRC-11: keep the listed sensors (names trimmed); second frame lists unknown names (to warn about).

    The wanted list is a user argument (bounded), so it is a broadcast literal table.
    """
    if isinstance(names, str):
        names = [n.strip() for n in names.split(",") if n.strip()]
    spark = readings.sparkSession
    wanted = spark.createDataFrame([(n,) for n in names], "sensor string")
    kept = readings.join(F.broadcast(wanted), "sensor", "left_semi")
    unknown = wanted.join(readings.select("sensor").distinct(), "sensor", "left_anti")
    return kept, unknown


# --- diagnostic bundles (SRC-7) ---------------------------------------------------------------

HEALTH_CHECK = T.StructType(
    [
        T.StructField("check_name", T.StringType()),
        T.StructField("passed", T.BooleanType()),
        T.StructField("message", T.StringType()),
        T.StructField("details", T.MapType(T.StringType(), T.StringType())),
    ]
)
PROCESSING_STEP = T.StructType(
    [
        T.StructField("step_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("start_time", T.StringType()),
        T.StructField("end_time", T.StringType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("message", T.StringType()),
        T.StructField("metrics", T.MapType(T.StringType(), T.StringType())),
        T.StructField("details", T.MapType(T.StringType(), T.StringType())),
    ]
)
BUNDLE = T.StructType(
    [
        T.StructField("bundle_id", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("config", T.MapType(T.StringType(), T.StringType())),
        T.StructField("data_summary", T.MapType(T.StringType(), T.StringType())),
        T.StructField("health_checks", T.ArrayType(HEALTH_CHECK)),
        T.StructField("processing_steps", T.ArrayType(PROCESSING_STEP)),
        T.StructField("errors", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
        T.StructField("warnings", T.ArrayType(T.StringType())),
        T.StructField("results_summary", T.MapType(T.StringType(), T.StringType())),
        T.StructField("log_excerpt", T.StringType()),
    ]
)


def read_bundles(spark: SparkSession, path: str) -> DataFrame:
    """SRC-7: nested JSON bundles with a declared schema; absent optional keys become NULL."""
    return spark.read.schema(BUNDLE).option("multiLine", True).json(path)


def bundle_health_checks(bundles: DataFrame) -> DataFrame:
    return bundles.select("bundle_id", F.explode_outer("health_checks").alias("c")).select("bundle_id", "c.*")


def bundle_steps(bundles: DataFrame) -> DataFrame:
    return bundles.select("bundle_id", F.explode_outer("processing_steps").alias("s")).select("bundle_id", "s.*")


def read_log_lines(spark: SparkSession, path: str, parts: bool = False) -> DataFrame:
    """SRC-8: log files as ``(file, line_no, line)``, line numbers per file from 1, as by splitting the text at line feeds (a file
    that ends with one has an empty last line; a carriage return before one goes). An empty file has no rows. With ``parts`` the files
    under ``path``, in the order of their names, are one log that lies in parts, each ending with a line feed; its ``file`` is ``path``.

    Files are read in splits by many tasks. Spark numbers the lines of a split in order, so a line's number is its place in its
    split plus the lines of the file's earlier splits: a running sum over one row per split."""
    at = F.col("_metadata")
    raw = spark.read.option("lineSep", "\n").text(path).select(
        (F.lit(path) if parts else at["file_path"]).alias("file"), at["file_path"].alias("_part"),
        at["file_block_start"].alias("_split"), at["file_size"].alias("_size"), F.monotonically_increasing_id().alias("_id"), "value")
    splits = raw.groupBy("file", "_part", "_split", "_size").agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_lines"), F.sum(F.octet_length("value") + 1).alias("_bytes"))
    along = Window.partitionBy("file").orderBy("_part", "_split").rowsBetween(Window.unboundedPreceding, 0)
    offsets = splits.withColumn("_before", F.sum("_lines").over(along) - F.col("_lines"))
    lines = raw.drop("file", "_size").join(offsets.select("file", "_part", "_split", "_first", "_before"), ["_part", "_split"]).select(
        "file", (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line_no"), F.regexp_replace("value", "\r$", "").alias("line"))
    ends = splits.groupBy("file", "_part", "_size").agg(F.sum("_lines").alias("n"), F.sum("_bytes").alias("b"))
    last = ends.groupBy("file").agg(F.sum("n").alias("n"), F.max_by(F.col("b") == F.col("_size"), "_part").alias("closed")).filter("closed")
    return lines.unionByName(last.select("file", (F.col("n") + 1).alias("line_no"), F.lit("").alias("line")))
