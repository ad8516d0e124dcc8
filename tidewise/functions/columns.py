"""Column-expression helpers shared by the operators (all JVM-side, codegen friendly)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SENSOR, TS, VALUE, BIN = "sensor", "ts", "value", "bin"


def nan_to_null(c: Column | str) -> Column:
    """NaN -> NULL. Spark orders NaN above every number and NaN poisons avg, so missing is always NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c.cast("double"))


def r6(c: Column | str) -> Column:
    """Round to 6 digits and turn -0.0 into 0.0 (stable value hashes across engines)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 6) + F.lit(0.0)



def sensor_window(order_col: str = BIN) -> Window:
    return Window.partitionBy(SENSOR).orderBy(order_col)



def lgamma_sql(x: str) -> str:
    """SQL text of log Gamma(x) for x > 0: shift by 10 then the Stirling series.

    Absolute error below 1e-13 for all x > 0 (Spark SQL has no lgamma builtin)."""
    z = f"(({x}) + 10.0D)"
    stirling = (f"(({z} - 0.5D) * ln({z}) - {z} + {0.5 * math.log(2 * math.pi)!r}D + 1.0D / (12.0D * {z}) "
                f"- 1.0D / (360.0D * power({z}, 3)) + 1.0D / (1260.0D * power({z}, 5)) - 1.0D / (1680.0D * power({z}, 7)))")
    shift = " + ".join(f"ln(({x}) + {j}.0D)" for j in range(10))
    return f"({stirling} - ({shift}))"



def days_between(later: Column, earlier: Column) -> Column:
    """Whole days between two DATE/TIMESTAMP_NTZ values (floor), timezone independent."""
    return F.timestamp_diff("DAY", earlier.cast("timestamp_ntz"), later.cast("timestamp_ntz")).cast("long")



def ordered_parts(df: DataFrame, order_cols: list[Column]) -> DataFrame:
    """``df`` sorted by range partitions, each row with its partition's number ``_pid``. Write it before use: two uses of the
    plan could see two samplings of the range boundaries."""
    return df.orderBy(*order_cols).withColumn("_pid", F.spark_partition_id())


def numbered(ordered: DataFrame, order_cols: list[Column], name: str = "rank") -> DataFrame:
    """1..N over the written result of ``ordered_parts``: per-partition counts (one row per partition), running offsets over
    that tiny table, and local row numbers plus the offset. The offsets table is bounded by the partition count."""
    local = ordered.withColumn(
        "_local", F.row_number().over(Window.partitionBy("_pid").orderBy(*order_cols))
    )
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    ).select("_pid", "_off")
    out = local.join(F.broadcast(offsets), "_pid").withColumn(name, (F.col("_local") + F.col("_off")).cast("long"))
    return out.drop("_pid", "_local", "_off")


def distributed_row_number(df: DataFrame, order_cols: list[Column], name: str = "rank") -> DataFrame:
    """1..N over a global order without moving every row into one task: a range-partitioned sort, written to the shared
    checkpoint folder (a lost executor only costs re-reading files), and ``numbered``. Runs its sort when called."""
    from tidewise.session import cut_lineage

    return numbered(cut_lineage(ordered_parts(df, order_cols), "rank"), order_cols, name)


def by_sensor(df: DataFrame) -> DataFrame:
    """Hash-partition on sensor with an explicit partition count ahead of a grouped-map kernel.

    Kernel stages are compute-heavy but byte-light, and AQE would coalesce them into a few
    tasks. A user ``repartition(n, sensor)`` (REPARTITION_BY_NUM) is never coalesced. Apply it
    *before* the per-sensor windows: they and the grouping then reuse this one exchange. ``n``
    (``spark.tidewise.kernelPartitions``, default 3 x default parallelism) differs from the
    shuffle partition count, so the planner cannot mistake it for an existing exchange and drop it.
    """
    from tidewise.session import ship_package

    spark = df.sparkSession
    ship_package(spark)  # every kernel path passes here: workers must import tidewise
    n = spark.conf.get("spark.tidewise.kernelPartitions", None)
    n = int(n) if n else 3 * spark.sparkContext.defaultParallelism
    if n == int(spark.conf.get("spark.sql.shuffle.partitions", "200")):
        n += 1
    return df.repartition(n, SENSOR)
