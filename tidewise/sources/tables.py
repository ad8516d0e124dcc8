"""Bindings of the driver test tables to the canonical long ``readings`` schema.

| view        | sensor                        | ts            | value            |
|-------------|-------------------------------|---------------|------------------|
| orders_r    | o_orderpriority               | o_orderdate   | o_totalprice     |
| lineitem_r  | l_returnflag || l_linestatus  | l_shipdate    | l_extendedprice  |
| events_r    | event_type                    | ts            | value            |

Only the three columns are selected, so the parquet scan reads three columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewise.functions.columns import nan_to_null

BINDINGS = {
    "orders": ("o_orderpriority", "o_orderdate", "o_totalprice"),
    "lineitem": ("concat(l_returnflag, l_linestatus)", "l_shipdate", "l_extendedprice"),
    "events": ("event_type", "ts", "value"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str, name: str = "orders") -> DataFrame:
    sensor, ts, value = BINDINGS[name]
    df = table(spark, sf_dir, name)
    return df.select(
        F.expr(sensor).cast("string").alias("sensor"),
        F.col(ts).cast("timestamp_ntz").alias("ts"),
        nan_to_null(F.col(value)).alias("value"),
    )


def readings_sql(name: str = "orders") -> str:
    """The same binding as SQL (DuckDB views carry the table names)."""
    sensor, ts, value = BINDINGS[name]
    sensor = sensor.replace("concat(l_returnflag, l_linestatus)", "l_returnflag || l_linestatus")
    return f"SELECT {sensor} AS sensor, CAST({ts} AS TIMESTAMP) AS ts, CAST({value} AS DOUBLE) AS value FROM {name}"
