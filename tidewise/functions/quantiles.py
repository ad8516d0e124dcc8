"""Exact quantiles of groups of any size.

The built-in ``percentile`` keeps a group's value counts in one buffer of one task. That suits groups of a bounded size; a
group beyond ``BUFFER_ROWS`` goes another way: its histogram (group, value, count) is partially aggregated, sorted by range
over many tasks, and a running count of the partitions' totals tells which few partitions hold the asked ranks. Only those
are counted through. Equal values are one histogram row, so ties don't gather either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: rows of a group that ``percentile`` may buffer
BUFFER_ROWS = 5_000_000


def selected_quantiles(df: DataFrame, keys: list[str], col: str, probs: list[float]) -> DataFrame:
    """(keys, _q): linearly interpolated quantiles of the non-null values as an array in the order of ``probs``, by selection
    over range partitions. The sorted histogram is written once. Groups without values have no row."""
    from tidewise.session import cut_lineage

    hist = df.filter(F.col(col).isNotNull()).groupBy(*keys, F.col(col).cast("double").alias("_v")).agg(F.count("*").alias("_n"))
    hist = cut_lineage(hist.repartitionByRange(*keys, "_v").withColumn("_part", F.spark_partition_id()), "histogram")
    by = Window.partitionBy(*keys)  # a row per range partition at most
    parts = hist.groupBy(*keys, "_part").agg(F.sum("_n").alias("_here")).select(
        *keys, "_part", "_here",
        (F.sum("_here").over(by.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_here")).alias("_before"),
        F.sum("_here").over(by).alias("_total"))
    asked = F.array(*[F.struct(F.lit(i).alias("i"), (F.lit(float(p)) * (F.col("_total") - 1)).alias("at")) for i, p in enumerate(probs)])
    parts = parts.withColumn("_asked", F.filter(asked, lambda a: (F.ceil(a["at"]) >= F.col("_before")) & (F.floor(a["at"]) < F.col("_before") + F.col("_here"))))
    wanted = parts.filter(F.size("_asked") > 0).select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_part").alias("_p"), "_before", "_asked")
    same = F.col("_part") == F.col("_p")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    inside = Window.partitionBy("_part", *keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    rows = hist.join(wanted, same).withColumn("_end", F.sum("_n").over(inside) + F.col("_before"))
    first = F.col("_end") - F.col("_n")  # ranks first .. end - 1 have this value
    low = F.filter("_asked", lambda a: (F.floor(a["at"]) >= first) & (F.floor(a["at"]) < F.col("_end")))
    high = F.filter("_asked", lambda a: (F.ceil(a["at"]) >= first) & (F.ceil(a["at"]) < F.col("_end")))
    share = F.concat(
        F.transform(low, lambda a: F.struct(a["i"].alias("i"), (F.lit(1.0) - (a["at"] - F.floor(a["at"]))).alias("w"))),
        F.transform(high, lambda a: F.struct(a["i"].alias("i"), (a["at"] - F.floor(a["at"])).alias("w"))))
    values = rows.select(*keys, "_v", F.explode(share).alias("s"))
    sums = values.groupBy(*keys).agg(*[F.sum(F.when(F.col("s.i") == i, F.col("_v") * F.col("s.w"))).alias(f"_q{i}") for i in range(len(probs))])
    out = sums.select(*keys, F.array(*[f"_q{i}" for i in range(len(probs))]).alias("_q"))
    return out if keys else out.filter(F.col("_q")[0].isNotNull())


def aggregate_with_quantiles(df: DataFrame, keys: list[str], aggs: list[Column], col: str, probs: list[float],
                             buffer_rows: int | None = BUFFER_ROWS) -> DataFrame:
    """``df.groupBy(keys).agg(*aggs)`` with a column ``_q``, the array of quantiles of ``col``. Groups of more than
    ``buffer_rows`` rows go by selection (looked for only where the whole input has more); None says that groups are bounded."""
    q = F.percentile(F.col(col), F.array(*[F.lit(float(p)) for p in probs])).alias("_q")
    if buffer_rows is None or df.count() <= buffer_rows:
        return df.groupBy(*keys).agg(*aggs, q)
    hot = df.groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > buffer_rows).drop("_rows")
    if hot.isEmpty():
        return df.groupBy(*keys).agg(*aggs, q)
    ordinary = df.join(hot, keys, "left_anti").groupBy(*keys).agg(*aggs, q)
    large = df.join(hot, keys, "left_semi")
    rest = large.groupBy(*keys).agg(*aggs) if aggs else hot
    return ordinary.unionByName(rest.join(selected_quantiles(large, keys, col, probs), keys, "left"))
