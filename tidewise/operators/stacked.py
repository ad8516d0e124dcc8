"""Per-sensor numpy kernels over stacks of sensors.

A kernel works on a matrix: one row per sensor, all with the same time points. The grid without NULLs arrives in Arrow
batches, partitioned by sensor and sorted within it, so a sensor's points follow one another; complete sensors are held until
``STACK_POINTS`` points are there, those with equal points are stacked, and the kernel runs once per stack. That replaces
one pandas frame and hundreds of small numpy calls per sensor. A task holds one stack and one sensor more.

Failures stay where they belong: when a stack fails, its sensors are run one by one, and one that fails alone gives one row
with its name and the message in ``error`` (other columns NULL).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewise.functions.columns import BIN, SENSOR, by_sensor

STACK_POINTS = 1 << 18

#: (names, t of n points, values as sensors x n, bins as a list of Arrow arrays) -> columns by name
Kernel = Callable[[list[str], np.ndarray, np.ndarray, list], dict]


_MICROS = {"day": 86_400_000_000, "hour": 3_600_000_000}


class Series:
    """One sensor's points: ``bin`` (Arrow), ``value``, and ``t``, whole units since its first point."""

    def __init__(self, name: str, parts: list[pa.RecordBatch], unit: str):
        self.name = name
        self.bin, value = (pa.chunked_array([p.column(i) for p in parts]).combine_chunks() for i in (1, 2))
        self.value = np.asarray(value.to_numpy(zero_copy_only=False), dtype=float)
        at = self.bin.cast(pa.timestamp("us")).cast(pa.int64()).to_numpy()
        self.t = ((at - at[0]) // _MICROS[unit]).astype(float)

    def points(self):
        """Equal for sensors that can be stacked."""
        n = len(self.t)
        return n, None if n and self.t[0] == 0 and self.t[-1] == n - 1 else self.t.tobytes()


def series(batches: Iterator[pa.RecordBatch], unit: str) -> Iterator[Series]:
    name, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        runs = pc.run_end_encode(batch.column(0))
        at = 0
        for value, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
            if parts and value != name:
                yield Series(name, parts, unit)
                parts = []
            name = value
            parts.append(batch.slice(at, end - at))
            at = end
    if parts:
        yield Series(name, parts, unit)


def guarded(kernel: Kernel, stack: list[Series], fields: list[str]) -> Iterator[dict]:
    """The kernel's columns; of a sensor that fails by itself one row with its name and the error."""
    try:
        yield kernel([s.name for s in stack], stack[0].t, np.stack([s.value for s in stack]), [s.bin for s in stack])
    except Exception as e:  # noqa: BLE001
        if len(stack) > 1:
            for s in stack:
                yield from guarded(kernel, [s], fields)
        else:
            yield {f: [stack[0].name if f == SENSOR else str(e) or type(e).__name__ if f == "error" else None] for f in fields}


def run_guarded(grouped: DataFrame, run: Callable, schema, on_error: Callable) -> DataFrame:
    """``run(pdf)`` on each sensor's rows in a grouped map; a sensor for which it fails gives ``on_error(pdf, message)``, so one bad
    sensor never ends a stage."""
    def guard(pdf):
        try:
            return run(pdf)
        except Exception as e:  # noqa: BLE001
            return on_error(pdf, str(e) or type(e).__name__)

    return grouped.groupBy(SENSOR).applyInPandas(guard, schema)


def run_stacks(grid: DataFrame, kernel: Kernel, schema: str, time_unit: str = "day") -> DataFrame:
    """``kernel`` on the non-null points of the sensors of ``grid`` (sensor, bin, value) -> ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema))

    def stacks(batches):
        held: dict = {}
        size = 0
        for s in series(batches, time_unit):
            held.setdefault(s.points(), []).append(s)
            size += len(s.t)
            if size >= STACK_POINTS:
                yield from held.values()
                held, size = {}, 0
        yield from held.values()

    def run(batches):
        for stack in stacks(batches):
            for found in guarded(kernel, stack, target.names):
                columns = [found[f.name] for f in target]
                columns = [c if isinstance(c, pa.Array) else pa.array(c, from_pandas=True) for c in columns]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, target)], schema=target)

    points = by_sensor(grid.filter(F.col("value").isNotNull()).select(SENSOR, BIN, "value"))
    return points.sortWithinPartitions(SENSOR, BIN).mapInArrow(run, schema)
