"""Nearest neighbours by stable projections and kd-trees.

Vectors are scaled to length 1 and projected to ``DIMS`` dimensions by Gaussian (2-stable) directions. For two points at
distance d, projected distance squared / d squared follows a chi-square law with DIMS degrees of freedom. A
query verifies the points of the kd-tree's leaves on the original vectors, but for leaves whose distance D and its k-th best
distance d satisfy  chi2cdf(D*D / (d*d)) >= STOP: a closer point that is still unseen would have been projected that far with
probability 1 - STOP at most.

The top of the tree is fitted on a bounded sample (SAMPLE rows by hash) and cuts the projected space into cells. Each cell
gets a tree of its own, fitted in a task on one in RATE of its rows, whose leaves hold about BLOCK rows each, so leaves grow in
number with the table and stay equal in size. A leaf over BLOCK rows (by chance, or by equal projections) is split by hash;
a leaf or such a part is a unit. A query first searches its own unit, which bounds d; then it is sent, in one more
round, to the other units whose boxes the test can't rule out.

Units that are neighbours in the tree make one task's work: its points are held (HELD bytes of vectors at most), the queries sent
to it stream by. Within a unit a tree with leaves of TILE points rules out further ones. A leaf meets all its queries in one product
of float32 matrices; what comes within its rounding error of a query's k-th best is verified in float64, so the
products decide nothing. The queries sent grow with rows x rows / HELD, the products with rows x rows where the test rules out little.

Equal vectors are one point that keeps its k + 1 smallest ids, so a vector shared by a third of all rows is one
point in the index, and as a query it is searched once. Nothing of the corpus reaches the driver but the projected sample, the
trees and a number of rows for each leaf.

Cases: vectors that are null, zero, or hold null or non-finite components take no part; a vector is compared with those
of its own length only; rows equal in id and vector are one row, rows
equal in id alone are two (a query's own id never answers it, and only one such row is made up for); ties go to the smaller vec_id; an empty table, or
one without a row to ask for, gives no rows; other columns aren't read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from tidewise.session import Scratch, ship_package

DIMS = 8
STOP = 0.98
SAMPLE = 20_000
BLOCK = 8192
RATE = 256
LEAF = 64
TILE = 256
HELD = 48 << 20
QUERIES = 1024


def chi2_quantile(p: float, m: int = DIMS) -> float:
    """x with chi-square CDF p, for an even number of degrees of freedom."""
    def cdf(x):
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(m // 2))

    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cdf(mid) < p else (lo, mid)
    return hi


def directions(length: int) -> np.ndarray:
    return np.random.default_rng(7 + length).standard_normal((length, DIMS))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def project(x: np.ndarray) -> np.ndarray:
    return _unit(x.astype(np.float64)) @ directions(x.shape[1])


def split(points: np.ndarray, most: int) -> list[tuple]:
    """kd-tree as (axis, cut, left, right) nodes; a leaf is (None, rows). Halves the widest axis at its median."""
    nodes: list[tuple] = []

    def build(rows):
        at = len(nodes)
        nodes.append(())
        p = points[rows]
        width = p.max(axis=0) - p.min(axis=0) if len(rows) else np.zeros(1)
        if len(rows) <= most or width.max() == 0:
            nodes[at] = (None, rows)
            return at
        axis = int(width.argmax())
        cut = float(np.median(p[:, axis]))
        left = p[:, axis] < cut
        if not left.any():
            left = p[:, axis] <= cut
            cut = float(np.nextafter(cut, np.inf))
        nodes[at] = (axis, cut, build(rows[left]), build(rows[~left]))
        return at

    build(np.arange(len(points)))
    return nodes


def cells(nodes: list[tuple]) -> tuple[dict[int, int], np.ndarray, np.ndarray]:
    """Cell number of each leaf, and the cells' boxes (lower and upper corners, infinite outside)."""
    number, lows, highs = {}, [], []

    def walk(at, lo, hi):
        node = nodes[at]
        if node[0] is None:
            number[at] = len(lows)
            lows.append(lo)
            highs.append(hi)
            return
        axis, cut, left, right = node
        h, low = hi.copy(), lo.copy()
        h[axis] = low[axis] = cut
        walk(left, lo, h)
        walk(right, low, hi)

    walk(0, np.full(DIMS, -np.inf), np.full(DIMS, np.inf))
    return number, np.array(lows), np.array(highs)


def graft(nodes: list[tuple], inner: dict[int, list[tuple]]) -> list[tuple]:
    """The tree with the trees of ``inner`` (by cell) in place of its leaves."""
    number, out = cells(nodes)[0], list(nodes)
    for leaf, cell in number.items():
        if cell in inner:
            at = [leaf, *range(len(out), len(out) + len(inner[cell]) - 1)]
            moved = [n if n[0] is None else (n[0], n[1], at[n[2]], at[n[3]]) for n in inner[cell]]
            out[leaf] = moved[0]
            out += moved[1:]
    return out


class Tree:
    """A kd-tree as arrays, with the boxes of its leaves."""

    def __init__(self, nodes: list[tuple]):
        number, self.low, self.high = cells(nodes)
        ends = [n[0] is None for n in nodes]
        self.axis = np.array([-1 if e else n[0] for e, n in zip(ends, nodes)])
        self.cut = np.array([0.0 if e else n[1] for e, n in zip(ends, nodes)])
        self.down = np.array([i if e else n[2] for i, (e, n) in enumerate(zip(ends, nodes))])
        self.up = np.array([i if e else n[3] for i, (e, n) in enumerate(zip(ends, nodes))])
        self.leaf = np.array([number.get(i, -1) for i in range(len(nodes))])

    def locate(self, points: np.ndarray) -> np.ndarray:
        at, rows = np.zeros(len(points), dtype=np.int64), np.arange(len(points))
        while len(rows := rows[self.axis[at[rows]] >= 0]):
            node = at[rows]
            at[rows] = np.where(points[rows, self.axis[node]] < self.cut[node], self.down[node], self.up[node])
        return self.leaf[at]


def reach(last: np.ndarray, quantile: float) -> np.ndarray:
    """Squared projected distance from which the test rules out a leaf, by the k-th best cosine; -2 if there is none."""
    return np.where(last > -2, quantile * (np.maximum(0.0, 2 - 2 * last) + 1e-12), np.inf)


def gaps(low: np.ndarray, high: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distance of each box (row) to each point q (column)."""
    low, high, q = (x.astype(np.float32) for x in (low, high, q))
    out = np.zeros((len(low), len(q)), dtype=np.float32)
    step = max(1, (1 << 17) // max(1, len(q)))  # what fits a core's cache
    for a in range(0, len(low), step):
        for i in range(DIMS):
            d = low[a:a + step, i, None] - q[:, i]
            np.maximum(d, q[:, i] - high[a:a + step, i, None], out=d)
            np.maximum(d, 0, out=d)
            d *= d
            out[a:a + step] += d
    return out


class Search:
    """kd-trees over the points of some units; rows come by unit."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, copies: np.ndarray, units: np.ndarray, x: np.ndarray):
        order, low, high, of = [], [], [], []
        starts = np.flatnonzero(np.r_[True, units[1:] != units[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], len(units)]):
            p = project(x[a:b])
            for rows in (n[1] for n in split(p, TILE) if n[0] is None and len(n[1])):
                order.append(rows + a)
                low.append(p[rows].min(axis=0))
                high.append(p[rows].max(axis=0))
                of.append(units[a])
        self.low, self.high, self.of = np.array(low), np.array(high), np.array(of)
        self.ends = np.r_[0, np.cumsum([len(rows) for rows in order])]
        order = np.concatenate(order)
        self.points, self.ids, self.copies, self.x = points[order], ids[order], copies[order], x[order]
        self.scale = np.abs(self.x).max(axis=1).astype(np.float64)
        self.norm, self.flat = np.empty(len(order)), np.empty(self.x.shape, dtype=np.float32)
        for a, b in zip(self.ends, self.ends[1:]):
            u = self.x[a:b] / self.scale[a:b, None]
            self.norm[a:b] = np.sqrt((u * u).sum(axis=1))
            self.flat[a:b] = u / self.norm[a:b, None]

    def near(self, v: np.ndarray, own: np.ndarray, last: np.ndarray, need: int, quantile: float) -> tuple[np.ndarray, ...]:
        """(query, row, cosine, last): the best ``need`` points for each query, ties to the smaller id, of the leaves that the test
        leaves open, but for those of the unit ``own``. ``last``: the cosine that a query's points of rank ``need`` is known to
        reach, -2 if none; it is returned with what these points tell."""
        s = np.abs(v).max(axis=1).astype(np.float64)
        u = v / s[:, None]
        norm = np.sqrt((u * u).sum(axis=1))
        unit = u / norm[:, None]
        gap = gaps(self.low, self.high, unit @ directions(v.shape[1]))
        flat = unit.astype(np.float32)
        # rounding error of the products of unit vectors, by its bound for sums in any order
        eps = (v.shape[1] + 8) * 2.0**-24
        last = last.copy()
        best = [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)]
        found: list[tuple] = []
        product = np.empty(len(v) * TILE, dtype=np.float32)

        def verify():
            """Cosines of what was found; each query's best so far, and its new bound."""
            rows, points = (np.concatenate(x) for x in zip(*found))
            found.clear()
            cos, step = np.empty(len(rows)), max(1, (1 << 21) // v.shape[1])
            for a in range(0, len(rows), step):
                r, p = rows[a:a + step], points[a:a + step]
                cos[a:a + step] = ((self.x[p] / self.scale[p, None]) * u[r]).sum(axis=1) / (self.norm[p] * norm[r])
            keep = cos >= last[rows]
            q, p, c = (np.concatenate(x) for x in zip(best, (rows[keep], points[keep], cos[keep])))
            order = np.lexsort((self.ids[p], -c, q))
            q, p, c = q[order], p[order], c[order]
            first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, dtype=np.int64)
            group = np.repeat(first, np.diff(np.r_[first, len(q)]))
            upto = np.cumsum(self.copies[p])
            upto -= (upto - self.copies[p])[group]
            reached = (upto >= need) & (upto - self.copies[p] < need)
            last[q[reached]] = np.maximum(last[q[reached]], c[reached])
            keep = np.arange(len(q)) - group < need  # as many points hold as many smaller ids, or more
            best[:] = q[keep], p[keep], c[keep]
            return reach(last, quantile), (last - eps).astype(np.float32)

        open_to, least = reach(last, quantile), (last - eps).astype(np.float32)
        many, waiting = max(4096, 2 * len(v)), 0
        for leaf in np.argsort(gap.mean(axis=1), kind="stable"):
            asked = np.flatnonzero((gap[leaf] < open_to) & (own != self.of[leaf]))
            if not len(asked):
                continue
            a, b = self.ends[leaf], self.ends[leaf + 1]
            sent = flat if len(asked) == len(v) else flat[asked]
            if (n := (b - a) * len(asked)) > len(product):  # a leaf of equal projections
                product = np.empty(n, dtype=np.float32)
            near = np.matmul(self.flat[a:b], sent.T, out=product[:n].reshape(b - a, len(asked)))
            floor = least[asked]
            free = np.flatnonzero(floor < -1.5)
            if len(free) and b - a > need:
                floor[free] = np.partition(near[:, free], b - a - need, axis=0)[b - a - need] - np.float32(2 * eps)
            hit = np.flatnonzero(near.max(axis=0) >= floor)
            if len(hit):
                point, at = np.nonzero(near[:, hit] >= floor[hit])
                found.append((asked[hit[at]], point + a))
                waiting += len(at)
                if waiting > many:
                    open_to, least = verify()
                    waiting = 0
        if found:
            verify()
        q, p, c = best
        keep = c >= last[q]
        return q[keep], p[keep], c[keep], last


def valid(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, dim, v) of the vectors that take part; v packs the components, floats where the column has them, else doubles."""
    kind = _kind(vectors, vec_col)
    d = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<float>" if kind == "<f4" else "array<double>").alias("v"))

    def pack(batches):
        for b in batches:
            v = b.column(1)
            ends = v.offsets.to_numpy().astype(np.int64)
            ends -= ends[0]
            x = v.flatten().fill_null(math.nan).to_numpy(zero_copy_only=False).astype(kind) + np.array(0, dtype=kind)  # -0.0 is 0.0
            bad, some = (np.r_[0, np.cumsum(x)][ends] for x in (~np.isfinite(x), x != 0))
            packed = pa.Array.from_buffers(pa.binary(), len(v), [None, pa.py_buffer((ends * x.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x))])
            keep = pa.array((np.diff(bad) == 0) & (np.diff(some) > 0))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(ends).astype(np.int32)), packed], names=["vec_id", "dim", "v"]).filter(keep)

    return d.filter(F.col("v").isNotNull() & F.col("vec_id").isNotNull()).mapInArrow(pack, "vec_id long, dim int, v binary")


def _kind(vectors: DataFrame, vec_col: str) -> str:
    held = vectors.schema[vec_col].dataType
    return "<f4" if isinstance(held, ArrayType) and isinstance(held.elementType, FloatType) else "<f8"


def _matrix(column, kind: str) -> np.ndarray:
    """Packed vectors of one length."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), -1)


def _by_dim(batch, kind: str):
    """(dim, rows, vectors) of each length in a batch with columns dim and v."""
    dim = batch.column("dim").to_numpy()
    for d in np.unique(dim).tolist():
        own = np.flatnonzero(dim == d)
        yield d, own, _matrix(batch.column("v") if len(own) == len(batch) else batch.column("v").take(pa.array(own)), kind)


def distinct_points(rows: DataFrame, asking: DataFrame, k: int) -> DataFrame:
    """(n, p, ids, asked, dim, v): each vector once, numbered, with its smallest id, its k + 1 smallest ids, and whether it is in ``asking``.
    All of it comes from one shuffle, before which no task keeps more than k + 1 ids of a vector."""
    by = Window.partitionBy("v").orderBy("vec_id")
    few = rows.withColumn("r", F.dense_rank().over(by)).filter(F.col("r") <= k + 1)
    few = few.withColumn("before", F.lag("vec_id").over(by)).filter("before is null or before < vec_id")  # equal rows are one
    few = few.withColumns({f"id{i}": F.lead("vec_id", i).over(by) for i in range(1, k + 1)}).filter("before is null")
    ids = F.array_compact(F.array("vec_id", *(f"id{i}" for i in range(1, k + 1))))
    points = few.select("v", "dim", F.col("vec_id").alias("p"), ids.alias("ids"))
    return points.join(asking.hint("merge"), "v", "left").select(F.monotonically_increasing_id().alias("n"), "p", "ids", F.col("asked").isNotNull().alias("asked"), "dim", "v")


def _fit(points: DataFrame, top, most: int, kind: str) -> dict[int, dict[int, list[tuple]]]:
    """By dim and cell of the trees ``top``: a tree of the sampled points (dim, v) there; a leaf holds at most ``most`` of them."""
    def place(batches):
        for b in batches:
            cell, at = np.zeros(len(b), dtype=np.int64), np.zeros((len(b), DIMS))
            for d, own, x in _by_dim(b, kind):
                at[own] = project(x)
                cell[own] = top.value[d].locate(at[own])
            packed = pa.array([r.tobytes() for r in at], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("dim"), pa.array(cell), packed], names=["dim", "cell", "at"])

    def run(key, part: pd.DataFrame) -> pd.DataFrame:
        nodes = split(np.frombuffer(b"".join(part["at"]), dtype=np.float64).reshape(-1, DIMS), most)
        axis, cut, down, up = zip(*((-1, 0.0, -1, -1) if n[0] is None else n for n in nodes))
        return pd.DataFrame({"dim": [key[0]], "cell": [key[1]], "axis": [axis], "cut": [cut], "down": [down], "up": [up]})

    out: dict[int, dict[int, list[tuple]]] = {}
    placed = points.select("dim", "v").mapInArrow(place, "dim int, cell long, at binary")
    tree = "dim int, cell long, axis array<int>, cut array<double>, down array<int>, up array<int>"
    for r in placed.groupBy("dim", "cell").applyInPandas(run, tree).collect():  # about one node for BLOCK / 2 rows
        out.setdefault(r["dim"], {})[r["cell"]] = [(None, None) if n[0] < 0 else n for n in zip(r["axis"], r["cut"], r["down"], r["up"])]
    return out


class Units:
    """Leaves of all trees numbered through, the units that they are cut into, and the tasks' shares of these."""

    def __init__(self, trees: dict[int, Tree], size: dict[int, int], block: int, share: dict[int, int]):
        self.trees, self.first = trees, {}
        lows, highs, parts, of, at, n = [], [], [], [], -1, 0
        for dim, tree in trees.items():
            self.first[dim] = sum(map(len, lows))
            lows.append(tree.low)
            highs.append(tree.high)
            n = share[dim]  # vectors of two lengths share no task
            for leaf in range(len(tree.low)):
                rows = size.get(self.first[dim] + leaf, 0)
                parts.append(max(1, -(-rows // block)))
                for _ in range(parts[-1]):
                    if n >= share[dim]:
                        at, n = at + 1, 0
                    of.append(at)
                    n += -(-rows // parts[-1])
        self.low, self.high = (np.concatenate(x) if x else np.zeros((0, DIMS)) for x in (lows, highs))
        self.parts = np.array(parts, dtype=np.int64)
        self.unit = np.r_[0, np.cumsum(self.parts)]  # the first of each leaf
        self.leaf = np.repeat(np.arange(len(self.parts)), self.parts)
        self.task = np.array(of, dtype=np.int32)  # of each unit
        self.tasks = at + 1


def _leaf(trees: dict[int, Tree], first: dict[int, int], batch, kind: str) -> np.ndarray:
    out = np.zeros(len(batch), dtype=np.int64)
    for d, own, x in _by_dim(batch, kind):
        out[own] = first[d] + trees[d].locate(project(x))
    return out


def _pieces(batches, *names: str):
    """(values, rows) of stretches of rows equal in these columns."""
    for b in batches:
        if len(b):
            keys = [b.column(n).to_numpy(zero_copy_only=False) for n in names]
            cut = np.flatnonzero(np.r_[True, np.any([x[1:] != x[:-1] for x in keys], axis=0), True])
            for a, e in zip(cut, cut[1:]):
                yield tuple(int(x[a]) for x in keys), b.slice(a, e - a)


def _held(pieces: list, kind: str) -> Search:
    t = pa.Table.from_batches(pieces)
    return Search(*(t.column(n).to_numpy() for n in ("n", "p", "copies", "unit")), np.concatenate([_matrix(b.column("v"), kind) for b in pieces]))


def knn(vectors: DataFrame, every: int = 50, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", stop: float = STOP, block: int = BLOCK,
        rate: int = RATE, sample_rows: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row whose id ``every`` divides."""
    spark = vectors.sparkSession
    ship_package(spark)
    quantile, kind, need = chi2_quantile(stop), _kind(vectors, vec_col), k + 1
    tables = Scratch(spark, "knn")
    queries = valid(vectors.filter(F.col(id_col) % every == 0), id_col, vec_col)
    asking = queries.select("v").distinct().withColumn("asked", F.lit(True))
    points = tables.keep(distinct_points(valid(vectors, id_col, vec_col), asking, k), "points")
    more = tables.keep(points.filter(F.size("ids") > 1).select("n", "ids"), "ids")
    asked = points.filter("asked").select(F.col("n").alias("q"), "v")
    asked = tables.keep(queries.distinct().join(asked, "v").select(F.col("vec_id").alias("query_id"), "q"), "asked")

    count = {r["dim"]: r["count"] for r in points.groupBy("dim").count().collect()}  # one row per length
    total = sum(count.values())
    # the smallest hashes; the filter leaves about twice as many, so no task sorts the table
    most_hash = min(2**63 - 1, int(-(2**63) + 2**64 * min(1.0, 2 * sample_rows / max(1, total))))
    sample = points.select("dim", "v").filter(F.xxhash64("v") <= F.lit(most_hash)).orderBy(F.xxhash64("v"), "v").limit(sample_rows)

    def projected(batches):
        for b in batches:
            at = np.zeros((len(b), DIMS))
            for _, own, x in _by_dim(b, kind):
                at[own] = project(x)
            yield pa.RecordBatch.from_arrays([b.column("dim"), pa.array([r.tobytes() for r in at], pa.binary())], names=["dim", "at"])

    sample = sample.mapInArrow(projected, "dim int, at binary").toArrow()  # at most SAMPLE rows of DIMS numbers
    dims, at = sample["dim"].to_numpy(), np.frombuffer(b"".join(sample["at"].to_pylist()), dtype=np.float64).reshape(-1, DIMS)
    top = {d: split(at[dims == d], max(LEAF, int((dims == d).sum() * block / max(1, total)))) for d in sorted(count)}
    trees = {d: Tree(nodes) for d, nodes in top.items()}
    if total > block:
        inner = _fit(points.filter(F.pmod(F.xxhash64("v"), F.lit(rate)) == 0), spark.sparkContext.broadcast(trees), max(1, block // rate), kind)
        trees = {d: Tree(graft(nodes, inner.get(d, {}))) for d, nodes in top.items()}
    first_leaf = dict(zip(trees, np.cumsum([0, *(len(t.low) for t in trees.values())]).tolist()))
    forest = spark.sparkContext.broadcast((trees, first_leaf))

    def counted(batches):
        for b in batches:
            leaf, n = np.unique(_leaf(*forest.value, b, kind), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(n)], names=["leaf", "n"])

    size = points.select("dim", "v").mapInArrow(counted, "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n")).collect()  # one row per leaf
    # a task's share: enough tasks for every core, and no more than HELD
    wide = int(kind[2])
    share = {d: max(1, min(HELD // (d * wide), max(block, -(-total // (4 * spark.sparkContext.defaultParallelism))))) for d in trees}
    units = Units(trees, {r["leaf"]: r["n"] for r in size}, block, share)
    shared = spark.sparkContext.broadcast(units)
    tasks = max(1, units.tasks)

    def place(batches):
        u = shared.value
        for b in batches:
            leaf = _leaf(u.trees, u.first, b, kind)
            unit = u.unit[leaf] + (b.column("h").to_numpy().view(np.uint64) % u.parts[leaf].astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(u.task[unit]), pa.array(unit), *(b.column(n) for n in ("n", "p", "copies", "asked", "v"))],
                                             names=["task", "unit", "n", "p", "copies", "asked", "v"])

    placed = points.select("n", "p", F.size("ids").cast("long").alias("copies"), "asked", "dim", "v", F.xxhash64("n").alias("h"))
    placed = placed.mapInArrow(place, "task int, unit long, n long, p long, copies long, asked boolean, v binary")

    def answers(tree: Search, v: np.ndarray, own: np.ndarray, last: np.ndarray):
        """(from, bounds, lists of n, p and cos) of QUERIES queries after the other."""
        for a in range(0, len(v), QUERIES):
            q, rows, cos, now = tree.near(v[a:a + QUERIES], own[a:a + QUERIES], last[a:a + QUERIES], need, quantile)
            ends = pa.array(np.searchsorted(q, np.arange(len(now) + 1)).astype(np.int32))
            yield a, now, [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (tree.points[rows], tree.ids[rows], cos)]

    def at_home(batches):
        def unit(pieces):
            t = pa.Table.from_batches(pieces)
            t = t.filter(t["asked"]).combine_chunks()
            if not t.num_rows:
                return
            q, own, v = (t[n].combine_chunks() for n in ("n", "unit", "v"))
            for a, last, lists in answers(_held(pieces, kind), _matrix(v, kind), np.full(len(q), -1), np.full(len(q), -2.0)):
                of = [x.slice(a, len(last)) for x in (q, own, v)]
                yield pa.RecordBatch.from_arrays([*of, pa.array(last), *lists], names=["q", "own", "v", "last", "n", "p", "cos"])

        held, now = [], None
        for key, piece in _pieces(batches, "unit"):
            if held and key != now:
                yield from unit(held)
                held = []
            held, now = [*held, piece], key
        if held:
            yield from unit(held)

    home = placed.repartitionById(tasks, F.col("task")).sortWithinPartitions("task", "unit")
    home = tables.keep(home.mapInArrow(at_home, "q long, own long, v binary, last double, n array<long>, p array<long>, cos array<double>"), "home")

    def route(batches):
        u = shared.value
        if not len(u.task):
            return
        begin = np.flatnonzero(np.r_[True, u.task[1:] != u.task[:-1]])
        for whole in batches:
            step = max(1, (1 << 21) // len(u.task))
            for b in (whole.slice(a, step) for a in range(0, len(whole), step)):
                last, own = b.column("last").to_numpy(), b.column("own").to_numpy()
                near = np.zeros((len(u.task), len(b)), dtype=bool)
                lengths = np.array([len(x) for x in b.column("v").to_pylist()]) // wide
                for d in np.unique(lengths).tolist():
                    rows = np.flatnonzero(lengths == d)
                    at = project(_matrix(b.column("v").take(pa.array(rows)), kind))
                    leaves = slice(u.first[d], u.first[d] + len(u.trees[d].low))
                    of = slice(u.unit[leaves.start], u.unit[leaves.stop])
                    near[of, rows] = (gaps(u.low[leaves], u.high[leaves], at) < reach(last[rows], quantile))[u.leaf[of] - leaves.start]
                near[own, np.arange(len(b))] = False
                task, row = np.nonzero(np.logical_or.reduceat(near, begin, axis=0))
                sent, none = b.take(pa.array(row)), np.zeros(len(row), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(task.astype(np.int32)), pa.array(np.ones(len(row), dtype=np.int32)), sent.column("own"), sent.column("q"),
                                                  pa.array(none), pa.array(none), sent.column("last"), sent.column("v")], names=names)

    names = ["task", "kind", "unit", "n", "p", "copies", "last", "v"]
    routed = home.select("q", "own", "last", "v").mapInArrow(route, "task int, kind int, unit long, n long, p long, copies long, last double, v binary")
    both = placed.select("task", F.lit(0).alias("kind"), "unit", "n", "p", "copies", F.lit(0.0).alias("last"), "v").unionAll(routed)

    def away(batches):
        held, tree, now = [], None, None
        for (task, asks), piece in _pieces(batches, "task", "kind"):
            if task != now:
                held, tree, now = [], None, task
            if not asks:
                held.append(piece)
                continue
            if tree is None:
                tree = _held(held, kind)
                held = []
            q, own, last = piece.column("n"), piece.column("unit").to_numpy(), piece.column("last").to_numpy()
            for a, _, lists in answers(tree, _matrix(piece.column("v"), kind), own, last):
                some = pa.array(np.diff(lists[0].offsets.to_numpy()) > 0)
                yield pa.RecordBatch.from_arrays([q.slice(a, len(lists[0])), *lists], names=["q", "n", "p", "cos"]).filter(some)

    both = both.repartitionById(tasks, F.col("task")).sortWithinPartitions("task", "kind", "unit")
    found = both.mapInArrow(away, "q long, n array<long>, p array<long>, cos array<double>").unionAll(home.select("q", "n", "p", "cos"))
    found = found.repartition("q").select("q", F.explode(F.arrays_zip("n", "p", "cos")).alias("x")).select("q", "x.n", "x.p", "x.cos")
    # k + 1 points hold as many ids or more, which come before any id of a later point
    found = found.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("cos"), "p", "n"))).filter(F.col("r") <= need)
    found = tables.keep(found.select("q", "n", "p", "cos"), "found")
    tables.drop("points", "home")
    # back from points to ids: every query id asks as its point
    found = found.join(more, "n", "left").withColumn("ids", F.coalesce("ids", F.array("p")))
    ids = found.select("q", "cos", F.explode("ids").alias("vec_id")).withColumn("r", F.row_number().over(
        Window.partitionBy("q").orderBy(F.desc("cos"), "vec_id"))).filter(F.col("r") <= need)
    pairs = asked.join(ids.select("q", "cos", "vec_id"), "q").filter(F.col("vec_id") != F.col("query_id"))
    final = Window.partitionBy("query_id").orderBy(F.desc("cos"), "vec_id")
    return (pairs.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", F.col("cos").alias("score")))


def report(vectors: DataFrame) -> DataFrame:
    return knn(vectors)
