"""Histogram sort into shards of near equal bytes.

Rows are ordered by (k1, k2, k3): 62-bit hashes of the text, of the id and of a row number that the key table
fixes, so equal texts are neighbours and rows equal in text and id can still be told apart. For
each of the n - 1 splitters a bracket of the key space holds the wanted byte position. Every round cuts
all brackets into ``probes`` parts, counts the exact bytes below each cut over all partitions (one small
partial aggregate), and keeps the part that holds the position, until a cut is within ``tolerance`` of
it. When a bracket has shrunk to one text (a hot group of copies larger than the tolerance), refining goes
on inside it by k2, and inside one (text, id) by k3. Then the rows are exchanged once.

Slots: rows are numbered inside cells (shard, leading bits of k1, for heavy cells leading bits of k2, and where these
are heavy, too, of k3), so no task holds a whole shard, a hot text or a row repeated very often; a prefix sum over the
cell counts completes the number. The number of cells follows the number of rows.

Cases: a null text has size 1 (and the CRC of the empty text); null ids hash like any value; repeated rows (equal in
text and id) are cut like any others, which of them goes where follows their order in the files; a very long text is one
row of that size; an empty table has no rows; other columns than the id and the text aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewise.session import cut_lineage

BITS = 62
SPAN = 1 << BITS
KEYS = ("k1", "k2", "k3")
ROWS_PER_CELL = 1 << 20


def _key(*cols) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*cols), 64 - BITS)


def _count_below(keys: DataFrame, brackets: dict[int, tuple], probes: int) -> dict[int, dict[int, int]]:
    """Bytes in each of the ``probes`` parts of every bracket. A bracket is (fixed, lo, hi): it cuts [lo, hi) of
    the key after the ``fixed`` ones, among the rows that have these."""
    parts = []
    for i, (fixed, lo, hi) in brackets.items():
        k = F.col(KEYS[len(fixed)])
        inside = (k >= lo) & (k < hi)
        for name, value in zip(KEYS, fixed):
            inside = inside & (F.col(name) == value)
        step = -(-(hi - lo) // probes)
        parts.append(F.when(inside, F.struct(F.lit(i).alias("i"), (k - lo).alias("d"), F.lit(step).cast("long").alias("s"))))
    # a row lies in at most one part of each bracket; brackets often coincide in the first round
    cells = keys.select("size", F.explode(F.filter(F.array(*parts), lambda x: x.isNotNull())).alias("x"))
    rows = (cells.groupBy(F.col("x.i").alias("i"), F.expr("x.d div x.s").alias("c"))
            .agg(F.sum("size").alias("b")).collect())  # at most brackets x probes rows
    out: dict[int, dict[int, int]] = {i: {} for i in brackets}
    for r in rows:
        out[r["i"]][r["c"]] = r["b"]
    return out


def find_splitters(keys: DataFrame, n: int, total: int, tolerance: float = 0.002, probes: int = 256) -> list[tuple[int, int, int]]:
    """n - 1 keys (k1, k2, k3); a row belongs to the shard with as many splitters at or below its key. Each
    has within ``tolerance`` of a shard's share of bytes below it of its wanted number."""
    slack = max(1.0, tolerance * total / n)
    want = {i: total * i / n for i in range(1, n)}
    brackets = {i: ((), 0, SPAN) for i in want}
    below = {i: 0 for i in want}  # exact bytes below the bracket
    done: dict[int, tuple[int, int, int]] = {}
    while brackets:
        # equal brackets are counted once
        distinct = {}
        for i, b in brackets.items():
            distinct.setdefault(b, i)
        counts = _count_below(keys, {i: b for b, i in distinct.items()}, probes)
        for i, (fixed, lo, hi) in list(brackets.items()):
            cells, step = counts[distinct[fixed, lo, hi]], -(-(hi - lo) // probes)
            at, best, inside = below[i], (abs(below[i] - want[i]), lo), None
            for c in sorted(cells):
                if at <= want[i] < at + cells[c]:
                    inside = (c, at)
                at += cells[c]
                best = min(best, (abs(at - want[i]), min(hi, lo + (c + 1) * step)))
            nearest = (*fixed, best[1], 0, 0)[:3]
            if best[0] <= slack or inside is None:
                done[i] = nearest
                del brackets[i]
                continue
            new_lo = lo + inside[0] * step
            new_hi = min(hi, new_lo + step)
            below[i] = inside[1]
            if new_hi - new_lo > 1:
                brackets[i] = (fixed, new_lo, new_hi)
            elif len(fixed) < 2:
                brackets[i] = ((*fixed, new_lo), 0, SPAN)
            else:  # a single row
                done[i] = nearest
                del brackets[i]
    return [done[i] for i in sorted(done)]


def _leading(key: str, bits: int) -> Column:
    return F.shiftright(key, BITS - bits)


def shard(docs: DataFrame, n: int = 8, tolerance: float = 0.002, rows_per_cell: int = ROWS_PER_CELL, heavy_bits: int = 6) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row. A cell has ``rows_per_cell`` rows (less in small tables);
    one with over 4 times the mean is cut further by ``heavy_bits`` of the next key."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keys = cut_lineage(docs.select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        _key(text).alias("k1"), _key(F.col("doc_id")).alias("k2"), _key(F.monotonically_increasing_id()).alias("k3")), "shard-keys")
    total, rows = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).collect()[0]
    cell_bits = max(9, (rows // rows_per_cell).bit_length())
    keys = keys.withColumn("c1", _leading("k1", cell_bits))
    crowded = F.col("n") > 4 * rows / (1 << cell_bits)
    # at most a quarter of the cells is crowded, hashed keys make that the hot texts
    heavy = [r["c1"] for r in keys.groupBy("c1").agg(F.count(F.lit(1)).alias("n")).filter(crowded).select("c1").collect()]
    zero = F.lit(0).cast("long")
    keys = keys.withColumn("c2", F.when(F.col("c1").isin(heavy), _leading("k2", heavy_bits)).otherwise(zero) if heavy else zero)
    c3 = zero
    if heavy:
        again = keys.filter(F.col("c1").isin(heavy)).groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("n")).filter(crowded).collect()
        if again:  # few rows repeated very often
            c3 = F.when(F.struct("c1", "c2").isin([F.struct(F.lit(r["c1"]).alias("c1"), F.lit(r["c2"]).alias("c2")) for r in again]),
                        _leading("k3", heavy_bits)).otherwise(zero)
    splitters = find_splitters(keys, n, total, tolerance) if total else []
    number = F.lit(0)
    for k1, k2, k3 in splitters:
        beyond = (F.col("k2") > k2) | ((F.col("k2") == k2) & (F.col("k3") >= k3))
        number = number + ((F.col("k1") > k1) | ((F.col("k1") == k1) & beyond)).cast("int")
    placed = keys.withColumn("shard", number.cast("int")).withColumn("c3", c3)
    at = ["shard", "c1", "c2", "c3"]
    cells = placed.groupBy(*at).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy(*at[1:]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select(*at, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off"))
    inside = Window.partitionBy(*at).orderBy(*KEYS)
    numbered = placed.withColumn("at", F.row_number().over(inside))
    # the offsets have one row per cell: their number is bounded by the rows over rows_per_cell and the heavy cells' parts
    return (numbered.join(F.broadcast(offsets), at)
            .select("doc_id", "size", "text_crc32", "shard", (F.col("off") + F.col("at") - 1).alias("slot")))


def report(docs: DataFrame, n: int = 8) -> DataFrame:
    """One row per document under the ``bytes`` law."""
    return shard(docs, n).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                 F.lit(None).cast("int").alias("grown_shard"))
