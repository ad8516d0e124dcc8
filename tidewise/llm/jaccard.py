"""Exact n-gram Jaccard join by signature trees.

A document's set is its distinct n-word shingles (64-bit hashes). Documents with equal sets form a class; one
of each class goes on. Two classes can only reach ``percent`` if they share a shingle among the first few of each
set in any fixed order (prefix filter); in ours a shingle comes first whose rarest word is rare in the corpus (by a count
sketch of fixed size), so that few strangers meet, which changes the work, not the result. Classes that share such a key meet in a bucket, and there a signature tree prunes:

* a member has its size, a bit map of its shingles (of a long document those with the smallest hashes, as many as fill
  half the map) and ``rest`` = size - bits set;
* a node has the OR of its members' maps, the range of their sizes and their largest ``rest``;
* two nodes are traversed together only while a pair below them could still reach the threshold: the overlap
  is at most rest (of the longer document, whose shingles are sampled more sparsely) + common bits.

What the trees leave are candidate pairs; a large bucket sends on a spanning forest of them. The components of the
candidates are clusters: every link lies inside one, and a class that lies in many common buckets is sent to its cluster
once. A long document's map says little, so clusters are pruned once more, by maps that grow with the set (two bits per
shingle; the larger of two is folded to the smaller), and their components are the clusters whose whole texts are
fetched. There signature trees name the pairs again, and every pair is verified, block pair by block pair. What leaves
a task is the number of links of each class and a spanning forest of them, so a group of n near copies sends 2 n
rows, not n * n; the forest gives the components. Both are exact.

Scale: a bucket over BLOCK members and a cluster over BLOCK_SHINGLES shingles are split into blocks by size, and
only block pairs whose size ranges fit meet in a task. Candidates, links and labels stay distributed.

Cases: null or empty texts have no set (n_shingles 0) and are their own component; fewer than n words make one
shingle of the whole sequence; repeated rows are one class; null ids are never the smallest unless all are
null; extra columns aren't read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewise.llm.bytewords import Words, slices
from tidewise.llm.components import components
from tidewise.session import Scratch, ship_package

BITS = 2048
SAMPLED = 1420  # shingles of a long document in its map: they set half the bits
LEAF, FAN = 16, 8
SMALL = 16  # buckets up to this size are one leaf; they are taken together
BLOCK = 1024
BLOCK_SHINGLES = 1 << 20
CELL_BITS = 22  # cells of the word counts that order the shingles: 4 MB are broadcast


def word_levels(docs: DataFrame) -> np.ndarray:
    """How often words occur, in steps of an eighth of a power of two, by the first CELL_BITS bits of their hashes (words of one cell
    are counted together). One byte per cell, whatever the corpus: a fixed size to collect and to broadcast."""
    segment = 1 << 16

    def run(batches):
        held = np.zeros(1 << CELL_BITS, dtype=np.uint32)
        for b in batches:
            for lo, hi in slices(b.column(0)):
                cell, n = np.unique((Words(b.column(0), lo, hi).hash >> np.uint64(64 - CELL_BITS)).astype(np.int64), return_counts=True)
                held[cell] += n.astype(np.uint32)
        for k in range(0, len(held), segment):
            some = np.flatnonzero(held[k:k + segment])
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array([k // segment], pa.int32()), pa.array([some.astype(np.uint16).tobytes()]), pa.array([held[k + some].tobytes()])],
                                                 names=["segment", "cells", "counts"])

    def add(group):
        total = np.zeros(segment, dtype=np.int64)
        for cells, counts in zip(group["cells"], group["counts"]):
            total[np.frombuffer(cells, dtype=np.uint16)] += np.frombuffer(counts, dtype=np.uint32)
        return pd.DataFrame({"segment": [group["segment"].iloc[0]], "levels": [np.minimum(8 * np.log2(total + 1.0), 254).astype(np.uint8).tobytes()]})

    parts = docs.select("text").mapInArrow(run, "segment int, cells binary, counts binary")
    out = np.zeros(1 << CELL_BITS, dtype=np.uint8)
    for r in parts.groupBy("segment").applyInPandas(add, "segment int, levels binary").collect():
        out[r["segment"] * segment:(r["segment"] + 1) * segment] = np.frombuffer(r["levels"], dtype=np.uint8)
    return out


def _least_common(size: int, percent: int) -> int:
    """Shingles that a set of this size shares at least with any set at the threshold."""
    return -(-percent * size // 100)


def _signature(u: np.ndarray) -> np.ndarray:
    bits = np.zeros(BITS, dtype=bool)
    if len(u) > SAMPLED:
        u = u[u < np.uint64(int(SAMPLED / len(u) * 2.0 ** 64))]
    bits[(u & np.uint64(BITS - 1)).astype(np.int64)] = True
    return np.packbits(bits)


def _level(size: np.ndarray) -> np.ndarray:
    """Binary logarithm of the bits of the large map: at least two per shingle; 0 for sets whose small map holds all."""
    return np.where(size > SAMPLED, np.ceil(np.log2(np.maximum(2 * size, 2))), 0).astype(np.int64)


def _large_map(u: np.ndarray) -> bytes | None:
    """Map of all shingles of a long document by their low bits, so that dropping the highest of these folds it."""
    level = int(_level(np.array([len(u)]))[0])
    if not level:
        return None
    bits = np.zeros(1 << level, dtype=bool)
    bits[(u & np.uint64((1 << level) - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def _set_id(u: np.ndarray) -> bytes:
    return hashlib.blake2b(u.tobytes(), digest_size=16).digest()


def shingle_sets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, set_id, short, sig, large, prefix) of every row; the last five are null for an empty set, and
    ``large`` is for all but long ones. ``short`` is the first half of set_id: enough to meet by, since a clash only adds a candidate."""
    shared = docs.sparkSession.sparkContext.broadcast(word_levels(docs))  # a byte for each of the 2 ** CELL_BITS cells

    def run(batches):
        levels = shared.value
        for b in batches:
            for lo, hi in slices(b.column(1)):
                w = Words(b.column(1), lo, hi)
                keys, first = w.grams(n)
                rarest = w.least(n, levels[(w.hash >> np.uint64(64 - CELL_BITS)).astype(np.int64)])
                size, ids, shorts, sigs, larges, prefixes = [], [], [], [], [], []
                for d in range(hi - lo):
                    u, place = np.unique(keys[first[d]:first[d + 1]], return_index=True)
                    size.append(len(u))
                    if not len(u):
                        ids.append(None), shorts.append(None), sigs.append(None), larges.append(None), prefixes.append(None)
                        continue
                    take = len(u) - _least_common(len(u), percent) + 1
                    ordered = u[np.argsort(rarest[first[d]:first[d + 1]][place], kind="stable")[:take]]
                    ids.append(_set_id(u))
                    shorts.append(int.from_bytes(ids[-1][:8], "little", signed=True))
                    sigs.append(_signature(u).tobytes())
                    larges.append(_large_map(u))
                    prefixes.append(ordered.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(size, pa.int64()), pa.array(ids, pa.binary()), pa.array(shorts, pa.int64()),
                     pa.array(sigs, pa.binary()), pa.array(larges, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "set_id", "short", "sig", "large", "prefix"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, set_id binary, short long, sig binary, large binary, prefix array<long>")


def _could(x, y, a, b, common, percent):
    """Whether node pairs (x[a], y[b]) can hold a pair that reaches the threshold."""
    whole = (x[2][a] <= SAMPLED) & (y[2][b] <= SAMPLED)  # nothing sampled: either side bounds the overlap
    rest = np.where(whole, np.minimum(x[3][a], y[3][b]), np.maximum(x[3][a], y[3][b]))
    return (100 + percent) * (rest + common) >= percent * (x[1][a] + y[1][b])


class Tree:
    """Signature tree over members sorted by size: levels of (OR maps, smallest and largest size, largest
    rest), leaves first. ``sig`` has BITS / 64 words per member."""

    def __init__(self, size: np.ndarray, sig: np.ndarray):
        rest = size - np.bitwise_count(sig).sum(axis=1).astype(np.int64)
        self.levels = [(sig, size, size, rest)]
        fan = LEAF
        while len(self.levels[-1][1]) > 1:
            s, lo, hi, r = self.levels[-1]
            cut = np.arange(0, len(lo), fan)
            self.levels.append((np.bitwise_or.reduceat(s, cut), np.minimum.reduceat(lo, cut), np.maximum.reduceat(hi, cut), np.maximum.reduceat(r, cut)))
            fan = FAN

    def fan(self, level: int) -> int:
        return LEAF if level == 1 else FAN


def _possible(x, y, a, b, percent):
    """Which node pairs (x[a], y[b]) of one level stay."""
    fits = (100 * x[2][a] >= percent * y[1][b]) & (100 * y[2][b] >= percent * x[1][a])
    out = np.zeros(len(a), dtype=bool)
    k = np.flatnonzero(fits)
    for lo in range(0, len(k), 1 << 16):
        part = k[lo:lo + (1 << 16)]
        i, j = a[part], b[part]
        common = np.bitwise_count(x[0][i] & y[0][j]).sum(axis=1).astype(np.int64)
        out[part] = _could(x, y, i, j, common, percent)
    return out


def traverse(left: Tree, right: Tree | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Member pairs that the dual traversal can't rule out; ``right`` None: pairs i < j within ``left``."""
    own = right is None
    right = left if own else right
    top = max(len(left.levels), len(right.levels)) - 1
    a, b = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
    for level in range(top, -1, -1):
        x, y = left.levels[min(level, len(left.levels) - 1)], right.levels[min(level, len(right.levels) - 1)]
        if level < top:
            fan_a = left.fan(level + 1) if level + 1 < len(left.levels) else 1
            fan_b = right.fan(level + 1) if level + 1 < len(right.levels) else 1
            ka = (a[:, None] * fan_a + np.arange(fan_a))[:, :, None]
            kb = (b[:, None] * fan_b + np.arange(fan_b))[:, None, :]
            a, b = (z.ravel() for z in np.broadcast_arrays(ka, kb))
            inside = (a < len(x[1])) & (b < len(y[1]))
            a, b = a[inside], b[inside]
        if own:
            keep = a < b if level == 0 else a <= b
            a, b = a[keep], b[keep]
        good = _possible(x, y, a, b, percent)
        a, b = a[good], b[good]
    return a, b


def _runs(batches, columns: int):
    """Whole runs of rows equal in the first ``columns`` columns, from batches sorted by them."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = pa.concat_tables([held, t]).combine_chunks() if held is not None else t.combine_chunks()
        if not len(t):
            continue
        change = np.zeros(len(t), dtype=bool)
        for k in range(columns):
            v = np.asarray(t.column(k))
            change[1:] |= v[1:] != v[:-1]
        cut = np.flatnonzero(change)
        last = cut[-1] if len(cut) else 0
        if last:
            yield t.slice(0, last), np.concatenate(([0], cut))
        held = t.slice(last)
    if held is not None and len(held):
        yield held.combine_chunks(), np.array([0, len(held)])


def _fixed(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Binary values of one width as rows of bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, width)


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest member of each member's component under the pairs (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _prune(rows: DataFrame, percent: int) -> DataFrame:
    """Signature trees over the buckets (key, i, j; sorted): candidate pairs (a, b), of a large bucket only a
    spanning forest."""
    def run(batches):
        for t, cuts in _runs(batches, 3):
            size = np.asarray(t.column("n_shingles"))
            sig = np.ascontiguousarray(_fixed(t.column("sig"), BITS // 8)).view(np.uint64)
            ids = t.column("set_id").to_pylist()
            bi, bj, blk = (np.asarray(t.column(c)) for c in ("i", "j", "blk"))
            length = np.diff(cuts)
            leaf = (sig, size, size, size - np.bitwise_count(sig).sum(axis=1).astype(np.int64))
            a_out, b_out = [], []
            few = (length > 1) & (length <= SMALL)
            for m in np.unique(length[few]):  # all small buckets of one size at once: each is a single leaf
                x, y = np.triu_indices(m, 1)
                begin = cuts[:-1][few & (length == m)]
                a, b = (begin[:, None] + x).ravel(), (begin[:, None] + y).ravel()
                good = _possible(leaf, leaf, a, b, percent)
                a_out.append(a[good])
                b_out.append(b[good])
            for lo, m in zip(cuts[:-1][length > SMALL], length[length > SMALL]):
                rows = np.arange(lo, lo + m)
                rows = rows[np.lexsort((size[rows], blk[rows]))]
                one, two = rows[blk[rows] == bi[lo]], rows[blk[rows] == bj[lo]]
                right = None if bi[lo] == bj[lo] else Tree(size[two], sig[two])
                if len(one) and len(two):
                    a, b = traverse(Tree(size[one], sig[one]), right, percent)
                    label = lo + _forest(one[a] - lo, two[b] - lo, m)
                    inner = np.flatnonzero(label != np.arange(lo, lo + m))
                    a_out.append(lo + inner)
                    b_out.append(label[inner])
            at = [np.concatenate(x).tolist() if x else [] for x in (a_out, b_out)]
            yield pa.RecordBatch.from_arrays([pa.array([ids[k] for k in x], pa.binary()) for x in at], names=["a", "b"])

    return rows.select("key", "i", "j", "blk", "n_shingles", "sig", "set_id").mapInArrow(run, "a binary, b binary")


def _possible_large(large: list[bytes | None], size: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which of the pairs (a, b) their large maps leave: the overlap is at most the common bits and what collides in either
    map. Pairs with a short document stay as they are."""
    level = _level(size)
    out = np.ones(len(a), dtype=bool)
    low = np.minimum(level[a], level[b])
    for to in np.unique(low[low > 0]):
        pairs = np.flatnonzero(low == to)
        members, at = np.unique(np.concatenate((a[pairs], b[pairs])), return_inverse=True)
        maps = np.empty((len(members), 1 << (to - 3)), dtype=np.uint8)
        for k, m in enumerate(members):
            bits = np.frombuffer(large[m], dtype=np.uint8)
            maps[k] = np.bitwise_or.reduce(bits.reshape(-1, 1 << (to - 3)), axis=0)
        maps = maps.view(np.uint64)
        rest = size[members] - np.bitwise_count(maps).sum(axis=1).astype(np.int64)
        x, y = at[:len(pairs)], at[len(pairs):]
        step = max(1, (1 << 22) // maps.shape[1])
        for lo in range(0, len(pairs), step):
            i, j = x[lo:lo + step], y[lo:lo + step]
            common = np.bitwise_count(maps[i] & maps[j]).sum(axis=1).astype(np.int64) + np.minimum(rest[i], rest[j])
            out[pairs[lo:lo + step]] = (100 + percent) * common >= percent * (size[members[i]] + size[members[j]])
    return out


def _named(size: np.ndarray, sig: np.ndarray, blk: np.ndarray, i: int, j: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of the members of one block pair that the signature trees leave."""
    order = np.argsort(size, kind="stable")
    one, two = order[blk[order] == i], order[blk[order] == j]
    if not len(one) or not len(two):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    a, b = traverse(Tree(size[one], sig[one]), None if i == j else Tree(size[two], sig[two]), percent)
    return one[a], two[b]


def _refine(rows: DataFrame, percent: int) -> DataFrame:
    """Clusters (key, i, j; sorted) pruned by the large maps: a spanning forest (a, b) of the pairs that stay."""
    def run(batches):
        for t, cuts in _runs(batches, 3):
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                part = t.slice(lo, hi - lo)
                size, ids = np.asarray(part.column("n_shingles")), part.column("set_id").to_pylist()
                sig = np.ascontiguousarray(_fixed(part.column("sig"), BITS // 8)).view(np.uint64)
                a, b = _named(size, sig, np.asarray(part.column("blk")), part.column("i")[0].as_py(), part.column("j")[0].as_py(), percent)
                good = _possible_large(part.column("large").to_pylist(), size, a, b, percent)
                label = _forest(a[good], b[good], len(ids))
                inner = np.flatnonzero(label != np.arange(len(ids)))
                yield pa.RecordBatch.from_arrays([pa.array([ids[k] for k in x], pa.binary()) for x in (inner, label[inner])], names=["a", "b"])

    return rows.select("key", "i", "j", "blk", "n_shingles", "sig", "large", "set_id").mapInArrow(run, "a binary, b binary")


def _block_pairs(member: DataFrame, percent: int) -> DataFrame:
    """``member`` (key, blk, n_shingles, ...) with i and j: a row for every pair of blocks of its key that it takes part
    in and whose size ranges fit; nearly every key has the one pair (0, 0)."""
    many = member.filter("blk > 0").select("key").distinct()
    sized = member.join(many, "key", "left_semi").groupBy("key", "blk").agg(F.min("n_shingles").alias("lo"), F.max("n_shingles").alias("hi"))
    first, second = sized.select("key", F.col("blk").alias("i"), F.col("hi").alias("hi_i")), sized.select("key", F.col("blk").alias("j"), F.col("lo").alias("lo_j"))
    pairs = first.join(second, "key").filter((F.col("i") <= F.col("j")) & (100 * F.col("hi_i") >= percent * F.col("lo_j")))
    ends = pairs.select("key", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("blk"))
    single = member.join(many, "key", "left_anti").withColumn("i", F.lit(0)).withColumn("j", F.lit(0))
    return member.join(ends, ["key", "blk"]).unionByName(single)


def _sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    out = []
    for lo, hi in slices(texts):
        keys, first = Words(texts, lo, hi).grams(n)
        out += [np.unique(keys[first[d]:first[d + 1]]) for d in range(hi - lo)]
    return out


def _linked(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which of the pairs (a, b) of sets reach the threshold: the shingles of each a are marked, those of its partners
    looked up, about 2 million at a time."""
    size = np.array([len(u) for u in sets], dtype=np.int64)
    words, flat = np.unique(np.concatenate(sets), return_inverse=True)
    start = np.concatenate(([0], np.cumsum(size)))
    marked, out = np.zeros(len(words), dtype=bool), np.zeros(len(a), dtype=bool)
    order = np.argsort(a, kind="stable")
    cut = np.concatenate(([0], np.flatnonzero(np.diff(a[order])) + 1, [len(a)])) if len(a) else np.zeros(1, dtype=np.int64)
    for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
        x = a[order[lo]]
        own = flat[start[x]:start[x + 1]]
        marked[own] = True
        step = max(1, (1 << 21) // int(size[b[order[lo:hi]]].max()))
        for k in range(lo, hi, step):
            pairs = order[k:min(hi, k + step)]
            y = b[pairs]
            first = np.cumsum(size[y]) - size[y]
            at = np.arange(int(size[y].sum())) + np.repeat(start[y] - first, size[y])
            common = np.add.reduceat(marked[flat[at]], first, dtype=np.int64)
            out[pairs] = 100 * common >= percent * (size[x] + size[y] - common)
        marked[own] = False
    return out


def _texts(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """The rows of ``wanted`` (doc_id, set_id, key, i, j, blk, copies) with their texts: a text is fetched by id and accepted by its
    set, so an id with several texts gives the right one (an equal row more than once)."""
    columns = ["key", "i", "j", "blk", "set_id", "copies", "text"]

    def run(batches):
        for b in batches:
            for lo, hi in slices(b.column(6)):
                part = b.slice(lo, hi - lo)
                own = [_set_id(u) for u in _sets(part.column(6), n)]
                ok = pa.array([x == y for x, y in zip(own, part.column(4).to_pylist())], pa.bool_())
                yield part.filter(ok)

    # one plan at every size: a few wanted rows aren't broadcast either
    got = docs.select(F.col("doc_id").alias("_id"), "text").join(wanted.hint("merge"), F.col("_id").eqNullSafe(F.col("doc_id"))).select(*columns)
    return got.mapInArrow(run, got.schema)


def _verify(rows: DataFrame, n: int, percent: int, tasks: int) -> DataFrame:
    """Every candidate pair of every cluster (block pair) is verified. Rows (a, b, null) are spanning links, rows
    (a, null, n) say that class a is linked to n documents of other classes there."""
    def run(batches):
        for t, cuts in _runs(batches, 3):
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                part = t.slice(lo, hi - lo)
                ids = part.column("set_id").to_pylist()
                once = [k for k in range(len(ids)) if k == 0 or ids[k] != ids[k - 1]]  # sorted: equal rows follow one another
                if len(once) < len(ids):
                    part = part.take(pa.array(once))
                    ids = part.column("set_id").to_pylist()
                sets = _sets(part.column("text").combine_chunks(), n)
                size = np.array([len(u) for u in sets])
                sig = np.stack([_signature(u) for u in sets]).view(np.uint64)
                a, b = _named(size, sig, np.asarray(part.column("blk")), part.column("i")[0].as_py(), part.column("j")[0].as_py(), percent)
                near = _possible_large([_large_map(u) for u in sets], size, a, b, percent)
                a, b = a[near], b[near]
                good = _linked(sets, a, b, percent)
                a, b = a[good], b[good]
                copies = np.asarray(part.column("copies"))
                count = np.zeros(len(sets), dtype=np.int64)
                np.add.at(count, a, copies[b])
                np.add.at(count, b, copies[a])
                label = _forest(a, b, len(sets))
                inner, some = np.flatnonzero(label != np.arange(len(sets))), np.flatnonzero(count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[x] for x in inner] + [ids[x] for x in some], pa.binary()),
                     pa.array([ids[x] for x in label[inner]] + [None] * len(some), pa.binary()),
                     pa.array([None] * len(inner) + count[some].tolist(), pa.int64())], names=["a", "b", "n"])

    rows = rows.repartition(tasks, "key", "i", "j").sortWithinPartitions("key", "i", "j", "set_id")
    return rows.mapInArrow(run, "a binary, b binary, n long")


def _clusters(classes: DataFrame, cluster: DataFrame, percent: int, carried: list[str]) -> DataFrame:
    """The classes of each cluster (v, c) in blocks by size, a row for each pair of blocks that a class takes part in."""
    inside = Window.partitionBy("key").orderBy("n_shingles", "set_id")
    before = F.coalesce(F.sum("n_shingles").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    member = classes.join(cluster, classes["set_id"] == cluster["v"]).select(F.col("c").alias("key"), "set_id", "n_shingles", *carried)
    return _block_pairs(member.withColumn("blk", F.floor(before / BLOCK_SHINGLES).cast("int")), percent)


def links(docs: DataFrame, sets: DataFrame, n: int, percent: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) between classes of ``sets`` that connect all that the threshold connects, and (a, n): the number of
    documents of other classes that class a is linked to, of all pairs that reach the threshold. Of its tables in ``scratch`` only
    the links stay."""
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    full = sets.filter(F.col("set_id").isNotNull())
    classes = scratch.keep(full.groupBy("set_id").agg(
        F.min("doc_id").alias("doc_id"), F.first("short").alias("short"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"),
        F.first("large").alias("large"), F.count(F.lit(1)).alias("copies")), "classes")
    keys = full.select("set_id", "short", "n_shingles", "prefix").dropDuplicates(["set_id"]).select(F.explode("prefix").alias("key"), "short", "n_shingles")
    # the size range is tested first: a member stays if the next smaller or larger one of its bucket fits
    place = Window.partitionBy("key").orderBy("n_shingles", "short")
    met = keys.withColumn("less", F.lag("n_shingles").over(place)).withColumn("more", F.lead("n_shingles").over(place))
    met = met.filter((100 * F.col("less") >= percent * F.col("n_shingles")) | (100 * F.col("n_shingles") >= percent * F.col("more")))
    member = scratch.keep(met.select("key", "short", "n_shingles", F.floor((F.row_number().over(place) - 1) / BLOCK).cast("int").alias("blk")), "buckets")
    scratch.drop("sets")
    spread = _block_pairs(member, percent).select("key", "i", "j", "blk", "short")
    rows = (spread.join(classes.select("short", "set_id", "n_shingles", "sig"), "short")
            .repartition(tasks, "key", "i", "j").sortWithinPartitions("key", "i", "j"))
    cluster = components(_prune(rows, percent))
    scratch.drop("buckets")
    rows = (_clusters(classes, cluster, percent, ["sig", "large"]).select("key", "i", "j", "blk", "n_shingles", "sig", "large", "set_id")
            .repartition(tasks, "key", "i", "j").sortWithinPartitions("key", "i", "j"))
    cluster = components(_refine(rows, percent))
    wanted = scratch.keep(_clusters(classes, cluster, percent, ["doc_id", "copies"]).select("doc_id", "set_id", "key", "i", "j", "blk", "copies"), "wanted")
    scratch.drop("classes")
    found = scratch.keep(_verify(_texts(docs, wanted, n), n, percent, tasks), "links")
    scratch.drop("wanted")
    return found.filter("n IS NULL").select("a", "b"), found.filter("n IS NOT NULL").groupBy("a").agg(F.sum("n").alias("n"))


def groups(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) for every row: component_id is the smallest doc_id that links reach,
    n_links the number of other rows at the threshold or above, equal sets among them."""
    ship_package(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    scratch = Scratch(docs.sparkSession, "jaccard")
    sets = scratch.keep(shingle_sets(docs, n, percent), "sets")
    own = scratch.keep(sets.select("doc_id", "n_shingles", "set_id"), "own")  # what is left of the sets after the join
    spanning, linked = links(docs, sets, n, percent, scratch)
    sets, label = own, components(spanning)
    smallest = sets.filter(F.col("set_id").isNotNull()).groupBy("set_id").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    smallest = smallest.join(label, smallest["set_id"] == label["v"], "left").select("set_id", "least", "copies", F.coalesce("c", "set_id").alias("c"))
    component = smallest.groupBy("c").agg(F.min("least").alias("component_id"))
    by_set = smallest.join(component, "c").join(linked, F.col("set_id") == linked["a"], "left").select(
        "set_id", "component_id", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    return (sets.select("doc_id", "n_shingles", "set_id").join(by_set, "set_id", "left")
            .select("doc_id", "n_shingles", F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                    F.coalesce("n_links", F.lit(0)).alias("n_links")))


def _with_set(docs: DataFrame, n: int) -> DataFrame:
    """``docs`` with ``_set``, the set_id of each row's text."""
    columns, at = docs.columns, docs.columns.index("text")

    def run(batches):
        for b in batches:
            for lo, hi in slices(b.column(at)):
                part = b.slice(lo, hi - lo)
                own = pa.array([_set_id(u) if len(u) else None for u in _sets(part.column(at), n)], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, own], names=[*columns, "_set"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("_set", T.BinaryType())]))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One document of every group, the smallest by (doc_id, set_id, text) with null ids last; columns unchanged. Rows
    without a word are their own groups, those equal in id and text one. Only rows whose id (or null) stands with
    several sets are looked up by their own set."""
    ship_package(docs.sparkSession)
    short = docs.select(F.col("doc_id").cast("long"), "text")
    scratch = Scratch(docs.sparkSession, "jaccard")
    sets = scratch.keep(shingle_sets(short, n, percent), "sets")
    own = scratch.keep(sets.select("doc_id", "n_shingles", "set_id"), "own")
    label = components(links(short, sets, n, percent, scratch)[0])
    sets = own
    full = sets.filter(F.col("set_id").isNotNull()).groupBy("set_id").agg(F.min("doc_id").alias("_id"))
    full = full.join(label, full["set_id"] == label["v"], "left").select(F.coalesce("c", "set_id").alias("c"), F.struct(F.col("_id").isNull(), "_id", "set_id").alias("s"))
    kept = full.groupBy("c").agg(F.min("s").alias("s")).select(F.col("s")["_id"].alias("_id"), F.col("s")["set_id"].alias("_own"))
    kept = kept.unionByName(sets.filter(F.col("set_id").isNull()).select(F.col("doc_id").alias("_id"), F.col("set_id").alias("_own")).distinct())
    ids = sets.groupBy("doc_id").agg(F.min("set_id").alias("a"), F.max("set_id").alias("b"), F.count("set_id").alias("k"), F.count(F.lit(1)).alias("m"))
    several = scratch.keep(ids.filter((F.col("a") != F.col("b")) | ((F.col("k") > 0) & (F.col("k") < F.col("m")))).select(F.col("doc_id").alias("_many")), "several")
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    plain = docs.join(kept.join(several, F.col("_id").eqNullSafe(F.col("_many")), "left_anti"), same).drop("_id").withColumnRenamed("_own", "_set")
    mixed = _with_set(docs.join(several, F.col("doc_id").eqNullSafe(F.col("_many")), "left_semi"), n)
    mixed = mixed.join(kept, same & F.col("_set").eqNullSafe(F.col("_own")), "left_semi")
    row = Window.partitionBy("doc_id", "_set", F.when(F.col("_set").isNull(), F.col("text"))).orderBy("text")
    return plain.unionByName(mixed).withColumn("_row", F.row_number().over(row)).filter("_row = 1").select(*docs.columns)


def report(docs: DataFrame) -> DataFrame:
    return groups(docs)
