"""Phrase collocation mining with Misra-Gries summaries.

Documents are put in blocks of text, written once. First pass: a block sends the hash of each distinct phrase of 1 to 4 words, with
its count, to the hash partition it falls in. A partition merges what the blocks sent into one Misra-Gries summary whose
capacity exceeds the partition's mass divided by the threshold, so that what a count can have lost stays below the threshold:
every phrase that often survives, in a thirtieth of the memory. The partition answers each block with those of its hashes that
survived. Second pass: the blocks count the phrases so named, by their words. Hashes only choose what is counted; a clash
costs work and changes no result.

The candidates are then scored at their weakest cut by joins with the counts, and dropped where a longer candidate explains them.

Scale: a phrase has at most one entry per block, so a hot phrase is no hot key; the number of partitions grows with the
number of blocks, so a partition keeps its size. Nothing is broadcast or collected but the number of blocks.

Cases: a null text is empty; a null lang is ``und`` (the same language as that name); repeated rows count as often as they occur; a
text longer than a block is a block of its own; ties go by phrase in UTF-8 order; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewise.llm.bytewords import mix, slices
from tidewise.session import Scratch, ship_package

MIN_COUNT = 30
LONGEST = 4
PERCENT = 80
TOP = 2000
SCALE = 2_000_000
BLOCK_BYTES = 4 << 20
#: rows of one Arrow batch that a block sends
BATCH_ROWS = 32

#: no byte of UTF-8: stands for the end of a piece, and of a document
_BREAK = b"\xff"
#: A-Z lower-cased; the ends of pieces .,;:!? and 0x0A-0x0D become line feeds
_BYTES = bytes(b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))
_ODD = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, payload): rows (lang, text) in compressed blocks of about ``block_bytes`` of text."""
    def packed(held: list[pa.RecordBatch]) -> bytes:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            for part in held:
                out.write_batch(part)
        return sink.getvalue().to_pybytes()

    def run(batches):
        from pyspark import TaskContext

        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                held.append(batch.slice(lo, hi - lo))
                size += pc.sum(pc.binary_length(held[-1].column(1))).as_py()
                if size >= block_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([packed(held)], pa.binary())], names=["block", "payload"])
                    number, held, size = number + 1, [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([packed(held)], pa.binary())], names=["block", "payload"])

    read = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return read.mapInArrow(run, "block long, payload binary")


class Phrases:
    """The phrases of one language's texts in a block. ``words`` are the distinct words, ``ids`` the running text as word numbers with
    ``gap`` at each break; ``counted(k)`` gives the distinct phrases of k words."""

    def __init__(self, lang: str, texts: list[bytes]):
        running = (b" " + _BREAK + b" ").join(t.translate(_BYTES).replace(b"\n", b" " + _BREAK + b" ") for t in texts)
        coded = pa.array([*running.split(), _BREAK], pa.binary()).dictionary_encode()
        self.lang = lang
        self.words = coded.dictionary.to_pylist()
        self.ids = coded.indices.to_numpy().astype(np.int64)
        self.gap = self.words.index(_BREAK)
        self.total = int((self.ids != self.gap).sum())
        person = hashlib.blake2b(lang.encode(), digest_size=16).digest()
        each = b"".join(hashlib.blake2b(w, digest_size=8, person=person).digest() for w in self.words)
        self.hashes = np.frombuffer(each, dtype=np.uint64)
        self.running = [self.ids]  # the phrase of k words that begins at each place, as a number; -1 where a break is in it

    def counted(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, count, hash) of each distinct phrase of k words; ``place`` is one start of it. Call with k = 1, 2, ... in turn."""
        if k == 1:
            key = np.where(self.ids == self.gap, -1, self.ids)
        else:
            before, word = self.running[-1][:-1], self.ids[k - 1:]
            key = np.where((before < 0) | (word == self.gap), -1, before * len(self.words) + word)
        found, place, number, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        skip = int(len(found) > 0 and found[0] < 0)
        self.running = [number - skip]
        place, count = place[skip:], count[skip:]
        hashed = np.full(len(place), np.uint64(k), dtype=np.uint64)
        for j in range(k):
            hashed += self.hashes[self.ids[place + j]] * _ODD[j]
        return place, count, mix(hashed)

    def text(self, place: np.ndarray, k: int) -> list[str]:
        at = [self.ids[place + j].tolist() for j in range(k)]
        return [b" ".join([self.words[i] for i in ids]).decode("utf-8", "replace") for ids in zip(*at)]


def _languages(payload: bytes) -> Iterator[Phrases]:
    texts: dict[str, list[bytes]] = {}
    for batch in pa.ipc.open_stream(payload):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist()):
            texts.setdefault(lang, []).append(text)
    while texts:
        yield Phrases(*texts.popitem())


def _split(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(partition, 32-bit key in it) of 64-bit hashes."""
    part = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), dtype=np.int64)
    return part, ((hashes >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def sent(held: DataFrame, bits: int) -> DataFrame:
    """(part, block, keys, counts): the distinct phrases of each block by hash partition."""
    def run(batches):
        for batch in batches:
            for block, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = [p.counted(k)[1:] for p in _languages(payload.as_py()) for k in range(1, LONGEST + 1)]
                hashes, counts = np.concatenate([h for _, h in found]), np.concatenate([c for c, _ in found])
                del found
                order = np.argsort(hashes)
                part, key = _split(hashes[order], bits)
                counts = counts[order].astype(np.uint32)
                ends = np.searchsorted(part, np.arange((1 << bits) + 1))
                rows = [(p, block, key[a:b].tobytes(), counts[a:b].tobytes()) for p, (a, b) in enumerate(zip(ends[:-1], ends[1:])) if b > a]
                for i in range(0, len(rows), BATCH_ROWS):
                    yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*rows[i:i + BATCH_ROWS])], names=["part", "block", "keys", "counts"])

    return held.mapInArrow(run, "part long, block long, keys binary, counts binary")


def misra_gries(chunks: Iterator[tuple[np.ndarray, np.ndarray]], capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(keys, counts, lost): a summary of at most ``capacity`` counters over chunks of (keys, counts), merged a few at a time. The
    true count of a key lies between its counter (0 without one) and that plus ``lost`` <= mass / (capacity + 1): a cut takes the
    same amount off at least capacity + 1 counters."""
    keys, counts, lost = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64), 0
    waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def merged() -> None:
        nonlocal keys, counts, lost
        every = np.concatenate([keys, *(k for k, _ in waiting)])
        weight = np.concatenate([counts, *(c for _, c in waiting)])
        waiting.clear()
        order = np.argsort(every)
        every, weight = every[order], weight[order]
        first = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1]))) if len(every) else np.zeros(0, dtype=np.int64)
        keys, counts = every[first], np.add.reduceat(weight, first) if len(first) else weight
        if len(keys) > capacity:
            cut = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
            counts = counts - cut
            keys, counts, lost = keys[counts > 0], counts[counts > 0], lost + cut

    for k, c in chunks:
        waiting.append((k, c.astype(np.int64)))
        if sum(len(x) for x, _ in waiting) > 4 * capacity + 65_536:
            merged()
    merged()
    return keys, counts, lost


def survivors(sends: DataFrame, threshold: int = MIN_COUNT) -> DataFrame:
    """(block, part, keys): of each block's hashes those that may stand ``threshold`` times in all."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        chunks = [(np.frombuffer(k, dtype=np.uint32), np.frombuffer(c, dtype=np.uint32)) for k, c in zip(group["keys"], group["counts"])]
        capacity = sum(int(c.sum()) for _, c in chunks) // threshold + 1
        keys, counts, lost = misra_gries(iter(chunks), capacity)
        often = keys[counts + lost >= threshold]
        if not len(often):
            return pd.DataFrame({"block": [], "part": [], "keys": []})
        answers = []
        for k, _ in chunks:
            at = np.minimum(np.searchsorted(often, k), len(often) - 1)
            answers.append(k[often[at] == k].tobytes())
        out = pd.DataFrame({"block": group["block"], "part": group["part"], "keys": answers})
        return out[out["keys"].str.len() > 0]

    return sends.groupBy("part").applyInPandas(run, "block long, part long, keys binary")


def _counted(held: pd.DataFrame, answers: pd.DataFrame, bits: int) -> pd.DataFrame:
    """Counts of the phrases named by the answers, and each language's number of words (phrase null)."""
    named = np.sort(np.concatenate([np.zeros(0, np.uint64), *(
        (np.uint64(p) << np.uint64(32)) | np.frombuffer(k, dtype=np.uint32).astype(np.uint64) for p, k in zip(answers["part"], answers["keys"]))]))
    out = []
    for payload in held["payload"]:
        for p in _languages(payload):
            out.append(pd.DataFrame({"lang": [p.lang], "words": [0], "phrase": [None], "f": [p.total]}))
            for k in range(1, LONGEST + 1):
                place, count, hashed = p.counted(k)
                if not len(named) or not len(place):
                    continue
                part, key = _split(hashed, bits)
                whole = (part.astype(np.uint64) << np.uint64(32)) | key.astype(np.uint64)
                keep = named[np.minimum(np.searchsorted(named, whole), len(named) - 1)] == whole
                out.append(pd.DataFrame({"lang": p.lang, "words": k, "phrase": p.text(place[keep], k), "f": count[keep]}))
    return pd.concat(out) if out else pd.DataFrame({"lang": [], "words": [], "phrase": [], "f": []})


def phrase_counts(docs: DataFrame, scratch: Scratch, threshold: int = MIN_COUNT, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, f) of all phrases of 1 to 4 words that stand ``threshold`` times in the language, (lang, n))."""
    held = scratch.keep(blocks(docs, block_bytes), "blocks")
    bits = min(max(held.count() - 1, 0).bit_length(), 31)
    answers = scratch.keep(survivors(sent(held, bits), threshold), "answers")
    counted = held.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        lambda left, right: _counted(left, right, bits), "lang string, words int, phrase string, f long")
    counts = scratch.keep(counted.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f")).filter((F.col("f") >= threshold) | (F.col("words") == 0)), "counts")
    scratch.drop("blocks", "answers")
    return counts.filter("words > 0").select("lang", "phrase", "words", "f"), counts.filter("words = 0").select("lang", F.col("f").alias("n"))


def _part(first: str, length: str):
    """Words first .. first + length - 1 (from 1) of a phrase."""
    return F.expr(f"array_join(slice(split(phrase, ' '), {first}, {length}), ' ')")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of each candidate at its lowest-scoring cut, the shortest first part on ties."""
    cuts = counts.filter("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _part("1", "k").alias("first"), _part("k + 1", "words - k").alias("rest"))
    known = counts.select("lang", "phrase", "f")
    cuts = cuts.join(known.toDF("lang", "first", "l"), ["lang", "first"]).join(known.toDF("lang", "rest", "r"), ["lang", "rest"])
    score = F.expr(f"({SCALE}BD * cast(a as decimal(20))) div (cast(l as decimal(20)) + r)")
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def explained(counts: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the highest count of a longer candidate that holds the phrase."""
    inner = "flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), s -> array_join(slice(split(phrase, ' '), s, m), ' '))))"
    inside = counts.filter("words > 2").select("lang", "f", F.explode(F.expr(inner)).alias("phrase"))
    return inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def report(docs: DataFrame, threshold: int = MIN_COUNT, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each language's first ``top`` collocations: lang, rank, phrase, a, l, r, n, score; counts the corpus when called."""
    ship_package(docs.sparkSession)
    counts, sizes = phrase_counts(docs, Scratch(docs.sparkSession, "collocations"), threshold, block_bytes)
    found = scored(counts).join(explained(counts), ["lang", "phrase"], "left")
    found = found.filter(F.expr(f"longer is null or 100BD * longer < {PERCENT}BD * a"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return first.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
