"""Language-model scoring by context-tree weighting over bytes.

A text's tokens are written as bytes: lower-cased words, one space between them, END at last. Each byte is eight
binary decisions (a path in a 255-node tree), and every decision has a context tree over the ``DEPTH`` bytes before it
(END pads the beginning). A node s of a context tree with counts (a, b) mixes its Krichevsky-Trofimov estimate
with what its children (one more byte of context) say:

    Pw(s) = 1/2 KT(a, b) + 1/2 prod Pw(children),    at full depth Pw(s) = KT(a, b)

Training counts fix all Pw; a new decision gets the predictive mixture along its path: the KT rule (b + 1/2) / (a +
b + 1) of each depth, weighted by 1/2 KT / Pw of that node and what is left by the shallower ones. A context that
training lacks has zero counts: it weighs 1/2, says 1/2, and leaves all other nodes as they are.

Scale: documents are put in blocks inside the map tasks; a block sends each distinct (DEPTH + 1)-byte window
and each distinct word once. These are summed over all blocks, the trees are folded level by level with group-bys and
joins (one row per context and decision), and the values are joined back to the blocks that asked. Nothing is
broadcast or collected but two totals, so the model may grow with the corpus; a hot word has one row per block.

Cases: a null text is empty (it is the end token alone); a null id counts as the empty string in the split; repeated
rows are scored as they come; without training rows all counts are zero (each byte costs 8 bits, and the base has N = V = 0).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewise.functions.columns import lgamma_sql
from tidewise.llm.bytewords import Words, slices
from tidewise.session import Scratch, ship_package

DEPTH = 4
END = 0xFF  # no byte of UTF-8
BLOCK_BYTES = 16 << 20
WORD, WINDOW = 0, 1


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 7 == 2


def _signed(keys: np.ndarray) -> np.ndarray:
    return keys.astype(np.uint64).view(np.int64)


def token_stream(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): each text's words with one space between them and END at last."""
    lengths = w.end - w.start
    words = np.diff(w.first)
    size = np.bincount(np.repeat(np.arange(len(words)), words), weights=lengths + 1, minlength=len(words)).astype(np.int64)
    size = np.where(words > 0, size, 1)  # the last word's separator is the END byte
    at = np.concatenate(([0], np.cumsum(size)))
    out = np.full(at[-1], 0x20, dtype=np.uint8)
    begin = np.cumsum(lengths + 1) - (lengths + 1)
    blank = np.cumsum(words == 0) - (words == 0)  # texts without words before this one hold one byte each
    begin = begin + np.repeat(blank, words)
    total = int(lengths.sum())
    inside = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(begin, lengths) + inside] = w.low[np.repeat(w.start, lengths) + inside]
    out[at[1:] - 1] = END
    return out, at


def windows(stream: np.ndarray, at: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """The byte and the ``depth`` bytes before it, as one number for every byte; END pads a text's beginning."""
    key = stream.astype(np.uint64)
    inside = np.arange(len(stream)) - np.repeat(at[:-1], np.diff(at))
    for j in range(1, depth + 1):
        before = np.concatenate((np.full(min(j, len(stream)), END, dtype=np.uint8), stream[:-j])).astype(np.uint64)
        key |= np.where(inside >= j, before, np.uint64(END)) << np.uint64(8 * j)
    return key


def _pack(rows: list[pa.RecordBatch]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        for r in rows:
            out.write_batch(r)
    return sink.getvalue().to_pybytes()


def blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, payload): the rows of ``docs`` (doc_id, held, text) in compressed blocks of about ``block_bytes`` of text.
    Write it before use, so that a block stays what it is when a task is run again."""
    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held, size = [], 0
        for b in batches:
            for lo, hi in slices(b.column(2)):
                part = b.slice(lo, hi - lo)
                held.append(part)
                size += part.nbytes
                if size >= block_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([_pack(held)], pa.binary())], names=["block", "payload"])
                    number, held, size = number + 1, [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([_pack(held)], pa.binary())], names=["block", "payload"])

    return docs.mapInArrow(run, "block long, payload binary")


def _texts(payload: bytes):
    for b in pa.ipc.open_stream(payload):
        for lo, hi in slices(b.column(2)):
            yield b.slice(lo, hi - lo)


def _summed(parts: list[tuple]) -> tuple:
    keys = np.concatenate([p[0] for p in parts])
    codes, found = pd.factorize(keys)
    return found, np.bincount(codes, weights=np.concatenate([p[1] for p in parts]), minlength=len(found))


def ask(payloads: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(block, kind, key, n): every distinct word and window of a block with its training count (0 where only
    held-out texts have it)."""
    def run(batches):
        for batch in batches:
            for block, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                held: dict[int, list] = {WORD: [], WINDOW: []}
                for b in _texts(payload.as_py()):
                    w = Words(b.column(2), 0, len(b))
                    train = ~np.asarray(b.column(1))
                    stream, at = token_stream(w)
                    for kind, keys, weight in ((WORD, w.hash, np.repeat(train, np.diff(w.first))),
                                               (WINDOW, windows(stream, at, depth), np.repeat(train, np.diff(at)))):
                        codes, found = pd.factorize(keys)
                        held[kind].append((found, np.bincount(codes, weights=weight, minlength=len(found))))
                        if len(held[kind]) >= 8:
                            held[kind] = [_summed(held[kind])]
                for kind, parts in held.items():
                    keys, n = _summed(parts)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), block)), pa.array(np.full(len(keys), kind, dtype=np.int32)),
                                                      pa.array(_signed(keys)), pa.array(n.astype(np.int64))], names=["block", "kind", "key", "n"])

    return payloads.mapInArrow(run, "block long, kind int, key long, n long")


def _kt(a: str, b: str) -> str:
    """SQL of ln KT(a, b) = ln Gamma(a + 1/2) Gamma(b + 1/2) / (pi Gamma(a + b + 1))."""
    return f"({lgamma_sql(f'({a} + 0.5D)')} + {lgamma_sql(f'({b} + 0.5D)')} - {lgamma_sql(f'({a} + {b} + 1.0D)')} - {float(np.log(np.pi))!r}D)"


def _byte(key: str, j: int) -> str:
    return f"(shiftright({key}, {8 * j}) & 255)"


def window_costs(counts: DataFrame, scratch: Scratch, depth: int = DEPTH) -> DataFrame:
    """(key, cost): log10 probability of a window's byte after its context, from (key, n). The levels of the trees are the tables
    ``node0`` .. of ``scratch``."""
    # the eight decisions of a byte: node = leading one and the bits so far, bit = the next one
    # a context of d bytes is kept in the low d bytes, the latest byte lowest
    decisions = counts.select(
        "key", F.expr("cast(n as double)").alias("n"), F.expr("shiftrightunsigned(key, 8)").alias("ctx"),
        F.expr("explode(transform(sequence(0, 7), i -> named_struct("
               "'node', cast(shiftleft(1, i) | shiftright(key & 255, 8 - i) as int), 'bit', cast(shiftright(key & 255, 7 - i) & 1 as int))))").alias("x"),
    ).select("key", "n", "ctx", "x.node", "x.bit")
    level = decisions.groupBy("ctx", "node").agg(
        F.sum(F.expr("if(bit = 0, n, 0D)")).alias("a"), F.sum(F.expr("if(bit = 1, n, 0D)")).alias("b"))
    half = float(np.log(0.5))
    nodes: dict[int, DataFrame] = {}
    nodes[depth] = scratch.keep(level.select("ctx", "node", "a", "b", F.expr(_kt("a", "b")).alias("pw"), F.lit(1.0).alias("own")), f"node{depth}")
    for d in range(depth - 1, -1, -1):
        shallower = F.expr(f"ctx & {(1 << (8 * d)) - 1}L")
        up = (nodes[d + 1].groupBy(shallower.alias("ctx"), "node")
              .agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("pw").alias("below"))
              .withColumn("kt", F.expr(_kt("a", "b"))))
        most = F.greatest("kt", "below")
        pw = F.lit(half) + most + F.log1p(F.exp(F.least("kt", "below") - most))
        nodes[d] = scratch.keep(up.withColumn("pw", pw).select("ctx", "node", "a", "b", "pw", F.exp(F.lit(half) + F.col("kt") - F.col("pw")).alias("own")), f"node{d}")
    one = F.expr("(b + 0.5D) / (a + b + 1D)")
    path = nodes[0].select("ctx", "node", (F.col("own") * one).alias("p"), (1 - F.col("own")).alias("rest"))
    for d in range(1, depth + 1):
        parent = path.select(F.col("ctx").alias("up"), F.col("node").alias("up_node"), F.col("p").alias("up_p"), F.col("rest").alias("up_rest"))
        child = nodes[d].withColumn("up", F.expr(f"ctx & {(1 << (8 * (d - 1))) - 1}L"))
        path = (child.join(parent, [child["up"] == parent["up"], child["node"] == parent["up_node"]])
                .select(child["ctx"], child["node"], (F.col("up_p") + F.col("up_rest") * F.col("own") * one).alias("p"),
                        (F.col("up_rest") * (1 - F.col("own"))).alias("rest")))
    said = F.log10(F.expr("if(bit = 1, p, 1D - p)"))
    return decisions.join(path, ["ctx", "node"]).groupBy("key").agg(F.sum(said).alias("cost"))


def score(docs: DataFrame, depth: int = DEPTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of (doc_id, held, text): token counts, base score and the model's log10 probability."""
    spark = docs.sparkSession
    ship_package(spark)
    scratch = Scratch(spark, "lm")
    payloads = scratch.keep(blocks(docs.select(F.col("doc_id").cast("long"), F.col("held").cast("boolean"), "text"), block_bytes), "blocks")
    asked = scratch.keep(ask(payloads, depth), "asked")
    totals = scratch.keep(asked.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    n_docs = docs.filter(~F.col("held")).count()  # training end tokens
    row = totals.filter(f"kind = {WORD}").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("n") > 0).alias("v")).collect()[0]
    all_tokens, distinct = row["n"] + n_docs, row["v"] + (n_docs > 0)
    values = totals.filter(f"kind = {WORD}").select("kind", "key", F.col("n").cast("double").alias("value")).unionAll(
        window_costs(totals.filter(f"kind = {WINDOW}").select("key", "n"), scratch, depth).select(F.lit(WINDOW).alias("kind"), "key", F.col("cost").alias("value")))
    values = scratch.keep(values, "values")
    scratch.drop("counts", *[f"node{d}" for d in range(depth + 1)])
    answers = asked.select("block", "kind", "key").join(values, ["kind", "key"]).select("block", "kind", "key", "value")
    unit = float(np.log10(all_tokens + distinct + 1)) if all_tokens + distinct else 0.0
    end_count = float(n_docs)

    def run(_, payload: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        table = {kind: (pd.Index(part["key"].to_numpy()), part["value"].to_numpy()) for kind, part in known.groupby("kind")}

        def look(kind, keys):
            if not len(keys):
                return np.zeros(0)
            index, value = table[kind]
            return value[index.get_indexer(_signed(keys))]

        out = []
        for data in payload["payload"]:
            for b in _texts(data):
                w = Words(b.column(2), 0, len(b))
                docs, n = len(b), np.diff(w.first)
                doc = np.repeat(np.arange(docs), n)
                c = look(WORD, w.hash)
                base = np.bincount(doc, weights=np.log10(c + 1), minlength=docs) + np.log10(end_count + 1) - (n + 1) * unit
                stream, at = token_stream(w)
                cost = look(WINDOW, windows(stream, at, depth))
                out.append(pd.DataFrame({
                    "doc_id": b.column(0).to_pandas().astype("Int64"), "held_out": np.asarray(b.column(1)), "n_tokens": n + 1,
                    "n_known": np.bincount(doc[c > 0], minlength=docs) + (end_count > 0), "train_tokens": all_tokens,
                    "base_score": base, "score": np.bincount(np.repeat(np.arange(docs), np.diff(at)), weights=cost, minlength=docs),
                    "n_bytes": np.diff(at)}))
        columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes"]
        return pd.concat(out) if out else pd.DataFrame(columns=columns)

    got = payloads.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long")
    return got.withColumn("bits_per_byte", -F.col("score") / F.lit(float(np.log10(2))) / F.col("n_bytes"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document; ``bits_per_byte`` is the code length of the token stream."""
    return score(docs.select("doc_id", held_out().alias("held"), "text")).drop("n_bytes")
