"""Language identification by language-bitmask n-gram filters.

The n-grams are 4-byte windows of the lower-cased letters (other ASCII counts as a space). A language *holds* an
n-gram whose rate in its training texts is at least ``share`` of the highest rate of any language. All
languages live in one bit-sliced Bloom filter: slot s has a bitmask with a bit for each language, so
the AND of an n-gram's ``HASHES`` slots gives, in one lookup, all languages that hold it (and some false ones). For
each document the bits are counted per language, corrected for the language's false-positive rate
(its share of set slots to the power HASHES), and the largest corrected count decides.

Scale: learning is one pass that counts n-grams inside the tasks, then a partial aggregate over
(language, n-gram); the filter is built by a distributed OR per slot and has at most ``MAX_SLOTS`` masks
per 62 languages (32 MB), whatever the corpus. Prediction is one row-local pass.

Cases: null text or text without a letter gives ``und`` and score 0, as does a corpus without a labelled row; a null
language isn't learned from; a null id is treated as the empty string by the split; ties go to the language with
more training n-grams, then to the smaller name; extra columns pass through ``predict``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewise.llm.bytewords import buffer, mix, release_memory, slices
from tidewise.session import ship_package

HASHES = 3
MAX_SLOTS = 1 << 22
PLANE = 62  # languages per mask word
UND = "und"
LEAST, FEW = 0.2, 20  # ``keep`` rejects below this share of what was learned, from so many n-grams on
# space for ASCII that is no letter
_KEEP = np.arange(256, dtype=np.uint8)
_KEEP[[b for b in range(128) if not chr(b).isalpha()]] = 32


def grams(texts: pa.Array, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, document of each) of rows lo..hi; texts are lower-cased already. A text stands between one
    space and two, so any text with a letter has an n-gram; windows with fewer than two letter bytes are left out
    unless the text has a single letter byte."""
    raw, at = buffer(texts, lo, hi)
    docs, n = hi - lo, len(raw)
    lengths = np.diff(at)
    out = np.full(n + 3 * docs, 32, dtype=np.uint8)
    out[np.arange(n) + np.repeat(3 * np.arange(docs) + 1, lengths)] = _KEEP[raw]
    wide = out.astype(np.uint32)
    keys = (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:] if len(out) > 3 else np.zeros(0, np.uint32)
    letter = np.concatenate(([0], np.cumsum(out != 32)))
    letters = letter[4:] - letter[:-4] if len(out) > 3 else np.zeros(0, np.int64)
    begin = at[:-1] + 3 * np.arange(docs)
    in_doc = letter[begin + lengths + 1] - letter[begin + 1] if docs else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(docs), lengths + 3)[: len(keys)]
    inside = np.arange(len(keys)) < (begin + lengths)[doc]
    good = inside & (letters >= np.minimum(2, np.maximum(in_doc, 1))[doc])
    return keys[good], doc[good]


def count_grams(labelled: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of (text, lang)."""
    ship_package(labelled.sparkSession)

    def run(batches):
        held: dict[str, list] = {}
        for b in batches:
            texts, langs = pc.utf8_lower(pc.fill_null(b.column(0), "")), b.column(1)
            for lo, hi in slices(texts, 1 << 20):
                keys, doc = grams(texts, lo, hi)
                lang = langs.slice(lo, hi - lo).dictionary_encode()
                code = np.asarray(lang.indices)[doc]
                for i, name in enumerate(lang.dictionary.to_pylist()):
                    own = np.unique(keys[code == i], return_counts=True)
                    held.setdefault(name, []).append(own)
                    if len(held[name]) >= 16:
                        held[name] = [_merge(held[name])]
                del keys, doc, code
                release_memory()
        for name, parts in held.items():
            keys, n = _merge(parts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))],
                                             names=["lang", "gram", "n"])

    return labelled.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _merge(parts):
    keys = np.concatenate([p[0] for p in parts])
    n = np.concatenate([p[1] for p in parts])
    u, inv = np.unique(keys, return_inverse=True)
    return u, np.bincount(inv, weights=n, minlength=len(u)).astype(np.int64)


def _slot_of(keys: np.ndarray, j: int, slots: int) -> np.ndarray:
    return (mix(keys.astype(np.uint64) + (np.uint64(j + 1) << np.uint64(33))) & np.uint64(slots - 1)).astype(np.int64)


class Model:
    """``langs`` (most trained first), ``masks`` [planes, slots], ``fp`` false-positive rate of each language, ``seen``
    the share of the language's n-grams that training has met (Good-Turing: all but the share of those met once)."""

    def __init__(self, langs: list[str], masks: np.ndarray, seen: list[float] = ()):
        self.langs, self.masks, self.seen = langs, masks, np.array(seen, dtype=float)
        self.fp = np.array([np.mean((masks[i // PLANE] >> np.uint64(i % PLANE)) & np.uint64(1)) ** HASHES for i in range(len(langs))])


def fit(labelled: DataFrame, share: float = 0.5) -> Model:
    """Learn from all rows of (text, lang) with a language."""
    from tidewise.session import cut_lineage

    spark = labelled.sparkSession
    counts = cut_lineage(count_grams(labelled.filter(F.col("lang").isNotNull()).select("text", "lang")), "lang-grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct"), F.count_if(F.col("n") == 1).alias("once"))
    known = sorted(totals.collect(), key=lambda r: (-r["total"], r["lang"]))  # one row per language
    if not known:
        return Model([], np.zeros((1, 1), dtype=np.uint64))
    langs = [r["lang"] for r in known]
    slots = 1 << 12
    while slots < min(MAX_SLOTS, 16 * max(r["distinct"] for r in known)):
        slots *= 2
    number = spark.createDataFrame([(r["lang"], i, float(r["total"])) for i, r in enumerate(known)], "lang string, i int, total double")
    rated = counts.join(F.broadcast(number), "lang").withColumn("rate", F.col("n") / F.col("total"))
    kept = rated.withColumn("top", F.max("rate").over(Window.partitionBy("gram"))).filter(F.col("rate") >= share * F.col("top"))

    def place(batches):
        for b in batches:
            keys, i = np.asarray(b.column(0)), np.asarray(b.column(1))
            bit = (np.uint64(1) << (i % PLANE).astype(np.uint64)).astype(np.int64)
            for j in range(HASHES):
                yield pa.RecordBatch.from_arrays([pa.array((i // PLANE).astype(np.int32)), pa.array(_slot_of(keys, j, slots)), pa.array(bit)],
                                                 names=["plane", "slot", "mask"])

    table = (kept.select("gram", "i").mapInArrow(place, "plane int, slot long, mask long")
             .groupBy("plane", "slot").agg(F.bit_or("mask").alias("mask"))).toArrow()  # at most planes x slots rows
    masks = np.zeros((-(-len(langs) // PLANE), slots), dtype=np.uint64)
    masks[np.asarray(table["plane"]), np.asarray(table["slot"])] = np.asarray(table["mask"]).astype(np.uint64)
    return Model(langs, masks, [1 - r["once"] / r["total"] for r in known])


def _scores(model: Model, texts: pa.Array, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Corrected counts [docs, langs] and the n-grams of each document."""
    keys, doc = grams(texts, lo, hi)
    docs = hi - lo
    n = np.bincount(doc, minlength=docs)
    out = np.zeros((docs, len(model.langs)))
    slots = [_slot_of(keys, j, model.masks.shape[1]) for j in range(HASHES)]
    for p, plane in enumerate(model.masks):
        held = plane[slots[0]]
        for s in slots[1:]:
            held = held & plane[s]
        for i in range(p * PLANE, min(len(model.langs), (p + 1) * PLANE)):
            hit = np.bincount(doc[(held >> np.uint64(i % PLANE)) & np.uint64(1) == 1], minlength=docs)
            out[:, i] = np.maximum(0, (hit - n * model.fp[i]) / max(1e-9, 1 - model.fp[i]))
    return out, n


def _judged(model: Model, column: pa.Array):
    """(lo, hi, whether there is a letter, best language, its score, n-grams) for slices of the texts."""
    letter = regex.compile(r"\p{L}")
    raw = pc.fill_null(column, "")
    texts = pc.utf8_lower(raw)
    for lo, hi in slices(texts):
        spoken = np.array([letter.search(t) is not None for t in raw.slice(lo, hi - lo).to_pylist()], dtype=bool)
        best, scores, n = np.zeros(hi - lo, dtype=np.int64), np.zeros(hi - lo), np.zeros(hi - lo, dtype=np.int64)
        if model.langs:
            found, n = _scores(model, texts, lo, hi)
            best = found.argmax(axis=1)
            scores = np.where(spoken, np.clip(found[np.arange(hi - lo), best] / np.maximum(n, 1), 0, 1), 0.0)
        yield lo, hi, spoken, best, scores, n


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the corrected share of n-grams that the language holds)."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # at most MAX_SLOTS masks per plane
    columns = [c for c in docs.columns if c not in ("lang_pred", "score")]
    docs = docs.select(*columns)
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    at = columns.index(text_col)

    def run(batches):
        m = shared.value
        for b in batches:
            for lo, hi, spoken, best, scores, _ in _judged(m, b.column(at)):
                names = [m.langs[k] if s and m.langs else UND for k, s in zip(best, spoken)]
                yield pa.RecordBatch.from_arrays([*b.slice(lo, hi - lo).columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                                 names=[*columns, "lang_pred", "score"])

    return docs.mapInArrow(run, schema)


def keep(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang", least: float = LEAST) -> DataFrame:
    """The documents that are in a learned language; columns unchanged. A text without a letter goes; of FEW
    n-grams or more, so does one whose score is below ``least`` times the share of n-grams that training has met of
    the best language. Where nothing was learned, or not of the language a row is labelled with, letters suffice."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at, label = docs.columns.index(text_col), docs.columns.index(lang_col)

    def run(batches):
        m = shared.value
        learned = pa.array(m.langs, pa.string())
        for b in batches:
            judge = np.asarray(pc.or_(pc.is_null(b.column(label)), pc.is_in(b.column(label), learned)))
            for lo, hi, spoken, best, scores, n in _judged(m, b.column(at)):
                good = spoken & (~judge[lo:hi] | (n < FEW) | (scores >= least * m.seen[best])) if m.langs else spoken
                yield b.slice(lo, hi - lo).filter(pa.array(good, pa.bool_()))
            release_memory()

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit_on_training(docs: DataFrame) -> Model:
    return fit(docs.filter(~held_out()).select("text", "lang"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document."""
    p = predict(docs.select("doc_id", held_out().alias("held_out"), "text"), fit_on_training(docs))
    return p.select("doc_id", "held_out", "lang_pred", "score")
