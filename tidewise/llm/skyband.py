"""Source divergence audit: which terms and which other sources set a source's wording apart from its language.

One pass counts terms per (lang, source) inside the map tasks and sends each (lang, source, term) of a flush once; a
language keeps the terms that at least ``MIN_DOCS`` of its documents hold. A share is
p = 1 + floor(10^9 (count + 5) / (N + 5 V)), in exact integers.

Part ``term``: within a group, the excess p - q over the language's share never falls when the group's count rises, the
language's count falls, or (on ties) the term comes earlier in UTF-8. So a term that ``TOP`` others dominate in
all three can't be among the first ``TOP``. Hash partitions of a group keep their skyband (the terms dominated by fewer than
``TOP`` others), these are merged ``FAN_IN`` at a time, and the rest is ranked exactly. No task holds more than
``SKYBAND_TERMS`` (merged: ``FAN_IN`` times as many) terms of a group on average, however large the group.

Part ``pair``: shares of a block of sources by a slice of the terms make a small matrix per task; the sums of absolute differences
of all its columns are added up over the slices. The result itself has a row for each ordered pair of sources of a language.

Cases: null text, lang and source are '' (the same group as an empty one); a group without kept terms takes part with count 0, and with
V = 0 its pair values are 0; repeated rows count as often as they occur; ties are broken by item in UTF-8 order; a very long
text is one document, counted in the flush it falls in; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewise.llm.bytewords import slices
from tidewise.session import Scratch, ship_package

MIN_DOCS = 30
TOP = 50
SCALE = 1_000_000_000
SMOOTH = 5
#: distinct terms that a map task holds before it sends its counts on
FLUSH_TERMS = 300_000
SKYBAND_TERMS = 16_384
FAN_IN = 8
#: terms and sources of one matrix
SLICE_TERMS = 4_096
BLOCK_SOURCES = 256

#: A-Z lower-cased; bytes of no term (ASCII but letters) become spaces
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of a term in a group and the number of the group's documents with it;
    each group has one row with a null term."""
    def rows(held: dict):
        for (lang, source), (seen, having) in held.items():
            terms = list(seen)
            yield pa.RecordBatch.from_arrays([
                pa.repeat(pa.scalar(lang), len(terms) + 1), pa.repeat(pa.scalar(source), len(terms) + 1),
                pa.array([None, *terms], pa.binary()).cast(pa.string()),
                pa.array([0, *seen.values()], pa.int64()), pa.array([0, *(having[t] for t in terms)], pa.int64()),
            ], names=["lang", "source", "term", "n", "docs"])

    def run(batches):
        held: dict = {}
        for batch in batches:
            for lo, hi in slices(batch.column(2)):
                part = batch.slice(lo, hi - lo)
                texts = part.column(2).cast(pa.large_binary())
                for lang, source, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts):
                    words = text.as_py().translate(_TERM_BYTES).split()
                    seen, having = held.setdefault((lang, source), (Counter(), Counter()))
                    seen.update(words)
                    having.update(set(words))
                if sum(len(seen) for seen, _ in held.values()) >= FLUSH_TERMS:
                    yield from rows(held)
                    held = {}
        yield from rows(held)

    empty = F.lit("")
    read = docs.select(F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source"), F.coalesce("text", empty).alias("text"))
    parts = read.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, total: str, kept: str) -> Column:
    """1 + floor(SCALE (count + SMOOTH) / (total + SMOOTH kept)) in decimals of 38 digits."""
    return F.expr(f"1 + (({SCALE}BD * (cast({count} as decimal(20)) + {SMOOTH})) div (cast({total} as decimal(20)) + {SMOOTH} * cast({kept} as decimal(16))))")


def skyband(more: np.ndarray, less: np.ndarray, early: np.ndarray, k: int, block: int = 512) -> np.ndarray:
    """Positions of the points that fewer than k others dominate: ``more`` at least, ``less`` at most as large, ``early``
    smaller (all distinct). In the order below a point's dominators come before it, and it is enough to count those
    that the skyband holds: of k or more dominators, the first k are in it themselves."""
    order = np.lexsort((early, less, -more))
    less, early = less[order], early[order]
    held = np.zeros(0, dtype=np.int64)
    for lo in range(0, len(order), block):
        at = np.arange(lo, min(lo + block, len(order)))
        beaten = ((less[held] <= less[at, None]) & (early[held] < early[at, None])).sum(axis=1)
        at = at[beaten < k]
        beaten = beaten[beaten < k]
        inside = (less[at] <= less[at, None]) & (early[at] < early[at, None]) & (at < at[:, None])
        held = np.concatenate((held, at[beaten + inside.sum(axis=1) < k]))
    return order[held]


def _skybands(rows: DataFrame, buckets: int, k: int) -> DataFrame:
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("term", ignore_index=True)  # by code point, which is the order of UTF-8 bytes
        kept = skyband(group["n"].to_numpy(), group["lang_n"].to_numpy(), np.arange(len(group)), k)
        return group.iloc[np.sort(kept)][["lang", "source", "term", "n", "lang_n"]]

    bucket = F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int").alias("bucket")
    return rows.groupBy("lang", "source", bucket).applyInPandas(run, "lang string, source string, term string, n long, lang_n long")


def top_terms(counts: DataFrame, groups: DataFrame, most_terms: int, k: int = TOP) -> DataFrame:
    buckets = -(-most_terms // SKYBAND_TERMS) or 1
    band = _skybands(counts, buckets, k)
    if buckets > 1:
        band = _skybands(band, -(-buckets // FAN_IN), k)
    excess = band.join(groups, ["lang", "source"]).withColumn("value", share("n", "total", "kept") - share("lang_n", "lang_total", "kept"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    return excess.filter("value > 0").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


def _distances(key: tuple, shares: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
    """Partial sums of |p - q| over one slice of the terms, for the pairs between two blocks of sources."""
    lang, first, second, _ = key
    term, terms = pd.factorize(shares["term"])
    matrix = {}
    for block in {first, second}:
        own = sources[sources["block"] == block]
        values = np.repeat(own["none"].fillna(0).to_numpy(dtype=np.int64)[None, :], len(terms), axis=0)
        here = (shares["block"] == block).to_numpy()
        values[term[here], pd.Index(own["source"]).get_indexer(shares["source"][here])] = shares["p"].to_numpy()[here]
        matrix[block] = own["source"].to_numpy(), values
    (names, a), (others, b) = matrix[first], matrix[second]
    out = []
    for i, name in enumerate(names):
        value = np.abs(b - a[:, i:i + 1]).sum(axis=0)
        out.append(pd.DataFrame({"source": name, "item": others, "value": value}))
        if first != second:
            out.append(pd.DataFrame({"source": others, "item": name, "value": value}))
    found = pd.concat(out) if out else pd.DataFrame({"source": [], "item": [], "value": []})
    return found[found["source"] != found["item"]].assign(lang=lang)[["lang", "source", "item", "value"]]


def distances(counts: DataFrame, groups: DataFrame, most_terms: int, most_sources: int) -> DataFrame:
    cuts, blocks = -(-most_terms // SLICE_TERMS) or 1, -(-most_sources // BLOCK_SOURCES) or 1
    block = F.pmod(F.xxhash64("source"), F.lit(blocks)).cast("int")

    def met(rows: DataFrame) -> DataFrame:
        """Each row once for every pair of blocks that its source's block is in."""
        rows = rows.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        return rows.withColumn("first", F.least("block", "other")).withColumn("second", F.greatest("block", "other"))

    shares = counts.join(groups, ["lang", "source"]).select("lang", "source", "term", share("n", "total", "kept").alias("p"))
    shares = met(shares).withColumn("cut", F.pmod(F.xxhash64("term"), F.lit(cuts)).cast("int"))
    none = F.when(F.col("kept") > 0, F.expr(f"1 + ({SCALE * SMOOTH}BD div (cast(total as decimal(20)) + {SMOOTH} * cast(kept as decimal(16))))"))
    sources = met(groups.select("lang", "source", none.alias("none"))).withColumn("cut", F.explode(F.sequence(F.lit(0), F.lit(cuts - 1))))
    by = ["lang", "first", "second", "cut"]
    parts = shares.groupBy(by).cogroup(sources.groupBy(by)).applyInPandas(_distances, "lang string, source string, item string, value long")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def report(docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank) of both parts; counts the corpus when called."""
    spark = docs.sparkSession
    ship_package(spark)
    scratch = Scratch(spark, "divergence")
    every = scratch.keep(term_counts(docs), "all")
    terms = every.filter("term is not null")
    kept = scratch.keep(terms.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).filter(F.col("docs") >= MIN_DOCS).drop("docs"), "kept")
    counts = scratch.keep(terms.drop("docs").join(kept, ["lang", "term"]), "counts")
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = every.filter("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = scratch.keep(groups.na.fill(0, ["total", "kept", "lang_total"]), "groups")
    scratch.drop("all")
    most_terms = groups.agg(F.max("kept")).first()[0] or 0
    most_sources = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    return distances(counts, groups, most_terms, most_sources).unionByName(top_terms(counts, groups, most_terms))
