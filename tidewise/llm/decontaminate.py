"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over consecutive words; the positions with 0 are ignored, so a substituted word under a 0
doesn't hide the passage. The seed hashes of the benchmark items are joined with those of the documents,
window by window. Each hit names a diagonal (document position - item position); along it the words are
compared one by one, and the best runs (match +1, mismatch -2) are the verified overlaps. Those of an item, also on
several diagonals (after an inserted or missing word), add up where they follow one another in the item and in the
document, on diagonals at most ``MAX_SHIFT`` words apart: the heaviest such chain counts. A document is contaminated by
an item if the chain matches ``min_words`` words, or 4/5 of a shorter item. Items of 5 to 12 words have seeds of their
own, which propose them wherever one word is substituted; their words are also compared over the whole item.

Words are lower-cased runs of letters and digits (any byte beyond ASCII counts as a letter).

Scale: the benchmark is taken in blocks of at most ``BLOCK_WORDS`` words (its size is counted first); a block's
seeds are broadcast, and the documents are passed over row-locally, once per block, without any shuffle. Only
verified pairs leave the tasks.

Cases: null or empty texts and items hold nothing, an empty table gives no pairs; items of one or two words (any
text holds such) contaminate a document that consists of them, items of three or four match as a whole; repeated items
and documents each give their own pairs; of equally heavy chains the first in the document is reported; very long texts
are taken whole, a chain only looks back over twice the item; extra columns pass through ``drop_contaminated``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewise.llm.bytewords import IS_PUNCTUATION, Words, mix, slices
from tidewise.session import ship_package

# fixed values: the masks
MASKS = ("11111", "1101101", "1011011", "110010011")
SHORT_MASKS = ("1111", "11011", "10111", "11101")
MIN_ITEM = 3
MIN_WORDS = 10
SHORT_ITEM = MIN_WORDS * 5 // 4
MAX_SHIFT = 8
BLOCK_WORDS = 1 << 20
_TABLE_BITS = 22
ODD = mix(np.arange(64, dtype=np.uint64)) | np.uint64(1)


def _positions(mask: str) -> list[int]:
    return [j for j, m in enumerate(mask) if m == "1"]


def seed_hashes(words: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the masked window that begins at each word (as many as fit)."""
    n = max(0, len(words) - len(mask) + 1)
    acc = np.full(n, sum(1 << j for j in _positions(mask)), dtype=np.uint64)
    for j in _positions(mask):
        acc += words[j:j + n] * ODD[j]
    return mix(acc)


class Index:
    """Seeds of a block of items. ``words[first[i]:first[i + 1]]`` are the word hashes of item i."""

    def __init__(self, ids: list, texts: list):
        w = Words(pa.array(texts, pa.string()), 0, len(texts), IS_PUNCTUATION)
        self.ids, self.words, self.first = ids, w.hash, w.first
        self.masks: dict[str, tuple] = {}
        lengths = np.diff(self.first)
        least, most = min(map(len, MASKS)), SHORT_ITEM
        # mask -> item lengths that it serves; "1" * n stands for whole items of n words
        uses = {mask: (least, None) for mask in MASKS}
        uses |= {mask: (least, most) for mask in SHORT_MASKS}
        whole = {"1" * int(n): int(n) for n in np.unique(lengths) if 0 < n < least}
        for mask in [*uses, *(m for m in whole if m not in uses)]:
            lo, hi = uses.get(mask, (whole.get(mask), whole.get(mask)))
            h, item, pos = [], [], []
            for i, n in enumerate(lengths):
                if n == 0 or not (lo <= n and (hi is None or n <= hi) or n == whole.get(mask)):
                    continue
                own = seed_hashes(self.words[self.first[i]:self.first[i + 1]], mask)
                h.append(own)
                item.append(np.full(len(own), i))
                pos.append(np.arange(len(own)))
            if h:
                h, item, pos = np.concatenate(h), np.concatenate(item), np.concatenate(pos)
                order = np.argsort(h, kind="stable")
                seen = np.zeros(1 << _TABLE_BITS, dtype=bool)
                seen[(h >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True
                self.masks[mask] = (h[order], item[order], pos[order], seen)

    def hits(self, w: Words) -> np.ndarray:
        """Distinct (document, item, diagonal) rows of a batch of documents."""
        ends = np.repeat(w.first[1:], np.diff(w.first))
        doc_of = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
        found = []
        for mask, (h, item, pos, seen) in self.masks.items():
            own = seed_hashes(w.hash, mask)
            n = len(own)
            fits = np.arange(n) + len(mask) <= ends[:n]
            if len(mask) < MIN_ITEM:  # only documents that consist of the item
                fits &= np.diff(w.first)[doc_of[:n]] == len(mask)
            at = np.flatnonzero(seen[(own >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] & fits)
            lo, hi = np.searchsorted(h, own[at]), np.searchsorted(h, own[at], side="right")
            count = hi - lo
            at = np.repeat(at, count)
            k = np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            found.append(np.stack([doc_of[at], item[k], at - pos[k]], axis=1))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), dtype=np.int64)

    def _overlaps(self, w: Words, doc: int, item: int, diagonal: int, need: int) -> list[tuple]:
        """The runs along a diagonal, (matched, mismatched, document from, to, item from, to) each: the best one, then
        the best before and after it, and so on, while they match enough words."""
        a, b = self.first[item], self.first[item + 1]
        lo = max(diagonal, w.first[doc])
        hi = min(diagonal + (b - a), w.first[doc + 1])
        same = self.words[a + lo - diagonal:a + hi - diagonal] == w.hash[lo:hi]
        if b - a <= SHORT_ITEM and hi - lo == b - a and same.sum() >= need:
            return [(int(same.sum()), int(b - a - same.sum()), int(lo), int(hi), 0, int(b - a))]
        least, out, rest = min(MIN_ITEM + 1, b - a), [], [(0, int(hi - lo))]
        while rest:
            x, y = rest.pop()
            if same[x:y].sum() < least:
                continue
            total = np.concatenate(([0], np.cumsum(np.where(same[x:y], 1, -2))))
            low = np.minimum.accumulate(total)
            end = int(np.argmax(total - low))
            begin = int(np.flatnonzero(total[:end + 1] == low[end])[-1])
            matched = int(same[x + begin:x + end].sum())
            if matched >= least:
                at = int(lo) + x
                out.append((matched, end - begin - matched, at + begin, at + end, int(at + begin - diagonal), int(at + end - diagonal)))
                rest += [(x, x + begin), (x + end, y)]
        return out

    def verify(self, w: Words, min_words: int = MIN_WORDS) -> list[tuple]:
        """(document, item, matched, mismatched, first word, last word) of every contaminated pair."""
        found: dict[tuple, list] = {}
        for doc, item, diagonal in self.hits(w).tolist():
            size = int(self.first[item + 1] - self.first[item])
            need = min(min_words, -(-4 * size // 5))
            found.setdefault((doc, item, size, need), []).extend(self._overlaps(w, doc, item, diagonal, need))
        out = []
        for (doc, item, size, need), runs in found.items():
            if sum(r[0] for r in runs) >= need:
                matched, mismatched, lo, hi = heaviest_chain(runs, size)
                if matched >= need:
                    out.append((doc, item, matched, mismatched, int(lo - w.first[doc]), int(hi - 1 - w.first[doc])))
        return out


def heaviest_chain(runs: list[tuple], size: int) -> tuple:
    """(matched, mismatched, document from, to) of the chain of runs that matches most words. Runs follow one
    another in the item and in the document, neighbours on diagonals at most MAX_SHIFT apart; so a run's
    predecessor begins at most twice the item's ``size`` and MAX_SHIFT words before it."""
    runs = sorted(runs, key=lambda r: r[2])
    chains: list[tuple] = []
    for i, r in enumerate(runs):
        best = (0, 0, r[2])
        for j in range(i - 1, -1, -1):
            p = runs[j]
            if p[2] < r[2] - 2 * size - MAX_SHIFT:
                break
            if p[3] <= r[2] and p[5] <= r[4] and abs((r[2] - r[4]) - (p[2] - p[4])) <= MAX_SHIFT and chains[j][0] > best[0]:
                best = chains[j]
        chains.append((best[0] + r[0], best[1] + r[1], best[2], r[3]))
    return max(chains, key=lambda c: (c[0], -c[2]))


def indexes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block_words: int = BLOCK_WORDS):
    """The benchmark as broadcast indexes of bounded size, one after the other."""
    spark = benchmark.sparkSession
    items = benchmark.select(id_col, text_col).filter(F.col(text_col).isNotNull())
    size = items.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).collect()[0][0]
    blocks = max(1, -(-int(size) // (block_words * 4)))  # a word and its separator take four bytes or more on average
    for k in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64(id_col, text_col), F.lit(blocks)) == k).collect()  # about 4 x block_words bytes
        yield spark.sparkContext.broadcast(Index([r[0] for r in rows], [r[1] for r in rows]))


def find(docs: DataFrame, benchmark: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, item_id, matched, mismatched, first_word, last_word): one row per contaminated pair."""
    ship_package(docs.sparkSession)
    out = None
    for index in indexes(benchmark):
        def run(batches, index=index):
            ix = index.value
            for b in batches:
                for lo, hi in slices(b.column(1)):
                    ids = b.column(0).slice(lo, hi - lo).to_pylist()
                    got = ix.verify(Words(b.column(1), lo, hi, IS_PUNCTUATION), min_words)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[g[0]] for g in got], pa.int64()), pa.array([ix.ids[g[1]] for g in got], pa.int64()),
                         *[pa.array([g[k] for g in got], pa.int64()) for k in range(2, 6)]],
                        names=["doc_id", "item_id", "matched", "mismatched", "first_word", "last_word"])

        part = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
            run, "doc_id long, item_id long, matched long, mismatched long, first_word long, last_word long")
        out = part if out is None else out.unionAll(part)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without a contaminated pair, all columns unchanged."""
    ship_package(docs.sparkSession)
    at = docs.columns.index("text")
    for index in indexes(benchmark):
        def run(batches, index=index):
            for b in batches:
                for lo, hi in slices(b.column(at)):
                    bad = {g[0] for g in index.value.verify(Words(b.column(at), lo, hi, IS_PUNCTUATION), min_words)}
                    keep = pa.array([i not in bad for i in range(hi - lo)], pa.bool_())
                    yield b.slice(lo, hi - lo).filter(keep)

        docs = docs.mapInArrow(run, docs.schema)
    return docs
