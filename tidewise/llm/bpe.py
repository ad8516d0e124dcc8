"""Byte-level BPE by merge replay over the words of a block.

A task takes its texts in blocks. The distinct words (matches of the split pattern) of a block are laid out
once as a linked list of symbols with an inverted index from token pair to positions. Merges are then
applied in rank order to all words at once, and only the neighbours of a merged pair are entered anew. If
a merge brings up a pair of lower rank, that pair goes first, and the rest of this word's occurrences
wait, so every word sees its merges in the order of the one-word algorithm. Each distinct word of a block is
encoded once however often it occurs.

Scale: a block is the unit of the index; blocks need no shuffle, no shared dictionary and no driver, and a
lost executor costs its blocks. Memory is bounded by the block's bytes (a longer text is its own block).

Cases: a null text is empty (no ids); a very long text or word is encoded whole; other columns aren't read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewise.llm.bytewords import release_memory, slices
from tidewise.session import ship_package


def load_ranks(path: str) -> dict[bytes, int]:
    """Rank file: one base64 token and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Codec:
    """Encodes and decodes words by a rank table. ``most_scalar``: occurrence lists up to this length are
    merged one by one, longer ones as arrays (the same steps; only the speed differs)."""

    def __init__(self, ranks: dict[bytes, int], most_scalar: int = 8):
        self.most_scalar = most_scalar
        self.token = {i: t for t, i in ranks.items()}
        self.ranks = ranks
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.shift = max(self.token).bit_length()
        self.pairs = {}  # (left, right) as one number -> merged id
        for t, i in ranks.items():
            for cut in range(1, len(t)):
                left, right = ranks.get(t[:cut]), ranks.get(t[cut:])
                if left is not None and right is not None:
                    self.pairs[left << self.shift | right] = i
        self.keys = np.array(sorted(self.pairs), dtype=np.int64)
        self.ids = np.array([self.pairs[int(k)] for k in self.keys], dtype=np.int32)

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids, -1 where the two tokens don't merge."""
        key = left.astype(np.int64) << self.shift | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ids[at], np.int32(-1))

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of every word, by replaying the merges over all of them."""
        known = self.ranks.get
        parts = [w for w in words if known(w) is None]
        lengths = np.array([len(w) for w in parts], dtype=np.int64)
        begin = np.concatenate(([0], np.cumsum(lengths)))
        n = int(begin[-1])
        place = np.int32 if n < 1 << 31 else np.int64  # a block's arrays are most of a task's memory
        sym = self.byte[np.frombuffer(b"".join(parts), dtype=np.uint8)] if n else np.zeros(0, np.int32)
        nxt, prv = np.arange(1, n + 1, dtype=place), np.arange(-1, n - 1, dtype=place)
        nxt[begin[1:][lengths > 0] - 1] = -1
        prv[begin[:-1][lengths > 0]] = -1
        pair = np.full(n, -1, dtype=np.int32)  # merged id of the pair that begins at a position, or -1
        live = np.flatnonzero(nxt >= 0)
        pair[live] = self._lookup(sym[live], sym[live + 1])
        self._replay(sym, nxt, prv, pair, np.repeat(np.arange(len(parts), dtype=place), lengths))
        left = np.flatnonzero(sym >= 0)
        ids, ends = sym[left].tolist(), np.searchsorted(left, begin).tolist()
        done = iter(range(len(parts)))
        out = []
        for w in words:
            whole = known(w)
            if whole is None:
                k = next(done)
                out.append(ids[ends[k]:ends[k + 1]])
            else:
                out.append([whole])
        return out

    def _replay(self, sym, nxt, prv, pair, word_of) -> None:
        """All merges in rank order, in place; a used-up position gets symbol -1."""
        held = np.flatnonzero(pair >= 0)
        order = held[np.argsort(pair[held], kind="stable")]
        ranks, first = np.unique(pair[order], return_index=True)
        # inverted index: merged id -> position arrays (first fill) and single positions (later pairs)
        index: dict[int, list] = {r: [p] for r, p in zip(ranks.tolist(), np.split(order, first[1:]))} if len(order) else {}
        heap = list(index)
        while heap:
            r = heapq.heappop(heap)
            lists = index.pop(r)
            positions = np.unique(np.concatenate([np.atleast_1d(x) for x in lists]))  # left to right, word by word
            if len(positions) <= self.most_scalar or not self._merge_all(r, positions, sym, nxt, prv, pair, index, heap):
                self._merge_each(r, positions.tolist(), sym, nxt, prv, pair, word_of, index, heap)

    def _merge_all(self, r, positions, sym, nxt, prv, pair, index, heap) -> bool:
        """Merge all occurrences as arrays. False (and nothing changed) where the order inside a word
        matters: overlapping occurrences, or a new pair of lower rank."""
        p = positions[pair[positions] == r]
        if not len(p):
            return True
        j = nxt[p]
        if (pair[j] == r).any():
            return False
        k = nxt[j]
        behind = k >= 0
        # a pair that lasts only until the next occurrence is merged, too, must not be of lower rank
        brief = k[behind][pair[k[behind]] == r]
        q = self._lookup(np.full(len(brief), r), sym[brief])
        if ((q >= 0) & (q < r)).any():
            return False
        old_p, old_j, old_pair_j = sym[p], sym[j], pair[j]
        sym[p], sym[j], nxt[p], pair[j] = r, -1, k, -1
        prv[k[behind]] = p[behind]
        h = prv[p]
        h = h[h >= 0]
        old_pair_h = pair[h]
        right, left = p[behind], h
        q_right = self._lookup(sym[right], sym[nxt[right]])
        q_left = self._lookup(sym[left], sym[nxt[left]])
        fresh = np.concatenate((q_right, q_left))
        if ((fresh >= 0) & (fresh < r)).any():
            sym[p], sym[j], nxt[p] = old_p, old_j, j
            prv[k[behind]] = j[behind]
            pair[h] = old_pair_h
            pair[j] = old_pair_j
            pair[p] = r
            return False
        pair[p] = -1
        pair[right], pair[left] = q_right, q_left
        at = np.concatenate((right, left))
        at, fresh = at[fresh >= 0], fresh[fresh >= 0]
        if len(at):
            order = np.argsort(fresh, kind="stable")
            at, fresh = at[order], fresh[order]
            cuts = np.flatnonzero(np.diff(fresh)) + 1
            for q, part in zip(fresh[np.concatenate(([0], cuts))].tolist(), np.split(at, cuts)):
                if q not in index:
                    index[q] = []
                    heapq.heappush(heap, q)
                index[q].append(part)
        return True

    def _merge_each(self, r, positions, sym, nxt, prv, pair, word_of, index, heap) -> None:
        """Merge occurrences from left to right. Once a lower rank comes up in a word, the word's other
        occurrences wait until that pair has been merged."""
        sym, nxt, prv, pair = memoryview(sym), memoryview(nxt), memoryview(prv), memoryview(pair)
        get, shift = self.pairs.get, self.shift
        blocked, waiting = -1, []

        def enter(q, i):
            if q not in index:
                index[q] = []
                heapq.heappush(heap, q)
            index[q].append(i)

        for i in positions:
            if pair[i] != r:
                continue  # used up by an earlier merge
            if blocked >= 0 and word_of[i] == blocked:
                waiting.append(i)
                continue
            j = nxt[i]
            k = nxt[j]
            h = prv[i]
            sym[i], sym[j], nxt[i], pair[i], pair[j] = r, -1, k, -1, -1
            if k >= 0:
                prv[k] = i
                q = get(r << shift | sym[k], -1)
                pair[i] = q
                if q >= 0:
                    enter(q, i)
                    if q < r:
                        blocked = word_of[i]
            if h >= 0:
                q = get(sym[h] << shift | r, -1)
                pair[h] = q
                if q >= 0:
                    enter(q, h)
                    if q < r:
                        blocked = word_of[i]
        for i in waiting:
            enter(r, i)

    def decode(self, ids: Iterable[int]) -> bytes:
        token = self.token
        return b"".join([token[i] for i in ids])


def encode_texts(codec: Codec, pattern, texts: Iterable[str | None]) -> Iterator[tuple[list[int], dict[int, list[int]]]]:
    """For each text: the numbers of its words, and the block's word ids. The caller joins them."""
    number: dict[str, int] = {}
    rows = []
    for t in texts:
        found = pattern.findall(t) if t else []
        for w in set(found):
            if w not in number:
                number[w] = len(number)
        rows.append(np.fromiter(map(number.__getitem__, found), dtype=np.int32, count=len(found)))
    ids = codec.encode_words([w.encode("utf-8", "surrogatepass") for w in number])
    return rows, ids


#: bytes of text of a block: the words, ids and index of one block are most of a task's memory
BLOCK_BYTES = 8 << 20


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int):
    for b in batches:
        texts = b.column(1)
        for lo, hi in slices(texts, block_bytes):
            yield b.slice(lo, hi - lo)


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text",
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, ids array<int>) for every row."""
    ship_package(docs.sparkSession)
    schema = T.StructType([docs.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches):
        codec, pat = Codec(ranks), regex.compile(pattern)
        for b in _blocks(batches, block_bytes):
            yield _encoded(codec, pat, b, [id_col, "ids"])
            release_memory()

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _encoded(codec: Codec, pat, b: pa.RecordBatch, names: list[str]) -> pa.RecordBatch:
    rows, ids = encode_texts(codec, pat, (t.as_py() for t in b.column(1)))
    out = [[x for k in row for x in ids[k]] for row in rows]
    return pa.RecordBatch.from_arrays([b.column(0), pa.array(out, type=pa.list_(pa.int32()))], names=names)


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids") -> DataFrame:
    """``encoded`` with a binary column ``decoded``: the bytes of its ids (null stays null)."""
    ship_package(encoded.sparkSession)
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])

    def run(batches):
        codec = Codec(ranks)
        for b in batches:
            got = [None if x is None else codec.decode(x) for x in b.column(b.schema.get_field_index(ids_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, type=pa.binary())], names=[*b.schema.names, "decoded"])

    return encoded.mapInArrow(run, schema)


def report(docs: DataFrame, ranks: dict[bytes, int], pattern: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: number of ids, digest of the ids, digest of the bytes decoded from them."""
    ship_package(docs.sparkSession)

    def run(batches):
        codec, pat = Codec(ranks), regex.compile(pattern)
        for b in _blocks(batches, block_bytes):
            yield _reported(codec, pat, b)  # nothing of a block lives on while the next one is encoded
            release_memory()
        del codec
        release_memory()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _reported(codec: Codec, pat, b: pa.RecordBatch) -> pa.RecordBatch:
    rows, ids = encode_texts(codec, pat, (t.as_py() for t in b.column(1)))
    lengths = np.array([len(x) for x in ids], dtype=np.int64)
    written = [",".join(map(str, x)).encode() for x in ids]
    decoded = [codec.decode(x) for x in ids]
    n, h_ids, h_bytes = [], [], []
    for row in rows:
        n.append(int(lengths[row].sum()))
        numbers = row.tolist()
        h_ids.append(hashlib.sha256(b",".join(map(written.__getitem__, numbers))).hexdigest())
        h_bytes.append(hashlib.sha256(b"".join(map(decoded.__getitem__, numbers))).hexdigest())
    return pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(h_ids, pa.string()), pa.array(h_bytes, pa.string())],
                                      names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
