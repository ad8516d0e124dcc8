"""Divergence skyband, exact dedup and collocations against brute-force versions on fixtures with odd rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewise.llm import collocations, exactdedup, skyband

SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, phrase string, digest string, rank int"
ODD = [None, "", " \n\t ", "a", "É È", "日本語 テキスト\U0001F600", "1 2 3", "x" * 5000, "The the THE Élan élan", "a.b;c", "nul\x00nul \x1c \x7f\x80"]


def frame(spark, rows):
    """(doc_id, text, lang, source), with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, lang, source, "t", 1, "p", "d", 2) for i, t, lang, source in rows], SCHEMA)


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(seed, docs, words=40, vocabulary=60):
    rnd = random.Random(seed)
    pool = ["w%s" % chr(97 + i % 26) * (1 + i // 26) for i in range(vocabulary)]
    return [" ".join(rnd.choice(pool[:rnd.choice([5, 20, vocabulary])]) + rnd.choice(["", "", "", ",", ".\n", " \t"]) for _ in range(words)) for _ in range(docs)]


# ---- divergence ----------------------------------------------------------------------------------------

def divergence(rows):
    counts, having = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(text))
        counts[lang, source].update(terms)
        having[lang].update(set(terms))
    out = set()
    for lang in {g[0] for g in counts}:
        kept = [t for t, d in having[lang].items() if d >= 30]
        groups = {s: c for (g, s), c in counts.items() if g == lang}
        whole = Counter()
        for c in groups.values():
            whole.update(c)

        def p(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + int(Fraction(1_000_000_000 * (c[t] + 5), n + 5 * len(kept))) for t in kept}

        shares, q = {s: p(c) for s, c in groups.items()}, p(whole)
        for s, c in groups.items():
            pairs = sorted((-sum(abs(shares[s][t] - shares[o][t]) for t in kept), o.encode()) for o in groups if o != s)
            terms = sorted((q[t] - shares[s][t], t.encode()) for t in kept if c[t] and shares[s][t] > q[t])[:50]
            for part, found in (("pair", pairs), ("term", terms)):
                out |= {(lang, s, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(found)}
    return out


@pytest.mark.parametrize("split", [False, True])
def test_divergence_equals_brute_force(spark, monkeypatch, split):
    if split:  # many buckets, slices and source blocks; flushes inside a batch
        for name, value in (("SKYBAND_TERMS", 7), ("SLICE_TERMS", 9), ("BLOCK_SOURCES", 2), ("FAN_IN", 2)):
            monkeypatch.setattr(skyband, name, value)
    texts = prose(1, 400, vocabulary=150) + ODD * 3 + ["Same words SAME"] * 40
    rows = [(i, t, ["en", "de", None, ""][i % 7 % 4], [None, "", "s1", "s2", "s3", "ß"][i % 6 if i % 3 else 2]) for i, t in enumerate(texts)]
    rows += rows[:50] + [(900, None, "xx", "only"), (901, "few words", "yy", "a"), (902, None, "yy", "b"), (903, None, "yy", None)]
    found = [tuple(r) for r in skyband.report(frame(spark, rows)).collect()]
    assert len(found) == len(set(found)) and set(found) == divergence(rows)
    assert any(r[0] == "yy" and r[4] == 0 for r in found)  # V = 0


def test_divergence_of_an_empty_table(spark):
    assert skyband.report(frame(spark, [])).count() == 0


def test_skyband_holds_what_few_dominate():
    rnd = np.random.default_rng(3)
    for n, k in ((0, 3), (1, 1), (700, 1), (1500, 5), (1500, 50)):
        more, less, early = rnd.integers(0, 30, n), rnd.integers(0, 30, n), rnd.permutation(n)
        beaten = ((more[None] >= more[:, None]) & (less[None] <= less[:, None]) & (early[None] < early[:, None])).sum(axis=1) if n else np.zeros(0)
        assert sorted(skyband.skyband(more, less, early, k)) == list(np.flatnonzero(beaten < k))


def test_share_is_exact_for_large_counts(spark):
    big = 4_000_000_000_000_000_000
    row = spark.range(1).selectExpr(f"{big}L as c", f"{big + 7}L as t", "123456789L as v").select(skyband.share("c", "t", "v").alias("p")).first()
    assert row["p"] == 1 + (10**9 * (big + 5)) // (big + 7 + 5 * 123456789)


# ---- exact dedup ---------------------------------------------------------------------------------------

def normal(text):
    return re.sub("[\x20\x09-\x0D]+", " ", text or "")


def test_dedup_equals_brute_force(spark):
    rnd = random.Random(5)
    base = ODD + ["a  b", "a b", "a\tb", "a\n \x0b\x0c\rb", "a b ", " a b", "a b", "A b"]
    rows = [(i, rnd.choice(base + ["hot text"] * 12), "en", "s") for i in range(400)]
    rnd.shuffle(rows)
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[normal(t)].append(i)
    found = exactdedup.report(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        text = normal({i: t for i, t, *_ in rows}[r["doc_id"]])
        assert r["keep_id"] == min(groups[text]) and r["group_size"] == len(groups[text])
        assert r["kept"] == (r["doc_id"] == r["keep_id"])
        assert r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert exactdedup.report(frame(spark, [])).count() == 0


def test_dedup_keeps_one_of_repeated_rows_and_of_rows_without_id(spark):
    rows = [(7, "twice", "en", "s")] * 5 + [(None, "twice", "en", "s")] + [(None, "no id", "en", "s")] * 3 + [(2, None, None, None), (None, "", None, None)]
    found = exactdedup.report(frame(spark, rows)).collect()
    by = defaultdict(list)
    for r in found:
        by[r["text_sha256"]].append(r)
    sha = {t: by[hashlib.sha256(t.encode()).hexdigest()] for t in ("twice", "no id", "")}
    assert {t: sum(r["kept"] for r in g) for t, g in sha.items()} == {"twice": 1, "no id": 1, "": 1}
    assert {r["keep_id"] for r in sha["twice"]} == {7} and {r["keep_id"] for r in sha["no id"]} == {None} and {r["keep_id"] for r in sha[""]} == {2}
    assert {r["group_size"] for r in sha["twice"]} == {6}


def test_index_outlives_the_session_table(spark, tmp_path):
    folder, buckets = f"{tmp_path}/index", 4
    first = exactdedup.report(frame(spark, [(10, "old text", "en", "s"), (11, "old  text", "en", "s")]), folder, buckets).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["kept"]) for r in first) == [(10, 10, True), (11, 10, False)]
    name = exactdedup.open_index(spark, folder, buckets)
    spark.sql(f"drop table {name}")  # as a new session has it
    second = exactdedup.report(frame(spark, [(1, "old text", "en", "s"), (2, "new", "en", "s"), (3, "new", "en", "s")]), folder, buckets).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["kept"]) for r in second) == [(1, 10, False), (2, 2, True), (3, 2, False)]
    name = exactdedup.open_index(spark, folder, buckets)
    assert spark.table(name).count() == 2
    rows = exactdedup.digests(frame(spark, [(5, "late", "en", "s")]))
    for _ in range(2):  # run again: nothing is appended twice
        exactdedup.ingest(rows, name, buckets, "again")
    assert spark.table(name).count() == 3
    plan = rows.join(spark.table(name).select("digest").hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan and plan.count("Exchange") == 1  # the new side only
    spark.table(name).write.insertInto(name)  # two ingests at once
    spark.catalog.refreshTable(name)
    assert exactdedup.kept_rows(spark, name).count() == 3


# ---- collocations --------------------------------------------------------------------------------------

def phrases_of(rows):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", low(text)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, 5):
                f[lang or "und"].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    return f, n


def collocated(rows, top=2000):
    f, n = phrases_of(rows)
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if a >= 30}
        found = []
        for p, a in often.items():
            if len(p) < 2:
                continue
            if any(len(x) > len(p) and 100 * b >= 80 * a and any(x[i:i + len(p)] == p for i in range(len(x) - len(p) + 1)) for x, b in often.items() if len(x) > 1):
                continue
            score, k = min((2_000_000 * a // (often[p[:k]] + often[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), often[p[:k]], often[p[k:]]))
        for i, (s, a, p, left, right) in enumerate(sorted(found)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, right, n[lang], -s))
    return out


@pytest.mark.parametrize("block_bytes, top", [(1 << 22, 2000), (3000, 2000), (1, 7)])
def test_collocations_equal_brute_force(spark, block_bytes, top):
    texts = prose(2, 250 if block_bytes > 1 else 60, words=60, vocabulary=30) + ODD * 2 + ["New York City hall, new york"] * 45 + ["über alles über alles"] * 33
    rows = [(i, t, ["en", "de", None, "und"][i % 5 % 4], "s") for i, t in enumerate(texts)] + [(999, "a b " * 4000, "en", None)]
    found = sorted(tuple(r) for r in collocations.report(frame(spark, rows), top=top, block_bytes=block_bytes).collect())
    assert found == sorted(collocated(rows, top)) and len(found) > 3


def test_collocations_of_an_empty_table(spark):
    assert collocations.report(frame(spark, [])).count() == 0
    assert collocations.report(frame(spark, [(1, None, None, None), (2, "", "en", "s")])).count() == 0


def test_misra_gries_loses_less_than_the_threshold():
    rnd = np.random.default_rng(4)
    keys = np.concatenate([np.minimum(rnd.zipf(1.3, 60_000), 1 << 31), np.repeat(np.arange(7_000_000, 7_000_040), 30)]).astype(np.uint32)
    rnd.shuffle(keys)
    chunks = [np.unique(c, return_counts=True) for c in np.array_split(keys, 57)]
    capacity = len(keys) // 30 + 1
    found, counts, lost = collocations.misra_gries(iter(chunks), capacity)
    true = Counter(keys.tolist())
    assert len(found) <= capacity and lost * (capacity + 1) <= len(keys) and lost < 30
    held = dict(zip(found.tolist(), counts.tolist()))
    assert all(held.get(k, 0) <= n <= held.get(k, 0) + lost for k, n in true.items())
    assert {k for k, n in true.items() if n >= 30} <= set(held)
    few, few_counts, few_lost = collocations.misra_gries(iter([(k, c.astype(np.uint32)) for k, c in chunks]), 50)  # merged many times
    assert len(few) <= 50 and few_lost * 51 <= len(keys)
    assert all(true[k] - few_lost <= c <= true[k] for k, c in zip(few.tolist(), few_counts.tolist()))


def test_counts_are_by_words_and_hashes_only_choose(spark):
    """At threshold 1 every phrase survives the summaries, and its count is exact."""
    rows = [(i, t, "en", "s") for i, t in enumerate(prose(6, 60, words=50, vocabulary=12))]
    f, n = phrases_of(rows)
    counts, sizes = collocations.phrase_counts(frame(spark, rows), collocations.Scratch(spark, "test"), threshold=1)
    assert {tuple(r["phrase"].split(" ")): r["f"] for r in counts.collect()} == dict(f["en"])
    assert [tuple(r) for r in sizes.collect()] == [("en", n["en"])]


# ---- word hashes ---------------------------------------------------------------------------------------

def test_regular_words_have_hashes_of_their_own(spark):
    """Thue-Morse words cancel out in any polynomial modulo 2**64; two documents of them share no shingle."""
    import pyarrow as pa

    from tidewise.llm import ctw, jaccard
    from tidewise.llm.bytewords import Words

    bits = [0]
    while len(bits) < 1024:
        bits += [1 - x for x in bits]
    one, two = ("".join(c[x] for x in bits) for c in ("ab", "ba"))
    w = Words(pa.array([f"{one} {two}", f"\n{two}  {one}", "a" * 8, "a" * 9, "", " "]), 0, 6)
    h = w.hash.tolist()
    assert h[0] == h[3] and h[1] == h[2] and len(set(h)) == 4
    rows = frame(spark, [(1, f"{one} {one} {one}", "en", "s"), (2, f"{two} {two} {two}", "en", "s"), (3, f"x {one} y z", "en", "s")])
    found = {r["doc_id"]: (r["component_id"], r["n_links"]) for r in jaccard.report(rows).collect()}
    assert found == {1: (1, 0), 2: (2, 0), 3: (3, 0)}
    kept = sorted(r["doc_id"] for r in jaccard.keep_one(rows.select("doc_id", "text"), 5, 80).collect())
    assert kept == [1, 2, 3]
    split = frame(spark, [(1, one, "en", "s"), (2, two, "en", "s")]).withColumn("held", F.col("doc_id") == 2)
    known = {r["doc_id"]: (r["n_known"], r["n_tokens"]) for r in ctw.score(split).collect()}
    assert known == {1: (2, 2), 2: (1, 2)}  # the second word is unknown, its end is not


# ---- large maps of the Jaccard join --------------------------------------------------------------------

def test_large_maps_lose_no_link_and_part_strangers():
    from tidewise.llm import jaccard

    rnd = np.random.default_rng(7)
    sets = []
    for size in (1500, 1600, 2047, 2048, 2049, 4000, 9000):
        base = np.unique(rnd.integers(0, 1 << 63, size, dtype=np.uint64))
        sets += [base] + [np.unique(np.concatenate((base[int(len(base) * cut):], rnd.integers(0, 1 << 63, int(len(base) * cut), dtype=np.uint64)))) for cut in (0.02, 0.1, 0.2)]
        sets.append(base[: int(len(base) * 0.85)])
    sets.append(np.unique(rnd.integers(0, 1 << 63, 300, dtype=np.uint64)))
    a, b = np.triu_indices(len(sets), 1)
    size, large = np.array([len(u) for u in sets]), [jaccard._large_map(u) for u in sets]
    assert large[-1] is None and len(large[0]) == 4096 // 8
    for percent in (80, 90):
        linked = jaccard._linked(sets, a, b, percent)
        possible = jaccard._possible_large(large, size, a, b, percent)
        assert possible[linked].all() and linked.sum() > 5
        mapped = np.array([m is not None for m in large])
        strangers = (a // 5 != b // 5) & mapped[a] & mapped[b]
        assert possible[strangers].mean() < 0.02


def test_long_near_copies_link(spark):
    from tidewise.llm import jaccard

    rnd = random.Random(8)
    pool = ["w%d" % i for i in range(3000)]
    long = [[rnd.choice(pool) for _ in range(n)] for n in (2500, 6000, 2500)]
    texts = []
    for words in long:
        other = list(words)
        other[100] = "changed"
        texts += [" ".join(words), " ".join(other), " ".join(words[: len(words) * 97 // 100])]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts + texts[:2] + [None, ""])]

    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i:i + 3]) for i in range(max(len(w) - 2, 1))} if w else set()

    sets = {i: shingles(t) for i, t, *_ in rows}
    links = {i: [j for j in sets if j != i and sets[i] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j])] for i in sets}
    found = {r["doc_id"]: r for r in jaccard.report(frame(spark, rows)).collect()}
    assert {i: r["n_links"] for i, r in found.items()} == {i: len(x) for i, x in links.items()}
    assert {i: r["component_id"] for i, r in found.items() if links[i]} == {i: min(x + [i]) for i, x in links.items() if x}
