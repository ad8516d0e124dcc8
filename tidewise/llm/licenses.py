"""Licence scan by a positional rare-token index.

Templates (licence grants and key phrases) are word sequences with mandatory key phrases; the first one is the template's
anchor. The index keeps, for each template, the highest-IDF words of the anchor (document frequencies counted over
all scanned documents) with their positions. A file looks up its words in the index; a hit of a template's
rarest word proposes (template, file position - template position); the postings of its other indexed words
are intersected at this relative position, and what is left is verified word by word: the anchor at its place, each
further key phrase at most ``SHIFT`` words from its own, so that a filled-in name or a reworded line between them loses
nothing. All indexed words are mandatory, so no standing template is missed, whatever the frequencies.

Scale: one pass over the texts, row-local, writes each document's word count and licence words, and the
words of those few documents that hold every mandatory word of a template. The only shuffle carries one row
per task and licence word for the frequencies. The templates are fixed text, so the index has a fixed bound.

Cases: a null or empty text has no words, labels or score (0); long texts cost time in proportion to
their words and hits; repeated rows are scanned as they come; an empty table gives no rows; places that tie for the
best share give one score, and labels are distinct; a null id stays null; other columns aren't read.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewise.llm.spans import empty
from tidewise.session import cut_lineage

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# fixed values: label -> phrase whose every place counts
BASE_PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
# fixed values: label, words of the public licence text, mandatory key phrases (the anchor first)
GRANTS = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction",
     ["permission is hereby granted free of charge", "without restriction"]),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
                 "with the license you may obtain a copy of the license at",
     ["licensed under the apache license", "except in compliance with the license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met",
     ["redistribution and use in source and binary forms"]),
    ("bsd-2", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
              "disclaimer in the documentation and or other materials provided with the distribution this software is provided by",
     ["materials provided with the distribution this software is provided by", "redistributions in binary form must reproduce the above copyright notice"]),
    ("bsd-3", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
              "derived from this software without specific prior written permission",
     ["endorse or promote products derived from this software without specific prior written permission", "neither the name of"]),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation",
     ["gnu general public license", "free software foundation"]),
    ("gpl-2", "gnu general public license as published by the free software foundation either version 2 of the license or "
              "at your option any later version",
     ["gnu general public license as published by the free software foundation", "version 2 of the license"]),
    ("gpl-3", "gnu general public license as published by the free software foundation either version 3 of the license or "
              "at your option any later version",
     ["gnu general public license as published by the free software foundation", "version 3 of the license"]),
    ("lgpl-2.1", "gnu lesser general public license as published by the free software foundation either version 2 1 of the license or "
                 "at your option any later version",
     ["gnu lesser general public license as published by the free software foundation", "version 2 1 of the license"]),
    ("lgpl-3", "gnu lesser general public license as published by the free software foundation either version 3 of the license or "
               "at your option any later version",
     ["gnu lesser general public license as published by the free software foundation", "version 3 of the license"]),
    ("agpl-3", "gnu affero general public license as published by the free software foundation either version 3 of the license or "
               "at your option any later version",
     ["gnu affero general public license as published by the free software foundation", "version 3 of the license"]),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ["mozilla public license"]),
    ("epl-2", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0",
     ["eclipse public license", "accompanying materials"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     ["for any purpose with or without fee is hereby granted"]),
    ("zlib", "in no event will the authors be held liable for any damages arising from the use of this software permission is granted "
             "to anyone to use this software for any purpose including commercial applications",
     ["permission is granted to anyone to use this software for any purpose", "in no event will the authors be held liable"]),
    ("bsl-1", "distributed under the boost software license version 1 0", ["boost software license"]),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ["free and unencumbered software released into the public domain"]),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights "
            "to the work worldwide under copyright law",
     ["dedicated the work to the public domain by waiving all"]),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
     ["creative commons attribution 4 0 international"]),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license",
     ["creative commons attribution sharealike"]),
    ("cc-by-nd", "this work is licensed under a creative commons attribution noderivatives 4 0 international license",
     ["creative commons attribution noderivatives"]),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial",
     ["creative commons attribution noncommercial"]),
    ("cc-by-nc-sa", "this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international license",
     ["creative commons attribution noncommercial sharealike"]),
    ("cc-by-nc-nd", "this work is licensed under a creative commons attribution noncommercial noderivatives 4 0 international license",
     ["creative commons attribution noncommercial noderivatives"]),
]
#: Words by which a key phrase may stand nearer to or further from its template's anchor than the template says.
SHIFT = 24


def words(text: Column) -> Column:
    """Lower-cased words of a text; none for null. (Spark's ``lower`` also maps letters beyond A-Z;
    none of them is or becomes a separator, or a letter of the base phrases.)"""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != "")


def _templates() -> list[dict]:
    out = [{"label": label, "words": text.split(), "must": [text.split()], "base": True} for label, text in BASE_PHRASES]
    for label, text, must in GRANTS:
        out.append({"label": label, "words": text.split(), "must": [p.split() for p in must], "base": False})
    for t in out:
        ws = t["words"]
        t["must_at"] = [next(k for k in range(len(ws)) if ws[k:k + len(p)] == p) for p in t["must"]]
        t["sure"] = sorted({at + k for p, at in zip(t["must"], t["must_at"]) for k in range(len(p))})  # they stand in every find
    return out


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, present, w): licence words present, and all words where a template could stand."""
    templates = _templates()
    vocabulary = sorted({w for t in templates for w in t["words"]})
    d = docs.select("doc_id", words(F.col("text")).alias("w"))
    d = d.select("doc_id", "w", F.array_distinct(F.filter("w", lambda w: w.isin(vocabulary))).alias("present"))
    could = F.lit(False)
    for t in templates:
        must = sorted({w for p in t["must"] for w in p})
        could = could | (F.size(F.array_intersect(F.col("present"), _strings(must))) == len(must))
    kept = F.when(F.size("present") > 1, F.when(could, F.col("w")))
    return cut_lineage(d.select("doc_id", F.size("w").cast("long").alias("n_words"), "present", kept.alias("w")), "license-words")


def build_index(digested: DataFrame, rare: int = 4) -> list[dict]:
    """Templates with the ``rare`` highest-IDF words of their anchors, rarest first.
    IDF = ln((docs + 1) / (df + 1)) over all documents."""
    counted = (digested.select(F.explode(F.concat("present", F.array(F.lit("")))).alias("w"))  # '' counts the documents
               .groupBy("w").agg(F.count(F.lit(1)).alias("df")).collect())  # bounded by the fixed vocabulary
    df = {r["w"]: r["df"] for r in counted}
    n = df.pop("", 0)
    templates = _templates()
    for t in templates:
        at = {}
        for k, w in enumerate(t["must"][0]):
            at.setdefault(w, t["must_at"][0] + k)
        order = sorted(at, key=lambda w: (-math.log((n + 1) / (df.get(w, 0) + 1)), w))
        t["rare"] = [(at[w], w) for w in order[:rare]]
    return templates


def _strings(ws: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in ws])


def _posting(t: int, pos: int) -> Column:
    return F.struct(F.lit(t).alias("t"), F.lit(pos).alias("pos"))


def find(digested: DataFrame, index: list[dict]) -> DataFrame:
    """(doc_id, n_words, found): found = array of (t, at, share) of standing proposals, where share is the share of the
    template's words that stand in its key phrases or at their positions relative to the anchor."""
    postings: dict[str, list[Column]] = {}
    for i, t in enumerate(index):
        pos, w = t["rare"][0]
        postings.setdefault(w, []).append(_posting(i, pos))
    lookup = F.create_map(*[x for w, p in postings.items() for x in (F.lit(w), F.array(*p))])
    hits = F.filter(F.transform("w", lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda h: h["x"].isin(list(postings)))
    proposed = F.array_distinct(F.flatten(F.transform(hits, lambda h: F.transform(
        lookup[h["x"]], lambda p: F.struct(p["t"].alias("t"), (h["i"] - p["pos"]).alias("at"))))))
    d = digested.select("doc_id", "n_words", "w", proposed.alias("proposed"))

    def here(c: Column, pos: int, w: str) -> Column:
        return F.coalesce(F.get(F.col("w"), c["at"] + pos) == w, F.lit(False))

    def stands(begin: Column, phrase: list[str]) -> Column:
        return (begin >= 0) & (F.slice(F.col("w"), F.greatest(begin + 1, F.lit(1)), F.lit(len(phrase))) == _strings(phrase))

    def nearby(begin: Column, phrase: list[str]) -> Column:
        return F.exists(F.sequence(begin - SHIFT, begin + SHIFT), lambda b: stands(b, phrase))

    def agreeing(c: Column, t: dict) -> Column:
        sure = F.array(*[F.lit(k in t["sure"]) for k in range(len(t["words"]))])
        return F.size(F.filter(_strings(t["words"]), lambda w, k: F.get(sure, k) | F.coalesce(F.get(F.col("w"), c["at"] + k) == w, F.lit(False))))

    def check(c: Column) -> Column:
        """The share for a standing proposal, else null."""
        branches = None
        for i, t in enumerate(index):
            ok = (c["t"] == i) & reduce(and_, [here(c, pos, w) for pos, w in t["rare"]]) & stands(c["at"] + t["must_at"][0], t["must"][0])
            for phrase, at in zip(t["must"][1:], t["must_at"][1:]):
                ok = ok & nearby(c["at"] + at, phrase)
            branches = (F if branches is None else branches).when(ok, agreeing(c, t) / len(t["words"]))
        return branches

    checked = F.transform("proposed", lambda c: F.struct(c["t"].alias("t"), c["at"].alias("at"), check(c).alias("share")))
    found = F.when(F.coalesce(F.size("proposed"), F.lit(0)) > 0, F.filter(checked, lambda c: c["share"].isNotNull())).otherwise(
        empty("array<struct<t:int,at:int,share:double>>"))
    return d.select("doc_id", "n_words", found.alias("found"))


def _labels(found: Column, index: list[dict]) -> Column:
    names = F.array(*[F.lit(t["label"]) for t in index])
    return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda c: F.get(names, c["t"])))), ",")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: places of the base phrases, labels, and the best share as the score."""
    digested = digest(docs)
    index = build_index(digested)
    n_base = sum(t["base"] for t in index)  # base phrases come first
    f = find(digested, index).withColumn("base", F.filter("found", lambda c: c["t"] < n_base))
    at = F.transform("base", lambda c: c["at"].cast("long"))
    score = F.coalesce(F.array_max(F.transform("found", lambda c: c["share"])), F.lit(0.0))
    return f.select("doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
                    F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
                    _labels(F.col("base"), index).alias("base_labels"), _labels(F.col("found"), index).alias("labels"),
                    score.alias("score"))
