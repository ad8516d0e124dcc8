"""Registered queries of the training-data operators, and SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_ctw_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewise.llm import ctw

    return ctw.report(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewise.llm import licenses

    return licenses.report(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewise.llm import secrets

    return secrets.report(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewise.llm import decontaminate

    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewise.llm import langid

    return langid.report(table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewise.llm import jaccard

    return jaccard.report(table(spark, sf_dir, "documents"))


def op7_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewise.llm import sharding

    return sharding.report(table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewise.llm import pii

    return pii.report(table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tidewise.llm import bpe

    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.report(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op10_stable_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewise.llm import neighbours

    return neighbours.report(table(spark, sf_dir, "embeddings"))


def op11_skyband(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewise.llm import skyband

    return skyband.report(table(spark, sf_dir, "documents"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewise.llm import exactdedup

    return exactdedup.report(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewise.llm import collocations

    return collocations.report(table(spark, sf_dir, "documents"))


Q = {f.__name__: f for f in (op1_ctw_score, op2_license_scan, op3_secret_scan, op4_decontaminate, op5_language_id, op6_jaccard_join, op7_histogram_shards, op8_pii, op9_byte_bpe, op10_stable_projections, op11_skyband, op12_exact_dedup, op13_collocations)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _license_templates() -> str:
    """(t, label, base, ws, anchor, anchor_at, others, sure) of every template as SQL rows; places count from 1."""
    from tidewise.llm import licenses

    def words(ws: list[str]) -> str:
        return "[" + ", ".join(f"'{w}'" for w in ws) + "]"

    rows = []
    for i, t in enumerate(licenses._templates()):
        others = ", ".join(f"{{'shift': {at - t['must_at'][0]}, 'p': {words(p)}}}" for p, at in zip(t["must"][1:], t["must_at"][1:]))
        rows.append(f"({i}, '{t['label']}', {str(t['base']).lower()}, {words(t['words'])}, {words(t['must'][0])}, {t['must_at'][0] + 1}, "
                    f"[{others}]::struct(shift int, p varchar[])[], {[k + 1 for k in t['sure']]})")
    return "values " + ",\n".join(rows)


def _license_sql() -> str:
    from tidewise.llm.licenses import SHIFT

    return rf"""
with templates(t, label, base, ws, anchor, anchor_at, others, sure) as ({_license_templates()}),
d as (select row_number() over () as row, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
anchors as (select row, w, t.*, unnest(list_filter(range(1, len(w) + 1), lambda i: w[i:i + len(anchor) - 1] = anchor)) as i
  from d join templates t on contains(' ' || array_to_string(w, ' ') || ' ', ' ' || array_to_string(anchor, ' ') || ' ')),
found as (select row, label, base, i - 1 as place,
    len(list_filter(range(1, len(ws) + 1), lambda k: list_contains(sure, k) or (i - anchor_at + k >= 1 and coalesce(w[i - anchor_at + k] = ws[k], false)))) / len(ws) as share
  from anchors where len(list_filter(others, lambda o: len(list_filter(range(greatest(1, i + o.shift - {SHIFT}), i + o.shift + {SHIFT + 1}),
    lambda b: w[b:b + len(o.p) - 1] = o.p)) = 0)) = 0),
marks as (select row, count(*) filter (base) as n_base, min(place) filter (base) as first_word, max(place) filter (base) as last_word,
    string_agg(distinct label, ',' order by label) filter (base) as base_labels, string_agg(distinct label, ',' order by label) as labels, max(share) as score
  from found group by row)
select doc_id, len(w) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word, coalesce(base_labels, '') as base_labels,
  coalesce(labels, '') as labels, coalesce(score, 0.0)::double as score
from d left join marks using (row)"""


ORACLE: dict[str, str] = {
    "op2_license_scan": _license_sql(),
    # every candidate is compared; the query's tree search must have missed none of the 5 nearest
    "op10_stable_projections": """
with v as (select distinct vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs as (select q.vec_id as query_id, c.vec_id, list_cosine_similarity(q.v, c.v) as score from v q join v c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 50 = 0),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from pairs)
select query_id, rank, vec_id, score from ranked where rank <= 5""",
    # the links of a document include rows with an equal set; a set of shingles is the list of their sorted texts
    "op6_jaccard_join": rf"""
with recursive d as (select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as w from documents),
sets as (select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_sort(list_distinct([array_to_string(w[i:i + 2], ' ') for i in range(1, len(w) - 1)])) end as s from d),
classes as (select row_number() over () as c, s, count(*) as m, min(doc_id) as doc_id from sets group by s),
parts as (select c, len(s) as n, unnest(s) as shingle from classes),
links as (select a.c as a, b.c as b from parts a join parts b on a.shingle = b.shingle and a.c <> b.c and 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  group by a.c, b.c, a.n, b.n having 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach as (select a, b from links union select r.a, l.b from reach r join links l on l.a = r.b),
least_id as (select c.c, least(c.doc_id, min(o.doc_id)) as component_id from classes c left join reach r on r.a = c.c left join classes o on o.c = r.b group by c.c, c.doc_id),
partners as (select l.a as c, sum(o.m) as n from links l join classes o on o.c = l.b group by l.a)
select s.doc_id, len(s.s) as n_shingles, case when len(s.s) = 0 then s.doc_id else i.component_id end as component_id,
  case when len(s.s) = 0 then 0 else c.m - 1 + coalesce(p.n, 0) end::bigint as n_links
from sets s join classes c on c.s = s.s join least_id i using (c) left join partners p using (c)""",
    "op11_skyband": rf"""
with d as (select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source, {_LOWER} as text from documents),
words as (select doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
kept as (select lang, term, count(*) as lc from words group by lang, term having count(distinct doc) >= 30),
counts as (select w.lang, w.source, w.term, count(*) as n from words w join kept using (lang, term) group by all),
langs as (select lang, count(*) as v, sum(lc) as ln from kept group by lang),
groups as (select g.lang, g.source, coalesce(l.v, 0) as v, coalesce(l.ln, 0) as ln, coalesce(t.n, 0) as n
  from (select distinct lang, source from d) g left join langs l using (lang) left join (select lang, source, sum(n) as n from counts group by all) t using (lang, source)),
shares as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
    1 + (1000000000::hugeint * (coalesce(c.n, 0) + 5)) // (g.n + 5 * g.v) as p, 1 + (1000000000::hugeint * (k.lc + 5)) // (g.ln + 5 * g.v) as q
  from groups g join kept k using (lang) left join counts c using (lang, source, term)),
pairs as (select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
both_parts as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(p.value, 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
  union all select lang, source, 'term', term, (p - q)::bigint from shares where n > 0 and p > q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from both_parts)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 50""",
    "op12_exact_dedup": r"""
with d as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents)
select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size, doc_id = min(doc_id) over same as kept, text_sha256
from d window same as (partition by text_sha256)""",
    "op13_collocations": rf"""
with d as (select coalesce(lang, 'und') as lang, {_LOWER} as text from documents),
pieces as (select lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) as piece from d),
words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
sizes as (select lang, sum(len(w)) as n from words group by lang),
starts as (select lang, w, unnest(range(1, len(w) + 1)) as s from words),
grams as (select lang, w[s:s + k - 1] as g from starts, (values (1), (2), (3), (4)) x(k) where s + k - 1 <= len(w)),
often as (select lang, g, array_to_string(g, ' ') as phrase, count(*) as f from grams group by lang, g having count(*) >= 30),
cand as (select * from often where len(g) > 1),
cuts as (select c.lang, c.phrase, c.f as a, k, l.f as l, r.f as r, (2000000::hugeint * c.f) // (l.f + r.f) as score
  from (select *, unnest(range(1, len(g))) as k from cand) c join often l on l.lang = c.lang and l.g = c.g[1:c.k] join often r on r.lang = c.lang and r.g = c.g[c.k + 1:]),
best as (select * from (select *, row_number() over (partition by lang, phrase order by score, k) as i from cuts) where i = 1),
inside as (select lang, f, g[s:s + m - 1] as g from (select *, unnest(range(1, len(g) - m + 2)) as s from (select *, unnest(range(2, len(g))) as m from cand))),
longer as (select lang, array_to_string(g, ' ') as phrase, max(f) as longer from inside group by all),
ranked as (select b.*, row_number() over (partition by b.lang order by b.score desc, b.a desc, b.phrase) as rank
  from best b left join longer o using (lang, phrase) where o.longer is null or 100 * o.longer < 80 * b.a)
select r.lang, r.rank, r.phrase, r.a, r.l, r.r, s.n::bigint as n, r.score::bigint as score from ranked r join sizes s using (lang) where r.rank <= 2000""",
}
