"""Personal data: regular expressions propose spans, checksums confirm them, context words score them.

Every step is a row-local built-in expression: no shuffle, no Python, one pass over the text.
The patterns follow the leftmost non-overlapping rule of the plain forms (given in comments);
possessive quantifiers and the look-behind only stop Java's matcher from retrying inside a run, so
a long run costs linear time and no stack. A match that fails its validator is dropped and stays
consumed.

Cases: null or empty text has no spans, an empty table no rows; very long texts are scanned whole; repeated rows are
scanned as they come; spans that begin together are ordered by their end, then kind; other columns
pass through (``find``/``redact``) and a clashing name is replaced by the operator's own column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewise.llm.spans import as_text, empty, let, regex_spans

# fixed values: kind -> (pattern, guard, base score, context words)
# email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
# ip     [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
# card   [0-9]([\x20-]?[0-9])+
# phone  \+[0-9][\x20().0-9-]+[0-9]
# iban   two letters, two digits, 11 to 30 letters or digits; or printed in groups of four, the last of one to four (from
#        the second group after the check digits on, each holds a digit, so following capitals aren't taken along)
KINDS = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9,
              ["mail", "email", "contact", "write"]),
    "ip": (r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", 0.6, ["ip", "host", "server", "address"]),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){15}", 0.8, ["card", "visa", "credit", "payment"]),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.7, ["phone", "call", "tel", "mobile"]),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}+|\x20[A-Z0-9]{4}(?![A-Za-z0-9])"
             r"(?:\x20(?=[A-Z]{0,3}[0-9])[A-Z0-9]{4}(?![A-Za-z0-9])){1,6}+(?:\x20(?=[A-Z]{0,2}[0-9])[A-Z0-9]{1,3}(?![A-Za-z0-9]))?+)(?![A-Za-z0-9])",
             r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11}|\x20[A-Z0-9]{4}\x20)", 0.8, ["iban", "bank", "account", "transfer"]),
}
# fixed values: words that speak against personal data
AGAINST = ["serial", "order", "part", "article", "sku", "version"]
BASE = ("email", "ip", "card", "phone")
SPAN_OUT = "array<struct<start:bigint,end:bigint,kind:string,score:double>>"


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """True where the digit string passes the Luhn check."""
    def weigh(d, i):
        v = d.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(v > 9, v - 9).otherwise(v)

    each = F.transform(F.split(F.reverse(number), ""), weigh)
    return F.aggregate(each, F.lit(0), lambda a, v: a + v) % 10 == 0


def mod97(code: Column) -> Column:
    """True where an IBAN-like code has remainder 1 modulo 97 (letters count from A = 10)."""
    moved = F.split(F.concat(F.substring(code, 5, 64), F.substring(code, 1, 4)), "")

    def step(acc, ch):
        letter = ch.rlike("[A-Z]")
        return F.when(letter, (acc * 100 + F.ascii(ch) - 55) % 97).otherwise((acc * 10 + ch.cast("int")) % 97)

    return F.aggregate(moved, F.lit(0), step) == 1


def _valid(kind: str):
    return lambda s: _confirmed(kind, s["m"])


def _confirmed(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: p.rlike("^0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])$"))
    if kind == "card":
        return let(digits(m), lambda d: F.when(F.length(d).between(16, 19), luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(digits(m)).between(8, 15)
    if kind == "iban":
        return let(F.regexp_replace(m, "\\x20", ""), lambda c: F.when(F.length(c).between(15, 34), mod97(c)).otherwise(F.lit(False)))
    return F.lit(True)


def _any_of(words: list[str]) -> str:
    return r"(?i)(?<![A-Za-z])(?:" + "|".join(words) + r")(?![A-Za-z])"


def _scored(text: Column, kind: str, spans: Column, window: int) -> Column:
    """The kind's base score: raised by a tenth where one of its context words stands in the ``window`` characters
    before the span; else lowered by a tenth, and by another where a word of AGAINST stands there."""
    _, _, base, words = KINDS[kind]

    def score(before):
        moved = F.when(before.rlike(_any_of(words)), F.lit(0.1)).when(before.rlike(_any_of(AGAINST)), F.lit(-0.2)).otherwise(F.lit(-0.1))
        return F.round(F.lit(base) + moved, 6)

    def one(s):
        at = F.greatest(s["start"] - window, F.lit(0).cast("long"))
        before = F.substring(text, (at + 1).cast("int"), (s["start"] - at).cast("int"))
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"), let(before, score).alias("score"))

    return F.transform(spans, one)


def find(df: DataFrame, text_col: str = "text", window: int = 40, min_added: float = 0.7) -> DataFrame:
    """``df`` with one array column ``pii_<kind>`` per kind: validated spans (code points, end
    exclusive) with a score. Base kinds keep every validated span; kinds that the method adds
    (``iban``) need a score of ``min_added``, which words that speak against them prevent."""
    text = F.col(text_col)
    out = df
    for kind, (pattern, guard, _, _) in KINDS.items():
        raw = regex_spans(text, pattern, guard)
        out = out.withColumn(f"pii_{kind}", F.filter(raw, _valid(kind)))
    for kind in KINDS:
        found = F.col(f"pii_{kind}")
        scored = _scored(text, kind, found, window)
        if kind not in BASE:
            scored = F.filter(scored, lambda s: s["score"] >= min_added)
        out = out.withColumn(f"pii_{kind}", F.when(F.size(found) > 0, scored).otherwise(empty(SPAN_OUT)))
    return out


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with every span of ``find`` replaced by its kind in brackets, e.g. ``[EMAIL]``.
    Overlapping spans become one replacement named by the first; a null text stays null."""
    text = F.col(text_col)
    found = find(df, text_col)
    spans = F.sort_array(F.concat(*[F.col(f"pii_{k}") for k in KINDS]))
    found = found.withColumn("_pii", spans)

    def step(acc, s):
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        taken = F.struct(s["end"].alias("at"), F.concat(acc["out"], F.array(gap, F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))).alias("out"))
        inside = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        return F.when(s["start"] < acc["at"], inside).otherwise(taken)

    init = F.struct(F.lit(0).cast("long").alias("at"), empty("array<string>").alias("out"))
    rebuilt = F.aggregate(F.col("_pii"), init, step, lambda acc: F.concat(
        F.concat_ws("", acc["out"]), F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return (found.withColumn(text_col, F.when(F.size("_pii") > 0, rebuilt).otherwise(text))
            .drop("_pii", *[f"pii_{k}" for k in KINDS]))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, digest of the base spans, all spans by kind
    as listed, then start; ``n_iban`` and the highest span score are the method's own."""
    f = find(docs.select("doc_id", "text"))
    spans = {k: as_text(F.col(f"pii_{k}"), k) for k in KINDS}
    f = f.select(
        "doc_id", *[F.size(f"pii_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        F.array_join(F.concat(*[spans[k] for k in BASE]), ",").alias("_base"),
        F.array_join(F.concat(*spans.values()), ",").alias("spans"),
        F.array_max(F.transform(F.concat(*[F.col(f"pii_{k}") for k in KINDS]), lambda s: s["score"])).alias("max_score"))
    return f.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(F.col("_base"), 256).alias("base_sha256"), "spans", "max_score")
