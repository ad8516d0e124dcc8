"""Native span helpers shared by the secret and PII scanners.

Spark has no function that returns the positions of all matches. ``split`` gives the pieces
between the matches and ``regexp_extract_all`` the matches themselves, both from the same
leftmost, non-overlapping search, so running sums of their lengths are the positions. ``length``
counts code points, as the span positions do. Both run only where ``rlike`` has found a match.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:bigint,end:bigint,m:string>>"
CHUNK = 512


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` as a lambda variable: evaluated once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def empty(kind: str) -> Column:
    return F.expr(f"cast(array() as {kind})")


def _zero() -> Column:
    return F.lit(0).cast("long")


def _width(x: Column) -> Column:
    return x["gap"] + F.coalesce(F.length(x["m"]).cast("long"), _zero())


def _fold(part: Column, start_at: Column) -> Column:
    """Spans of one chunk of (gap, match) pairs that begins at ``start_at``."""
    def step(acc, x):
        start = acc["at"] + x["gap"]
        end = acc["at"] + _width(x)
        span = F.struct(start.alias("start"), end.alias("end"), x["m"].alias("m"))
        return F.struct(end.alias("at"),
                        F.when(x["m"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(span))).alias("out"))

    return F.aggregate(part, F.struct(start_at.alias("at"), empty(SPAN).alias("out")), step, lambda acc: acc["out"])


def _positions(pairs: Column) -> Column:
    """Two levels (chunk totals, then each chunk) keep the work near linear in the matches of a text."""
    def with_chunks(chunks):
        totals = F.transform(chunks, lambda c: F.aggregate(c, _zero(), lambda a, x: a + _width(x)))
        starts = F.aggregate(
            totals, F.struct(_zero().alias("at"), empty("array<bigint>").alias("out")),
            lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
            lambda acc: acc["out"])
        return F.flatten(F.zip_with(chunks, starts, _fold))

    chunked = F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / CHUNK).cast("int")),
                          lambda i: F.slice(pairs, i * CHUNK + 1, F.lit(CHUNK)))
    return let(chunked, with_chunks)


def regex_spans(text: Column, pattern: str, guard: str) -> Column:
    """All matches of ``pattern`` as array<struct<start, end, m>>; ``guard`` is a cheap pattern that
    is found in every text holding a match. A null or empty text gives an empty array."""
    pieces = F.transform(F.split(text, pattern), lambda p: F.length(p).cast("long"))
    pairs = F.arrays_zip(pieces.alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    return F.when(F.coalesce(text.rlike(guard), F.lit(False)), let(pairs, _positions)).otherwise(empty(SPAN))


def as_text(spans: Column, kind: str) -> Column:
    """Spans of one kind as 'kind:start:end' strings."""
    return F.transform(spans, lambda s: F.concat(F.lit(f"{kind}:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")))
