"""Error messages of log files (TXT-6), for files of any length.

A message is what the pattern ``ERROR.*?:(.*?)(?=\\d{4}-\\d{2}-\\d{2}|$)`` captures in a file's whole text, dots matching
line feeds: from the first ``:`` after an ``ERROR`` (wherever it stands) to the next date (in the middle of a line, too) or
the file's end. Reading left to right, that is a machine of three states: SEARCH for ERROR, then COLON, then TEXT up to a
date. So a file need not be in one task: each chunk of lines says where it ends from each of the three states, one
small row per chunk is folded along the file, and the chunks that hold one of the first messages are read from their true state.

Chunks and files may be very many and small: a task reads its partition, sorted by them, as one stream, and holds one
chunk at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewise.session import ship_package

# fixed values: the tokens of the pattern, and the limits of the original
_TOKEN = re.compile(r"ERROR|:|[0-9]{4}-[0-9]{2}-[0-9]{2}")
MAX_ERRORS = 10
MAX_ERROR_CHARS = 500

SEARCH, COLON, TEXT = 0, 1, 2
CHUNK_LINES = 20_000


def messages(text: str, state: int) -> tuple[int, list[tuple[int, int]]]:
    """(state at the end, [start, end) of the captures, a continued one first and an open one last)."""
    found, start = [], 0
    for m in _TOKEN.finditer(text):
        token = m.group()
        if state == SEARCH:
            state = COLON if token == "ERROR" else SEARCH
        elif state == COLON:
            if token == ":":
                state, start = TEXT, m.end()
        elif token[0].isdigit():
            found.append((start, m.start()))
            state = SEARCH
    if state == TEXT:
        found.append((start, len(text)))
    return state, found


def _stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


#: rows of a batch that a task hands back
BATCH_ROWS = 10_000
_ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}


def _by_run(df: DataFrame, by: list[str], then: str, of_run: Callable[[tuple, Iterable[tuple]], Iterator[tuple]],
            columns: dict[str, str]) -> DataFrame:
    """``of_run(key, rows)`` for the rows of each value of the columns ``by`` (the first ones of ``df``) in the order of ``then``: rows of
    ``df``'s first column and ``columns``. Partitions are as many as the session shuffles into, so what a task sorts shrinks with their number."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    k, name = len(by), df.columns[0]
    schema = ", ".join([f"{name} {df.schema[name].dataType.simpleString()}", *(f"{c} {t}" for c, t in columns.items())])

    def run(batches):
        types = []

        def read():
            for b in batches:
                types[:] = [b.schema.types[0], *(_ARROW[t] for t in columns.values())]
                yield from zip(*(c.to_pylist() for c in b.columns))

        found = (x for key, of_key in groupby(read(), key=lambda r: r[:k]) for x in of_run(key, of_key))
        while some := list(islice(found, BATCH_ROWS)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), types)], names=[name, *columns])

    return df.repartition(partitions, *by).sortWithinPartitions(*by, then).mapInArrow(run, schema)


def error_extract(lines: DataFrame, key: str = "file", max_errors: int = MAX_ERRORS, chunk_lines: int = CHUNK_LINES,
                  max_chars: int = MAX_ERROR_CHARS) -> DataFrame:
    """(key, n, message): the first ``max_errors`` messages of each file of ``lines`` (key, line_no from 1, line), stripped and
    cut to ``max_chars`` characters. A file without one has no row."""
    ship_package(lines.sparkSession)
    chunked = lines.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.floor((F.col("line_no") - 1) / chunk_lines).cast("long").alias("_chunk"), "line_no",
        F.coalesce("line", F.lit("")).alias("line"))

    def ends(of, rows):
        text = "\n".join([r[3] for r in rows])
        out = [*of]
        for s in (SEARCH, COLON, TEXT):
            end, found = messages(text, s)
            out += [end, len(found) - (s == TEXT)]  # a continued capture was counted where it began
        yield tuple(out)

    def fold(of, rows):
        state, before = SEARCH, 0
        for r in rows:
            yield r[0], r[1], state, before
            state, before = r[2 + 2 * state], before + r[3 + 2 * state]

    def pieces(of, rows):
        rows = iter(rows)
        _, _, line_no, _, state, n = next(rows)
        if line_no is not None:
            return  # no state: none of the first messages is in this chunk
        text = "\n".join([r[3] for r in rows])
        for i, (a, b) in enumerate(messages(text, state)[1]):
            number = n + i + (state != TEXT)
            if number > max_errors:
                break
            piece = text[a:b]
            body = piece.lstrip()
            blank = piece[:len(piece) - len(body)][:max_chars]
            yield of[0], number, of[1], blank + body[:max_chars], bool(body[max_chars:].strip())

    per_state = {c: t for s in (SEARCH, COLON, TEXT) for c, t in ((f"end{s}", "int"), (f"new{s}", "long"))}
    states = _by_run(chunked, ["_key", "_chunk"], "line_no", ends, {"_chunk": "long", **per_state})
    states = _by_run(states, ["_key"], "_chunk", fold, {"_chunk": "long", "_state": "int", "_before": "long"})
    wanted = states.filter((F.col("_before") < max_errors) | ((F.col("_state") == TEXT) & (F.col("_before") <= max_errors)))
    # a chunk's state is its first row (a null line_no sorts before the lines)
    stated = chunked.withColumns({"_state": F.lit(None).cast("int"), "_before": F.lit(None).cast("long")}).unionByName(
        wanted.withColumns({"line_no": F.lit(None).cast("long"), "line": F.lit(None).cast("string")}))
    found = _by_run(stated, ["_key", "_chunk"], "line_no", pieces,
                    {"n": "int", "_chunk": "long", "piece": "string", "more": "boolean"})
    # blank beginnings are stripped; after them a whole chunk adds at least a character per line, so few pieces are enough
    enough = max_chars // chunk_lines + 3
    along = Window.partitionBy("_key", "n").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, 0)
    begun = F.max(_stripped(F.col("piece")) != "").over(along)
    found = found.withColumn("_begun", begun).withColumn("_place", F.sum(F.col("_begun").cast("int")).over(along))
    near = F.col("_begun") & (F.col("_place") <= enough)
    whole = found.groupBy("_key", "n").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(near, F.struct("_chunk", "piece")))), lambda x: x["piece"]), "\n").alias("text"),
        F.max(F.when(near, F.col("more")).otherwise(F.col("_begun") & (_stripped(F.col("piece")) != ""))).alias("more"))
    cut = F.substring(F.regexp_replace("text", r"^\s+", ""), 1, max_chars)
    return whole.select(F.col("_key").alias(key), F.col("n").cast("long").alias("n"),
                        F.when(F.col("more"), cut).otherwise(F.substring(_stripped(F.col("text")), 1, max_chars)).alias("message"))
