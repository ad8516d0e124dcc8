"""Text / diagnostics operators (TXT-1..TXT-10), re-aimed at tables of text and log lines.

All are row-level expressions or bounded windows: per document, per log file, per bundle. Names are replaced by a join with
the dictionary table (``anonymize``); error messages of logs (TXT-6) are in ``logs``.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewise.functions.columns import distributed_row_number
from tidewise.session import cut_lineage

# fixed values: default path patterns of the original masker (Windows, Unix, home), its token, the name prefix, the
# tail limit and the response-parsing defaults
DEFAULT_PATH_PATTERNS = [
    r"[A-Za-z]:\\[^\s\"']+",
    r"/[^\s\"']+(?:/[^\s\"']+)+",
    r"~[^\s\"']+",
]
PATH_MASK = "[PATH_MASKED]"
NAME_PREFIX = "SENSOR_"
TAIL_LINES = 100
NO_SUMMARY = "No summary provided"
DEFAULT_CONFIDENCE = "medium"
FALLBACK_CONFIDENCE = "low"
FALLBACK_CHARS = 500
BUNDLE_KEYS = ("bundle_id", "created_at", "version")


def name_dictionary(names: DataFrame, col: str, prefix: str = NAME_PREFIX) -> DataFrame:
    """TXT-1: distinct names in sorted order -> ``prefix`` + 3-digit (or longer) number."""
    d = names.select(F.col(col).alias("name")).where(F.col("name").isNotNull()).distinct()
    r = distributed_row_number(d, [F.col("name").asc()], "n")
    return r.select("name", F.format_string(f"{prefix}%03d", F.col("n")).alias("alias"), F.col("n").alias("ordinal"))


def mask_paths(text: Column, patterns: list[str] | None = None) -> Column:
    """TXT-2: chained regex replacement; a custom pattern list replaces the defaults."""
    out = text
    for p in patterns or DEFAULT_PATH_PATTERNS:
        out = F.regexp_replace(out, p, PATH_MASK)
    return out


def _any_of(names: list[str]) -> str:
    """A pattern for the longest of ``names`` at a position: common prefixes are shared, so matching
    costs the length of a name, not their number. ``names`` are sorted and distinct."""
    out, i = [], 0
    while i < len(names):
        j = i + 1
        while j < len(names) and names[j][:1] == names[i][:1]:
            j += 1
        prefix = names[i]
        while not names[j - 1].startswith(prefix):  # first and last of the sorted run share what all share
            prefix = prefix[:-1]
        rest = [n[len(prefix):] for n in names[i:j] if n != prefix]
        tail = f"(?:{_any_of(rest)}){'?' if names[i] == prefix else ''}" if rest else ""
        out.append("".join("\\" + c if c.isascii() and not c.isalnum() else c for c in prefix) + tail)
        i = j
    return "|".join(out)


def _replaced(text: Column, pattern: Column, alias: Column) -> Column:
    """Each match of ``pattern`` replaced by its entry in the map ``alias``."""
    between = F.split(text, pattern, -1)
    aliases = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda m: F.element_at(alias, m))
    return F.concat_ws("", F.flatten(F.zip_with(between, aliases, lambda t, m: F.array(t, F.coalesce(m, F.lit(""))))))


def replace_names(text: Column, dictionary: list[tuple[str, str]], parity: bool = False) -> Column:
    """TXT-3 for a list of pairs that the caller has: substring replacement in one pass, at each place the longest name, so
    neither ``sensor_1`` eats the prefix of ``sensor_10`` nor a name rewrites an alias. ``parity=True`` replaces one name after
    the other in dictionary order, over the aliases too. For a table of names see ``anonymize``."""
    pairs = [(n, a) for n, a in dictionary if n]
    if not pairs:
        return text
    if parity:
        steps = F.from_json(F.lit(json.dumps([{"n": n, "a": a} for n, a in pairs])), "array<struct<n:string,a:string>>")
        return F.aggregate(steps, text, lambda acc, p: F.replace(acc, p["n"], p["a"]))
    pattern = _any_of(sorted({n for n, _ in pairs}))
    alias = F.from_json(F.lit(json.dumps(dict(pairs))), "map<string,string>")
    return F.when(text.rlike(pattern), _replaced(text, F.lit(pattern), alias)).otherwise(text)


def map_strings(c: Column, kind: T.DataType, f: Callable[[Column], Column]) -> Column:
    """``f`` on every string inside a column: array elements, map keys and values, struct fields, at any depth."""
    if isinstance(kind, T.StringType):
        return f(c)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: map_strings(x, kind.elementType, f))
    if isinstance(kind, T.MapType):
        keyed = F.transform_keys(c, lambda k, v: map_strings(k, kind.keyType, f))
        return F.transform_values(keyed, lambda k, v: map_strings(v, kind.valueType, f))
    if isinstance(kind, T.StructType):
        fields = [map_strings(c[x.name], x.dataType, f).alias(x.name) for x in kind.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    return c


def _strings(c: Column, kind: T.DataType) -> Column:
    """All strings inside a column, as an array."""
    none = F.array().cast("array<string>")
    if isinstance(kind, T.StringType):
        return F.array(c)
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.flatten(F.transform(c, lambda x: _strings(x, kind.elementType))), none)
    if isinstance(kind, T.MapType):
        return F.concat(_strings(F.map_keys(c), T.ArrayType(kind.keyType)), _strings(F.map_values(c), T.ArrayType(kind.valueType)))
    if isinstance(kind, T.StructType):
        return F.coalesce(F.concat(none, *[_strings(c[x.name], x.dataType) for x in kind.fields]), none)
    return none


#: characters of a text that are cut into windows at once
PIECE_CHARS = 50_000


#: a place of the names at which more characters than this stand takes any
MOST_CHARACTERS = 200


def _shapes(dictionary: DataFrame) -> Column:
    """Scalar (longest, patterns): the longest name's length, and for each length a pattern whose group 1 is, from every place of a
    text, what agrees with the names of that length in the characters that stand at each of their places. So it finds all
    names of this length and little else; its own length is bounded by theirs and the alphabet."""
    each = F.transform(F.sequence(F.lit(1), F.length("name")), lambda i: F.substring("name", i, F.lit(1)))
    characters = dictionary.select(F.length("name").alias("n"), F.posexplode(each).alias("at", "c"))
    quoted = F.when(F.col("c").rlike(r"^[\x00-\x7F&&[^A-Za-z0-9]]$"), F.concat(F.lit("\\"), "c")).otherwise(F.col("c"))
    places = characters.groupBy("n", "at").agg(F.sort_array(F.collect_set(quoted)).alias("of"))
    place = F.when(F.size("of") > MOST_CHARACTERS, ".").otherwise(F.concat(F.lit("["), F.array_join("of", ""), F.lit("]")))
    lengths = places.groupBy("n").agg(F.array_sort(F.collect_list(F.struct("at", place.alias("p")))).alias("places"))
    pattern = F.concat(F.lit("(?s)(?=("), F.array_join(F.transform("places", lambda x: x["p"]), ""), F.lit("))"))
    return lengths.agg(F.struct(F.coalesce(F.max("n"), F.lit(0)).alias("longest"), F.collect_list(pattern).alias("patterns"))).scalar()


def occurring_names(texts: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(_key, _alias): for the string arrays ``_strings`` of each ``_key`` the dictionary's names that occur anywhere in them, as a map
    to their aliases. Every part of a text that has some name's length and shape is joined with the dictionary table, so the names
    never pass through the driver or the plan; only their shapes do, as a scalar subquery."""
    t = texts.select("_key", F.explode("_strings").alias("s"), _shapes(dictionary).alias("_shapes"))
    # a long text in pieces that overlap by the longest name
    starts = F.sequence(F.lit(0), F.floor(F.length("s") / PIECE_CHARS).cast("int"))
    longest = F.col("_shapes.longest")
    pieces = t.select("_key", "_shapes", F.explode(F.transform(starts, lambda i: F.substring("s", i * PIECE_CHARS + 1, longest + PIECE_CHARS))).alias("s"))
    windows = F.flatten(F.transform("_shapes.patterns", lambda p: F.array_distinct(F.regexp_extract_all("s", p, F.lit(1)))))
    hits = pieces.select("_key", F.explode(windows).alias("name")).join(dictionary.select("name", "alias"), "name")
    return hits.groupBy("_key").agg(F.map_from_entries(F.collect_set(F.struct("name", "alias"))).alias("_alias"))


def anonymize(df: DataFrame, columns: list[str], dictionary: DataFrame, mask: bool = False) -> DataFrame:
    """TXT-3/TXT-4/TXT-5 with a table of names (name, alias): in every string of ``columns``, nested or not, names are replaced in one
    pass, at each place the longest; with ``mask``, paths are masked after that.

    The names that occur in a row's strings come from a distributed join; the row is then rewritten by an expression that
    knows only those. Rows are matched by a hash of their strings: equal rows share their names, and a clash of two only
    widens the names tried."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    strings = F.filter(F.concat(*[_strings(F.col(c), kinds[c]) for c in columns]), lambda s: s.isNotNull())
    keyed = df.withColumn("_key", F.xxhash64(strings))
    texts = keyed.select("_key", F.array_distinct(strings).alias("_strings"))
    found = occurring_names(texts, dictionary.filter(F.length("name") > 0))
    by_length = F.sort_array(F.transform(F.map_keys("_alias"), lambda n: F.struct(F.length(n).alias("l"), n.alias("n"))), asc=False)
    quoted = F.transform(by_length, lambda x: F.concat(F.lit("\\Q"), F.replace(x["n"], F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E")))
    pattern = F.array_join(quoted, "|")

    def clean(c: Column) -> Column:
        c = F.when(c.isNull() | F.col("_alias").isNull(), c).otherwise(_replaced(c, pattern, F.col("_alias")))
        return mask_paths(c) if mask else c

    joined = keyed.join(found, "_key", "left")
    return joined.select(*[map_strings(F.col(f"`{c}`"), kinds[c], clean).alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns])


def text_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """Whole text -> (key, line_no 1.., line); Python ``split('\\n')`` semantics (trailing empties kept)."""
    return df.select(key, F.posexplode(F.split(F.col(text), "\n", -1)).alias("line_no", "line")).withColumn(
        "line_no", (F.col("line_no") + 1).cast("long")
    )


def log_tail(lines: DataFrame, key: str, max_lines: int = TAIL_LINES) -> DataFrame:
    """TXT-7: last ``max_lines`` lines of each file, re-joined in order."""
    w = Window.partitionBy(key).orderBy(F.col("line_no").desc())
    last = lines.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= max_lines)
    return last.groupBy(key).agg(
        F.count(F.lit(1)).cast("long").alias("n_lines"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("excerpt"),
    )


def text_tail(df: DataFrame, key: str, text: str, max_lines: int = TAIL_LINES) -> DataFrame:
    """TXT-7 of whole texts: the last ``max_lines`` lines of each row's text, without exploding or shuffling lines. A
    null text gives no row."""
    lines = df.filter(F.col(text).isNotNull()).select(key, F.split(text, "\n", -1).alias("_lines"))
    n = F.least(F.size("_lines"), F.lit(max_lines))
    return lines.select(key, n.cast("long").alias("n_lines"),
                        F.array_join(F.slice("_lines", F.size("_lines") - n + 1, n), "\n").alias("excerpt"))


def event_log_lines(events: DataFrame) -> DataFrame:
    """Log lines derived from the events table, one log file per user, numbered by time:
    ``<ts> <LEVEL> <event_type>: value=<v> event=<id>`` with ERROR for error events. Of the errors, one in four has no colon, one
    goes on for a second line, and one has a date in the middle of the line."""
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
    head = F.format_string("%s %s %s", F.col("ts").cast("string"), level, F.col("event_type"))
    body = F.format_string("value=%.2f event=%d", F.col("value"), F.col("event_id"))
    kind = F.when(F.col("event_type") == "error", F.col("event_id") % 4).otherwise(0)
    entry = (F.when(kind == 1, F.concat(head, F.lit(" "), body))
             .when(kind == 2, F.concat(head, F.lit(": "), body, F.lit("\n  caused by event "), F.col("event_id").cast("string")))
             .when(kind == 3, F.concat(head, F.lit(": "), body, F.lit(" seen "), F.to_date("ts").cast("string"), F.lit(" again: yes")))
             .otherwise(F.concat(head, F.lit(": "), body)))
    file = F.format_string("user_%d.log", F.col("user_id"))
    rows = events.select(file.alias("file"), "ts", "event_id", F.posexplode(F.split(entry, "\n")).alias("_part", "line"))
    # a file may hold most of the events: its lines are sorted by range partitions, whose rows Spark numbers in order, so a
    # line's number is its place among the file's lines of its partition plus those of the earlier partitions
    ordered = cut_lineage(rows.orderBy("file", "ts", "event_id", "_part").select("file", F.monotonically_increasing_id().alias("_id"), "line"), "lines")
    ordered = ordered.withColumn("_range", F.shiftright("_id", 33))
    ranges = ordered.groupBy("file", "_range").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    along = Window.partitionBy("file").orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    offsets = ranges.withColumn("_before", F.sum("_lines").over(along) - F.col("_lines"))
    return ordered.join(offsets, ["file", "_range"]).select(
        "file", (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line_no"), "line")


def step_shares(steps: DataFrame, bundle: str, step: str, duration: str) -> DataFrame:
    """TXT-8: per bundle total duration and each step's duration and percent of it."""
    agg = steps.groupBy(bundle, step).agg(F.sum(duration).alias("duration"))
    total = F.sum("duration").over(Window.partitionBy(bundle))
    return agg.select(bundle, step, "duration", total.alias("total"),
                      F.try_divide(F.col("duration") * 100.0, total).alias("percent"))


def first_k_per_group(df: DataFrame, group: str, order: list[str], k: int, stage: str | None = None) -> DataFrame:
    """First k rows per group in ``order`` without one unbounded task per group: first k per
    (group, stage) (e.g. per day), then first k of those candidates per group."""
    if stage is not None:
        w1 = Window.partitionBy(group, stage).orderBy(*order)
        df = df.withColumn("_r1", F.row_number().over(w1)).filter(F.col("_r1") <= k).drop("_r1")
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k).withColumnRenamed("_r", "rank")


def bundle_counts(events: DataFrame) -> DataFrame:
    """TXT-9 re-aimed at events: per user, error and warning counts and the first 5 error events."""
    counts = events.groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "error").cast("long").alias("n_errors"),
        F.count_if(F.col("event_type") == "signup").cast("long").alias("n_warnings"),
    )
    errs = events.filter(F.col("event_type") == "error").withColumn("_day", F.to_date("ts"))
    first5 = first_k_per_group(errs, "user_id", ["ts", "event_id"], 5, stage="_day")
    firsts = first5.groupBy("user_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "event_id"))),
                                 lambda x: x["event_id"].cast("string")), ",").alias("first_errors")
    )
    return counts.join(firsts, "user_id", "left")


RESPONSE = T.StructType([
    T.StructField("summary", T.StringType()),
    T.StructField("issues", T.ArrayType(T.StringType())),
    T.StructField("recommendations", T.ArrayType(T.StringType())),
    T.StructField("confidence", T.StringType()),
])


def parse_response(text: Column) -> Column:
    """TXT-10: first '{' .. last '}' parsed as JSON with defaults; otherwise the first 500 chars
    as summary with confidence 'low'."""
    blob = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    has = (blob != "") & F.json_object_keys(blob).isNotNull()
    js = F.from_json(blob, RESPONSE)
    empty = F.array().cast("array<string>")
    return F.when(
        has,
        F.struct(
            F.coalesce(js["summary"], F.lit(NO_SUMMARY)).alias("summary"),
            F.coalesce(js["issues"], empty).alias("issues"),
            F.coalesce(js["recommendations"], empty).alias("recommendations"),
            F.coalesce(js["confidence"], F.lit(DEFAULT_CONFIDENCE)).alias("confidence"),
        ),
    ).otherwise(
        F.struct(F.substring(text, 1, FALLBACK_CHARS).alias("summary"), empty.alias("issues"), empty.alias("recommendations"),
                 F.lit(FALLBACK_CONFIDENCE).alias("confidence"))
    )


def anonymize_bundles(bundles: DataFrame, dictionary: DataFrame, mask: bool = True) -> DataFrame:
    """TXT-5: names replaced and paths masked in every string of the bundle rows, nested ones included;
    only the bundle's id, time and version stay as they are."""
    return anonymize(bundles, [c for c in bundles.columns if c not in BUNDLE_KEYS], dictionary, mask)
