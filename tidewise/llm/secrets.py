"""Secret scan with an incremental blob ledger.

A *blob* is a distinct text, addressed by its SHA-256; a path (document row) points at a blob. The
ledger is a table of (blob, rule_version, findings), one row per scanned pair, clean blobs included.
A run scans only pairs that the ledger lacks, appends them, and joins the findings back to every
path. All steps are DataFrame functions.

Scale: the copies of a text meet in a partial aggregate before the shuffle, so a hot text sends
one row per task. The join back carries only (path, blob); its hot blob is split by AQE's skew join.

Cases: a null or empty text is the blob of the empty string, without findings; very long texts are scanned whole; an
empty table adds no blobs; repeated rows each get their row, a pair that two runs appended counts once; a clashing extra column is dropped (only the id and the text are read).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewise.llm.spans import empty, regex_spans
from tidewise.session import cut_lineage, run_folder, write_table

# fixed values: kind -> (pattern, guard)
# assign  (password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)  letters in either case, group 2 of 12+
# access  AKIA[A-Z0-9]+  18+ characters
# hex     [0-9a-f]+      16+ characters (a run of that length is the only match that is kept)
_ASSIGN = r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*+[:=]\x20*+["']?"""
RULES = {
    "assign": (_ASSIGN + r"[A-Za-z0-9+/_.=-]++", r"(?i)(?:word|wd|secret|token|key)[\"']?\x20*+[:=]"),
    "access": (r"AKIA[A-Z0-9]++", "AKIA"),
    "hex": (r"[0-9a-f]{16,}+", r"[0-9a-f]{16}"),
    "github": (r"gh[pousr]_[A-Za-z0-9]{36,}+", "gh[pousr]_"),
    "pem": (r"-----BEGIN [A-Z ]*+PRIVATE KEY-----", "-----BEGIN "),
}
BASE = ("assign", "access", "hex")
RULE_VERSION = "1"
FOUND = "array<struct<start:bigint,rank:int,end:bigint,kind:string>>"


def _keep(kind: str):
    if kind == "assign":
        return lambda s: F.length(F.regexp_replace(s["m"], "^" + _ASSIGN, "")) >= 12
    if kind == "access":
        return lambda s: F.length(s["m"]) >= 18
    return lambda s: F.lit(True)


def _tagged(kind: str):
    rank = list(RULES).index(kind)
    return lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"))


def _of(kind: str):
    return lambda s: s["kind"] == kind


def findings(text: Column) -> Column:
    """All findings of a text, by start, then kind as listed."""
    return F.sort_array(F.concat(*[
        F.transform(F.filter(regex_spans(text, pattern, guard), _keep(kind)), _tagged(kind))
        for kind, (pattern, guard) in RULES.items()]))


def update_ledger(docs: DataFrame, ledger: str, rule_version: str = RULE_VERSION) -> DataFrame:
    """Scan the blobs of ``docs`` that the ledger folder lacks under this rule version, append the
    results as one batch folder, and return the ledger's rows for this version. The folder may be new;
    a batch appears only once it is written whole, so a rerun after a failure scans what is missing. Where the ledger
    has rows, the digests alone look for unseen blobs, and only the texts of these are moved."""
    spark = docs.sparkSession
    blobs = docs.select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    schema = f"blob string, found {FOUND}"
    version = f"{ledger.rstrip('/')}/rule_version={rule_version}"
    p = spark._jvm.org.apache.hadoop.fs.Path(version)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        seen = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(version).select("blob")
        new = cut_lineage(blobs.select("blob").distinct().join(seen, "blob", "left_anti"), "unseen")
        blobs = blobs.join(new, "blob", "left_semi")
    unseen = blobs.groupBy("blob").agg(F.first("text").alias("text"))
    write_table(unseen.select("blob", findings(F.col("text")).alias("found")), f"{version}/{uuid.uuid4().hex}")
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(version)


def scan(docs: DataFrame, ledger: str | None = None, rule_version: str = RULE_VERSION) -> DataFrame:
    """(doc_id, blob, found) for every row of ``docs``; ``ledger`` defaults to a new one of this run."""
    ledger = ledger or f"{run_folder(docs.sparkSession)}/ledger-{uuid.uuid4().hex}"
    # two runs at once may both append a pair: it counts once
    known = update_ledger(docs, ledger, rule_version).filter(F.size("found") > 0).groupBy("blob").agg(F.first("found").alias("found"))
    paths = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("blob"))
    return paths.join(known, "blob", "left").select("doc_id", "blob", F.coalesce("found", empty(FOUND)).alias("found"))


def report(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """One row per document: counts and digest of the base kinds, all spans as kind:start:end."""
    f = scan(docs, ledger)
    text = lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))
    base = F.filter("found", lambda s: s["kind"].isin(*BASE))
    return f.select(
        "doc_id", *[F.size(F.filter("found", _of(k))).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(F.array_join(F.transform(base, text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("found", text), ",").alias("spans"), "blob")
