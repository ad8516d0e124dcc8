"""Exact deduplication with a persistent digest index.

The index is a Parquet table bucketed and sorted by digest: one row (digest, doc_id, row_no, batch) for the first
document of each text. New documents are reduced to one row per digest (partial aggregates first, so a hot text sends
one row per task), meet the index in a sort-merge anti-join that shuffles the new side only, and those left
are appended. A text counts by the SHA-256 of its normalised form: runs of white space ``[\\x20\\x09-\\x0D]+`` are one space.

The folder outlives the session: ``open_index`` declares the table anew over the files. An ingest that is run again
appends nothing twice (its digests are there by then); rows that two ingests at once wrote for one digest are
reduced to the first by (id, batch, row) on read.

Cases: a null text is empty; an empty table gives no rows; repeated rows (equal in id and text, too) are told
apart by their row number, so exactly one of them stays; a null doc_id comes after all others, so keep_id is null
only where every row of the text lacks an id; very long texts are hashed whole; other columns are not read, so
clashing names don't matter.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewise.session import Scratch, run_folder

#: of a run that is not a single space already; other runs need no replacing
_RUNS = r"\x20[\x20\x09-\x0D]+|[\x09-\x0D][\x20\x09-\x0D]*"
#: a text held by this share of the rows or more is joined by broadcast: there can't be more than this many
HOT_SHARE = 1000
#: the query lets the table arrive in this many batches, by doc_id
ARRIVALS = 2


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), _RUNS, " "), 256))


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, row_no, digest) of every row; the row number tells repeated rows apart once this is written."""
    return docs.select("doc_id", F.monotonically_increasing_id().alias("row_no"), digest(F.col("text")).alias("digest"))


def open_index(spark: SparkSession, folder: str, buckets: int, id_type: str = "bigint") -> str:
    """Declare the index table over ``folder`` in this session (new or with files) and return its name. The number of
    buckets is part of the folder's name, as Spark can't read a bucketed table by another number."""
    path = f"{folder.rstrip('/')}/digests-{buckets}"
    name = "digest_index_" + hashlib.md5(path.encode()).hexdigest()
    spark.sql(f"create table if not exists {name} (digest binary, doc_id {id_type}, row_no bigint, batch string) using parquet "
              f"clustered by (digest) sorted by (digest) into {int(buckets)} buckets location '{path}'")
    spark.catalog.refreshTable(name)
    return name


def _first(batch: Column) -> Column:
    """Sorts by id (null last), then by batch and row."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", batch.alias("batch"), "row_no")).alias("first")


def ingest(rows: DataFrame, index: str, buckets: int, batch: str) -> None:
    """Append the digests of ``rows`` (doc_id, row_no, digest) that the index lacks, each with its first document."""
    seen = rows.sparkSession.table(index).select("digest")
    new = rows.groupBy("digest").agg(_first(F.lit(batch))).join(seen.hint("merge"), "digest", "left_anti")
    new.select("digest", "first.doc_id", "first.row_no", "first.batch").repartition(buckets, "digest").write.insertInto(index)
    rows.sparkSession.catalog.refreshTable(index)


def kept_rows(spark: SparkSession, index: str) -> DataFrame:
    """(digest, first): the document that stays for each text ever ingested."""
    return spark.table(index).groupBy("digest").agg(_first(F.col("batch")))


def report(docs: DataFrame, folder: str | None = None, buckets: int | None = None, arrivals: int = ARRIVALS) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id (of the row that stays), group_size (rows of ``docs`` with this text), kept,
    text_sha256.

    ``docs`` arrive in ``arrivals`` batches of ascending doc_id, each deduplicated against what the index holds by then, so
    with a new index the smallest doc_id stays; with an earlier one the documents already in it stay. Runs its ingests when called."""
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = open_index(spark, folder or f"{run_folder(spark)}/digest-index-{uuid.uuid4().hex}", buckets, docs.schema["doc_id"].dataType.simpleString())
    scratch, run = Scratch(spark, "dedup"), uuid.uuid4().hex
    rows = scratch.keep(digests(docs), "rows")
    total, low, high = rows.agg(F.count("*"), F.min("doc_id"), F.max("doc_id")).first()
    arrival = F.lit(arrivals - 1)
    if low is not None and arrivals > 1:
        width = (high - low) // arrivals + 1
        arrival = F.coalesce(F.expr(f"int((cast(doc_id as decimal(20)) - {low}) div {width})"), arrival)
    for k in range(arrivals):
        ingest(rows.filter(arrival == k), index, buckets, f"{run}-{k:04d}")
    sizes = rows.groupBy("digest").agg(F.count("*").alias("group_size"))
    groups = scratch.keep(sizes.join(kept_rows(spark, index), "digest"), "groups")
    hot = F.broadcast(groups.filter(F.col("group_size") * HOT_SHARE >= total))
    cold = rows.join(hot.select("digest"), "digest", "left_anti").join(groups, "digest")
    return rows.join(hot, "digest").unionByName(cold).select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("first.batch").startswith(run) & (F.col("first.row_no") == F.col("row_no"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
