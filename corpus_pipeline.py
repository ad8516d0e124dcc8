"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read back as the next one's input.

Language ID drops documents without a letter and those whose score says that they are in no learned language (``langid.keep``;
where no labelled row was learned from, only the former); near-duplicate removal
keeps the document with the smallest doc_id of each group (five-word shingles, similarity 0.8); decontamination drops
documents that hold a benchmark passage; PII spans are replaced in the text (``n_chars`` follows); the last
stage encodes what is left with a byte-level BPE vocabulary.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewise.llm import bpe, decontaminate, jaccard, langid, pii
from tidewise.session import run_folder, write_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = _documents(docs)
    return langid.keep(docs, langid.fit_on_training(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(_documents(docs), n=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(_documents(docs), spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _documents(pii.redact(_documents(docs)).withColumn("n_chars", F.length("text").cast("long")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.report(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("byte-level BPE", tokens),
]

#: SQL can't express byte-pair merges by rank; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    folder = f"{run_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        write_table(stage(spark, docs, sf_dir), f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
