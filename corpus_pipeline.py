"""A training corpus from the documents table: five stages of ``splice_spark.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and is written as Parquet before the
next one reads it, so a lost executor costs tasks of one stage only.  All but
the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splice_spark.functions.lineage import delete, shared_folder, temporary
from splice_spark.llm import byte_bpe, decontamination, pii, quality_classifier, simhash_dedup
from splice_spark.llm.common import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality_classifier.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of SimHash near-duplicates."""
    return simhash_dedup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less than a twentieth of whose words stand in benchmark phrases."""
    return decontamination.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; n_chars follows the text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, and digests of the ids and of what they decode to."""
    return byte_bpe.round_trip(docs)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("redact_pii", redact_pii),
    ("tokenise", tokenise),
]

#: SQL has neither the classifier nor the tokenizer; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage needs on the way, and the rows of the stage before, go once it is written."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        with temporary(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
