"""A training corpus from ``documents``: quality, near duplicates, benchmark leaks, personal data, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gleanery.llm.common import stored
from gleanery.llm.decontaminate import drop_leaks
from gleanery.llm.near_dups import drop_near_duplicates
from gleanery.llm.packing import pack_documents
from gleanery.llm.pii import redact
from gleanery.llm.quality import keep_quality, labels_of


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    Null and empty texts are judged by the bias, repeated rows one by one; an empty table stays empty, and all columns stay.
    """
    return keep_quality(docs, labels_of(spark, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays.

    Null and empty texts and rows without an id belong to no group and stay; ties go to the least id; all columns stay.
    """
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go.

    Null and empty texts and rows without an id stay, very long texts are read whole; with an empty table nothing goes.
    """
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind.

    No row goes; null texts stay null, each of several rows of an id is covered by the spans of its own text.
    """
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in which sequence; lengths are those of a public tokenizer.

    Null and empty texts have no piece, long ones several; repeated rows are packed one by one; an empty table gives no row.
    """
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("personal data", personal_data),
    ("best-fit packing", packing),
]

#: Fitted models and verified similarity have no SQL twin; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written to shared storage and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
