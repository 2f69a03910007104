"""A training corpus from documents: language, near-copies, benchmark leaks, mixture, token files.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from citytrace.llm import fmindex, langid, mixing, rangecoder, simhash
from citytrace.session import checkpoint_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a determined language; the network learns from the labelled ones not held out."""
    return langid.identified(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints (three words) links of two bits connect, that of the smallest id."""
    return simhash.one_of_each(docs, simhash.near_duplicates(docs, words=3, radius=2))


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every benchmark passage cut out."""
    return fmindex.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources repeated, half as often again as the largest at most; every document stays."""
    return mixing.mixed(docs, repetitions=1.5)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, written and read back; a row for each document in them."""
    return rangecoder.token_output(docs)


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("leaks", leaks),
    ("mixture", mixture),
    ("token_files", token_files),
]

#: The recurrent network and the token files have no SQL counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from the documents on; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{checkpoint_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
