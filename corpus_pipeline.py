"""A training-data pipeline over ``documents``: five operators in a row.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor
kept, and is written as Parquet and read again before the next. All but the
last return the columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import exact_dedup, packing, quality_pu, secret_scan, simhash
from ledgerline.llm.common import staging, table
from ledgerline.session import ensure_checkpoint_dir

# Training has no SQL; tests/llm runs the pipeline against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_pu.keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (white space aside) one stays."""
    return exact_dedup.drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents within the SimHash radius one stays."""
    return simhash.drop_near_copies(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked; every document stays."""
    return secret_scan.redact_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become pieces placed in sequences of 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("simhash near-dedup", near),
    ("secret scans", secrets),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``. Each stage's result is
    written below spark.checkpoint.dir, what it staged is deleted then, and
    the last result is read back."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus/{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        with staging(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
