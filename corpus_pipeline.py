"""A corpus pipeline of five stages over ``documents``, each written as Parquet and reread by the next.

language ID (texts without a known language go), quality (documents that score
below the threshold go), exact dedup, SimHash near-dedup (one document of each
group stays), packing. Every stage works on all rows that its predecessor kept.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import exact_dedup, language_id, packing, quality, simhash
from ledgerlens.llm.queries import WORD_BPE
from ledgerlens.session import checkpoint_dir


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is known; learns from all of them that name one."""
    return language_id.keep_known(docs, language_id.train(docs, F.lit(True)))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that score at least the threshold; learns from the labelled ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality.keep_good(docs, quality.train(docs, labels, F.lit(True)))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the smallest id of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the smallest id of each group of near copies."""
    return simhash.drop_near_copies(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences."""
    return packing.pack(docs, public_tokenizers.path(WORD_BPE))


STAGES = [
    ("language_id", language_stage),
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_stage),
    ("simhash_near_dedup", near_stage),
    ("packing", packing_stage),
]

#: Learned models and tokenizers are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, each stage written to the session's shared folder and reread."""
    folder = f"{checkpoint_dir(spark, local_fallback=True).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
