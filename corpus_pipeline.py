"""The corpus pipeline, from raw documents to pieces for training.

Every stage works on all that its predecessor kept and, but for the last,
returns the columns of ``documents``.  Stages are written as Parquet in the
shared folder and read again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import mixing, ngram_join, quality_rules, secrets, sentencepiece
from gridloom.plans.staging import materialize


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, and the frequent lines of the
    others.  Lines are judged by the number of texts alone: a share of the host
    would let the same line through in a larger table."""
    return quality_rules.filter_documents(docs, max_share=0.0)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five words, 0.8)."""
    return ngram_join.drop_near_duplicates(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are struck out of the texts; no document goes."""
    return secrets.redact(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mix_documents(docs)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become piece ids."""
    return sentencepiece.encode_documents(docs)


STAGES = [
    ("quality rules", rules_stage),
    ("n-gram Jaccard join", near_stage),
    ("secret scans", secrets_stage),
    ("mixing", mix_stage),
    ("SentencePiece", pieces_stage),
]

#: The signatures, the Markov models and the pieces have no SQL; the stages are
#: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
