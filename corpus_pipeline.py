"""From raw documents to training shards: quality, near-dedup, decontamination, mixing, token shards.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next stage's
docs.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from zonepace.llm.common import load
from zonepace.llm.decontamination import remove_contaminated
from zonepace.llm.mixing import domain_labels, mix
from zonepace.llm.near_dedup import drop_near_copies
from zonepace.llm.quality import fit_quality, keep_quality
from zonepace.llm.queries import ID_VOCABULARY
from zonepace.llm.training_order import training_order
from zonepace.session import ensure_checkpoint_dir, scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return keep_quality(docs, fit_quality(docs, load(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return remove_contaminated(docs, load(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated at the rates that bring the languages to their target shares."""
    return mix(docs, domain_labels(docs, load(spark, sf_dir, "labels")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token sequences at their slots of the training order."""
    return training_order(docs, ID_VOCABULARY)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mixing", mixing), ("tokens", tokens)]

# Learned scores, sampled signatures and a tokenizer's ids: not expressible in SQL; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result but the last is written to the shared folder and read again."""
    ensure_checkpoint_dir(spark)
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline/{uuid.uuid4().hex}/{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
