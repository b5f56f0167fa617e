"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepace.session import ensure_checkpoint_dir, scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Rows and bytes per Arrow batch handed to Python, whichever is reached first: whole
# texts of any length then take a worker a few times this much (or one text, if that is longer).
ARROW_ROWS, ARROW_BYTES = 512, 4 << 20


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small (see ``ARROW_ROWS``)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder of ``spark.checkpoint.dir``, read back.

    Cuts the lineage: a lost executor re-reads files instead of recomputing,
    and non-deterministic columns (row ids) keep their values.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(df: DataFrame, col: str = "text") -> Column:
    """The text column as a string; null counts as empty."""
    return F.coalesce(df[col].cast("string"), F.lit(""))


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(col, UPPER, LOWER)


def at_most(df: DataFrame, bound: int) -> bool:
    """True when ``df`` has at most ``bound`` rows; counts no further than that."""
    return df.limit(bound + 1).count() <= bound
