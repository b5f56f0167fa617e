"""Stage hand-over tables.

The pipeline hands each stage's output to the next as a written table,
like the original's Parquet files between stages: cleaned trips and the
cell table are built once per session and input directory, written under
the shared checkpoint folder (``spark.checkpoint.dir``), and read back.
Downstream queries then start from the table instead of re-running the
cleaning chain, and a lost executor re-reads files instead of recomputing
lineage.  A stage belongs to the state of its source: the list of its files with
sizes and modification times is part of the key, so rewritten input is
read anew.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from zonepace.session import scratch_path

_BUILT: dict[tuple[str, str, str], str] = {}


def source_state(spark: SparkSession, source: str) -> str:
    """The files under ``source`` with size and modification time, as one digest (listed by Spark's file source, unread)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source).select("path", "modificationTime", "length")
    return hashlib.sha1("\n".join(sorted(map(str, files.collect()))).encode()).hexdigest()


def source_digest(spark: SparkSession, source: str) -> str:
    """A short name for this state of ``source``."""
    return hashlib.sha1((source + source_state(spark, source)).encode()).hexdigest()[:12]


def stage(spark: SparkSession, name: str, source: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Return stage ``name`` for ``source``; build and write it on first use in this session."""
    app = spark.sparkContext.applicationId
    state = source_state(spark, source)
    key = (app, name, source + state)
    path = _BUILT.get(key)
    if path is None:
        tag = hashlib.sha1((source + state).encode()).hexdigest()[:12]
        path = scratch_path(spark, f"stages/{tag}/{name}")
        build().write.mode("overwrite").parquet(path)
        _BUILT[key] = path
    return spark.read.parquet(path)
