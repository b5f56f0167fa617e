"""Quality scores: the supervised subword embeddings of ``subword_model.py`` on the ``quality`` labels."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepace.llm import subword_model as M
from zonepace.llm.common import small_batches, text_of

THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that teach nothing: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, max_train: int = M.MAX_TRAIN) -> np.ndarray:
    """Logits learned from the labelled rows of ``docs`` outside the held-out fold (at most ``max_train``)."""
    texts = docs.select("doc_id", text_of(docs).alias("text"))
    known = labels.filter(~held_out()).select("doc_id", F.col("quality").alias("label"))
    return M.fit(texts, known, 2, max_train)


def score_quality(docs: DataFrame, logits: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs``; null and empty texts get the empty text's score."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(logits)
    source = docs.select("doc_id", text_of(docs).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def score(batches):
        scorer = M.scorer_of(shared.value)
        for b in batches:
            yield pa.record_batch([b.column("doc_id"), pa.array(scorer.score(b.column("text"))[0][:, 1])], names=["doc_id", "score"])

    return (source.mapInArrow(score, f"doc_id {kind}, score double")
            .select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")))


def keep_quality(docs: DataFrame, logits: np.ndarray, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns unchanged, that score at least the threshold."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(logits)

    def keep(batches):
        scorer = M.scorer_of(shared.value)
        for b in batches:
            yield b.filter(pa.array(scorer.score(b.column(text_col))[0][:, 1] >= threshold))

    return docs.mapInArrow(keep, docs.schema)
