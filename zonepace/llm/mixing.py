"""Soft-membership mixing: document rates whose expected domain token totals match targets.

1. A classifier (``subword_model.py``) trained on a labelled table gives each
   document d its domain posteriors p_dk; t_d is its number of white-space words (tokens).
2. Rates r_d >= 0 minimise
   1/2 |sum_d t_d r_d p_d / T - b w|^2 + RIDGE/2 sum_d (t_d / T) (r_d - 1)^2
   with T the tokens of all documents, w the target shares and b the budget over T,
   by accelerated projected gradient descent.  Each iteration is one Spark job
   over (t, p): a task recomputes its documents' rates from the residuals of the
   iterations before (a few numbers each) and returns K sums.  No per-document state is kept
   between jobs, so a lost executor costs only its tasks.
3. A document gets floor(r_d + u_d) copies, u_d uniform from a hash of its id and
   text, so expected totals are met.

The default budget is the least that does not thin out the anchor domain.  A label table of any
kind will do; the registered query takes the languages of the rows that ``labels`` marks as good.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepace.llm import subword_model as M
from zonepace.llm.common import small_batches, text_of, written

RIDGE, TOLERANCE, MAX_ITERATIONS = 1e-4, 2e-4, 200
# The default budget leaves the anchor domain this much above its own tokens, so that no fit error thins it out.
HEADROOM = 1.01
# The domains are languages; the target share of tokens of each.
DOMAINS = ("en", "de", "fr", "es")
TARGETS = {"en": 0.52, "de": 0.18, "fr": 0.18, "es": 0.12}
ANCHOR = "en"
_T, _P, _RATE = "mix__tokens", "mix__p", "mix__rate"


def domain_labels(docs: DataFrame, labels: DataFrame, domains: tuple[str, ...] = DOMAINS) -> DataFrame:
    """(doc_id, label): the language, as a number, of the documents that the labels table marks as good."""
    good = labels.filter("quality = 1").select("doc_id").distinct()
    number = F.array_position(F.array(*map(F.lit, domains)), F.col("lang")).cast("int") - 1
    return docs.select("doc_id", number.alias("label")).filter("label >= 0").join(good, "doc_id", "left_semi")


def with_posteriors(docs: DataFrame, logits: np.ndarray, text_col: str = "text") -> DataFrame:
    """``docs`` with tokens and posteriors (``mix__tokens``, ``mix__p``), written."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(logits)

    def score(batches):
        scorer = M.scorer_of(shared.value)
        for b in batches:
            p, words = scorer.score(b.column(text_col))
            tokens = pa.array(words.astype(np.float64))
            rows = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * p.shape[1]), pa.array(p.ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns, tokens, rows], names=[*b.schema.names, _T, _P])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return written(docs.mapInArrow(score, f"{fields}, {_T} double, {_P} array<double>"), "posteriors")


def replay(p: np.ndarray, residuals: list[np.ndarray], lipschitz: float) -> tuple[np.ndarray, np.ndarray]:
    """(rates, extrapolated rates) after the given iterations."""
    rate = ahead = np.ones(len(p))
    for i, residual in enumerate(residuals):
        fresh = np.maximum(0.0, ahead - (p @ residual + RIDGE * (ahead - 1)) / lipschitz)
        ahead = fresh + i / (i + 3) * (fresh - rate)
        rate = fresh
    return rate, ahead


def _posteriors(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(_P).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def fit_rates(scored: DataFrame, targets: np.ndarray, anchor: int | None, budget: float | None = None,
              max_iterations: int = MAX_ITERATIONS) -> tuple[list[np.ndarray], float, dict]:
    """(residuals, step constant, report): what ``replay`` needs to give any document its rate."""
    k = len(targets)
    table = scored.select(_T, _P)
    p = [F.col(_P)[i] for i in range(k)]
    facts = table.agg(F.sum(_T).alias("t"), *[F.sum(F.col(_T) * p[i]).alias(f"m{i}") for i in range(k)],
                      *[F.sum(F.col(_T) * p[i] * p[j]).alias(f"a{i}_{j}") for i in range(k) for j in range(i, k)]).first()
    total = facts["t"] or 0.0
    if not total:
        return [], 1.0, {"tokens": 0.0, "budget": 0.0, "iterations": 0, "error": 0.0}
    share = np.array([facts[f"m{i}"] for i in range(k)]) / total
    gram = np.array([[facts[f"a{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)]) / total
    lipschitz = float(np.linalg.eigvalsh(gram)[-1]) + RIDGE
    ratio = budget / total if budget else max(1.0, HEADROOM * share[anchor] / targets[anchor]) if anchor is not None and targets[anchor] > 0 else 1.0
    goal = ratio * targets
    residuals: list[np.ndarray] = []

    def sums(history):
        def add(batches):
            got = np.zeros(2 * k)
            for b in batches:
                q, t = _posteriors(b), b.column(_T).to_numpy()
                rate, ahead = replay(q, history, lipschitz)
                got += np.concatenate([(t * rate) @ q, (t * ahead) @ q])
            yield pa.record_batch({f"s{i}": pa.array([v]) for i, v in enumerate(got)})
        row = (table.mapInArrow(add, ", ".join(f"s{i} double" for i in range(2 * k)))
               .agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(2 * k)]).first())
        return np.array(row[:k]) / total, np.array(row[k:]) / total

    at, ahead, before = share, share, None
    for _ in range(max_iterations):
        # Done: the targets are met, or (targets that no rates can meet) the totals stand still.
        if np.abs(at - goal).max() <= TOLERANCE * ratio or before is not None and np.abs(at - before).max() <= TOLERANCE * ratio / 100:
            break
        before = at
        residuals.append(ahead - goal)
        at, ahead = sums(list(residuals))
    report = {"tokens": total, "budget": ratio * total, "iterations": len(residuals), "error": float(np.abs(at - goal).max()),
              "shares": share.tolist(), "fitted": (at / at.sum()).tolist() if at.sum() else at.tolist()}
    return residuals, lipschitz, report


def with_rates(scored: DataFrame, residuals: list[np.ndarray], lipschitz: float) -> DataFrame:
    """``scored`` with ``mix__rate``."""
    def rate(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(replay(_posteriors(b), residuals, lipschitz)[0])],
                                             names=[*b.schema.names, _RATE])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in scored.schema)
    return scored.mapInArrow(rate, f"{fields}, {_RATE} double")


def _copies(hash_col: Column) -> Column:
    u = F.pmod(hash_col, F.lit(1 << 40)) / float(1 << 40)
    return F.floor(F.col(_RATE) + u).cast("int")


def fit_mixing(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, domains: tuple[str, ...] = DOMAINS,
               anchor: str | None = ANCHOR, budget: float | None = None, max_train: int = M.MAX_TRAIN, text_col: str = "text",
               id_col: str = "doc_id"):
    """(scored rows, residuals, step constant, report) for ``docs`` and (doc_id, label) domain labels.

    The scored rows carry all columns of ``docs``.  Null and empty texts weigh
    nothing and get a rate by their posteriors.
    """
    texts = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("text"))
    logits = M.fit(texts, labels, len(domains), max_train)
    want = targets or TARGETS
    shares = np.array([want[d] for d in domains], float)
    scored = with_posteriors(docs, logits, text_col)
    residuals, lipschitz, report = fit_rates(scored, shares / shares.sum(), domains.index(anchor) if anchor else None, budget)
    return scored, residuals, lipschitz, report


def mixing_rates(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, p_<domain>..., rate, copies: one row per row of ``docs``;
    ``labels`` are (doc_id, label) with the number of the domain."""
    narrow = docs.select("doc_id", text_of(docs).alias("text"))
    domains = options.get("domains", DOMAINS)
    scored, residuals, lipschitz, _ = fit_mixing(narrow, labels, **options)
    rated = with_rates(scored.select("doc_id", F.xxhash64("doc_id", "text").alias("mix__h"), _T, _P), residuals, lipschitz)
    return rated.select("doc_id", F.col(_T).cast("long").alias("n_words"), *[F.col(_P)[i].alias(f"p_{d}") for i, d in enumerate(domains)],
                        F.col(_RATE).alias("rate"), _copies(F.col("mix__h")).alias("copies"))


def mix(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, each as often as its rate says; no row moves between tasks."""
    scored, residuals, lipschitz, _ = fit_mixing(docs, labels, id_col=id_col, text_col=text_col, **options)
    times = _copies(F.xxhash64(id_col, F.coalesce(F.col(text_col), F.lit(""))))
    rated = with_rates(scored, residuals, lipschitz).withColumn("mix__copies", times).filter("mix__copies > 0")
    return (rated.withColumn("mix__copy", F.explode(F.sequence(F.lit(1), F.col("mix__copies"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
