"""Quality classifier, mixing and the pipeline: held-out accuracy, targets, edge cases."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_CHECK, SF_SMALL
from zonepace.llm import mixing as X
from zonepace.llm import quality as Q
from zonepace.llm import subword_model as M


def test_quality_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF_CHECK}/documents.parquet"), spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    logits = Q.fit_quality(docs, labels)
    got = {r.doc_id: r for r in Q.score_quality(docs, logits).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    truth = {r.doc_id: r.quality for r in labels.collect() if got[r.doc_id].held_out}
    right = [got[i].predicted == q for i, q in truth.items()]
    assert np.mean(right) > 0.95
    kept = Q.keep_quality(docs, logits)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.predicted}


def test_scores_do_not_depend_on_batches_or_cache(monkeypatch):
    rng = np.random.default_rng(0)
    logits = rng.normal(size=(1 << M.BITS, 2)).astype(np.float32)
    texts = ["", "a b a", "Wort wort é 漢字", "x" * 4000, "y y y z"] * 3
    want, sizes = M.Scorer(logits).score(pa.array(texts))
    monkeypatch.setattr(M, "CACHE_WORDS", 1)
    one = M.Scorer(logits)
    assert np.allclose(np.concatenate([one.score(pa.array([t]))[0] for t in texts]), want, atol=1e-12)
    # A text's logits are the mean over its features.
    feature, share = M.text_features("y y y z")
    direct = share @ logits[feature]
    p = np.exp(direct - direct.max())
    assert np.allclose(p / p.sum(), want[4], atol=1e-5)


def test_quality_edges(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    logits = Q.fit_quality(docs, none)
    scores = Q.score_quality(docs, logits).collect()
    assert len(scores) == docs.count() and {round(r.score, 6) for r in scores} == {0.5}
    odd = spark.createDataFrame([(None, 1, 0), (0, None, 0), (1, 1, 0), (1, 0, 0), (1, 1, 0), (999, 1, 1)], "doc_id long, quality int, toxic int")
    assert Q.score_quality(docs, Q.fit_quality(docs, odd)).count() == docs.count()
    assert Q.score_quality(docs.limit(0), logits).count() == 0


def test_mixing_meets_targets(spark):
    docs, labels = spark.read.parquet(f"{SF_CHECK}/documents.parquet"), spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    rates = X.mixing_rates(docs, X.domain_labels(docs, labels)).toPandas()
    assert len(rates) == docs.count() and (rates.rate >= 0).all()
    p = rates[[f"p_{d}" for d in X.DOMAINS]].to_numpy()
    assert np.allclose(p.sum(axis=1), 1)
    totals = (rates.n_words * rates.rate).to_numpy() @ p
    want = np.array([X.TARGETS[d] for d in X.DOMAINS])
    assert np.abs(totals / totals.sum() - want).max() < 2e-3
    assert (np.abs(rates.copies - rates.rate) < 1).all()


def test_projected_gradient_against_direct_solution(spark):
    """With hard memberships and reachable targets every document of a domain gets target / share."""
    rng = np.random.default_rng(3)
    rows = [(float(rng.integers(1, 50)), np.eye(3)[rng.integers(3)].tolist()) for _ in range(200)]
    scored = spark.createDataFrame(rows, "mix__tokens double, mix__p array<double>").repartition(3)
    want = np.array([0.5, 0.3, 0.2])
    residuals, lipschitz, report = X.fit_rates(scored, want, None)
    t, p = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    rate, _ = X.replay(p, residuals, lipschitz)
    assert report["error"] < 1e-3
    assert np.abs((t * rate) @ p / t.sum() - want).max() < 1e-3
    # Targets that cannot be met end at nonnegative rates.
    residuals, lipschitz, _ = X.fit_rates(scored, np.array([1.0, 0.0, 0.0]), None)
    rate, _ = X.replay(p, residuals, lipschitz)
    assert (rate >= 0).all() and rate[p[:, 1] == 1].max() < 0.05


def test_mix_rows(spark, docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, label int")
    options = {"domains": ("a", "b"), "targets": {"a": 0.5, "b": 0.5}, "anchor": None}
    out = X.mix(docs, labels, **options)
    assert out.columns == docs.columns
    copies = {r.doc_id: r.copies for r in X.mixing_rates(docs, labels, **options).collect()}
    assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == {i: c for i, c in copies.items() if c}
    assert X.mix(docs.limit(0), labels, **options).count() == 0
    none = spark.createDataFrame([], "doc_id long, label int")
    assert X.mixing_rates(docs, none, **options).count() == docs.count()


@pytest.mark.parametrize("sf_dir", [SF_SMALL])
def test_pipeline_stages(spark, sf_dir, tmp_path):
    import corpus_pipeline as C

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, [docs.count()]
    for name, stage in C.STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        seen.append(docs.count())
    assert seen[0] > seen[1] > seen[2] > seen[3] <= seen[4]
    out = C.run(spark, sf_dir)
    assert out.agg(F.sum("n_tokens")).first()[0] > 0 and out.select("slot").distinct().count() == out.count()
