"""Scaling, labels, quality scores, K-Means invariants, DBSCAN vs brute force."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from zonepace import config as C
from zonepace.operators import dbscan as DS
from zonepace.operators import kmeans as KM
from zonepace.operators import marts as MA
from zonepace.operators import quality as QU
from zonepace.operators import scaling as SC

FEATS = C.CLUSTER_FEATURES
KEY = ["zone_id", "hour_of_day", "day_of_week"]


def _np_features(pdf):
    X = pdf[FEATS].astype(float).to_numpy()
    return X


def test_standard_scaler(spark, cells_df):
    sc, _ = SC.scale_features(SC.prepare_features(cells_df), FEATS, "standard")
    X = sc.select(*FEATS).toPandas().to_numpy()
    assert np.allclose(X.mean(axis=0), 0, atol=1e-8) and np.allclose(X.std(axis=0), 1, atol=1e-8)


def test_robust_scaler_matches_numpy(spark, cells_df, cells_pdf):
    sc, _ = SC.scale_features(SC.prepare_features(cells_df), FEATS, "robust")
    got = sc.orderBy("zone_id").select(*FEATS).toPandas().to_numpy()
    X = _np_features(cells_pdf.sort_values("zone_id"))
    q1, med, q3 = np.percentile(X, [25, 50, 75], axis=0)
    iqr = np.where(q3 - q1 == 0, 1.0, q3 - q1)
    assert np.allclose(got, (X - med) / iqr, atol=1e-9)


def test_unknown_scaler():
    with pytest.raises(ValueError):
        SC.make_scaler("minmax")
    assert SC.make_scaler(None) == "standard"


def test_missing_feature_raises(spark, cells_df):
    with pytest.raises(KeyError):
        SC.prepare_features(cells_df.drop("hour_sin"))


def test_semantic_labels_monotone(spark):
    rows = [(s, r) for s, r in [(10.0, 2), (20.0, 1), (30.0, 0), (11.0, 2), (21.0, 1), (31.0, 0)]]
    df = spark.createDataFrame(rows, "avg_speed_mph double, raw_cluster int")
    out = MA.assign_semantic_labels(df).groupBy("congestion_level").agg(F.avg("avg_speed_mph").alias("s")) \
        .orderBy("congestion_level").collect()
    speeds = [r["s"] for r in out]
    assert [r["congestion_level"] for r in out] == [0, 1, 2] and speeds == sorted(speeds, reverse=True)


def _brute_silhouette(X, lab):
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    s = np.zeros(len(X))
    for i in range(len(X)):
        own = lab == lab[i]
        if own.sum() == 1:
            continue
        a = D[i, own].sum() / (own.sum() - 1)
        b = min(D[i, lab == c].mean() for c in np.unique(lab) if c != lab[i])
        s[i] = (b - a) / max(a, b)
    return s


def test_silhouette_matches_brute_force(spark, cells_df, cells_pdf):
    df = cells_df.withColumn("lab", (F.col("zone_id") - 1) / 100).withColumn("lab", F.floor("lab").cast("int"))
    df = SC.prepare_features(df)
    per = QU.silhouette_samples(df, FEATS, ["lab"], ["zone_id"]).orderBy("zone_id").toPandas()
    p = cells_pdf.sort_values("zone_id")
    X = _np_features(p)
    lab = ((p["zone_id"].to_numpy() - 1) // 100)
    want = _brute_silhouette(X, lab)
    assert np.allclose(per["sil_lab"].to_numpy(), want, atol=1e-7)
    assert want.mean() > 0.2


def test_db_ch_match_formulas(spark, cells_df, cells_pdf):
    df = SC.prepare_features(cells_df.withColumn("lab", F.floor((F.col("zone_id") - 1) / 100).cast("int")))
    p = cells_pdf.sort_values("zone_id")
    X = _np_features(p)
    lab = ((p["zone_id"].to_numpy() - 1) // 100)
    ks = np.unique(lab)
    cen = np.array([X[lab == k].mean(0) for k in ks])
    s = np.array([np.linalg.norm(X[lab == k] - cen[i], axis=1).mean() for i, k in enumerate(ks)])
    db = np.mean([max((s[i] + s[j]) / np.linalg.norm(cen[i] - cen[j]) for j in range(len(ks)) if j != i)
                  for i in range(len(ks))])
    W = sum(((X[lab == k] - cen[i]) ** 2).sum() for i, k in enumerate(ks))
    B = sum((lab == k).sum() * ((cen[i] - X.mean(0)) ** 2).sum() for i, k in enumerate(ks))
    ch = (B / (len(ks) - 1)) / (W / (len(X) - len(ks)))
    assert abs(QU.davies_bouldin(df, FEATS, "lab").first()[0] - db) < 1e-9
    assert abs(QU.calinski_harabasz(df, FEATS, "lab").first()[0] - ch) < 1e-6 * ch


def test_ari_bounds_and_identity(spark, cells_df):
    df = cells_df.withColumn("a", F.col("zone_id") % 3).withColumn("b", F.col("zone_id") % 5) \
        .withColumn("c", F.lit(7) - F.col("zone_id") % 3)
    ari = QU.adjusted_rand(df, "a", "b").first()["ari"]
    assert -1 <= ari <= 1
    assert QU.adjusted_rand(df, "a", "c").first()["ari"] == 1.0


def test_cv_nonnegative(spark, cells_df):
    df = cells_df.withColumn("congestion_level", F.col("zone_id") % 3)
    assert all(r["cv"] >= 0 for r in QU.cv_intra(df).collect())


def test_kmeans_invariants(spark, cells_df):
    sc, _ = SC.scale_features(SC.prepare_features(cells_df), FEATS)
    data = KM.stable_input(sc, KEY, FEATS)
    fit = KM.train_kmeans(data, 3, n_init=2)
    lab = MA.assign_semantic_labels(KM.predict(fit, data))
    rows = lab.groupBy("congestion_level").agg(F.avg("avg_speed_mph").alias("s")).orderBy("congestion_level").collect()
    assert [r["congestion_level"] for r in rows] == [0, 1, 2]
    speeds = [r["s"] for r in rows]
    assert speeds == sorted(speeds, reverse=True)
    # same labels after repartitioning the input
    data2 = KM.stable_input(sc.repartition(7), KEY, FEATS)
    lab2 = MA.assign_semantic_labels(KM.predict(KM.train_kmeans(data2, 3, n_init=2), data2))
    j = lab.select(*KEY, "congestion_level").join(lab2.select(*KEY, F.col("congestion_level").alias("l2")), KEY)
    assert QU.adjusted_rand(j, "congestion_level", "l2").first()["ari"] == 1.0


def test_inertia_falls_with_k(spark, cells_df):
    sc, _ = SC.scale_features(SC.prepare_features(cells_df), FEATS)
    data = KM.stable_input(sc, KEY, FEATS)
    inert = [KM.train_kmeans(data, k, n_init=2).inertia for k in (2, 3, 5)]
    assert inert[0] > inert[1] > inert[2]


def test_elbow_detection():
    ks, inertias = [2, 3, 4, 5, 6, 7], [1000, 500, 300, 250, 230, 220]
    k, tag = KM.detect_elbow(ks, inertias)
    assert tag in ("kneedle", "2nd-derivative") and 2 <= k <= 7
    assert KM.detect_elbow([2, 3], [10, 5]) == (C.DEFAULT_K, "default-k (too-few-points)")
    assert KM.detect_elbow_second_diff(ks, inertias) == 3


def test_elbow_table_matches_numpy(spark):
    ks, inertias = [2, 3, 4, 5, 6, 7], [1000.0, 500.0, 300.0, 250.0, 230.0, 220.0]
    t = spark.createDataFrame(list(zip(ks, inertias)), "k int, inertia double")
    assert KM.elbow_second_diff_table(t).first()["elbow_k"] == KM.detect_elbow_second_diff(ks, inertias)


def _brute_dbscan(X, eps, min_samples):
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    nb = D <= eps
    core = nb.sum(1) >= min_samples
    comp = -np.ones(len(X), dtype=int)
    c = 0
    for i in range(len(X)):
        if core[i] and comp[i] < 0:
            stack = [i]
            comp[i] = c
            while stack:
                u = stack.pop()
                for v in np.where(nb[u] & core)[0]:
                    if comp[v] < 0:
                        comp[v] = c
                        stack.append(v)
            c += 1
    lab = comp.copy()
    for i in range(len(X)):
        if not core[i]:
            cs = comp[nb[i] & core]
            lab[i] = cs.min() if len(cs) else -1
    return nb.sum(1), lab


def test_dbscan_matches_brute_force(spark, cells_df, cells_pdf):
    sc, _ = SC.scale_features(SC.prepare_features(cells_df), FEATS)
    got = DS.dbscan(sc, ["zone_id"], FEATS, eps=0.9, min_samples=5).orderBy("zone_id").toPandas()
    cnt = DS.neighbour_counts(sc, ["zone_id"], FEATS, eps=0.9, min_samples=5).orderBy("zone_id").toPandas()
    p = cells_pdf.sort_values("zone_id")
    X = _np_features(p)
    X = (X - X.mean(0)) / X.std(0)
    want_n, want_lab = _brute_dbscan(X, 0.9, 5)
    assert (cnt["neighbors"].to_numpy() == want_n).all()
    assert (got["dbscan_label"].to_numpy() == want_lab).all()
    m = DS.dbscan_metrics(spark.createDataFrame(got)).first()
    assert m["n_noise"] == int((want_lab == -1).sum())


def test_pca_centred_and_signed(spark, cells_df):
    from zonepace.operators.pca import pca_projection
    sc, _ = SC.scale_features(SC.prepare_features(cells_df), FEATS)
    proj, ratio, load = pca_projection(sc, FEATS, keep=["zone_id"])
    pcs = proj.select("pc1", "pc2").toPandas().to_numpy()
    assert np.allclose(pcs.mean(0), 0, atol=1e-9)
    assert ratio[0] >= ratio[1] > 0
    assert (load[np.abs(load).argmax(axis=0), [0, 1]] > 0).all()


def test_ari_pairs_match_single(spark, cells_df):
    df = cells_df.withColumn("a", F.col("zone_id") % 3).withColumn("b", F.col("zone_id") % 5) \
        .withColumn("c", (F.col("zone_id") * 7) % 4)
    got = {(r["a"], r["b"]): r["ari"] for r in QU.adjusted_rand_pairs(df, ["a", "b", "c"]).collect()}
    for x, y in (("a", "b"), ("a", "c"), ("b", "c")):
        assert abs(got[(x, y)] - QU.adjusted_rand(df, x, y).first()["ari"]) < 1e-12


def test_stable_input_places_rows_alike(spark, cells_df):
    """The same rows lie in the same partitions however the input was dealt, with more than one partition."""
    def places(df):
        part = KM.stable_input(df, KEY, FEATS, partitions=4)
        return sorted(part.select(F.spark_partition_id().alias("p"), *KEY).collect())
    first = places(cells_df)
    assert len({r["p"] for r in first}) > 1
    assert first == places(cells_df.repartition(7)) == places(cells_df)


def test_row_numbers_across_partitions(spark):
    from zonepace.functions.ranking import row_numbers
    df = spark.range(500).select((F.col("id") % 3).alias("g"), F.xxhash64("id").alias("v"))
    got = {(r["g"], r["v"]): r["n"] for r in row_numbers(df, ["g"], ["v"], "n").collect()}
    for g in range(3):
        vs = sorted(v for gg, v in got if gg == g)
        assert [got[(g, v)] for v in vs] == list(range(1, len(vs) + 1))


def test_dbscan_of_dense_and_large_cells(spark):
    """A sub-cell far above a pack, hot repeated points, noise, three features, a composite key: against brute force."""
    rng = np.random.default_rng(11)
    X = np.concatenate([np.repeat([[0.0, 0.0, 0.0]], 700, axis=0), rng.normal(0, 0.02, (300, 3)), rng.normal(2, 0.25, (120, 3)),
                        rng.uniform(-6, 6, (60, 3))])
    pdf = pd.DataFrame(X, columns=["f", "g", "h"])
    pdf["a"], pdf["b"] = np.arange(len(X)) // 50, np.arange(len(X)) % 50
    df = spark.createDataFrame(pdf).repartition(5)
    want_n, want = _brute_dbscan(X, 0.3, 6)
    got = DS.dbscan(df, ["a", "b"], ["f", "g", "h"], eps=0.3, min_samples=6).orderBy("a", "b").toPandas()
    cnt = DS.neighbour_counts(df, ["a", "b"], ["f", "g", "h"], eps=0.3, min_samples=6).orderBy("a", "b").toPandas()
    assert (cnt["neighbors"].to_numpy() == want_n).all()
    assert (got["dbscan_label"].to_numpy() == want).all() and (want == -1).any() and want.max() == 1
    assert DS.dbscan(df.limit(0), ["a", "b"], ["f", "g", "h"]).count() == 0
