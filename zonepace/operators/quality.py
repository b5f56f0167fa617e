"""Cluster quality: silhouette, Davies–Bouldin, Calinski–Harabasz, CV, ARI (Q1–Q9).

Centroid-based scores (DB, CH, CV) are grouped aggregates plus k×k
tables.  The silhouette needs, for every row, the sum of Euclidean
distances to every cluster, over all rows: the points are dealt into blocks,
each two blocks meet once in one task, which returns one row of partial
sums for the points of both, and these are added up.  Nothing is collected and no task holds
more than two blocks; the work stays quadratic in the number of points, so a
caller may pass a sample (``silhouette_sample`` with a cap).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepace import config as C
from zonepace.functions.frames import attach_row
from zonepace.functions.ranking import row_numbers

SIL_BLOCK = 4096  # points per block


def silhouette_sample(df: DataFrame, key: list[str], cap: int | None = None,
                      seed: int = C.KMEANS_RANDOM_STATE) -> DataFrame:
    """All rows, or with ``cap`` a deterministic sample of at most that many (Q1).

    Sampled rows are ranked by a seeded hash of the key, so the same rows are
    chosen however the table is partitioned.
    """
    if cap is None:
        return df
    h = F.xxhash64(*[F.col(k) for k in key], F.lit(seed))
    return df.orderBy(h, *[F.col(k) for k in key]).limit(cap)


def silhouette_samples(df: DataFrame, features: list[str], label_cols: list[str],
                       key: list[str]) -> DataFrame:
    """Per-row silhouette for one or several labelings of the same rows (Q2, Q3).

    ``label_cols`` lets one pass serve a whole k sweep: a block of distances
    is computed once and multiplied by the stacked one-hot matrix of all labelings.
    Output: key + one ``sil_{label}`` column per labeling.  A singleton
    cluster gives 0; a labeling with one cluster gives null.
    """
    cols = key + features + label_cols
    n = df.count()
    blocks = max(1, -(-n // SIL_BLOCK))
    # The clusters of every labeling with their sizes: k rows a labeling.
    sizes = {c: {r[0]: r[1] for r in df.groupBy(c).count().collect()} for c in label_cols}
    slots = [(c, lv) for c in label_cols for lv in sorted(sizes[c])]
    dealt = df.select(*cols).withColumn("_own", F.pmod(F.xxhash64(*key), F.lit(blocks)).cast("int"))
    # Each two blocks meet once: a point goes to the pair with every block, its own included.
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    rows = dealt.withColumn("_other", other).withColumns({"_a": F.least("_own", "_other"), "_b": F.greatest("_own", "_other")}).drop("_other")
    schema = ", ".join([f"`{k}` {t}" for k, t in df.select(*key).dtypes] + [f"_s{i} double" for i in range(len(slots))])

    def pair(pdf: pd.DataFrame) -> pd.DataFrame:
        low = (pdf["_own"] == pdf["_a"]).to_numpy()
        same = bool(pdf["_a"].iloc[0] == pdf["_b"].iloc[0])
        left, right = pdf[low], pdf if same else pdf[~low]
        x, y = left[features].to_numpy(np.float64), right[features].to_numpy(np.float64)
        hot = lambda part: np.column_stack([(part[c].to_numpy() == lv).astype(float) for c, lv in slots])
        hot_x, hot_y = hot(left), hot(right)
        sums, back = np.zeros((len(x), len(slots))), np.zeros((len(y), len(slots)))
        for s in range(0, len(x), 512):
            d2 = np.zeros((len(x[s:s + 512]), len(y)))
            for f in range(len(features)):
                diff = x[s:s + 512, f][:, None] - y[:, f][None, :]
                d2 += diff * diff
            d = np.sqrt(d2)
            sums[s:s + 512] = d @ hot_y
            if not same:
                back += d.T @ hot_x[s:s + 512]
        out = left[key] if same else pd.concat([left[key], right[key]])
        total = sums if same else np.concatenate([sums, back])
        return out.assign(**{f"_s{i}": total[:, i] for i in range(len(slots))})

    parts = rows.groupBy("_a", "_b").applyInPandas(pair, schema)
    total = parts.groupBy(*key).agg(*[F.sum(f"_s{i}").alias(f"_s{i}") for i in range(len(slots))])
    scored = df.select(*key, *label_cols).join(total, key)
    out = []
    for c in label_cols:
        mine = [(i, lv) for i, (cc, lv) in enumerate(slots) if cc == c]
        if len(mine) < 2:
            out.append(F.lit(None).cast("double").alias(f"sil_{c}"))
            continue
        own_n = F.lit(None).cast("long")
        within = F.lit(None).cast("double")
        for i, lv in mine:
            own_n = F.when(F.col(c) == lv, F.lit(sizes[c][lv])).otherwise(own_n)
            within = F.when(F.col(c) == lv, F.col(f"_s{i}")).otherwise(within)
        a_mean = within / (own_n - 1)
        b_mean = F.least(*[F.when(F.col(c) != lv, F.col(f"_s{i}") / F.lit(float(sizes[c][lv]))) for i, lv in mine], F.lit(float("inf")))
        most = F.greatest(a_mean, b_mean)
        out.append(F.when(own_n <= 1, 0.0).when(most == 0, 0.0).otherwise((b_mean - a_mean) / F.when(most != 0, most)).alias(f"sil_{c}"))
    return scored.select(*key, *out)


def silhouette_scores(samples: DataFrame, labelled: DataFrame, label_col: str, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(overall one-row table, per-cluster table) from per-row silhouettes."""
    s = samples.join(labelled.select(*key, label_col), key)
    overall = s.agg(F.avg(f"sil_{label_col}").alias("silhouette"))
    per = s.groupBy(label_col).agg(F.avg(f"sil_{label_col}").alias("silhouette"))
    return overall, per


def centroids(df: DataFrame, features: list[str], label: str) -> DataFrame:
    return df.groupBy(label).agg(*[F.avg(f).alias(f"c_{f}") for f in features], F.count(F.lit(1)).alias("n"))


def davies_bouldin(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """mean over clusters of max_j (s_i + s_j) / d(c_i, c_j); needs 2 ≤ k ≤ n−1 else NaN (Q4)."""
    cen = centroids(df, features, label)
    j = df.join(F.broadcast(cen), label)  # k rows
    dist = F.sqrt(sum((F.col(f) - F.col(f"c_{f}")) ** 2 for f in features))
    s = j.groupBy(label).agg(F.avg(dist).alias("s"))
    cs = cen.join(s, label)
    a = cs.select(*[F.col(c).alias(f"a_{c}") for c in cs.columns])
    b = cs.select(*[F.col(c).alias(f"b_{c}") for c in cs.columns])
    pairs = a.crossJoin(b).where(F.col(f"a_{label}") != F.col(f"b_{label}"))  # k×k, k ≤ a few dozen
    dij = F.sqrt(sum((F.col(f"a_c_{f}") - F.col(f"b_c_{f}")) ** 2 for f in features))
    ratio = F.when(dij == 0, F.lit(float("inf"))).otherwise((F.col("a_s") + F.col("b_s")) / dij)
    per = pairs.groupBy(f"a_{label}").agg(F.max(ratio).alias("r"))
    k = cen.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"))
    score = per.agg(F.avg("r").alias("db"))
    return attach_row(k, score).select(
        F.when((F.col("k") >= 2) & (F.col("k") <= F.col("n") - 1), F.coalesce(F.col("db"), F.lit(0.0)))
        .otherwise(F.lit(float("nan"))).alias("davies_bouldin"))


def calinski_harabasz(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """(B/(k−1)) / (W/(n−k)); W = 0 → 1.0; needs 2 ≤ k ≤ n−1 else NaN (Q5)."""
    cen = centroids(df, features, label)
    overall = df.agg(*[F.avg(f).alias(f"m_{f}") for f in features])
    w = df.join(F.broadcast(cen), label).agg(
        F.sum(sum((F.col(f) - F.col(f"c_{f}")) ** 2 for f in features)).alias("W"))
    b = attach_row(cen, overall).agg(
        F.sum(F.col("n") * sum((F.col(f"c_{f}") - F.col(f"m_{f}")) ** 2 for f in features)).alias("B"),
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"))
    j = attach_row(b, w)
    ch = F.when(F.col("W") == 0, F.lit(1.0)).otherwise(
        (F.col("B") / (F.col("k") - 1)) / (F.col("W") / (F.col("n") - F.col("k"))))
    return j.select(F.when((F.col("k") >= 2) & (F.col("k") <= F.col("n") - 1), ch)
                    .otherwise(F.lit(float("nan"))).alias("calinski_harabasz"))


def cv_intra(df: DataFrame, label: str = "congestion_level", speed: str = "avg_speed_mph") -> DataFrame:
    """Coefficient of variation of speed per level, population std; mean ≤ 0 → NaN (Q6)."""
    g = df.groupBy(label).agg(F.avg(speed).alias("_m"), F.stddev_pop(speed).alias("_s"))
    return g.select(label, F.when(F.col("_m") > 0, F.col("_s") / F.col("_m"))
                    .otherwise(F.lit(float("nan"))).alias("cv"))


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand Index of two labelings of the same rows.

    Contingency counts by (a, b) — a partial aggregate — then pair sums.
    Identical partitions (including the all-one-cluster case) → 1.0.
    """
    def c2(x):
        return x * (x - 1) / 2.0
    cont = df.groupBy(a, b).agg(F.count(F.lit(1)).cast("double").alias("nij"))
    sa = cont.groupBy(a).agg(F.sum("nij").alias("ai")).agg(F.sum(c2(F.col("ai"))).alias("sum_a"))
    sb = cont.groupBy(b).agg(F.sum("nij").alias("bj")).agg(F.sum(c2(F.col("bj"))).alias("sum_b"))
    sij = cont.agg(F.sum(c2(F.col("nij"))).alias("sum_ij"), F.sum("nij").alias("n"))
    j = attach_row(attach_row(sij, sa), sb)
    expected = F.col("sum_a") * F.col("sum_b") / c2(F.col("n"))
    max_idx = (F.col("sum_a") + F.col("sum_b")) / 2.0
    denom = max_idx - expected
    return j.select(F.when(denom == 0, F.lit(1.0))
                    .otherwise((F.col("sum_ij") - expected) / denom).alias("ari"))


def adjusted_rand_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """ARI for every pair of labelings in ``cols`` in one job: (a, b, ari).

    The pairs are stacked into (pair, la, lb) rows, so one grouped count
    builds every contingency table at once.
    """
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    if not pairs:
        return df.sparkSession.createDataFrame([], "a string, b string, ari double")
    stack = ", ".join(f"'{a}', '{b}', cast(`{a}` as bigint), cast(`{b}` as bigint)" for a, b in pairs)
    long = df.selectExpr(f"stack({len(pairs)}, {stack}) as (a, b, la, lb)")

    def c2(x):
        return x * (x - 1) / 2.0
    cont = long.groupBy("a", "b", "la", "lb").agg(F.count(F.lit(1)).cast("double").alias("nij"))
    sa = cont.groupBy("a", "b", "la").agg(F.sum("nij").alias("ai")).groupBy("a", "b").agg(F.sum(c2(F.col("ai"))).alias("sum_a"))
    sb = cont.groupBy("a", "b", "lb").agg(F.sum("nij").alias("bj")).groupBy("a", "b").agg(F.sum(c2(F.col("bj"))).alias("sum_b"))
    sij = cont.groupBy("a", "b").agg(F.sum(c2(F.col("nij"))).alias("sum_ij"), F.sum("nij").alias("n"))
    j = sij.join(sa, ["a", "b"]).join(sb, ["a", "b"])
    expected = F.col("sum_a") * F.col("sum_b") / c2(F.col("n"))
    denom = (F.col("sum_a") + F.col("sum_b")) / 2.0 - expected
    return j.select("a", "b", F.when(denom == 0, F.lit(1.0)).otherwise((F.col("sum_ij") - expected) / denom).alias("ari"))


def cluster_sizes(df: DataFrame, label: str = "congestion_level") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("size"))


def cluster_quality(scaled: DataFrame, labelled: DataFrame, features: list[str], key: list[str],
                    label: str = "congestion_level", silhouette: DataFrame | None = None,
                    per_cluster_sil: DataFrame | None = None) -> DataFrame:
    """Long metrics table (metric, level, value) + the KPI gate row (Q9).

    Gate: silhouette > 0.5 and every level's CV < 0.20; NaN fails.
    """
    rows = []
    if silhouette is not None:
        rows.append(silhouette.select(F.lit("silhouette").alias("metric"), F.lit(None).cast("long").alias("level"),
                                      F.col("silhouette").alias("value")))
    if per_cluster_sil is not None:
        rows.append(per_cluster_sil.select(F.lit("silhouette_cluster").alias("metric"),
                                           F.col(label).cast("long").alias("level"), F.col("silhouette").alias("value")))
    rows.append(davies_bouldin(scaled, features, label).select(
        F.lit("davies_bouldin").alias("metric"), F.lit(None).cast("long").alias("level"), F.col("davies_bouldin").alias("value")))
    rows.append(calinski_harabasz(scaled, features, label).select(
        F.lit("calinski_harabasz").alias("metric"), F.lit(None).cast("long").alias("level"),
        F.col("calinski_harabasz").alias("value")))
    cv = cv_intra(labelled, label)
    rows.append(cv.select(F.lit("cv_intra").alias("metric"), F.col(label).cast("long").alias("level"), F.col("cv").alias("value")))
    rows.append(cluster_sizes(labelled, label).select(
        F.lit("cluster_size").alias("metric"), F.col(label).cast("long").alias("level"), F.col("size").cast("double").alias("value")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    if silhouette is None:
        silhouette = labelled.sparkSession.range(1).select(F.lit(None).cast("double").alias("silhouette"))
    gate = kpi_gate(silhouette, cv).select(F.lit("kpi_pass").alias("metric"), F.lit(None).cast("long").alias("level"),
                                           F.col("kpi_pass").cast("double").alias("value"))
    return out.unionByName(gate)


def kpi_gate(silhouette: DataFrame, cv: DataFrame) -> DataFrame:
    """One row: sil_ok (overall silhouette > 0.5), cv_ok (every level's CV < 0.20), kpi_pass (both); null and NaN fail (Q9)."""
    sil = silhouette.select(F.coalesce(~F.isnan("silhouette") & (F.col("silhouette") > C.TARGET_SILHOUETTE), F.lit(False)).alias("sil_ok"))
    levels = cv.agg(F.coalesce(F.min(F.coalesce(~F.isnan("cv") & (F.col("cv") < C.TARGET_CVINTRA), F.lit(False))), F.lit(False)).alias("cv_ok"))
    return attach_row(sil, levels).withColumn("kpi_pass", F.col("sil_ok") & F.col("cv_ok"))


def level_window_rank(df: DataFrame, label: str, value: str, key: list[str]) -> DataFrame:
    """Rank of each row's silhouette within its level, largest first (for the sorted silhouette bands, Q3)."""
    ranked = row_numbers(df.withColumn("_down", -F.col(value)), [label], ["_down", *key], "band_rank")
    return ranked.drop("_down")


def scorecard(db: DataFrame, ch: DataFrame, ari_min: DataFrame, ari_mean: DataFrame,
              silhouette: DataFrame | None = None) -> DataFrame:
    """Metric, target, observed (as printed) and pass flag.

    Inputs are one-row tables; numbers are rounded half-up before printing
    so the text is the same in every engine.
    """
    r3 = lambda c: F.format_string("%.3f", F.floor(F.col(c) * 1000.0 + 0.5) / 1000.0)
    rows = []
    if silhouette is not None:
        rows.append(silhouette.select(F.lit(1).alias("ord"), F.lit("Silhouette").alias("metric"),
                                      F.lit("> 0.50").alias("target"), r3("silhouette").alias("observed"),
                                      (F.col("silhouette") > C.TARGET_SILHOUETTE).alias("pass")))
    rows.append(db.select(F.lit(2).alias("ord"), F.lit("Davies–Bouldin").alias("metric"), F.lit("< 1.00").alias("target"),
                          r3("davies_bouldin").alias("observed"),
                          (F.col("davies_bouldin") < C.TARGET_DAVIES_BOULDIN).alias("pass")))
    rows.append(ch.select(F.lit(3).alias("ord"), F.lit("Calinski–Harabasz").alias("metric"),
                          F.lit("higher better").alias("target"),
                          F.format_number(F.floor(F.col("calinski_harabasz") + 0.5), 0).alias("observed"),
                          F.lit(None).cast("boolean").alias("pass")))
    rows.append(ari_min.select(F.lit(4).alias("ord"), F.lit("ARI seed stability (min)").alias("metric"),
                               F.lit("≥ 0.80").alias("target"), r3("ari").alias("observed"),
                               (F.col("ari") >= C.TARGET_ARI_MIN).alias("pass")))
    rows.append(ari_mean.select(F.lit(5).alias("ord"), F.lit("ARI seed stability (mean)").alias("metric"),
                                F.lit("≥ 0.90").alias("target"), r3("ari").alias("observed"),
                                (F.col("ari") >= C.TARGET_ARI_MEAN).alias("pass")))
    rows.append(ari_min.select(F.lit(6).alias("ord"), F.lit("Stability gate").alias("metric"), F.lit("PASS").alias("target"),
                               F.when(F.col("ari") >= C.STABILITY_ARI_MIN, "PASS").otherwise("FAIL").alias("observed"),
                               (F.col("ari") >= C.STABILITY_ARI_MIN).alias("pass")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
