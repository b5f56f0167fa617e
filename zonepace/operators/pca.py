"""PCA projection of the scaled features.

Spark ML's ``PCA`` computes the d×d covariance distributed and solves the
tiny eigenproblem on the driver; it does not centre, so the column means
(one-row aggregate, broadcast) are subtracted first.  Component signs are
fixed so that each component's largest-magnitude loading is positive.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepace import config as C
from zonepace.functions.frames import attach_row


def covariance(df: DataFrame, features: list[str]) -> DataFrame:
    """Sample covariance of every ordered feature pair, long form (checkable core of M10)."""
    aggs = [F.covar_samp(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}")
            for a in features for b in features]
    stack = ", ".join(f"'{a}', '{b}', `{a}|{b}`" for a in features for b in features)
    return df.agg(*aggs).selectExpr(f"stack({len(features) ** 2}, {stack}) as (feature_a, feature_b, cov)")


def pca_projection(df: DataFrame, features: list[str] | None = None, k: int = 2,
                   keep: list[str] | None = None) -> tuple[DataFrame, list[float], np.ndarray]:
    """(rows with pc1..pck, explained variance ratios, loadings d×k)."""
    feats = features or C.CLUSTER_FEATURES
    means = df.agg(*[F.avg(f).alias(f"_m_{f}") for f in feats])
    centred = attach_row(df, means).withColumns(
        {f"_c_{f}": F.col(f).cast("double") - F.col(f"_m_{f}") for f in feats})
    vec = VectorAssembler(inputCols=[f"_c_{f}" for f in feats], outputCol="_v").transform(centred)
    model = PCA(k=k, inputCol="_v", outputCol="_pc").fit(vec)
    loadings = model.pc.toArray()  # d × k, tiny
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), range(k)])
    signs[signs == 0] = 1.0
    out = model.transform(vec).withColumn("_pca", vector_to_array("_pc"))
    cols = [(F.col("_pca")[i] * float(signs[i])).alias(f"pc{i + 1}") for i in range(k)]
    keep = keep if keep is not None else [c for c in df.columns if c not in feats]
    return out.select(*keep, *cols), [float(x) for x in model.explainedVariance.toArray()], loadings * signs
