"""Feature matrix and scalers.

The matrix stays a DataFrame keyed by the cell key: the five feature
columns as doubles (booleans as 0/1) plus, on request, a ``features``
vector for Spark ML.  Alignment between rows and labels is by key, never
by position.  Scalers are a one-row statistics table joined back as a
broadcast (one row, size is fixed by the feature count).
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepace import config as C
from zonepace.operators.quantile import exact_quantiles
from zonepace.functions.frames import attach_row


class UnknownScalerError(ValueError):
    pass


def prepare_features(df: DataFrame, features: list[str] | None = None, key: list[str] | None = None,
                     with_vector: bool = False) -> DataFrame:
    """Key columns + features as doubles; rows with a null feature dropped (M1).

    Missing feature column → ``KeyError``; other columns of ``df`` are kept.
    """
    feats = features or C.CLUSTER_FEATURES
    missing = [c for c in feats if c not in df.columns]
    if missing:
        raise KeyError(f"Missing clustering features: {missing}. Available: {df.columns}")
    out = df.dropna(subset=feats).withColumns({c: F.col(c).cast("int").cast("double")
                                               if dict(df.dtypes)[c] == "boolean" else F.col(c).cast("double")
                                               for c in feats})
    if with_vector:
        out = VectorAssembler(inputCols=feats, outputCol="features").transform(out)
    return out


def make_scaler(kind: str | None = C.SCALER_TYPE) -> str:
    """Validate a scaler name; None → "standard" (M2)."""
    k = (kind or "standard").lower()
    if k not in ("standard", "robust"):
        raise UnknownScalerError(f"Unknown SCALER_TYPE: {kind!r} (expected 'standard' or 'robust')")
    return k


def scaler_stats(df: DataFrame, features: list[str], kind: str = "standard") -> DataFrame:
    """One row: ``{f}_center`` and ``{f}_scale`` per feature.

    standard: mean and population std (zero → 1); robust: median and
    Q3 − Q1 (zero → 1), exact linear-interpolated quantiles.
    """
    kind = make_scaler(kind)
    if kind == "standard":
        row = df.agg(*[F.avg(f).alias(f"{f}_center") for f in features],
                     *[F.stddev_pop(f).alias(f"{f}_sd") for f in features])
        return row.select(*[F.col(f"{f}_center") for f in features],
                          *[F.when(F.col(f"{f}_sd") == 0, F.lit(1.0)).otherwise(F.col(f"{f}_sd")).alias(f"{f}_scale")
                            for f in features])
    stack = ", ".join(f"'{f}', cast(`{f}` as double)" for f in features)
    long = df.selectExpr(f"stack({len(features)}, {stack}) as (feature, value)")
    q = exact_quantiles(long, ["feature"], "value", [0.25, 0.5, 0.75], ["q1", "med", "q3"])
    iqr = F.col("q3") - F.col("q1")
    wide = q.agg(*[F.max(F.when(F.col("feature") == f, F.col("med"))).alias(f"{f}_center") for f in features],
                 *[F.max(F.when(F.col("feature") == f, F.when(iqr == 0, F.lit(1.0)).otherwise(iqr))).alias(f"{f}_scale")
                   for f in features])
    return wide


def scale_features(df: DataFrame, features: list[str] | None = None, kind: str = C.SCALER_TYPE,
                   stats: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(scaled table, stats row): (x − center) / scale for each feature (M3, M4)."""
    feats = features or C.CLUSTER_FEATURES
    stats = stats if stats is not None else scaler_stats(df, feats, kind)
    j = attach_row(df, stats)
    scaled = j.withColumns({f: (F.col(f) - F.col(f"{f}_center")) / F.col(f"{f}_scale") for f in feats})
    return scaled.drop(*[f"{f}_center" for f in feats], *[f"{f}_scale" for f in feats]), stats
