"""Sinks and secondary sources.

Tables are Parquet written by Spark; the month split is a ``file_ym``
partition column, so readers prune months by directory.  The metrics
document is a small JSON object written through Spark's text writer.
The centroid dimension is a CSV read with an explicit schema.
"""

from __future__ import annotations

import json
import math
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from zonepace.operators.kmeans import KMeansFit
from zonepace.sources.trips import resolve_column

# FIXED VALUES: header aliases of the zone-centroid CSV.
CENTROID_ALIASES = {
    "zone_id": ["zone_id", "LocationID"],
    "latitude": ["latitude", "lat", "Latitude"],
    "longitude": ["longitude", "lon", "Longitude"],
}


class StageOutputMissing(FileNotFoundError):
    pass


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite ``path`` with ``df`` (S10); parents are created by the writer."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_monthly(df: DataFrame, path: str, rows_per_file: int = 5_000_000, replace_months_only: bool = False) -> None:
    """One directory per month, ``file_ym=YYYY-MM/``, in files of about ``rows_per_file`` rows.

    Months are counted first (one small row each); rows then meet by (month, salt), with as many salts as the month
    needs files, so no month is one task's and no task writes a sliver of every month.  With
    ``replace_months_only`` the months in ``df`` replace their own folders and the others stay.
    """
    files = df.groupBy("file_ym").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(rows_per_file))).cast("int").alias("_files"))
    total = int(files.agg(F.coalesce(F.sum("_files"), F.lit(1))).first()[0])
    spread = df.join(F.broadcast(files), df["file_ym"].eqNullSafe(files["file_ym"])).drop(files["file_ym"])
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.col("_files"))
    dealt = spread.withColumn("_salt", salt).repartition(total, "file_ym", "_salt").drop("_files", "_salt")
    w = dealt.write.mode("overwrite").partitionBy("file_ym")
    w.option("partitionOverwriteMode", "dynamic" if replace_months_only else "static").parquet(path)


def read_parquet_safe(spark: SparkSession, path: str, label: str | None = None) -> DataFrame:
    """Read Parquet; a missing path names the stage that should have produced it."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            raise StageOutputMissing(
                f"Required parquet file not found: {path}" + (f" (expected from stage: {label})" if label else "")
            ) from e
        raise


def read_months(spark: SparkSession, path: str, months: list[str] | None = None,
                columns: list[str] | None = None) -> DataFrame:
    """Partitioned month read; a month list becomes partition pruning."""
    df = spark.read.parquet(path)
    if months:
        df = df.where(F.col("file_ym").isin(months))
    if columns:
        df = df.select(*columns)
    return df


def _clean_json(obj: Any) -> Any:
    if isinstance(obj, float) and (math.isnan(obj) or math.isinf(obj)):
        return str(obj)
    if isinstance(obj, dict):
        return {str(k): _clean_json(v) for k, v in obj.items()}
    if isinstance(obj, (list, tuple)):
        return [_clean_json(v) for v in obj]
    return obj


def write_json(spark: SparkSession, obj: dict, path: str) -> None:
    """Write a small JSON document (one text line) to ``path``."""
    doc = json.dumps(_clean_json(obj), default=str)
    spark.createDataFrame([(doc,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> dict:
    row = spark.read.text(path).first()
    return json.loads(row["value"]) if row else {}


def load_centroids(spark: SparkSession, path: str) -> DataFrame:
    """Zone centroid CSV with header aliases → (zone_id int, latitude, longitude double)."""
    raw = spark.read.option("header", True).csv(path)
    out = []
    for canonical, aliases in CENTROID_ALIASES.items():
        found = resolve_column(raw.columns, aliases)
        if found is None:
            raise KeyError(f"Centroid file lacks '{canonical}' (tried {aliases}); columns: {raw.columns}")
        t = "int" if canonical == "zone_id" else "double"
        out.append(F.col(f"`{found}`").try_cast(t).alias(canonical))
    return raw.select(*out)


def save_model_artifacts(fit: KMeansFit | None, scaler_stats: DataFrame, labels: DataFrame,
                         scaled: DataFrame, metrics: dict, out_dir: str) -> dict[str, str]:
    """Model, scaler statistics, labels, scaled features and metrics."""
    spark = labels.sparkSession
    base = out_dir.rstrip("/")
    paths = {
        "model": f"{base}/model", "scaler": f"{base}/scaler_stats", "labels": f"{base}/cluster_labels",
        "scaled": f"{base}/scaled_features", "metrics": f"{base}/metrics",
    }
    if fit is not None:
        rows = [(i, c, fit.k, fit.seed, fit.inertia, fit.n_iter) for i, c in enumerate(fit.centres)]
        write_parquet(spark.createDataFrame(rows, "centre int, x array<double>, k int, seed long, inertia double, n_iter int"), paths["model"])
    write_parquet(scaler_stats, paths["scaler"])
    write_parquet(labels, paths["labels"])
    write_parquet(scaled, paths["scaled"])
    write_json(spark, metrics, paths["metrics"])
    return paths


def load_model_artifacts(spark: SparkSession, out_dir: str) -> dict[str, Any]:
    """The written artifacts; ``model`` and ``scaled`` are None where the job wrote none (DBSCAN-only runs)."""
    base = out_dir.rstrip("/")
    out: dict[str, Any] = {}
    model = read_parquet_optional(spark, f"{base}/model")
    if model is not None:
        rows = sorted(model.collect(), key=lambda r: r["centre"])  # k rows
        model = KMeansFit([list(r["x"]) for r in rows], rows[0]["k"], rows[0]["seed"], rows[0]["inertia"], rows[0]["n_iter"])
    out["model"] = model
    out["scaler"] = read_parquet_safe(spark, f"{base}/scaler_stats", "clustering")
    out["labels"] = read_parquet_safe(spark, f"{base}/cluster_labels", "clustering")
    out["scaled"] = read_parquet_optional(spark, f"{base}/scaled_features")
    out["metrics"] = read_json(spark, f"{base}/metrics")
    return out


def read_parquet_optional(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None when there is none; any other fault is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
