"""The batch job: load → clean → cells → cluster → marts.

One SparkSession, five stages, each handing a written Parquet table to the
next (so a stage can be skipped and re-run alone, and lost executors never
force a recompute of earlier stages).  Row counts come from
``DataFrame.observe`` on the write itself — no extra pass.
"""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from zonepace import config as C
from zonepace.config import CleanConfig, ClusterConfig
from zonepace.operators import clean as CL
from zonepace.operators import dbscan as DS
from zonepace.operators import features as FE
from zonepace.operators import kmeans as KM
from zonepace.operators import marts as MA
from zonepace.operators import quality as QU
from zonepace.operators import scaling as SC
from zonepace.sources import io as IO
from zonepace.sources import trips as TR

log = logging.getLogger("zonepace")


@dataclass
class StageFlags:
    skip_load: bool = False
    skip_clean: bool = False
    skip_features: bool = False
    skip_cluster: bool = False
    only_viz: bool = False
    skip_viz: bool = False


@dataclass
class RunReport:
    seconds: dict[str, float] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    metrics: dict = field(default_factory=dict)


def _timed_write(report: RunReport, name: str, df: DataFrame, path: str, partition_by=None) -> None:
    """Write with a row count observed on the same pass."""
    obs = Observation(name)
    t0 = time.perf_counter()
    IO.write_parquet(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, partition_by)
    report.seconds[name] = round(time.perf_counter() - t0, 3)
    report.rows[name] = int(obs.get["rows"])
    log.info("%s: %d rows in %.1fs", name, report.rows[name], report.seconds[name])


def run_pipeline(spark: SparkSession, raw_dir: str, work_dir: str, flags: StageFlags = StageFlags(),
                 clean_cfg: CleanConfig = CleanConfig(), cluster_cfg: ClusterConfig = ClusterConfig()) -> RunReport:
    """Run the stages not skipped; returns timings, row counts and the metrics document (L1)."""
    rep = RunReport()
    w = work_dir.rstrip("/")
    p = {k: f"{w}/{k}" for k in ("raw_trips", "clean_trips", "trip_features", "cells", "model", "viz")}
    if flags.only_viz:
        flags = StageFlags(True, True, True, True, False)

    if not flags.skip_load:
        raw = TR.scan_raw_trips(spark, raw_dir)
        _timed_write(rep, "load", raw, p["raw_trips"], ["file_ym"])
    if not flags.skip_clean:
        raw = IO.read_parquet_safe(spark, p["raw_trips"], "load")
        cleaned = CL.clean_trips(raw, clean_cfg).drop(
            "_src_file", "_src_path", "_row_index", "_has_fare", "_has_passengers")
        _timed_write(rep, "clean", cleaned, p["clean_trips"], ["file_ym"])
    if not flags.skip_features:
        cleaned = IO.read_parquet_safe(spark, p["clean_trips"], "clean")
        # Per-trip features, a folder a month; the cells are folded from the written table.
        IO.save_monthly(FE.engineer_features(cleaned), p["trip_features"])
        _timed_write(rep, "features", FE.cells_of(IO.read_parquet_safe(spark, p["trip_features"], "features")), p["cells"])
    if not flags.skip_cluster:
        cells = IO.read_parquet_safe(spark, p["cells"], "features")
        rep.metrics = run_clustering(spark, cells, p["model"], cluster_cfg, rep)
    if not flags.skip_viz:
        labels = IO.read_parquet_safe(spark, f"{p['model']}/cluster_labels", "clustering")
        _timed_write(rep, "viz", MA.build_viz_data(labels), p["viz"])
    return rep


def run_clustering(spark: SparkSession, cells: DataFrame, out_dir: str, cfg: ClusterConfig = ClusterConfig(),
                   rep: RunReport | None = None) -> dict:
    """Scale → choose k (unless given) → fit → levels → quality → optional DBSCAN → artifacts (L2)."""
    rep = rep or RunReport()
    key = C.CELL_KEY[:3]
    feats = cfg.features
    t0 = time.perf_counter()
    table = SC.prepare_features(cells, feats)
    scaled, stats = SC.scale_features(table, feats, cfg.scaler)
    scaled = scaled.checkpoint(eager=True)
    info = {}
    k = cfg.k
    if k is None:
        k, _sweep, info = KM.choose_k(scaled, key, feats, cfg.k_range, cfg.n_init, cfg.seed, cfg.k_rule)
    data = KM.stable_input(scaled, key, feats)
    # The sweep has fitted the chosen k with the same seeds already.
    fit = info["fits"][k] if info and k in info["fits"] else KM.train_kmeans(data, k, cfg.seed, cfg.n_init, cfg.max_iter)
    labelled = MA.assign_semantic_labels(KM.predict(fit, data)).drop("features", "_rid").checkpoint(eager=True)
    sample = QU.silhouette_sample(labelled, key).checkpoint(eager=True)
    per_row = QU.silhouette_samples(sample, feats, ["congestion_level"], key)
    overall, per = QU.silhouette_scores(per_row, sample, "congestion_level", key)
    # Quality in original units for CV / centroid means; scaled for the distance scores.
    orig = cells.join(labelled.select(*key, "congestion_level"), key)
    quality = QU.cluster_quality(labelled, orig, feats, key, silhouette=overall, per_cluster_sil=per)
    metrics = {"k": int(k), "features": list(feats), "inertia": fit.inertia, "n_iter": fit.n_iter,
               "quality": [r.asDict() for r in quality.collect()],  # ≤ 4k + 6 rows
               "centroid_means": [r.asDict() for r in MA.centroid_means(orig, feats).collect()]}
    metrics["stability"] = KM.stability(scaled, key, k, feats, n_init=cfg.n_init)
    if info:
        metrics["k_selection"] = {x: info[x] for x in ("ks", "inertias", "silhouettes", "elbow_k",
                                                       "elbow_source", "silhouette_argmax_k", "chosen")}
    labels_out = orig
    if cfg.use_dbscan:
        db = DS.dbscan(labelled, key, feats)
        metrics["dbscan"] = DS.dbscan_metrics(db).first().asDict()
        labels_out = labels_out.join(db, key, "left")
    IO.save_model_artifacts(fit, stats, labels_out, labelled, metrics, out_dir)
    rep.seconds["cluster"] = round(time.perf_counter() - t0, 3)
    return metrics
