"""Entry contract, the batch job end to end, and the incremental ingest."""

from __future__ import annotations

import os
import tempfile

import pandas as pd

import __spark_entry__ as E
from tests.conftest import SF_SMALL, make_trips
from zonepace.config import ClusterConfig
from zonepace.plans.catalog import QUERIES
from zonepace.plans.pipeline import StageFlags, run_pipeline
from zonepace.sources import io as IO


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 15
    assert "speed_deviation" in df.columns


def test_every_query_has_oracle_or_is_listed():
    """The library's own queries; those of the optional subpackage are listed in its tests."""
    no_oracle = set(QUERIES) - set(E.oracle_sql())
    assert no_oracle <= {"k_sweep"}


def test_some_queries_on_smallest_tables(spark):
    qs = E.queries()
    for k in ("clean_audit", "viz_mart", "kpi_row", "eps_neighbors"):
        assert qs[k](spark, SF_SMALL).count() >= 0


def test_pipeline_end_to_end(spark):
    raw = tempfile.mkdtemp(prefix="zp-pipe-raw-")
    work = tempfile.mkdtemp(prefix="zp-pipe-work-")
    t = make_trips(2000, seed=1).drop(columns=["trip_duration"])
    t["fare_amount"] = 12.0
    t["passenger_count"] = 1
    t.to_parquet(os.path.join(raw, "yellow_tripdata_2023-01.parquet"), index=False, coerce_timestamps="us")
    rep = run_pipeline(spark, raw, work, StageFlags(), cluster_cfg=ClusterConfig(k=3, n_init=1, use_dbscan=True))
    assert rep.rows["load"] == 2000 and rep.rows["clean"] == 2000
    assert rep.rows["viz"] == rep.rows["features"]
    arts = IO.load_model_artifacts(spark, f"{work}/model")
    assert arts["model"] is not None and arts["metrics"]["k"] == 3
    assert set(r["congestion_level"] for r in arts["labels"].select("congestion_level").distinct().collect()) == {0, 1, 2}
    # re-run only the mart stage from the written tables
    rep2 = run_pipeline(spark, raw, work, StageFlags(only_viz=True))
    assert rep2.rows["viz"] == rep.rows["viz"]


def test_streaming_ingest_matches_batch(spark):
    from zonepace.streaming.ingest import ingest_new_files
    raw = tempfile.mkdtemp(prefix="zp-stream-raw-")
    out = tempfile.mkdtemp(prefix="zp-stream-out-")
    t = make_trips(300, seed=2).drop(columns=["trip_duration"])
    t = pd.concat([t, t.iloc[:5]], ignore_index=True)
    t.to_parquet(os.path.join(raw, "yellow_tripdata_2023-01.parquet"), index=False, coerce_timestamps="us")
    schema = spark.read.parquet(raw).schema
    q = ingest_new_files(spark, raw, schema, f"{out}/clean", checkpoint=f"{out}/ck")
    q.awaitTermination(120)
    assert spark.read.parquet(f"{out}/clean").count() == 300


def test_streaming_feeds_keep_their_own_progress(spark):
    from zonepace.streaming.ingest import ingest_new_files
    out = tempfile.mkdtemp(prefix="zp-stream3-out-")
    for feed, n in (("a", 40), ("b", 30)):
        raw = tempfile.mkdtemp(prefix=f"zp-stream3-{feed}-")
        make_trips(n, seed=n).drop(columns=["trip_duration"]).to_parquet(
            os.path.join(raw, "yellow_tripdata_2023-01.parquet"), index=False, coerce_timestamps="us")
        q = ingest_new_files(spark, raw, spark.read.parquet(raw).schema, f"{out}/{feed}")
        q.awaitTermination(120)
        assert spark.read.parquet(f"{out}/{feed}").count() == n


def test_streaming_ingest_one_file_per_batch(spark):
    """Two monthly files, one per micro-batch: per-file dedup and month rule stay exact."""
    from datetime import timedelta

    from zonepace.streaming.ingest import ingest_new_files
    raw = tempfile.mkdtemp(prefix="zp-stream2-raw-")
    out = tempfile.mkdtemp(prefix="zp-stream2-out-")
    jan = make_trips(100, seed=3).drop(columns=["trip_duration"])
    jan = pd.concat([jan, jan.iloc[:2]], ignore_index=True)           # 2 duplicates
    feb = make_trips(50, seed=4).drop(columns=["trip_duration"])
    feb["pickup_datetime"] = feb["pickup_datetime"] + timedelta(days=31)
    feb["dropoff_datetime"] = feb["dropoff_datetime"] + timedelta(days=31)
    feb.loc[0, ["pickup_datetime", "dropoff_datetime"]] = [jan.loc[0, "pickup_datetime"], jan.loc[0, "dropoff_datetime"]]  # wrong month
    jan.to_parquet(os.path.join(raw, "yellow_tripdata_2023-01.parquet"), index=False, coerce_timestamps="us")
    feb.to_parquet(os.path.join(raw, "yellow_tripdata_2023-02.parquet"), index=False, coerce_timestamps="us")
    schema = spark.read.parquet(raw).schema
    q = ingest_new_files(spark, raw, schema, f"{out}/clean", checkpoint=f"{out}/ck", max_files_per_trigger=1)
    q.awaitTermination(180)
    got = {r["file_ym"]: r["n"] for r in spark.read.parquet(f"{out}/clean").groupBy("file_ym").count()
           .withColumnRenamed("count", "n").collect()}
    assert got == {"2023-01": 100, "2023-02": 49}


def test_dashboard_empty_view(spark):
    from zonepace.operators import dashboard as DB
    from zonepace.plans import catalog as K
    m = K.mart(spark, SF_SMALL)
    view = DB.ViewParams(hour=99)
    story = DB.auto_story(m, view).collect()
    assert len(story) == 1 and story[0]["story"] == "No data matches this filter."
    kpi = DB.kpi_row(m, view).first()
    assert kpi["n_obs"] == 0 and kpi["avg_speed_filtered"] == 0.0 and kpi["pct_high"] == 0.0 and kpi["total_trips"] == 0
