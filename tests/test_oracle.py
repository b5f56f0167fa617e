"""SQL logic tests: Spark queries against their DuckDB oracles on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, digest

KEYS = [
    "clean_audit", "clean_trips", "remove_duplicates", "remove_trivial_same_zone", "iqr_fence", "clean_trips_iqr",
    "cells_full", "speed_deviation", "viz_mart", "severity_dim", "zone_hour_heatmap", "describe_trips",
    "hist_speed", "feature_distributions", "kpi_row", "auto_story", "map_points", "scale_robust",
    "davies_bouldin", "calinski_harabasz", "ari", "cluster_quality", "scorecard", "eps_neighbors",
    "elbow_second_diff", "zone_centroids", "load_centroids", "data_freshness",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[key])
    orows = cur.fetchall()
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)
