"""Shared fixtures: one local session and the two seeded frames the original tests use."""

from __future__ import annotations

import os
import sys
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from zonepace.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", shuffle_partitions=4)
    yield s
    s.stop()


def make_trips(n: int = 200, seed: int = 42) -> pd.DataFrame:
    """Trips that pass every cleaning rule: 3-minute pickups from 2023-01-02, same PU/DO zone."""
    rng = np.random.default_rng(seed)
    start = datetime(2023, 1, 2)
    pickups = [start + timedelta(minutes=3 * i) for i in range(n)]
    dist = rng.uniform(0.5, 10.0, n).round(3)
    dur = np.clip(np.round(dist / rng.uniform(5, 40, n) * 3600), 120, 1799).astype(int)  # 1–300 mph band avoided
    zones = rng.integers(1, 264, n)
    return pd.DataFrame({
        "pickup_datetime": pickups,
        "dropoff_datetime": [p + timedelta(seconds=int(d)) for p, d in zip(pickups, dur)],
        "trip_distance": dist,
        "trip_duration": dur.astype(float),
        "PULocationID": zones.astype("int32"),
        "DOLocationID": zones.astype("int32"),
    })


def make_cells(seed: int = 7) -> pd.DataFrame:
    """300 cells in three separable groups (fast, medium, slow)."""
    rng = np.random.default_rng(seed)
    parts = []
    for speed, sd, dens, dev, wknd in [((28, 2.5), 0, (5, 25), (4, 1), False),
                                      ((15, 2.0), 0, (40, 100), (0, 1), False),
                                      ((6, 1.5), 0, (120, 220), (-5, 1), True)]:
        n = 100
        hours = rng.integers(0, 24, n)
        parts.append(pd.DataFrame({
            "zone_id": rng.integers(1, 264, n), "hour_of_day": hours, "day_of_week": rng.integers(0, 7, n),
            "is_weekend": wknd, "avg_speed_mph": rng.normal(*speed, n),
            "trip_density": rng.integers(*dens, n), "speed_deviation": rng.normal(*dev, n),
        }))
    df = pd.concat(parts, ignore_index=True)
    df["hour_sin"] = np.sin(2 * np.pi * df["hour_of_day"] / 24)
    df["hour_cos"] = np.cos(2 * np.pi * df["hour_of_day"] / 24)
    df["log_trip_density"] = np.log1p(df["trip_density"])
    # unique key for alignment
    df["zone_id"] = np.arange(len(df)) + 1
    return df


@pytest.fixture()
def trips_pdf():
    return make_trips()


@pytest.fixture()
def trips_df(spark, trips_pdf):
    return spark.createDataFrame(trips_pdf)


@pytest.fixture()
def cells_pdf():
    return make_cells()


@pytest.fixture()
def cells_df(spark, cells_pdf):
    return spark.createDataFrame(cells_pdf)
