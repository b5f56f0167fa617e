"""Per-trip features, cells and the deviation."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from zonepace.operators import features as FE


def test_time_features(spark, trips_df):
    out = FE.add_time_features(trips_df).select("pickup_datetime", "hour_of_day", "day_of_week", "is_weekend").toPandas()
    ts = pd.to_datetime(out["pickup_datetime"])
    assert (out["hour_of_day"] == ts.dt.hour).all()
    assert (out["day_of_week"] == ts.dt.dayofweek).all()  # 0 = Monday
    assert (out["is_weekend"] == (ts.dt.dayofweek >= 5)).all()


def test_speed_zero_duration_is_null(spark, trips_pdf):
    p = trips_pdf.copy()
    p.loc[0, "trip_duration"] = 0.0
    out = FE.engineer_features(spark.createDataFrame(p))
    assert out.count() == 199
    assert out.where(F.col("speed_mph") <= 0).count() == 0


def test_cells_columns_and_ranges(spark, trips_df):
    c = FE.build_cells(trips_df).toPandas()
    for col in ["avg_speed_mph", "trip_density", "avg_trip_duration", "speed_deviation", "hour_sin", "hour_cos",
                "log_trip_density", "is_airport", "is_cbd", "is_rush_hour"]:
        assert col in c.columns
    assert c["trip_density"].sum() == 200
    assert c["hour_sin"].between(-1, 1).all() and c["hour_cos"].between(-1, 1).all()
    assert np.allclose(c["log_trip_density"], np.log1p(c["trip_density"]))


def _f4(spark):
    rows = []
    for z in (1, 2):
        for h in (8, 9):
            for d, s in ((0, 10.0 + z + h), (6, 20.0 + z)):
                rows.append((z, h, d, d >= 5, s, 5, 600.0))
    return spark.createDataFrame(rows, "zone_id int, hour_of_day int, day_of_week int, is_weekend boolean, "
                                       "avg_speed_mph double, trip_density long, avg_trip_duration double")


def test_deviation_averages_zero_per_zone_hour(spark):
    out = FE.compute_speed_deviation(_f4(spark)).groupBy("zone_id", "hour_of_day").agg(F.avg("speed_deviation").alias("m"))
    assert all(abs(r["m"]) < 1e-9 for r in out.collect())


def test_deviation_sign(spark):
    rows = [(1, 8, 0, False, 10.0, 5, 1.0), (1, 8, 1, False, 30.0, 5, 1.0)]
    df = spark.createDataFrame(rows, "zone_id int, hour_of_day int, day_of_week int, is_weekend boolean, "
                                     "avg_speed_mph double, trip_density long, avg_trip_duration double")
    out = {r["day_of_week"]: r["speed_deviation"] for r in FE.compute_speed_deviation(df).collect()}
    assert out[0] == -10.0 and out[1] == 10.0


def test_duration_and_stamps_ignore_session_zone(spark):
    """A naive 01:50 → 02:10 trip on a spring-forward day lasts 20 minutes in any session zone."""
    from zonepace.functions import scalar as S
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        r = spark.sql("select timestamp_ntz'1995-04-02 01:50:00' as p, timestamp_ntz'1995-04-02 02:10:00' as d").select(
            S.duration_seconds("p", "d").alias("s"), S.year_month("d").alias("ym"), S.timestamp_text("d").alias("t"),
            S.hour_of_day("d").alias("h")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["s"] == 1200.0 and r["ym"] == "1995-04" and r["t"] == "1995-04-02 02:10:00" and r["h"] == 2
