"""Cleaning rules: corrupt n rows of a clean fixture, expect exactly n dropped."""

from __future__ import annotations

from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from zonepace.config import CleanConfig
from zonepace.operators import clean as CL


def _count_kept(spark, pdf, cfg=CleanConfig(use_quality_gate=True, check_month=False), **kw):
    return CL.clean_trips(_numbered(spark, pdf), cfg, **kw).count()


def _numbered(spark, pdf):
    return spark.createDataFrame(pdf.assign(_row_index=range(len(pdf))))


def test_full_chain_keeps_valid_rows(spark, trips_pdf):
    assert _count_kept(spark, trips_pdf) == 200


def test_invalid_timestamps(spark, trips_pdf):
    p = trips_pdf.copy()
    p.loc[:4, ["pickup_datetime", "dropoff_datetime"]] = p.loc[:4, ["dropoff_datetime", "pickup_datetime"]].values
    assert _count_kept(spark, p) == 195


def test_invalid_distance(spark, trips_pdf):
    p = trips_pdf.copy()
    p.loc[0, "trip_distance"] = 0.0
    p.loc[1, "trip_distance"] = 201.0
    assert _count_kept(spark, p) == 198


def test_invalid_duration(spark, trips_pdf):
    p = trips_pdf.copy()
    p.loc[0, "trip_duration"] = 0.0
    p.loc[1, "trip_duration"] = 14401.0
    assert _count_kept(spark, p) == 198


def test_speed_outliers(spark, trips_pdf):
    p = trips_pdf.copy()
    p.loc[0, ["trip_distance", "trip_duration"]] = [100.0, 300.0]   # 1200 mph
    p.loc[1, ["trip_distance", "trip_duration"]] = [0.01, 10000.0]  # 0.0036 mph
    assert _count_kept(spark, p) == 198


def test_invalid_zones(spark, trips_pdf):
    p = trips_pdf.copy()
    p.loc[0, "PULocationID"] = 0
    p.loc[1, "DOLocationID"] = 999
    assert _count_kept(spark, p) == 198


def test_nulls(spark, trips_pdf):
    p = trips_pdf.copy()
    p.loc[0, "trip_distance"] = np.nan
    p.loc[1, "trip_duration"] = np.nan
    assert _count_kept(spark, p) == 198


def test_duplicates_removed(spark, trips_pdf):
    p = pd.concat([trips_pdf, trips_pdf.iloc[:3]], ignore_index=True)
    assert _count_kept(spark, p) == 200


def test_duplicates_keep_first_in_file_order(spark, trips_pdf):
    p = pd.concat([trips_pdf.iloc[:1], trips_pdf.iloc[:1]], ignore_index=True)
    p["fare_amount"] = [5.0, 7.0]
    p["_src_file"] = "a.parquet"
    p["_row_index"] = [1, 0]
    df = spark.createDataFrame(p)
    out = CL.remove_duplicates(df).collect()
    assert len(out) == 1 and out[0]["fare_amount"] == 7.0
    assert "SortAggregate" not in CL.remove_duplicates(df)._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        CL.remove_duplicates(df.drop("_row_index"))


def test_duplicates_are_dealt_before_they_are_folded(spark, trips_pdf):
    """No hash table holds a whole split: both folds lie behind the one shuffle, which deals whole rows by the key."""
    import re
    p = trips_pdf.assign(file_ym="2023-01", fare_amount=5.0)
    plan = CL.remove_duplicates(_numbered(spark, p))._jdf.queryExecution().executedPlan().toString()
    steps = re.findall(r"Exchange hashpartitioning|SortAggregate|HashAggregate", plan)  # the last step first
    assert steps == ["HashAggregate", "HashAggregate", "Exchange hashpartitioning"]


def test_duplicates_of_odd_keys_meet(spark):
    """0.0 and -0.0, NaN and null are one key each; a row without an order never displaces one with it."""
    at = F.lit("2023-01-02 08:00:00").cast("timestamp_ntz")
    rows = [(1, 0.0, 3, 30.0), (1, -0.0, 2, 20.0), (2, float("nan"), 5, 50.0), (2, float("nan"), 4, 40.0),
            (None, None, 7, 70.0), (None, None, 6, 60.0), (3, 1.0, None, 80.0), (3, 1.0, 9, 90.0), (4, 1.0, None, 95.0)]
    df = spark.createDataFrame(rows, "PULocationID int, trip_distance double, _row_index long, fare_amount double").repartition(5)
    df = df.withColumns({"DOLocationID": F.col("PULocationID"), "pickup_datetime": at, "dropoff_datetime": at, "file_ym": F.lit("2023-01")})
    for out, extra in ((CL.remove_duplicates(df), []), (CL.remove_duplicates(df, with_copies=True), ["_copies"])):
        got = {r["PULocationID"]: (r["_row_index"], r["fare_amount"], *[r[c] for c in extra]) for r in out.collect()}
        copies = {1: 2, 2: 2, None: 2, 3: 2, 4: 1}
        want = {1: (2, 20.0), 2: (4, 40.0), None: (6, 60.0), 3: (9, 90.0), 4: (None, None)}
        assert got == {k: (*v, *([copies[k]] if extra else [])) for k, v in want.items()} and out.count() == 5


def test_duplicates_are_per_file(spark, trips_pdf):
    p = pd.concat([trips_pdf.iloc[:1], trips_pdf.iloc[:1]], ignore_index=True)
    p["file_ym"], p["_row_index"], p["_src_file"] = "2023-01", [0, 0], ["yellow.parquet", "green.parquet"]
    assert CL.remove_duplicates(spark.createDataFrame(p)).count() == 2


def test_audit_agrees_with_chain_on_differing_copies(spark, trips_pdf):
    first, second = trips_pdf.iloc[:2], trips_pdf.iloc[:2]
    p = pd.concat([first, second], ignore_index=True)
    p["fare_amount"], p["passenger_count"] = [10.0, -3.0, -10.0, 3.0], 1
    cfg = CleanConfig(check_month=False)
    rows = {r["step"]: r["rows"] for r in CL.clean_audit(_numbered(spark, p), cfg).collect()}
    assert rows["kept"] == CL.clean_trips(_numbered(spark, p), cfg).count() == 1 and rows["quality"] == 1 and rows["duplicates"] == 2


def test_wrong_month(spark, trips_pdf):
    p = trips_pdf.copy()
    p["file_ym"] = "2023-01"
    p.loc[:3, "pickup_datetime"] = p.loc[:3, "pickup_datetime"] + timedelta(days=40)
    p.loc[:3, "dropoff_datetime"] = p.loc[:3, "dropoff_datetime"] + timedelta(days=40)
    assert _count_kept(spark, p, CleanConfig(check_month=True)) == 196


def test_unparseable_month_is_noop(spark, trips_pdf):
    p = trips_pdf.copy()
    p["file_ym"] = "garbage"
    assert _count_kept(spark, p, CleanConfig(check_month=True)) == 200


def test_trivial_same_zone(spark, trips_pdf):
    p = trips_pdf.copy()
    p.loc[:4, "trip_distance"] = 0.03
    p.loc[:4, "trip_duration"] = 60.0       # 1.8 mph, passes the speed rule
    p.loc[5, "trip_distance"] = 2.5
    assert _count_kept(spark, p) == 195


def test_boundaries_are_inclusive(spark, trips_pdf):
    p = trips_pdf.iloc[:4].copy()
    p["DOLocationID"] = (p["PULocationID"] % 263) + 1
    p["trip_distance"] = [0.01, 200.0, 0.10, 1.0]
    p["trip_duration"] = [30.0, 14400.0, 360.0, 3600.0]      # speeds 1.2, 50, 1, 1
    assert _count_kept(spark, p) == 4


def test_iqr_fence_removes_single_outlier(spark, trips_pdf):
    base = trips_pdf.iloc[:1]
    p = pd.concat([base] * 301, ignore_index=True)
    p["pickup_datetime"] = [base["pickup_datetime"].iloc[0] + timedelta(minutes=i) for i in range(301)]
    p["dropoff_datetime"] = p["pickup_datetime"] + timedelta(seconds=600)
    p["trip_duration"] = 600.0
    p["PULocationID"] = 1
    p["DOLocationID"] = 2
    p["trip_distance"] = 600 / 3600 * 20.0
    p.loc[0, "trip_distance"] = 600 / 3600 * 90.0
    out = CL.remove_iqr_speed_outliers_by_zone(spark.createDataFrame(p), k=3.0, min_trips_per_zone=100, scope=[])
    assert out.count() == 300


def test_iqr_fence_small_zones_pass(spark, trips_pdf):
    out = CL.remove_iqr_speed_outliers_by_zone(spark.createDataFrame(trips_pdf), min_trips_per_zone=10_000, scope=[])
    assert out.count() == 200


def test_quality_signals(spark, trips_pdf):
    p = trips_pdf.copy()
    p["fare_amount"] = 10.0
    p["passenger_count"] = 1
    p.loc[0, "fare_amount"] = -5.0
    p.loc[1, "passenger_count"] = 0
    p.loc[2, "passenger_count"] = None
    assert _count_kept(spark, p) == 198


def test_quality_absent_columns_noop(spark, trips_pdf):
    assert "fare_amount" not in trips_pdf.columns
    assert _count_kept(spark, trips_pdf) == 200


def test_audit_adds_up(spark, trips_pdf):
    p = trips_pdf.copy()
    p.loc[0, "PULocationID"] = 0
    p = pd.concat([p, p.iloc[5:7]], ignore_index=True)
    rows = {r["step"]: r["rows"] for r in CL.clean_audit(_numbered(spark, p), CleanConfig(check_month=False)).collect()}
    assert rows["input"] == 202 and rows["duplicates"] == 2 and rows["zones"] == 1 and rows["kept"] == 199
    assert sum(v for k, v in rows.items() if k not in ("input",)) == 202


def test_exact_quantiles_match_numpy(spark):
    from zonepace.operators.quantile import exact_quantiles
    rng = np.random.default_rng(3)
    g = np.where(rng.random(5000) < 0.7, 0, rng.integers(1, 5, 5000))  # group 0 is hot
    v = rng.normal(size=5000)
    df = spark.createDataFrame(pd.DataFrame({"g": g, "v": v}))
    got = {r["g"]: (r["a"], r["b"]) for r in exact_quantiles(df, ["g"], "v", [0.25, 0.9], ["a", "b"]).collect()}
    for k in np.unique(g):
        want = np.quantile(v[g == k], [0.25, 0.9])
        assert np.allclose(got[k], want, rtol=0, atol=1e-12)
