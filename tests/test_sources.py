"""Sources and sinks: alias resolution, schema drift, month stamps, round trips."""

from __future__ import annotations

import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from zonepace.sources import io as IO
from zonepace.sources import trips as TR


def test_parse_year_month():
    assert TR.parse_year_month("yellow_tripdata_2023-01.parquet") == "2023-01"
    assert TR.parse_year_month("/x/green_tripdata_2024-12.parquet") == "2024-12"
    with pytest.raises(ValueError):
        TR.parse_year_month("trips.parquet")


def _write(pdf, path):
    pdf.to_parquet(path, index=False, coerce_timestamps="us")


def test_scan_resolves_aliases_and_drift(spark, trips_pdf):
    d = tempfile.mkdtemp(prefix="zp-raw-")
    a = trips_pdf.iloc[:100].drop(columns=["trip_duration"]).rename(
        columns={"pickup_datetime": "tpep_pickup_datetime", "dropoff_datetime": "tpep_dropoff_datetime"})
    a["passenger_count"] = 1  # bigint
    a["fare_amount"] = 9.5
    b = trips_pdf.iloc[100:].drop(columns=["trip_duration"]).rename(
        columns={"pickup_datetime": "lpep_pickup_datetime", "dropoff_datetime": "lpep_dropoff_datetime"})
    b["passenger_count"] = 2.0  # double
    c = trips_pdf.iloc[:10].drop(columns=["trip_duration"])  # no stamp in the name, no optional columns
    _write(a, os.path.join(d, "yellow_tripdata_2023-01.parquet"))
    _write(b, os.path.join(d, "green_tripdata_2023-01.parquet"))
    _write(c, os.path.join(d, "extra.parquet"))
    df = TR.scan_raw_trips(spark, d)
    pdf = df.toPandas()
    assert len(pdf) == 210
    assert set(pdf["file_ym"]) == {"2023-01"}
    assert pdf.loc[pdf["_src_file"] == "extra.parquet", "passenger_count"].isna().all()
    assert not pdf.loc[pdf["_src_file"] == "extra.parquet", "_has_fare"].any()
    assert (pdf["trip_duration"] > 0).all()


def test_missing_required_column(spark, trips_pdf):
    df = spark.createDataFrame(trips_pdf.drop(columns=["PULocationID"]))
    with pytest.raises(TR.MissingColumnError):
        TR.standardize_columns(df)


def test_cast_bad_values_to_null(spark):
    df = spark.createDataFrame(pd.DataFrame({
        "pickup_datetime": ["2023-01-01 10:00:00", "bad"], "dropoff_datetime": ["2023-01-01 10:10:00", "x"],
        "trip_distance": ["1.5", "abc"], "PULocationID": ["12", "2.7"], "DOLocationID": ["3", "4"],
    }))
    out = TR.cast_dtypes(TR.standardize_columns(df, keep_quality=False)).collect()
    assert out[0]["PULocationID"] == 12 and out[1]["PULocationID"] is None
    assert out[1]["trip_distance"] is None and out[1]["pickup_datetime"] is None


def test_modal_month(spark, trips_pdf):
    p = trips_pdf.copy()
    p["f"] = "x"
    out = TR.modal_month(spark.createDataFrame(p), "f").collect()
    assert out[0]["_modal_ym"] == "2023-01"


def test_parquet_and_json_round_trip(spark):
    d = tempfile.mkdtemp(prefix="zp-io-")
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    IO.write_parquet(df, f"{d}/t")
    assert sorted(r["a"] for r in IO.read_parquet_safe(spark, f"{d}/t").collect()) == [1, 2]
    IO.write_json(spark, {"k": 3, "m": {"1": 0.5}, "nan": float("nan")}, f"{d}/m")
    back = IO.read_json(spark, f"{d}/m")
    assert back["k"] == 3 and back["m"]["1"] == 0.5
    with pytest.raises(FileNotFoundError, match="expected from stage: clean"):
        IO.read_parquet_safe(spark, f"{d}/missing", "clean")


def test_centroid_csv_aliases(spark):
    d = tempfile.mkdtemp(prefix="zp-csv-")
    pd.DataFrame({"LocationID": [1, 2], "lat": [40.1, 40.2], "lon": [-73.9, -74.0]}).to_csv(f"{d}/c.csv", index=False)
    out = IO.load_centroids(spark, f"{d}/c.csv").orderBy("zone_id").collect()
    assert out[1]["zone_id"] == 2 and out[1]["latitude"] == 40.2 and out[0]["longitude"] == -73.9


def test_month_from_partition_folder(spark, trips_pdf):
    """Spark-written files are named part-…; the stamp comes from the parent folder."""
    import glob
    d = tempfile.mkdtemp(prefix="zp-part-")
    p = trips_pdf.drop(columns=["trip_duration"]).copy()
    p["file_ym"] = "2023-01"
    spark.createDataFrame(p).write.mode("overwrite").partitionBy("file_ym").parquet(f"{d}/raw")
    files = sorted(glob.glob(f"{d}/raw/file_ym=*/*.parquet"))
    assert files and all("2023" not in os.path.basename(f) for f in files)
    out = TR.scan_raw_trips(spark, [f"file://{f}" for f in files])
    assert {r["file_ym"] for r in out.select("file_ym").distinct().collect()} == {"2023-01"}
    assert out.count() == 200
