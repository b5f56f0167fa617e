"""Test inputs derived from the driver's tables.

The driver's tables hold no taxi trips, so a trip table is derived from
``lineitem`` by plain arithmetic that Spark SQL and DuckDB evaluate
identically (the DuckDB twin lives in :mod:`zonepace.plans.oracle`).  Every
97th order is repeated to create duplicates of the natural key that differ in
fare and passengers; ``_row_index`` puts the copy before the original for
even orders and behind it for odd ones.  Pickups spill past month ends; durations include negative, zero, short and very long trips.
The work grows with ``lineitem``: nothing here is a fixed small input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# FIXED VALUES: the adapter's formulas (shared with the DuckDB oracle).
TRIP_ADAPTER_EXPRS = [
    "timestampadd(MINUTE, cast(l_orderkey % 1500 as int), l_shipdate) as pickup_datetime",
    """timestampadd(SECOND,
         (cast(l_quantity - 3 as int) * 90 - case when l_linenumber = 7 then 70 else 0 end)
           * case when l_linenumber = 6 and l_quantity > 45 then 5 else 1 end,
         timestampadd(MINUTE, cast(l_orderkey % 1500 as int), l_shipdate)) as dropoff_datetime""",
    """case when l_discount = 0.10 and l_tax = 0.08 then null
            else l_extendedprice / cast(5000 as double) - cast(0.18 as double) end as trip_distance""",
    "cast(l_partkey % 266 as int) as PULocationID",
    "cast((l_partkey + (l_linenumber - 1) * 37) % 266 as int) as DOLocationID",
    "l_extendedprice * (l_discount - cast(0.01 as double)) - copy * cast(3 as double) as fare_amount",
    "case when l_tax = 0.05 then null else l_linenumber - 1 + copy end as passenger_count",
    """l_orderkey * 100 + l_linenumber * 10
         + case when copy = 0 then 5 when l_orderkey % 2 = 0 then 1 else 9 end as _row_index""",
    "date_format(l_shipdate, 'yyyy-MM') as file_ym",
]
LINEITEM_COLUMNS = [
    "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_shipdate",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trip rows (before standardisation) derived from ``lineitem``."""
    li = table(spark, sf_dir, "lineitem").select(*LINEITEM_COLUMNS, F.lit(0).alias("copy"))
    dup = li.where(F.col("l_orderkey") % 97 == 0).withColumn("copy", F.lit(1))
    return li.unionByName(dup).selectExpr(*TRIP_ADAPTER_EXPRS)
