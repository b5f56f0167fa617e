"""Per-trip features and the zone-hour cell table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonepace import config as C
from zonepace.functions import scalar as S


def add_time_features(df: DataFrame) -> DataFrame:
    """hour_of_day, day_of_week (0=Mon), is_weekend, month."""
    return df.withColumns({
        "hour_of_day": S.hour_of_day(),
        "day_of_week": S.day_of_week(),
        "is_weekend": S.day_of_week() >= 5,
        "month": F.month("pickup_datetime"),
    })


def add_speed_feature(df: DataFrame) -> DataFrame:
    """speed_mph; zero duration → null."""
    return df.withColumn("speed_mph", S.speed_mph())


def add_zone_feature(df: DataFrame) -> DataFrame:
    """zone_id = pickup zone (P5)."""
    return df.withColumn("zone_id", F.col("PULocationID").cast("int"))


def engineer_features(df: DataFrame) -> DataFrame:
    """P3 + P4 + P5, then drop rows without a speed."""
    return (
        df.transform(add_time_features).transform(add_speed_feature).transform(add_zone_feature)
        .where(F.col("speed_mph").isNotNull())
    )


def aggregate_zone_hour(trips: DataFrame) -> DataFrame:
    """One row per (zone, hour, weekday, weekend): mean speed, trips, mean duration (A1).

    A hash aggregate with a map-side partial step: a busy zone's trips are
    folded to one partial row per task before the shuffle, so skew in
    zones does not reach the reducers.  Sums are whole numbers of 2^-30, so a mean is the same
    however tasks and shuffles order the rows.
    """
    return trips.groupBy(*C.CELL_KEY).agg(
        S.exact_mean(F.col("speed_mph")).alias("avg_speed_mph"),
        F.count("speed_mph").alias("trip_density"),
        S.exact_mean(F.col("trip_duration")).alias("avg_trip_duration"),
    )


def compute_speed_deviation(cells: DataFrame, weighted: bool = False) -> DataFrame:
    """speed_deviation = cell speed − mean over the weekday cells of (zone, hour).

    The baseline is the unweighted mean of the cells; ``weighted=True``
    weights cells by trip count.  A window replaces the reference's
    aggregate-then-join: one shuffle on (zone, hour), each window ≤ 7 rows.
    """
    w = Window.partitionBy("zone_id", "hour_of_day")
    if weighted:
        base = F.sum(F.col("avg_speed_mph") * F.col("trip_density")).over(w) / F.sum("trip_density").over(w)
    else:
        base = (S.exact_sum(F.col("avg_speed_mph")).over(w).cast("double") / F.count("avg_speed_mph").over(w)) / F.lit(float(S.UNITS))
    return cells.withColumn("speed_deviation", F.col("avg_speed_mph") - base)


def add_cyclic_hour(cells: DataFrame) -> DataFrame:
    """hour_sin, hour_cos."""
    return cells.withColumns({"hour_sin": S.hour_sin(), "hour_cos": S.hour_cos()})


def add_log_density(cells: DataFrame) -> DataFrame:
    """log_trip_density = log1p(trip_density)."""
    return cells.withColumn("log_trip_density", S.log_density())


def add_zone_attributes(cells: DataFrame) -> DataFrame:
    """is_airport, is_cbd, is_rush_hour."""
    return cells.withColumns({
        "is_airport": S.is_airport(), "is_cbd": S.is_cbd(), "is_rush_hour": S.is_rush_hour(),
    })


def build_cells(clean: DataFrame) -> DataFrame:
    """Cleaned trips → the full zone-hour cell table (L3)."""
    return cells_of(engineer_features(clean))


def cells_of(trips: DataFrame) -> DataFrame:
    """Trips with features → the full zone-hour cell table."""
    return (
        trips.transform(aggregate_zone_hour)
        .transform(compute_speed_deviation)
        .transform(add_cyclic_hour)
        .transform(add_log_density)
        .transform(add_zone_attributes)
    )


def cells_summary(cells: DataFrame) -> DataFrame:
    """Stage summary: distinct zones/hours, rows, deviation mean/std, tags."""
    return cells.agg(
        F.count_distinct("zone_id").alias("unique_zones"),
        F.count_distinct("hour_of_day").alias("hours_covered"),
        F.count(F.lit(1)).alias("n_rows"),
        F.avg("speed_deviation").alias("speed_dev_mean"),
        F.stddev_samp("speed_deviation").alias("speed_dev_std"),
        F.avg("log_trip_density").alias("log_density_mean"),
        F.count_if("is_airport").alias("airport_rows"),
        F.count_if("is_cbd").alias("cbd_rows"),
        F.count_if("is_rush_hour").alias("rush_hour_rows"),
        F.min("hour_of_day").alias("hour_min"),
        F.max("hour_of_day").alias("hour_max"),
    )
