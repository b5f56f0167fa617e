"""Registered queries: ``(spark, sf_dir) -> DataFrame`` per operator key.

Each query reads the driver's tables (the trip adapter derives trips from
``lineitem``) and runs the library operators over the whole input.  Output
columns are normalised for the oracle compare: doubles rounded to 6
places, integral types widened to BIGINT.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepace import config as C
from zonepace.config import CleanConfig
from zonepace.operators import clean as CL
from zonepace.operators import features as FE
from zonepace.plans import stages as ST
from zonepace.sources import io as IO
from zonepace.sources import fixtures as FX
from zonepace.sources import trips as TR
from zonepace.functions import scalar as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def round6(x):
    """floor(x·1e6 + 0.5)/1e6: plain IEEE steps, so both engines agree bit for bit."""
    r = F.floor(x * F.lit(1e6) + F.lit(0.5)).cast("double") / F.lit(1e6)
    return F.when(F.isnan(x) | (F.abs(x) >= F.lit(1e12)), x).otherwise(r)


def norm(df: DataFrame) -> DataFrame:
    """Round doubles to 6 places, widen integers, timestamps as text; leave out ``_`` columns (file, row order)."""
    out = []
    for f in df.schema.fields:
        if f.name.startswith("_"):
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            out.append(round6(c.cast("double")).alias(f.name))
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            out.append(c.cast("long").alias(f.name))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out.append(S.timestamp_text(c).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


# ---- shared stages (lazy plans; Catalyst dedups nothing across queries) ----

def std_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter → canonical names → coerced types → trip_duration, written once as the
    load-stage table (the batch job's stage 1 output), so later rules read stored
    columns instead of re-deriving them per predicate."""
    def build():
        raw = FX.raw_trips(spark, sf_dir)
        return TR.add_trip_duration(TR.cast_dtypes(TR.standardize_columns(raw)))
    return ST.stage(spark, "std_trips", sf_dir, build)


def clean_trips(spark: SparkSession, sf_dir: str, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """Cleaned trips; the default chain is a stage table built once per session."""
    if cfg != CleanConfig():
        return CL.clean_trips(std_trips(spark, sf_dir), cfg)
    return ST.stage(spark, "clean_trips", sf_dir, lambda: CL.clean_trips(std_trips(spark, sf_dir), cfg))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone-hour cell table (stage table built from the cleaned-trips stage)."""
    return ST.stage(spark, "cells", sf_dir, lambda: FE.build_cells(clean_trips(spark, sf_dir)))


# ---- step 1: the minimum slice ---------------------------------------------

@register("clean_audit")
def q_clean_audit(spark, sf_dir):
    return norm(CL.clean_audit(std_trips(spark, sf_dir)))


@register("clean_trips")
def q_clean_trips(spark, sf_dir):
    return norm(clean_trips(spark, sf_dir))


@register("zone_hour_cells")
def q_zone_hour_cells(spark, sf_dir):
    feat = FE.engineer_features(clean_trips(spark, sf_dir))
    return norm(FE.aggregate_zone_hour(feat))


@register("speed_deviation")
def q_speed_deviation(spark, sf_dir):
    c = FE.compute_speed_deviation(FE.aggregate_zone_hour(FE.engineer_features(clean_trips(spark, sf_dir))))
    return norm(c.select(*C.CELL_KEY, "avg_speed_mph", "trip_density", "speed_deviation"))


@register("cells_full")
def q_cells_full(spark, sf_dir):
    return norm(cells(spark, sf_dir))


@register("slowest_cells")
def q_slowest_cells(spark, sf_dir):
    """Flagship: the 15 cells furthest below their zone-hour baseline."""
    c = cells(spark, sf_dir)
    return norm(
        c.orderBy(F.col("speed_deviation").asc(), *[F.col(k).asc() for k in C.CELL_KEY])
        .limit(15)
        .select(*C.CELL_KEY, "avg_speed_mph", "trip_density", "speed_deviation")
    )


# ---- step 2: sources, single rules, projections ----------------------------

def _renamed_raw(spark, sf_dir, mapping: dict[str, str], drop: list[str] = ()):
    raw = FX.raw_trips(spark, sf_dir)
    return raw.withColumnsRenamed(mapping).drop(*drop)


def drifting_files(spark, sf_dir) -> str:
    """The trips as monthly raw files of three vintages: tpep_ names with double passengers, lpep_ names with long ones, and one
    without fares; written once per session and state of the input."""
    from zonepace.session import scratch_path
    path = scratch_path(spark, f"raw_trips/{ST.source_digest(spark, sf_dir)}")
    if path not in _WRITTEN:
        raw = FX.raw_trips(spark, sf_dir)
        month = F.substring("file_ym", 6, 2).cast("int") % 3
        for i, (prefix, kind) in enumerate((("tpep", "double"), ("lpep", "long"), ("tpep", "long"))):
            one = raw.where(month == i).withColumn("passenger_count", F.col("passenger_count").cast(kind))
            one = one.withColumnsRenamed({c: f"{prefix}_{c}" for c in ("pickup_datetime", "dropoff_datetime")}).drop("_row_index")
            IO.save_monthly(one.drop("fare_amount") if i == 2 else one, f"{path}/vintage_{i}")
        _WRITTEN.add(path)
    return path


_WRITTEN: set[str] = set()


@register("scan_trips")
def q_scan_trips(spark, sf_dir):
    """Drifting monthly files listed, read a vintage at a time, aligned, coerced, stamped and united."""
    trips = TR.scan_raw_trips(spark, drifting_files(spark, sf_dir))
    return norm(trips.withColumn("has_fare", F.col("_has_fare")))


@register("standardize_columns")
def q_standardize_columns(spark, sf_dir):
    """A green-cab vintage (lpep_ names) without passenger_count: optional column filled with nulls."""
    raw = _renamed_raw(spark, sf_dir, {"pickup_datetime": "lpep_pickup_datetime",
                                       "dropoff_datetime": "lpep_dropoff_datetime"}, drop=["passenger_count"])
    return norm(TR.standardize_columns(raw))


@register("cast_dtypes")
def q_cast_dtypes(spark, sf_dir):
    """Every canonical column arrives as text; coercion restores types, junk → null."""
    raw = FX.raw_trips(spark, sf_dir)
    texts = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    # Text junk the coercion must null out: fractional zone ids and non-numbers.
    texts = texts.withColumn(
        "PULocationID",
        F.when(F.col("passenger_count") == "3", F.concat(F.col("PULocationID"), F.lit(".5"))).otherwise(F.col("PULocationID")),
    ).withColumn(
        "fare_amount", F.when(F.col("passenger_count") == "4", F.lit("n/a")).otherwise(F.col("fare_amount")),
    )
    return norm(TR.cast_dtypes(TR.standardize_columns(texts)))


@register("trip_duration")
def q_trip_duration(spark, sf_dir):
    return norm(std_trips(spark, sf_dir).select("pickup_datetime", "dropoff_datetime", "trip_duration"))


@register("parse_year_month")
def q_parse_year_month(spark, sf_dir):
    """Month stamps parsed from per-month file names (S6); names without a stamp give ''."""
    raw = FX.raw_trips(spark, sf_dir)
    name = F.when(F.substring("file_ym", 6, 2).cast("int") % 2 == 0,
                  F.concat(F.lit("yellow_tripdata_"), F.col("file_ym"), F.lit(".parquet"))
                  ).otherwise(F.concat(F.lit("trips_part_"), F.substring("file_ym", 6, 2), F.lit(".parquet")))
    named = raw.select(name.alias("file_name"))
    return norm(named.groupBy("file_name").agg(F.count(F.lit(1)).alias("trips"))
                .withColumn("year_month", TR.parse_year_month_expr("file_name")))


@register("modal_month")
def q_modal_month(spark, sf_dir):
    """Fallback stamp: most frequent pickup month of each file."""
    t = std_trips(spark, sf_dir)
    return norm(TR.modal_month(t, "file_ym").withColumnRenamed("_modal_ym", "modal_ym"))


def _rule_key(name: str, pred_fn):
    @register(name)
    def q(spark, sf_dir):
        t = std_trips(spark, sf_dir)
        return norm(t.where(pred_fn()))
    return q


_rule_key("remove_nulls", CL.keep_not_null)
_rule_key("remove_invalid_timestamps", CL.keep_timestamps)
_rule_key("remove_wrong_month", CL.keep_month)
_rule_key("remove_invalid_distance", CL.keep_distance)
_rule_key("remove_invalid_duration", CL.keep_duration)
_rule_key("remove_speed_outliers", CL.keep_speed)
_rule_key("remove_invalid_zones", CL.keep_zones)
_rule_key("remove_trivial_same_zone", CL.keep_not_trivial)
_rule_key("remove_invalid_quality", CL.keep_quality)


@register("remove_duplicates")
def q_remove_duplicates(spark, sf_dir):
    return norm(CL.remove_duplicates(std_trips(spark, sf_dir)))


@register("iqr_fence")
def q_iqr_fence(spark, sf_dir):
    """Per-zone speed fences, k = 3, zones with ≥ 100 cleaned trips, whole table."""
    return norm(CL.iqr_fences(clean_trips(spark, sf_dir), k=3.0, min_trips_per_zone=100, scope=[]))


@register("clean_trips_iqr")
def q_clean_trips_iqr(spark, sf_dir):
    """Chain with the fence on: k = 1.5, zones with ≥ 100 trips, whole table."""
    c = clean_trips(spark, sf_dir)
    return norm(CL.remove_iqr_speed_outliers_by_zone(c, k=1.5, min_trips_per_zone=100, scope=[]))


@register("iqr_fence_monthly")
def q_iqr_fence_monthly(spark, sf_dir):
    """The default scope: fences per month file and zone, here for zones with 3 trips in a month."""
    return norm(CL.iqr_fences(clean_trips(spark, sf_dir), min_trips_per_zone=3))


@register("clean_trips_iqr_monthly")
def q_clean_trips_iqr_monthly(spark, sf_dir):
    """The chain with its own IQR option on."""
    return norm(clean_trips(spark, sf_dir, CleanConfig(use_iqr_filter=True, iqr_k=1.5, iqr_min_trips=3)))


@register("clean_retention")
def q_clean_retention(spark, sf_dir):
    """Kept / input percent per month file."""
    t = std_trips(spark, sf_dir)
    n_in = t.groupBy("file_ym").agg(F.count(F.lit(1)).alias("rows_in"))
    n_out = clean_trips(spark, sf_dir).groupBy("file_ym").agg(F.count(F.lit(1)).alias("rows_kept"))
    j = n_in.join(n_out, "file_ym", "left").fillna(0, ["rows_kept"])
    return norm(j.withColumn("retention_pct", F.lit(100.0) * F.col("rows_kept") / F.col("rows_in")))


@register("time_features")
def q_time_features(spark, sf_dir):
    t = FE.add_time_features(clean_trips(spark, sf_dir))
    return norm(t.select("pickup_datetime", "PULocationID", "hour_of_day", "day_of_week", "is_weekend", "month"))


@register("speed_feature")
def q_speed_feature(spark, sf_dir):
    t = FE.add_speed_feature(std_trips(spark, sf_dir))
    return norm(t.select("pickup_datetime", "dropoff_datetime", "trip_distance", "trip_duration", "speed_mph"))


@register("engineer_features")
def q_engineer_features(spark, sf_dir):
    return norm(FE.engineer_features(clean_trips(spark, sf_dir)))


@register("cyclic_hour")
def q_cyclic_hour(spark, sf_dir):
    return norm(cells(spark, sf_dir).select(*C.CELL_KEY, "hour_sin", "hour_cos"))


@register("log_density")
def q_log_density(spark, sf_dir):
    return norm(cells(spark, sf_dir).select(*C.CELL_KEY, "trip_density", "log_trip_density"))


@register("zone_attributes")
def q_zone_attributes(spark, sf_dir):
    return norm(cells(spark, sf_dir).select(*C.CELL_KEY, "is_airport", "is_cbd", "is_rush_hour"))


@register("cyclic_distance")
def q_cyclic_distance(spark, sf_dir):
    """Circular vs linear distance of each cell's hour from 23:00."""
    c = cells(spark, sf_dir)
    return norm(c.select(*C.CELL_KEY,
                         F.abs(F.col("hour_of_day") - 23).alias("linear_distance"),
                         S.circular_hour_distance("hour_of_day", 23).alias("circular_distance")))


@register("cells_summary")
def q_cells_summary(spark, sf_dir):
    return norm(FE.cells_summary(cells(spark, sf_dir)))


# ---- step 3: fixed labels → mart, chart tables, dashboard -------------------

from zonepace.operators import dashboard as DB  # noqa: E402
from zonepace.operators import marts as MA  # noqa: E402

VIEW = DB.ViewParams(hour=8, day_filter="Weekdays Only", days=[1, 2, 3], focus_level=-1)


def labelled_cells(spark, sf_dir) -> DataFrame:
    """Cells with a deterministic raw labelling (hour band of 6 h) ranked into levels.

    Lets every downstream table be checked by SQL independently of a
    random K-Means start.
    """
    def build():
        c = cells(spark, sf_dir).withColumn("raw_cluster", F.floor(F.col("hour_of_day") / 6).cast("int"))
        return MA.assign_semantic_labels(c)
    return ST.stage(spark, "labelled_cells", sf_dir, build)


def mart(spark, sf_dir) -> DataFrame:
    """The viz mart as a stage table: every panel reads it instead of building it."""
    return ST.stage(spark, "mart", sf_dir, lambda: MA.build_viz_data(labelled_cells(spark, sf_dir)))


def zone_centroids(spark, sf_dir) -> DataFrame:
    """Centroid dimension for the zones seen in the data; every 50th zone has none."""
    z = cells(spark, sf_dir).select("zone_id").distinct().where(F.col("zone_id") % 50 != 0)
    return z.select("zone_id", (F.lit(40.5) + F.col("zone_id") * 0.002).alias("latitude"),
                    (F.lit(-74.25) + ((F.col("zone_id") * 37) % 263) * 0.002).alias("longitude"))


@register("semantic_labels")
def q_semantic_labels(spark, sf_dir):
    return norm(labelled_cells(spark, sf_dir).select(*C.CELL_KEY, "avg_speed_mph", "congestion_level"))


@register("viz_mart")
def q_viz_mart(spark, sf_dir):
    return norm(mart(spark, sf_dir))


@register("level_lookup")
def q_level_lookup(spark, sf_dir):
    m = labelled_cells(spark, sf_dir)
    return norm(m.select("congestion_level").distinct().select(
        "congestion_level", S.level_label().alias("congestion_label"), S.level_hex().alias("color_hex")))


@register("severity_dim")
def q_severity_dim(spark, sf_dir):
    return norm(DB.severity_dim(mart(spark, sf_dir)))


def _severity_of(hours: int):
    """The palette of a mart whose levels are blocks of ``hours`` hours: 24 / hours levels."""
    def query(spark, sf_dir):
        m = mart(spark, sf_dir)
        return norm(DB.severity_dim(m.withColumn("congestion_level", F.floor(F.col("hour_of_day") / hours).cast("int"))))
    return query


register("severity_dim_3")(_severity_of(8))
register("severity_dim_6")(_severity_of(4))
register("severity_dim_24")(_severity_of(1))


@register("hourly_trend")
def q_hourly_trend(spark, sf_dir):
    return norm(MA.hourly_trend(mart(spark, sf_dir)))


@register("cluster_distribution")
def q_cluster_distribution(spark, sf_dir):
    return norm(MA.cluster_distribution(mart(spark, sf_dir)))


@register("cluster_distribution_view")
def q_cluster_distribution_view(spark, sf_dir):
    """The dashboard's level bars at 8 o'clock: every level of the palette, zero where the view has none."""
    m = mart(spark, sf_dir)
    return norm(MA.level_distribution(DB.apply_filters(m, DB.ViewParams(hour=8)), DB.severity_dim(m)))


@register("day_hour_heatmap")
def q_day_hour_heatmap(spark, sf_dir):
    return norm(MA.day_hour_heatmap(mart(spark, sf_dir)))


@register("day_hour_speed")
def q_day_hour_speed(spark, sf_dir):
    """Weekday × hour mean trip speed over cleaned trips."""
    return norm(MA.day_hour_heatmap(FE.engineer_features(clean_trips(spark, sf_dir)), value="speed_mph"))


@register("top_congested_zones")
def q_top_congested_zones(spark, sf_dir):
    return norm(MA.top_congested_zones(mart(spark, sf_dir), 20))


@register("zone_hour_heatmap")
def q_zone_hour_heatmap(spark, sf_dir):
    return norm(MA.zone_hour_heatmap(mart(spark, sf_dir), 40, by="density"))


@register("zone_hour_heatmap_app")
def q_zone_hour_heatmap_app(spark, sf_dir):
    return norm(MA.zone_hour_heatmap(mart(spark, sf_dir), 25, by="level"))


@register("cluster_profile")
def q_cluster_profile(spark, sf_dir):
    return norm(MA.cluster_profile(labelled_cells(spark, sf_dir)))


@register("cluster_summary")
def q_cluster_summary(spark, sf_dir):
    return norm(MA.cluster_summary(mart(spark, sf_dir)))


@register("centroid_means")
def q_centroid_means(spark, sf_dir):
    return norm(MA.centroid_means(labelled_cells(spark, sf_dir)))


@register("mart_header")
def q_mart_header(spark, sf_dir):
    return norm(MA.mart_header(mart(spark, sf_dir)))


@register("feature_correlation")
def q_feature_correlation(spark, sf_dir):
    return norm(MA.feature_correlation(cells(spark, sf_dir)))


def features_df(spark, sf_dir):
    return FE.engineer_features(clean_trips(spark, sf_dir))


@register("describe_trips")
def q_describe_trips(spark, sf_dir):
    return norm(MA.describe(features_df(spark, sf_dir), ["trip_distance", "trip_duration", "speed_mph"]))


@register("hist_distance")
def q_hist_distance(spark, sf_dir):
    return norm(MA.histogram(features_df(spark, sf_dir), S.clip("trip_distance", 0, 30), 80))


@register("hist_log_distance")
def q_hist_log_distance(spark, sf_dir):
    return norm(MA.histogram(features_df(spark, sf_dir), F.log1p("trip_distance"), 80))


@register("hist_duration")
def q_hist_duration(spark, sf_dir):
    return norm(MA.histogram(features_df(spark, sf_dir), S.clip(F.col("trip_duration") / 60.0, 0, 90), 80))


@register("box_duration")
def q_box_duration(spark, sf_dir):
    t = features_df(spark, sf_dir).where(F.col("trip_duration") / 60.0 < 120)
    return norm(MA.box_stats(t, F.col("trip_duration") / 60.0))


@register("hist_speed")
def q_hist_speed(spark, sf_dir):
    return norm(MA.histogram(features_df(spark, sf_dir), S.clip("speed_mph", 0, 100), 100))


@register("hist_deviation")
def q_hist_deviation(spark, sf_dir):
    return norm(MA.histogram(cells(spark, sf_dir), S.clip("speed_deviation", -20, 20), 80))


@register("hist_density")
def q_hist_density(spark, sf_dir):
    return norm(MA.histogram(cells(spark, sf_dir), F.col("trip_density"), 60))


@register("hist_log_density")
def q_hist_log_density(spark, sf_dir):
    return norm(MA.histogram(cells(spark, sf_dir), F.col("log_trip_density"), 60))


@register("feature_distributions")
def q_feature_distributions(spark, sf_dir):
    """Density-normalised 40-bin histogram per (feature, level), each group's own range (H2)."""
    lc = labelled_cells(spark, sf_dir)
    stack = ", ".join(f"'{c}', cast(`{c}` as double)" for c in C.CLUSTER_FEATURES)
    long = lc.selectExpr("congestion_level", f"stack({len(C.CLUSTER_FEATURES)}, {stack}) as (feature, value)")
    return norm(MA.histogram(long, F.col("value"), 40, group_cols=["feature", "congestion_level"], density=True))


@register("deviation_histogram")
def q_deviation_histogram(spark, sf_dir):
    return norm(MA.deviation_histogram(mart(spark, sf_dir)))


@register("density_deviation_points")
def q_density_deviation_points(spark, sf_dir):
    return norm(MA.density_deviation_points(mart(spark, sf_dir)))


@register("density_deviation_eda")
def q_density_deviation_eda(spark, sf_dir):
    return norm(MA.density_deviation_clipped(cells(spark, sf_dir)))


@register("monthly_trend")
def q_monthly_trend(spark, sf_dir):
    return norm(MA.monthly_trend(features_df(spark, sf_dir)))


@register("hourly_counts")
def q_hourly_counts(spark, sf_dir):
    return norm(features_df(spark, sf_dir).groupBy("hour_of_day").agg(F.count(F.lit(1)).alias("trips")))


@register("hourly_speed_weekend")
def q_hourly_speed_weekend(spark, sf_dir):
    t = features_df(spark, sf_dir)
    return norm(t.groupBy("hour_of_day", "is_weekend").agg(F.avg(S.clip("speed_mph", 1, 100)).alias("avg_speed")))


@register("top_zones_volume")
def q_top_zones_volume(spark, sf_dir):
    t = features_df(spark, sf_dir)
    return norm(MA._top_k(t, "PULocationID", F.count(F.lit(1)), 20).withColumnRenamed("_m", "trips"))


@register("slowest_zones")
def q_slowest_zones(spark, sf_dir):
    t = features_df(spark, sf_dir)
    return norm(MA._top_k(t, "PULocationID", F.avg(S.clip("speed_mph", 1, 100)), 20, desc=False)
                .withColumnRenamed("_m", "avg_speed"))


@register("eda_cluster_summary")
def q_eda_cluster_summary(spark, sf_dir):
    """Mean and std (ddof 1) per level of speed, density and deviation, rounded half-even to 3."""
    lc = labelled_cells(spark, sf_dir)
    feats = ["avg_speed_mph", "trip_density", "speed_deviation"]
    r3 = lambda x: F.rint(x * 1000.0) / 1000.0
    return norm(lc.groupBy("congestion_level").agg(
        *[r3(F.avg(f)).alias(f"{f}_mean") for f in feats],
        *[r3(F.stddev_samp(f)).alias(f"{f}_std") for f in feats]))


@register("dashboard_filter")
def q_dashboard_filter(spark, sf_dir):
    return norm(DB.apply_filters(mart(spark, sf_dir), VIEW))


@register("dashboard_focus")
def q_dashboard_focus(spark, sf_dir):
    return norm(DB.apply_filters(mart(spark, sf_dir), DB.ViewParams(hour=17, day_filter="Weekends Only", focus_level=3)))


@register("insights")
def q_insights(spark, sf_dir):
    return norm(DB.insights(mart(spark, sf_dir)))


@register("kpi_row")
def q_kpi_row(spark, sf_dir):
    return norm(DB.kpi_row(mart(spark, sf_dir), VIEW))


@register("auto_story")
def q_auto_story(spark, sf_dir):
    return norm(DB.auto_story(mart(spark, sf_dir), VIEW))


@register("top_zones_dashboard")
def q_top_zones_dashboard(spark, sf_dir):
    return norm(DB.top_zones_dashboard(mart(spark, sf_dir), VIEW))


@register("map_points")
def q_map_points(spark, sf_dir):
    cent = IO.load_centroids(spark, centroid_csv(spark, sf_dir))  # the dashboard reads the CSV dimension
    return norm(DB.map_points(mart(spark, sf_dir), cent, VIEW))


@register("filtered_table")
def q_filtered_table(spark, sf_dir):
    return norm(DB.filtered_table(mart(spark, sf_dir), VIEW))


# ---- step 4: feature matrix, scaling, quality on fixed labels ---------------

from zonepace.operators import quality as QU  # noqa: E402
from zonepace.operators import scaling as SC  # noqa: E402

FEATS = C.CLUSTER_FEATURES


def feature_table(spark, sf_dir) -> DataFrame:
    """Labelled cells with the five features as doubles (M1)."""
    return SC.prepare_features(labelled_cells(spark, sf_dir))


def scaled_table(spark, sf_dir, kind: str = "standard") -> DataFrame:
    """Labelled cells with scaled features, as a stage table (the quality scores read it several times)."""
    return ST.stage(spark, f"scaled_{kind}", sf_dir, lambda: SC.scale_features(feature_table(spark, sf_dir), FEATS, kind)[0])


@register("feature_matrix")
def q_feature_matrix(spark, sf_dir):
    return norm(feature_table(spark, sf_dir).select(*C.CELL_KEY[:3], *FEATS))


@register("scale_standard")
def q_scale_standard(spark, sf_dir):
    return norm(scaled_table(spark, sf_dir, "standard").select(*C.CELL_KEY[:3], *FEATS))


@register("scale_robust")
def q_scale_robust(spark, sf_dir):
    return norm(scaled_table(spark, sf_dir, "robust").select(*C.CELL_KEY[:3], *FEATS))


@register("davies_bouldin")
def q_davies_bouldin(spark, sf_dir):
    return norm(QU.davies_bouldin(scaled_table(spark, sf_dir), FEATS, "congestion_level"))


@register("calinski_harabasz")
def q_calinski_harabasz(spark, sf_dir):
    return norm(QU.calinski_harabasz(scaled_table(spark, sf_dir), FEATS, "congestion_level"))


@register("cv_intra")
def q_cv_intra(spark, sf_dir):
    return norm(QU.cv_intra(labelled_cells(spark, sf_dir)))


@register("ari")
def q_ari(spark, sf_dir):
    """ARI between the hour-band levels and a second labeling (zone + hour) mod 4."""
    lc = labelled_cells(spark, sf_dir).withColumn("second", (F.col("zone_id") + F.col("hour_of_day")) % 4)
    return norm(QU.adjusted_rand(lc, "congestion_level", "second"))


@register("ari_identical")
def q_ari_identical(spark, sf_dir):
    """ARI of a labeling with a relabelled copy of itself is exactly 1."""
    lc = labelled_cells(spark, sf_dir).withColumn("copy", F.lit(10) - F.col("congestion_level"))
    return norm(QU.adjusted_rand(lc, "congestion_level", "copy"))


def _silhouette(spark, sf_dir):
    sc = scaled_table(spark, sf_dir)
    key = C.CELL_KEY[:3]
    # The rows feed the scoring pass and the join: cut them once.
    sample = QU.silhouette_sample(sc, key).checkpoint(eager=True)
    per_row = QU.silhouette_samples(sample, FEATS, ["congestion_level"], key)
    return sc, sample, per_row


@register("silhouette_overall")
def q_silhouette_overall(spark, sf_dir):
    sc, sample, per_row = _silhouette(spark, sf_dir)
    overall, _ = QU.silhouette_scores(per_row, sample, "congestion_level", C.CELL_KEY[:3])
    return norm(overall)


@register("silhouette_per_cluster")
def q_silhouette_per_cluster(spark, sf_dir):
    sc, sample, per_row = _silhouette(spark, sf_dir)
    _, per = QU.silhouette_scores(per_row, sample, "congestion_level", C.CELL_KEY[:3])
    return norm(per)


@register("silhouette_samples")
def q_silhouette_samples(spark, sf_dir):
    sc, sample, per_row = _silhouette(spark, sf_dir)
    # Ranked by the six digits shown, so equal values fall back to the key.
    j = per_row.join(sample.select(*C.CELL_KEY[:3], "congestion_level"), C.CELL_KEY[:3])
    j = j.withColumn("sil_congestion_level", round6(F.col("sil_congestion_level"))).checkpoint(eager=True)
    return norm(QU.level_window_rank(j, "congestion_level", "sil_congestion_level", C.CELL_KEY[:3]))


@register("cluster_quality")
def q_cluster_quality(spark, sf_dir):
    """Metrics document as a long table on the fixed labels, with silhouettes and the KPI gate (Q9)."""
    sc, sample, per_row = _silhouette(spark, sf_dir)
    overall, per = QU.silhouette_scores(per_row.checkpoint(eager=True), sample, "congestion_level", C.CELL_KEY[:3])
    return norm(QU.cluster_quality(sc, labelled_cells(spark, sf_dir), FEATS, C.CELL_KEY[:3], silhouette=overall, per_cluster_sil=per))


@register("kpi_gate")
def q_kpi_gate(spark, sf_dir):
    """The KPI gate on two labelings of all cells: the fixed hour bands over the scaled features, and speed bands of a
    quarter each over their band number, whose levels are tight by construction (Q9)."""
    key = C.CELL_KEY[:3]
    overall, _ = QU.silhouette_scores(*_silhouette(spark, sf_dir)[:0:-1], "congestion_level", key)
    labelled = labelled_cells(spark, sf_dir)
    band = F.floor(F.log("avg_speed_mph") / F.log(F.lit(1.25))).cast("int")
    tight = labelled.select(*key, "avg_speed_mph", band.alias("congestion_level"), band.cast("double").alias("band")).checkpoint(eager=True)
    tight_sil, _ = QU.silhouette_scores(QU.silhouette_samples(tight, ["band"], ["congestion_level"], key), tight, "congestion_level", key)
    rows = [QU.kpi_gate(sil, QU.cv_intra(table)).select(F.lit(name).alias("labeling"), "sil_ok", "cv_ok", "kpi_pass")
            for name, sil, table in (("hour_bands", overall, labelled), ("speed_bands", tight_sil, tight))]
    return norm(rows[0].unionByName(rows[1]))


# ---- steps 5–7: K-Means, DBSCAN, PCA, geometry, freshness -------------------

from zonepace.operators import dbscan as DS  # noqa: E402
from zonepace.operators import geo as GE  # noqa: E402
from zonepace.operators import kmeans as KM  # noqa: E402
from zonepace.operators import pca as PC  # noqa: E402

KEY3 = C.CELL_KEY[:3]

def _cell_id():
    return F.col("zone_id").cast("long") * 1000 + F.col("hour_of_day") * 10 + F.col("day_of_week")


def cell_scaled(spark, sf_dir) -> DataFrame:
    """Real cells (not the fixed labels), scaled with the standard scaler, plus
    ``cell_id`` = zone·1000 + hour·10 + weekday (unique, ordered like the key)."""
    def build():
        scaled, _ = SC.scale_features(SC.prepare_features(cells(spark, sf_dir)), FEATS, "standard")
        return scaled.withColumn("cell_id", _cell_id())
    return ST.stage(spark, "cell_scaled", sf_dir, build)


def _default_fit(spark, sf_dir):
    """(rows, fit): K-Means at the default k, best of ten restarts drawn by cell id."""
    data = KM.stable_input(cell_scaled(spark, sf_dir), KEY3, FEATS, id_col="cell_id")
    return data, KM.train_kmeans(data, C.DEFAULT_K)


@register("kmeans_labels")
def q_kmeans_labels(spark, sf_dir):
    """K-Means at the default k, levels ranked by speed (M5 + W8)."""
    data, fit = _default_fit(spark, sf_dir)
    return norm(MA.assign_semantic_labels(KM.predict(fit, data)).select(*KEY3, "avg_speed_mph", "congestion_level"))


@register("kmeans_facts")
def q_kmeans_facts(spark, sf_dir):
    """The default fit in one row: rows, levels, falling speeds, every row with its nearest centre, and the inertia of the
    final centres, which is the cost recomputed from the labels (M5, W8)."""
    data, fit = _default_fit(spark, sf_dir)
    dist = [sum((F.col(f) - F.lit(float(x))) ** 2 for f, x in zip(FEATS, c)) for c in fit.centres]
    own = F.element_at(F.array(*dist), F.col("raw_cluster") + 1)
    lab = MA.assign_semantic_labels(KM.predict(fit, data).withColumns({"d_own": own, "d_min": F.least(*dist)}))
    levels = lab.groupBy("congestion_level").agg(F.avg("avg_speed_mph").alias("speed"), F.count(F.lit(1)).alias("n"),
                                                 F.count_if(F.col("d_own") <= F.col("d_min") + 1e-9).alias("near"), F.sum("d_own").alias("cost"))
    ahead = F.lag("speed").over(Window.orderBy("congestion_level"))  # k rows
    table = levels.withColumn("falls", F.coalesce(F.col("speed") < ahead, F.lit(True)))
    return norm(table.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_levels"),
                          (F.max("congestion_level") - F.min("congestion_level") + 1).alias("level_span"), F.max("n").alias("largest"),
                          F.min("falls").alias("speeds_fall"), (F.sum("near") == F.sum("n")).alias("all_nearest"),
                          (F.abs(F.sum("cost") / F.lit(fit.inertia) - 1) < 1e-9).alias("cost_agrees"),
                          F.lit(round(fit.inertia, 4)).alias("inertia"), F.lit(fit.seed).alias("seed")))


@register("k_sweep")
def q_k_sweep(spark, sf_dir):
    """Inertia and silhouette for k = 2..10, elbow and chosen k flagged."""
    chosen, sweep, info = KM.choose_k(cell_scaled(spark, sf_dir), KEY3, FEATS, id_col="cell_id")
    return norm(sweep.withColumns({
        "is_elbow": F.col("k") == info["elbow_k"], "is_silhouette_argmax": F.col("k") == info["silhouette_argmax_k"],
        "chosen": F.col("k") == chosen, "elbow_source": F.lit(info["elbow_source"])}))


@register("stability")
def q_stability(spark, sf_dir):
    """Pairwise ARI over 5 seeds at the default k (Q8)."""
    st = KM.stability(cell_scaled(spark, sf_dir), KEY3, C.DEFAULT_K, id_col="cell_id")
    return norm(spark.createDataFrame([(st["ari_mean"], st["ari_min"], st["ari_pass"])],
                                      "ari_mean double, ari_min double, ari_pass boolean"))


def fixed_partition_sweep(spark, sf_dir) -> DataFrame:
    """Within-cluster SSE of the hour split into k equal bands, k = 2..10 (data-derived curve for W9)."""
    sc = scaled_table(spark, sf_dir)
    ks = spark.range(C.K_RANGE[0], C.K_RANGE[1]).select(F.col("id").cast("int").alias("k"))
    lab = sc.crossJoin(F.broadcast(ks)).withColumn(  # ks: the 9 values of k, a fixed fan-out
        "band", F.floor(F.col("hour_of_day") * F.col("k") / 24))
    cen = lab.groupBy("k", "band").agg(*[F.avg(f).alias(f"c_{f}") for f in FEATS])
    sse = lab.join(cen, ["k", "band"]).groupBy("k").agg(
        F.sum(sum((F.col(f) - F.col(f"c_{f}")) ** 2 for f in FEATS)).alias("inertia"))
    return sse


@register("elbow_second_diff")
def q_elbow_second_diff(spark, sf_dir):
    return norm(KM.elbow_second_diff_table(fixed_partition_sweep(spark, sf_dir)))


@register("fixed_sweep")
def q_fixed_sweep(spark, sf_dir):
    return norm(fixed_partition_sweep(spark, sf_dir))


@register("eps_neighbors")
def q_eps_neighbors(spark, sf_dir):
    """ε-neighbour counts (self included) and core flags on the scaled cells."""
    return norm(DS.neighbour_counts(cell_scaled(spark, sf_dir), KEY3, FEATS, id_col="cell_id"))


@register("dbscan_core")
def q_dbscan_core(spark, sf_dir):
    nc = DS.neighbour_counts(cell_scaled(spark, sf_dir), KEY3, FEATS, id_col="cell_id")
    return norm(nc.agg(F.count_if("is_core").alias("n_core"), F.count(F.lit(1)).alias("n_points"),
                       F.sum("neighbors").alias("n_pairs")))


@register("dbscan_labels")
def q_dbscan_labels(spark, sf_dir):
    return norm(DS.dbscan(cell_scaled(spark, sf_dir), KEY3, FEATS, id_col="cell_id"))


@register("dbscan_metrics")
def q_dbscan_metrics(spark, sf_dir):
    return norm(DS.dbscan_metrics(DS.dbscan(cell_scaled(spark, sf_dir), KEY3, FEATS, id_col="cell_id")))


@register("pca_covariance")
def q_pca_covariance(spark, sf_dir):
    return norm(PC.covariance(scaled_table(spark, sf_dir), FEATS))


@register("pca_projection")
def q_pca_projection(spark, sf_dir):
    """2-D projection of all scaled cells, with levels (M10); scores to four digits, as two eigen-solvers agree to about twelve."""
    proj, ratio, _ = PC.pca_projection(scaled_table(spark, sf_dir), FEATS, keep=[*KEY3, "congestion_level"])
    proj = proj.withColumns({c: F.floor(F.col(c) * F.lit(1e4) + F.lit(0.5)).cast("double") / F.lit(1e4) for c in ("pc1", "pc2")})
    return norm(proj.withColumns({"explained_pc1": F.lit(ratio[0]), "explained_pc2": F.lit(ratio[1])}))


QUICK = ["avg_speed_mph", "trip_density", "speed_deviation"]


def _quick_clusters(spark, sf_dir) -> DataFrame:
    c = SC.prepare_features(cells(spark, sf_dir).select(*KEY3, *QUICK), QUICK).withColumn("speed_raw", F.col("avg_speed_mph"))
    scaled, _ = SC.scale_features(c.withColumn("cell_id", _cell_id()), QUICK, "standard")
    data = KM.stable_input(scaled, KEY3, QUICK, id_col="cell_id")
    fit = KM.train_kmeans(data, 3)
    return MA.assign_semantic_labels(KM.predict(fit, data), speed_col="speed_raw")


@register("eda_quick_clusters")
def q_eda_quick_clusters(spark, sf_dir):
    """Quick look over all cells: 3 raw features standardised, k = 3, levels by speed (M9)."""
    return norm(_quick_clusters(spark, sf_dir).select(*KEY3, F.col("speed_raw").alias("avg_speed_mph"), "congestion_level"))


@register("eda_quick_silhouette")
def q_eda_quick_silhouette(spark, sf_dir):
    """The silhouette figure of the quick look, over all cells (M9)."""
    # The rows feed the counts and the scoring pass: cut them once.
    lab = _quick_clusters(spark, sf_dir).select(*KEY3, *QUICK, "congestion_level").checkpoint(eager=True)
    per_row = QU.silhouette_samples(lab, QUICK, ["congestion_level"], KEY3)
    return norm(per_row.agg(F.avg("sil_congestion_level").alias("silhouette")))


def zone_vertices(spark, sf_dir) -> DataFrame:
    """Planar polygons for the zones seen in the data: squares, triangles for every
    third zone, and a square hole (opposite winding) in every tenth zone."""
    z = cells(spark, sf_dir).select("zone_id").distinct()
    cx = (F.col("zone_id") % 20) * 10.0
    cy = F.floor(F.col("zone_id") / 20) * 10.0
    sq = [(0, 0), (4, 0), (4, 4), (0, 4)]
    tri = [(0, 0), (6, 0), (0, 3)]
    hole = [(1, 1), (1, 2), (2, 2), (2, 1)]
    def ring(pts, ring_id):
        return F.array(*[F.struct(F.lit(ring_id).alias("ring"), F.lit(i).alias("seq"), F.lit(float(x)).alias("dx"),
                                  F.lit(float(y)).alias("dy")) for i, (x, y) in enumerate(pts)])
    shape = F.when(F.col("zone_id") % 3 == 0, ring(tri, 0)).otherwise(ring(sq, 0))
    shape = F.when(F.col("zone_id") % 10 == 0, F.concat(ring(sq, 0), ring(hole, 1))).otherwise(shape)
    v = z.select("zone_id", cx.alias("cx"), cy.alias("cy"), F.explode(shape).alias("p"))
    return v.select("zone_id", F.col("p.ring").alias("ring"), F.col("p.seq").alias("seq"),
                    (F.col("cx") + F.col("p.dx")).alias("x"), (F.col("cy") + F.col("p.dy")).alias("y"))


@register("zone_centroids")
def q_zone_centroids(spark, sf_dir):
    return norm(GE.polygon_centroids(zone_vertices(spark, sf_dir)))


# FIXED VALUE: the evaluation clock for the freshness check (a parameter of the query).
FRESHNESS_NOW = "1998-12-01 00:00:00"


@register("data_freshness")
def q_data_freshness(spark, sf_dir):
    """Lag between the newest cleaned pickup and a fixed 'now', against the 24 h target."""
    t = clean_trips(spark, sf_dir)
    mx = t.agg(F.max("pickup_datetime").alias("latest_pickup"))
    lag = S.duration_seconds(F.col("latest_pickup"), F.expr(f"timestamp_ntz'{FRESHNESS_NOW}'")) / 3600.0
    return norm(mx.select("latest_pickup", lag.alias("lag_hours"),
                          (lag < C.TARGET_FRESHNESS_HOURS).alias("fresh")))


@register("silhouette_sample")
def q_silhouette_sample(spark, sf_dir):
    """The rows the silhouette is defined on: all of them, unless a caller passes a cap (Q1)."""
    return norm(QU.silhouette_sample(scaled_table(spark, sf_dir), KEY3).select(*KEY3, "congestion_level"))


@register("scorecard")
def q_scorecard(spark, sf_dir):
    """Scorecard of the fixed labels; the ARI rows are the seed stability of K-Means at the default k."""
    sc, sample, per_row = _silhouette(spark, sf_dir)
    overall, _ = QU.silhouette_scores(per_row, sample, "congestion_level", C.CELL_KEY[:3])
    st = KM.stability(cell_scaled(spark, sf_dir), KEY3, C.DEFAULT_K, id_col="cell_id")
    ari = lambda x: spark.range(1).select(F.lit(x).alias("ari"))
    return norm(QU.scorecard(QU.davies_bouldin(sc, FEATS, "congestion_level"), QU.calinski_harabasz(sc, FEATS, "congestion_level"),
                             ari(st["ari_min"]), ari(st["ari_mean"]), silhouette=overall))



def centroid_csv(spark, sf_dir) -> str:
    """The centroid dimension written as CSV with the alternate headers (LocationID, lat, lon)."""
    from zonepace.session import scratch_path
    import hashlib
    state = sf_dir + ST.source_state(spark, sf_dir)
    path = scratch_path(spark, f"stages/{hashlib.sha1(state.encode()).hexdigest()[:12]}/centroids_csv")
    key = (spark.sparkContext.applicationId, "centroids_csv", state)
    if key not in ST._BUILT:
        z = zone_centroids(spark, sf_dir).select(F.col("zone_id").alias("LocationID"),
                                                 F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
        z.write.mode("overwrite").option("header", True).csv(path)
        ST._BUILT[key] = path
    return ST._BUILT[key]


@register("load_centroids")
def q_load_centroids(spark, sf_dir):
    """Centroid CSV source with header aliases (S16), read back from the written file."""
    return norm(IO.load_centroids(spark, centroid_csv(spark, sf_dir)))


@register("hist_deviation_raw")
def q_hist_deviation_raw(spark, sf_dir):
    """70-bin histogram of the unclipped deviation over its own range (H6, notebook form)."""
    return norm(MA.histogram(cells(spark, sf_dir), F.col("speed_deviation"), 70))


@register("deviation_stats")
def q_deviation_stats(spark, sf_dir):
    """Range and mean ± std (ddof 1) of the deviation, printed beside that histogram (H6)."""
    c = cells(spark, sf_dir)
    return norm(c.agg(F.min("speed_deviation").alias("dev_min"), F.max("speed_deviation").alias("dev_max"),
                      F.avg("speed_deviation").alias("dev_mean"), F.stddev_samp("speed_deviation").alias("dev_std")))
