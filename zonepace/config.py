"""Pipeline settings.

Everything below the ``FIXED VALUES`` marker must equal the published
behaviour of the trip-speed pipeline this package re-implements
(thresholds, column aliases, zone sets, labels, colours).  They are stated
plainly, in natural order.  Tunables that only affect how Spark runs the
work live in :mod:`zonepace.session`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original pipeline for identical results)
# ---------------------------------------------------------------------------

# Cleaning thresholds, all bounds inclusive.
MIN_SPEED_MPH = 1.0
MAX_SPEED_MPH = 100.0
MIN_DISTANCE_MILES = 0.01
MAX_DISTANCE_MILES = 200.0
MIN_DURATION_SECONDS = 30
MAX_DURATION_SECONDS = 4 * 3600
MIN_ZONE_ID = 1
MAX_ZONE_ID = 263
TRIVIAL_SAME_ZONE_DISTANCE_MILES = 0.10

# Per-zone IQR fence on speed (opt-in rule).
USE_IQR_SPEED_FILTER = False
IQR_FENCE_K = 3.0
IQR_MIN_TRIPS_PER_ZONE = 200

# Optional quality-signal columns.
KEEP_QUALITY_COLUMNS = True
QUALITY_COLUMNS = ["fare_amount", "passenger_count"]

# Raw column aliases across dataset vintages, first match wins (case-sensitive).
COLUMN_ALIASES = {
    "pickup_datetime": ["tpep_pickup_datetime", "lpep_pickup_datetime", "pickup_datetime"],
    "dropoff_datetime": ["tpep_dropoff_datetime", "lpep_dropoff_datetime", "dropoff_datetime"],
    "trip_distance": ["trip_distance"],
    "PULocationID": ["PULocationID"],
    "DOLocationID": ["DOLocationID"],
    "fare_amount": ["fare_amount"],
    "passenger_count": ["passenger_count"],
}
OPTIONAL_COLUMNS = {"fare_amount", "passenger_count"}

# Natural key used by the duplicate rule.
DEDUP_KEY = ["pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID", "trip_distance"]
# Columns that must be non-null after casting.
CRITICAL_COLUMNS = [
    "pickup_datetime", "dropoff_datetime", "trip_distance", "trip_duration",
    "PULocationID", "DOLocationID",
]

# Clustering features, in this order.
CLUSTER_FEATURES = ["hour_sin", "hour_cos", "is_weekend", "speed_deviation", "log_trip_density"]
CELL_KEY = ["zone_id", "hour_of_day", "day_of_week", "is_weekend"]

# KPI targets.
TARGET_SILHOUETTE = 0.5
TARGET_CVINTRA = 0.20
TARGET_DAVIES_BOULDIN = 1.00
TARGET_ARI_MIN = 0.80
TARGET_ARI_MEAN = 0.90
TARGET_FRESHNESS_HOURS = 24

# K-Means.
K_RANGE = (2, 11)  # inclusive-exclusive
DEFAULT_K = 6
KMEANS_RANDOM_STATE = 42
KMEANS_N_INIT = 10
KMEANS_MAX_ITER = 300
SILHOUETTE_SAMPLE_SIZE = 50_000
STABILITY_N_SEEDS = 5
STABILITY_ARI_MIN = 0.70
SCALER_TYPE = "standard"

# DBSCAN.
DBSCAN_NOISE_WARN_FRACTION = 0.30
DBSCAN_EPS = 0.5
DBSCAN_MIN_SAMPLES = 10

# Congestion level names and colours (level 0 = fastest).
CONGESTION_LABELS = {0: "Low", 1: "Medium", 2: "High"}
CONGESTION_HEX_COLORS = {0: "#2ecc71", 1: "#f39c12", 2: "#e74c3c"}
CONGESTION_RGBA_COLORS = {0: [46, 204, 113, 180], 1: [243, 156, 18, 180], 2: [231, 76, 60, 200]}
DEFAULT_HEX = "#7f8c8d"

DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
DAY_NAMES_SHORT = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]

# Zone tags (post-hoc labels, never clustering features).
AIRPORT_ZONES = [1, 132, 138]
CBD_ZONES = [
    4, 12, 13, 45, 48, 50, 68, 79, 87, 88, 90, 100, 107, 113, 114,
    125, 137, 140, 141, 142, 143, 144, 148, 151, 158, 161, 162,
    163, 164, 170, 186, 209, 211, 224, 229, 230, 231, 232, 233,
    234, 246, 249, 261, 262, 263,
]
RUSH_HOUR_MORNING = [7, 8, 9]
RUSH_HOUR_EVENING = [16, 17, 18, 19]

# ---------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class CleanConfig:
    """Switches of the cleaning chain."""

    use_iqr_filter: bool = USE_IQR_SPEED_FILTER
    use_quality_gate: bool = KEEP_QUALITY_COLUMNS
    iqr_k: float = IQR_FENCE_K
    iqr_min_trips: int = IQR_MIN_TRIPS_PER_ZONE
    check_month: bool = True


@dataclass(frozen=True)
class ClusterConfig:
    """Switches of the clustering stage."""

    k: int | None = None
    k_range: tuple[int, int] = K_RANGE
    n_init: int = KMEANS_N_INIT
    max_iter: int = KMEANS_MAX_ITER
    seed: int = KMEANS_RANDOM_STATE
    scaler: str = SCALER_TYPE
    use_dbscan: bool = False
    features: list[str] = field(default_factory=lambda: list(CLUSTER_FEATURES))
    k_rule: str = "elbow"  # "elbow" or "combined"
