"""Chart tables and the visualisation mart.

Every table a chart or dashboard panel draws is a DataFrame function of
the labelled cell table or of the cleaned trips.  Inputs at cell grain
are bounded by construction (≤ 263 zones × 24 hours × 7 days); trip-grain
inputs use partial aggregation and the skew-safe exact quantiles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonepace import config as C
from zonepace.functions import scalar as S
from zonepace.operators.quantile import exact_quantiles
from zonepace.functions.frames import attach_row


# ---- labels and the mart ----------------------------------------------------

def assign_semantic_labels(df: DataFrame, raw_col: str = "raw_cluster",
                           speed_col: str = "avg_speed_mph") -> DataFrame:
    """Rank raw cluster ids by mean speed: fastest → 0 … slowest → k−1.

    The ranking table has one row per raw cluster (k rows), so the join
    back is a broadcast; ties in mean speed go to the lower raw id.
    """
    speeds = df.groupBy(raw_col).agg(F.avg(speed_col).alias("_mean_speed"))
    w = Window.orderBy(F.col("_mean_speed").desc(), F.col(raw_col).asc())  # k rows only
    remap = speeds.select(raw_col, (F.row_number().over(w) - 1).alias("congestion_level"))
    return df.join(F.broadcast(remap), on=raw_col).drop(raw_col)


def build_viz_data(df: DataFrame) -> DataFrame:
    """One row per cell key: modal level, mean speed, summed density, mean deviation, tags (A4)."""
    if "is_weekend" not in df.columns and "day_of_week" in df.columns:
        df = df.withColumn("is_weekend", F.col("day_of_week") >= 5)
    for c in C.CELL_KEY:
        if c not in df.columns:
            raise KeyError(f"Expected column '{c}' missing from cluster labels")
    aggs = [
        F.mode("congestion_level", deterministic=True).alias("congestion_level"),
        F.avg("avg_speed_mph").alias("avg_speed_mph"),
        F.sum("trip_density").alias("trip_density"),
        F.avg("speed_deviation").alias("speed_deviation"),
    ]
    for c in ("is_airport", "is_cbd", "is_rush_hour"):
        if c in df.columns:
            aggs.append(F.first(c, ignorenulls=True).alias(c))
    viz = df.groupBy(*C.CELL_KEY).agg(*aggs)
    return viz.withColumns({
        "congestion_label": S.level_label(),
        "color_hex": S.level_hex(),
        "day_name": S.day_name_short(),
    })


# ---- aggregations over the mart ---------------------------------------------

def hourly_trend(viz: DataFrame) -> DataFrame:
    """Mean speed, density and deviation per hour (A5)."""
    return viz.groupBy("hour_of_day").agg(
        F.avg("avg_speed_mph").alias("avg_speed"),
        F.avg("trip_density").alias("avg_density"),
        F.avg("speed_deviation").alias("avg_deviation"),
    )


def cluster_distribution(viz: DataFrame) -> DataFrame:
    """Cells per level in level order, with label and colour."""
    return viz.groupBy("congestion_level").agg(F.count(F.lit(1)).alias("count")).withColumns({
        "label": S.level_label(), "color": S.level_hex(),
    })


def level_distribution(view: DataFrame, levels: DataFrame) -> DataFrame:
    """Cells of a filtered view per level of the palette ``levels``, zero where the view has none."""
    counts = view.groupBy("congestion_level").agg(F.count(F.lit(1)).alias("count"))
    return levels.select("congestion_level", "label", F.col("hex").alias("color")).join(F.broadcast(counts), "congestion_level", "left").select(
        "congestion_level", F.coalesce("count", F.lit(0)).alias("count"), "label", "color")


def day_hour_heatmap(viz: DataFrame, value: str = "congestion_level") -> DataFrame:
    """Weekday × hour matrix of the mean ``value`` (W1, W2); hours are fixed, no distinct pass."""
    p = viz.groupBy("day_of_week").pivot("hour_of_day", list(range(24))).agg(F.avg(value))
    return p.select("day_of_week", S.day_name_short().alias("day_name"),
                    *[F.col(str(h)).alias(f"h{h:02d}") for h in range(24)])


def _top_k(df: DataFrame, key: str, metric: Column, n: int, desc: bool = True) -> DataFrame:
    """Top-n keys by ``metric`` with the key as final tie-break (TakeOrderedAndProject)."""
    agg = df.groupBy(key).agg(metric.alias("_m"))
    order = [F.col("_m").desc() if desc else F.col("_m").asc(), F.col(key).asc()]
    w = Window.orderBy(*order)
    return agg.orderBy(*order).limit(n).withColumn("rank", F.row_number().over(w))


def top_congested_zones(viz: DataFrame, top_n: int = 20) -> DataFrame:
    """Zones with the highest mean level; colour of min(2, round-half-even(mean))."""
    t = _top_k(viz, "zone_id", F.avg("congestion_level"), top_n).withColumnRenamed("_m", "congestion_level")
    lvl = F.least(F.lit(2), F.rint("congestion_level").cast("int"))
    return t.withColumn("color", S.level_hex(lvl))


def zone_hour_heatmap(viz: DataFrame, top_n: int = 40, by: str = "density") -> DataFrame:
    """Top zones × hour matrix of mean level, zones in ranking order.

    ``by="density"``: top by summed trip density; ``by="level"``: by mean level.
    The top-n table is tiny, so the semi join is a broadcast.
    """
    metric = F.sum("trip_density") if by == "density" else F.avg("congestion_level")
    top = _top_k(viz, "zone_id", metric, top_n).select("zone_id", F.col("rank").alias("zone_rank"))
    sub = viz.join(F.broadcast(top.select("zone_id")), "zone_id", "left_semi")
    p = sub.groupBy("zone_id").pivot("hour_of_day", list(range(24))).agg(F.avg("congestion_level"))
    return F.broadcast(top).join(p, "zone_id").select(
        "zone_rank", "zone_id", *[F.col(str(h)).alias(f"h{h:02d}") for h in range(24)])


def cluster_profile(labelled: DataFrame) -> DataFrame:
    """Per-level means z-scored across levels (population std; 0 → 1).

    The across-level window runs over k rows only.  Level means are rounded
    to 1e-9 first: a feature whose level means are all ~0 (the deviation is
    centred per zone-hour) would otherwise have its float noise blown up to
    ±1 by the z-score.
    """
    feats = [f for f in ["avg_speed_mph", "speed_deviation", "log_trip_density", "trip_density", "hour_of_day"]
             if f in labelled.columns]
    r9 = lambda x: F.floor(x * F.lit(1e9) + F.lit(0.5)).cast("double") / F.lit(1e9)
    means = labelled.groupBy("congestion_level").agg(*[r9(F.avg(f)).alias(f) for f in feats])
    w = Window.partitionBy()
    out = [F.col("congestion_level")]
    for f in feats:
        sd = F.stddev_pop(f).over(w)
        out.append(((F.col(f) - F.avg(f).over(w)) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)).alias(f"z_{f}"))
    return means.select(*out)


def cluster_summary(viz: DataFrame) -> DataFrame:
    """Per level: rows, distinct zones, mean speed / deviation / density, weekend share."""
    return viz.groupBy("congestion_level").agg(
        F.count(F.lit(1)).alias("n_obs"),
        F.count_distinct("zone_id").alias("n_zones"),
        F.avg("avg_speed_mph").alias("avg_speed"),
        F.avg("speed_deviation").alias("avg_dev"),
        F.avg("trip_density").alias("avg_density"),
        F.avg(F.col("is_weekend").cast("double")).alias("wknd_share"),
    )


def centroid_means(labelled: DataFrame, features: list[str] | None = None) -> DataFrame:
    """Level means of the clustering features (original units) + speed + density,
    rounded half-even to 3 places (A13)."""
    feats = (features or C.CLUSTER_FEATURES) + ["avg_speed_mph", "trip_density"]
    return labelled.groupBy("congestion_level").agg(
        *[(F.rint(F.avg(F.col(f).cast("double")) * 1000.0) / 1000.0).alias(f) for f in feats])


def mart_header(viz: DataFrame) -> DataFrame:
    """Rows, distinct zones, number of levels and the ordered level list."""
    return viz.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("zone_id").alias("n_zones"),
        F.count_distinct("congestion_level").alias("k"),
        F.array_join(F.array_sort(F.collect_set(F.col("congestion_level").cast("string").cast("int"))), ",").alias("levels"),
    )


def feature_correlation(cells: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Pearson r for every ordered pair of columns, long form."""
    cols = cols or ["avg_speed_mph", "trip_density", "speed_deviation", "hour_of_day"]
    aggs = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a in cols for b in cols]
    wide = cells.agg(*aggs)
    stack = ", ".join(f"'{a}', '{b}', `{a}|{b}`" for a in cols for b in cols)
    return wide.selectExpr(f"stack({len(cols) ** 2}, {stack}) as (feature_a, feature_b, r)")


# ---- trip-grain EDA tables --------------------------------------------------

def describe(trips: DataFrame, cols: list[str],
             probs=(0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)) -> DataFrame:
    """count/mean/std(ddof 1)/min/percentiles/max per column, long form.

    The columns are unpivoted to (column, value); moments are one partial
    aggregate, percentiles come from the skew-safe exact operator.
    """
    stack = ", ".join(f"'{c}', cast(`{c}` as double)" for c in cols)
    long = trips.selectExpr(f"stack({len(cols)}, {stack}) as (column, value)").where(
        F.col("value").isNotNull() & ~F.isnan("value"))
    moments = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    names = [f"p{int(round(p * 100)):02d}" for p in probs]
    qs = exact_quantiles(long, ["column"], "value", list(probs), names)
    return moments.join(qs, "column")


def histogram(df: DataFrame, value: Column, bins: int, lo: float | None = None, hi: float | None = None,
              group_cols: list[str] | None = None, density: bool = False) -> DataFrame:
    """Equal-width histogram per group, every bin listed (H1–H6).

    Range = [lo, hi] when given (values outside dropped, last bin closed),
    else the group's own min/max (numpy's default; a constant group gets
    [v−0.5, v+0.5]).  ``density`` divides by n·width.  Bin index =
    floor((x−lo)·(bins/(hi−lo))), clamped to the last bin.
    """
    g = list(group_cols or [])
    v = df.select(*g, value.cast("double").alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    if lo is None or hi is None:
        rng = v.groupBy(*g).agg(F.min("_x").alias("_lo0"), F.max("_x").alias("_hi0"))
        rng = rng.select(*g,
                         F.when(F.col("_lo0") == F.col("_hi0"), F.col("_lo0") - 0.5).otherwise(F.col("_lo0")).alias("_lo"),
                         F.when(F.col("_lo0") == F.col("_hi0"), F.col("_hi0") + 0.5).otherwise(F.col("_hi0")).alias("_hi"))
        v = v.join(F.broadcast(rng), g) if g else attach_row(v, rng)
    else:
        rng = None
        v = v.withColumns({"_lo": F.lit(float(lo)), "_hi": F.lit(float(hi))})
        v = v.where((F.col("_x") >= F.col("_lo")) & (F.col("_x") <= F.col("_hi")))
    idx = F.floor((F.col("_x") - F.col("_lo")) * (F.lit(float(bins)) / (F.col("_hi") - F.col("_lo"))))
    idx = F.least(idx, F.lit(bins - 1))
    counts = v.groupBy(*g, idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    if rng is None:
        dims = df.sparkSession.range(bins).select(F.col("id").alias("bin"),
                                                  F.lit(float(lo)).alias("_lo"), F.lit(float(hi)).alias("_hi"))
        if g:
            dims = v.select(*g).distinct().crossJoin(dims)  # groups × bins: the histogram's own size
    else:
        dims = rng.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("_b")) \
            .withColumn("bin", F.col("_b").cast("long")).drop("_b")
    out = dims.join(counts, [*g, "bin"], "left").fillna(0, ["count"])
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    out = out.withColumns({
        "bin_lo": F.col("_lo") + F.col("bin") * width,
        "bin_hi": F.when(F.col("bin") == bins - 1, F.col("_hi")).otherwise(F.col("_lo") + (F.col("bin") + 1) * width),
    })
    if density:
        n = F.sum("count").over(Window.partitionBy(*g)) if g else F.sum("count").over(Window.partitionBy())
        out = out.withColumn("density", F.col("count") / (n * width))
    return out.drop("_lo", "_hi")


def box_stats(df: DataFrame, value: Column) -> DataFrame:
    """Box-plot numbers: quartiles, 1.5·IQR whiskers at the extreme data inside, fliers (H4)."""
    v = df.select(value.cast("double").alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    q = exact_quantiles(v, [], "_x", [0.25, 0.5, 0.75], ["q1", "median", "q3"], with_count=True)
    j = attach_row(v, q)
    iqr = F.col("q3") - F.col("q1")
    lo_f, hi_f = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    return j.groupBy("q1", "median", "q3", "n").agg(
        F.min(F.when(F.col("_x") >= lo_f, F.col("_x"))).alias("whisker_lo"),
        F.max(F.when(F.col("_x") <= hi_f, F.col("_x"))).alias("whisker_hi"),
        F.count_if((F.col("_x") < lo_f) | (F.col("_x") > hi_f)).alias("n_fliers"),
        F.avg("_x").alias("mean"),
    )


def monthly_trend(features: DataFrame) -> DataFrame:
    """Per month file: mean, exact median and count of trip speed."""
    sp = features.select("file_ym", "speed_mph")
    base = sp.groupBy("file_ym").agg(F.avg("speed_mph").alias("avg_speed"), F.count("speed_mph").alias("n_trips"))
    med = exact_quantiles(sp, ["file_ym"], "speed_mph", [0.5], ["median_speed"])
    return base.join(med, "file_ym", "left")


def deviation_histogram(viz: DataFrame, bins: int = 59) -> DataFrame:
    """Per-level histogram of deviation over [q0.005, q0.995] of all cells (H1).

    The two global quantiles come from ``percentile`` on the mart, which is
    bounded by construction; they are joined back as a one-row broadcast.
    """
    qs = viz.agg(F.percentile("speed_deviation", [0.005, 0.995]).alias("_q"))
    lo, hi = F.col("_q")[0], F.col("_q")[1]
    v = attach_row(viz, qs).select("congestion_level", "speed_deviation", lo.alias("_lo"), hi.alias("_hi"))
    v = v.where((F.col("speed_deviation") >= F.col("_lo")) & (F.col("speed_deviation") <= F.col("_hi")))
    idx = F.least(F.floor((F.col("speed_deviation") - F.col("_lo")) * (F.lit(float(bins)) / (F.col("_hi") - F.col("_lo")))),
                  F.lit(bins - 1))
    return v.groupBy("congestion_level", idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))


def density_deviation_points(viz: DataFrame) -> DataFrame:
    """Scatter rows: density clipped at the global p99, deviation, level (H7)."""
    p99 = viz.agg(F.percentile("trip_density", 0.99).alias("_p99"))
    return attach_row(viz, p99).select(
        *C.CELL_KEY, "congestion_level",
        F.least(F.greatest(F.col("trip_density").cast("double"), F.lit(0.0)), F.col("_p99")).alias("density_clipped"),
        "speed_deviation")


def density_deviation_clipped(cells: DataFrame, density: float = 500.0, deviation: float = 20.0) -> DataFrame:
    """The exploratory scatter: density clipped to [0, 500], deviation to ±20 (H7)."""
    return cells.select(*C.CELL_KEY, S.clip(F.col("trip_density").cast("double"), 0.0, density).alias("density_clipped"),
                        S.clip(F.col("speed_deviation"), -deviation, deviation).alias("deviation_clipped"))
