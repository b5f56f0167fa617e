"""Dashboard panels as DataFrame functions ``f(mart, params)``.

One widget setting is a :class:`ViewParams`; every panel is a function of
the (cached) mart and those parameters.  Nothing is collected: panels
that need a whole-mart figure (overall mean speed, maximum density, the
level list) get it as a one-row aggregate joined back by broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonepace import config as C
from zonepace.functions.frames import attach_row

# FIXED VALUES: severity palettes and level descriptors of the dashboard.
DISTINCT_SEVERITY_PALETTE = [
    "#2ecc71", "#16a085", "#3498db", "#9b59b6", "#f1c40f", "#f39c12",
    "#e67e22", "#e74c3c", "#c0392b", "#7f1d1d", "#581c87", "#1f2937",
]
RAMP_4 = ["#2ecc71", "#f1c40f", "#e67e22", "#c0392b"]
RAMP_6 = ["#2ecc71", "#7ed957", "#f1c40f", "#f39c12", "#e67e22", "#c0392b"]
# Beyond 12 levels: a 24-colour qualitative set, then grey.
QUALITATIVE_24 = [
    "#2E91E5", "#E15F99", "#1CA71C", "#FB0D0D", "#DA16FF", "#222A2A", "#B68100", "#750D86",
    "#EB663B", "#511CB5", "#00A08B", "#FB00D1", "#FC0080", "#B2828D", "#6C7C32", "#778AAE",
    "#862A16", "#A777F1", "#620042", "#1616A7", "#DA60CA", "#6C4516", "#0D2A63", "#AF0038",
]
LABELS_3 = ["Low", "Medium", "High"]
LABELS_4 = ["Low", "Moderate", "High", "Severe"]
DESCRIPTORS = ["Free-flow", "Light", "Light–Mod", "Moderate", "Mod–Heavy", "Heavy",
               "Heavy–Severe", "Severe", "Gridlock", "Extreme", "Critical", "Off-scale"]
PALETTE_ALPHA = 210
DEFAULT_RGBA = [127, 140, 141, 180]


@dataclass(frozen=True)
class ViewParams:
    hour: int = 8
    day_filter: str = "All Days"  # "All Days" | "Weekdays Only" | "Weekends Only"
    days: list[int] = field(default_factory=list)
    focus_level: int = -1


def _palette_rows(n: int) -> list[tuple[int, str, str, int]]:
    """(position, label, hex, alpha) for n sorted levels — a rule over n, ≤ n rows."""
    if n == 4:
        cols = RAMP_4
    elif n == 6:
        cols = RAMP_6
    elif n <= len(DISTINCT_SEVERITY_PALETTE):
        cols = DISTINCT_SEVERITY_PALETTE[:n]
    else:
        cols = QUALITATIVE_24[:n] + [C.DEFAULT_HEX] * max(0, n - len(QUALITATIVE_24))
    rows = []
    for i in range(n):
        if n == 3:
            label = LABELS_3[i]
        elif n == 4:
            label = LABELS_4[i]
        elif i < len(DESCRIPTORS):
            label = DESCRIPTORS[i]
        else:
            label = None  # "Level {lvl}" filled from the level itself
        rows.append((i, label, cols[i], PALETTE_ALPHA))
    return rows


def severity_dim(mart: DataFrame) -> DataFrame:
    """Palette for whatever levels the mart holds: (level, label, hex, r, g, b, a).

    Levels are ranked with a window over the distinct levels (k rows);
    the palette for every possible k up to that count is a small rule
    table joined on (k, position).  The canonical k = 3 set {0, 1, 2} uses
    the configured names, colours and RGBA.
    """
    spark: SparkSession = mart.sparkSession
    levels = mart.select("congestion_level").distinct()
    w = Window.orderBy("congestion_level")
    ranked = levels.select("congestion_level", (F.row_number().over(w) - 1).alias("pos"),
                           F.count(F.lit(1)).over(Window.partitionBy()).alias("k"),
                           F.min("congestion_level").over(Window.partitionBy()).alias("_min"),
                           F.max("congestion_level").over(Window.partitionBy()).alias("_max"))
    # The rule depends on k alone; its rows are as many as the mart has levels.
    k_levels = levels.count()
    rule = [(k_levels, *r) for r in _palette_rows(k_levels)]
    pal = spark.createDataFrame(rule, "k int, pos int, label string, hex string, alpha int")
    j = ranked.join(F.broadcast(pal), ["k", "pos"], "left")
    canonical = (F.col("k") == 3) & (F.col("_min") == 0) & (F.col("_max") == 2)
    cfg_rgba = F.create_map(*[x for lv, v in C.CONGESTION_RGBA_COLORS.items()
                              for x in (F.lit(lv), F.array(*[F.lit(c) for c in v]))])
    hexv = F.coalesce(F.col("hex"), F.lit(C.DEFAULT_HEX))
    from zonepace.functions import scalar as S
    rgba_generic = F.array(S.hex_channel(hexv, 0), S.hex_channel(hexv, 1), S.hex_channel(hexv, 2),
                           F.coalesce(F.col("alpha"), F.lit(PALETTE_ALPHA)))
    rgba = F.when(canonical, F.element_at(cfg_rgba, F.col("congestion_level"))).otherwise(rgba_generic)
    return j.select(
        "congestion_level",
        F.when(canonical, S.level_label()).otherwise(
            F.coalesce(F.col("label"), F.concat(F.lit("Level "), F.col("congestion_level").cast("string")))).alias("label"),
        F.when(canonical, S.level_hex()).otherwise(hexv).alias("hex"),
        rgba[0].alias("r"), rgba[1].alias("g"), rgba[2].alias("b"), rgba[3].alias("a"),
    )


def view_predicate(p: ViewParams):
    """Hour, weekday/weekend type, weekday list, cluster focus as one condition."""
    keep = F.col("hour_of_day") == p.hour
    if p.day_filter == "Weekdays Only":
        keep = keep & ~F.col("is_weekend")
    elif p.day_filter == "Weekends Only":
        keep = keep & F.col("is_weekend")
    if p.days:
        keep = keep & F.col("day_of_week").isin(list(p.days))
    if p.focus_level >= 0:
        keep = keep & (F.col("congestion_level") == p.focus_level)
    return keep


def apply_filters(mart: DataFrame, p: ViewParams) -> DataFrame:
    """The rows of a view."""
    return mart.where(view_predicate(p))


def insights(mart: DataFrame) -> DataFrame:
    """Peak hours (top 3), top zones (top 5) by mean level, level shares, overall speed,
    total density — long form (insight, rank, key, value) (A10)."""
    def top(key: str, n: int, name: str) -> DataFrame:
        agg = mart.groupBy(key).agg(F.avg("congestion_level").alias("value"))
        w = Window.orderBy(F.col("value").desc(), F.col(key).asc())
        return (agg.orderBy(F.col("value").desc(), F.col(key).asc()).limit(n)
                .select(F.lit(name).alias("insight"), F.row_number().over(w).alias("rank"),
                        F.col(key).cast("long").alias("key"), "value"))
    shares = mart.groupBy("congestion_level").agg(F.count(F.lit(1)).alias("_n")).select(
        F.lit("level_pct").alias("insight"), F.lit(None).cast("int").alias("rank"),
        F.col("congestion_level").cast("long").alias("key"),
        (F.lit(100.0) * F.col("_n") / F.sum("_n").over(Window.partitionBy())).alias("value"))
    overall = mart.agg(F.avg("avg_speed_mph").alias("s"), F.sum("trip_density").alias("d"))
    tail = overall.selectExpr("stack(2, 'overall_avg_speed', s, 'total_density', cast(d as double)) as (insight, value)") \
        .select("insight", F.lit(None).cast("int").alias("rank"), F.lit(None).cast("long").alias("key"), "value")
    return top("hour_of_day", 3, "peak_hour").unionByName(top("zone_id", 5, "top_zone")) \
        .unionByName(shares).unionByName(tail)


def kpi_row(mart: DataFrame, p: ViewParams) -> DataFrame:
    """Filter mean speed, delta to all, zones, high-level share, total trips.

    High threshold = the level at position int(0.66·#levels) of the
    sorted level list; an empty filter gives 0.0 speed and 0 %.
    """
    info = mart.agg(F.array_sort(F.collect_set("congestion_level")).alias("_levels"), F.avg("avg_speed_mph").alias("_all"))
    thr = F.element_at(F.col("_levels"), (F.floor(F.size("_levels") * F.lit(0.66)) + 1).cast("int"))
    # One pass over the facts' row and one over the mart: the view is a condition inside the aggregate.
    keep = view_predicate(p)
    return attach_row(mart, info.select("_all", thr.alias("_thr"))).agg(
        F.count_if(keep).alias("n_obs"),
        F.count_distinct(F.when(keep, F.col("zone_id"))).alias("n_zones"),
        F.avg(F.when(keep, F.col("avg_speed_mph"))).alias("_avg"),
        F.count_if(keep & (F.col("congestion_level") >= F.col("_thr"))).alias("_n_high"),
        F.sum(F.when(keep, F.col("trip_density"))).alias("_trips"),
        F.max("_all").alias("avg_speed_overall"), F.max("_thr").alias("high_threshold"),
    ).select(
        "n_obs", "n_zones",
        F.coalesce(F.col("_avg"), F.lit(0.0)).alias("avg_speed_filtered"),
        "avg_speed_overall",
        (F.coalesce(F.col("_avg"), F.lit(0.0)) - F.col("avg_speed_overall")).alias("delta_speed"),
        "high_threshold",
        (F.lit(100.0) * F.col("_n_high") / F.greatest(F.col("n_obs"), F.lit(1))).alias("pct_high"),
        F.coalesce(F.col("_trips"), F.lit(0)).cast("long").alias("total_trips"),
    )


def auto_story(mart: DataFrame, p: ViewParams, labels: DataFrame | None = None) -> DataFrame:
    """Narrative facts and the one-paragraph story of a view."""
    f = apply_filters(mart, p)
    labels = labels if labels is not None else severity_dim(mart)
    overall = mart.agg(F.avg("avg_speed_mph").alias("_all"), F.max("congestion_level").alias("_maxlvl"))
    # A global aggregate: one row even for an empty view.
    facts = attach_row(f, overall).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_distinct("zone_id").alias("n_zones"),
        F.avg("avg_speed_mph").alias("avg_speed"),
        F.avg("speed_deviation").alias("avg_dev"),
        F.mode("congestion_level", deterministic=True).alias("dom_level"),
        F.try_divide(F.lit(100.0) * F.count_if(F.col("congestion_level") >= F.col("_maxlvl") - 1),
                     F.count(F.lit(1))).alias("pct_high"),
        F.first("_all").alias("_all"),
    ).withColumn("delta", F.col("avg_speed") - F.col("_all"))
    facts = facts.join(F.broadcast(labels.select(F.col("congestion_level").alias("dom_level"),
                                                 F.col("label").alias("dom_label"))), "dom_level", "left")
    d, dev = F.col("delta"), F.col("avg_dev")
    # Numbers are rounded half-up before printing so every printf agrees on ties.
    r1 = lambda x: F.floor(x * 10.0 + 0.5) / 10.0
    speed_phrase = (F.when(d > 1, F.format_string("%.1f mph faster than the all-day average", r1(F.abs(d))))
                    .when(d < -1, F.format_string("%.1f mph slower than the all-day average", r1(F.abs(d))))
                    .otherwise(F.lit("close to the all-day average")))
    dev_phrase = (F.when(dev > 1, F.lit("zones are moving above their typical baseline — uncongested"))
                  .when(dev < -1, F.lit("zones are moving below their typical baseline — congested"))
                  .otherwise(F.lit("zones are at their typical baseline speed")))
    dom_label = F.coalesce(F.col("dom_label"), F.concat(F.lit("Level "), F.col("dom_level").cast("string")))
    story = F.format_string(
        "At %02d:00 (%s), %d zones are active. Average speed is %.1f mph, %s, and %s. "
        "The dominant cluster is %s, and %.0f%% of observations sit in the highest one-or-two congestion levels.",
        F.lit(p.hour), F.lit(p.day_filter.lower()), F.col("n_zones"), r1(F.col("avg_speed")), speed_phrase,
        dev_phrase, dom_label, F.floor(F.col("pct_high") + 0.5).cast("double"))
    empty = F.col("_n") == 0
    return facts.select("n_zones", "avg_speed", "delta", "avg_dev", "dom_level",
                        F.when(empty, F.lit(None)).otherwise(dom_label).alias("dom_label"),
                        "pct_high", F.when(empty, F.lit(None)).otherwise(speed_phrase).alias("speed_phrase"),
                        F.when(empty, F.lit(None)).otherwise(dev_phrase).alias("dev_phrase"),
                        F.when(empty, F.lit("No data matches this filter.")).otherwise(story).alias("story"))


def top_zones_dashboard(mart: DataFrame, p: ViewParams, labels: DataFrame | None = None, n: int = 15) -> DataFrame:
    """Top zones of the view by mean level; half-even rounded level clipped to the
    palette's level range picks the colour (W6)."""
    f = apply_filters(mart, p)
    labels = labels if labels is not None else severity_dim(mart)
    rng = labels.agg(F.min("congestion_level").alias("_lo"), F.max("congestion_level").alias("_hi"))
    agg = f.groupBy("zone_id").agg(F.avg("congestion_level").alias("avg_level"),
                                   F.avg("avg_speed_mph").alias("avg_speed"),
                                   F.sum("trip_density").alias("density"))
    order = [F.col("avg_level").desc(), F.col("zone_id").asc()]
    top = agg.orderBy(*order).limit(n).withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    top = attach_row(top, rng).withColumn(
        "lvl_int", F.least(F.greatest(F.rint("avg_level").cast("int"), F.col("_lo")), F.col("_hi")))
    top = top.join(F.broadcast(labels.select(F.col("congestion_level").alias("lvl_int"), F.col("hex"))), "lvl_int", "left")
    return top.select("rank", "zone_id", "avg_level", "avg_speed", "density", "lvl_int",
                      F.coalesce(F.col("hex"), F.lit("#e74c3c")).alias("color"),
                      F.concat(F.lit("Zone "), F.col("zone_id").cast("string")).alias("label"))


def map_points(mart: DataFrame, centroids: DataFrame, p: ViewParams, labels: DataFrame | None = None) -> DataFrame:
    """View rows placed on zone centroids, with colour and marker radius.

    Zones without a centroid are dropped (left join + drop = inner).  The
    centroid table has one row per zone id (≤ 263), so it is broadcast; the
    maximum density of the view is a one-row aggregate joined back, never
    an unpartitioned window over all rows.
    """
    f = apply_filters(mart, p)
    labels = labels if labels is not None else severity_dim(mart)
    m = f.join(F.broadcast(centroids.select("zone_id", "latitude", "longitude")), "zone_id", "inner")
    m = m.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    mx = m.agg(F.max("trip_density").alias("_max"))
    m = attach_row(m, mx).join(
        F.broadcast(labels.select("congestion_level", "label", "r", "g", "b", "a")), "congestion_level", "left")
    radius = F.when(F.col("_max") > 0, F.least(F.greatest(
        F.col("trip_density") / F.col("_max") * 350.0 + 140.0, F.lit(140.0)), F.lit(580.0))).otherwise(F.lit(180.0))
    return m.select(*C.CELL_KEY, "congestion_level", "latitude", "longitude", "trip_density",
                    F.coalesce("r", F.lit(DEFAULT_RGBA[0])).alias("r"), F.coalesce("g", F.lit(DEFAULT_RGBA[1])).alias("g"),
                    F.coalesce("b", F.lit(DEFAULT_RGBA[2])).alias("b"), F.coalesce("a", F.lit(DEFAULT_RGBA[3])).alias("a"),
                    F.coalesce(F.col("label"), F.col("congestion_level").cast("string")).alias("label"),
                    radius.alias("radius"))


def filtered_table(mart: DataFrame, p: ViewParams, labels: DataFrame | None = None) -> DataFrame:
    """The raw-data panel: view rows sorted by level descending, 7 display columns."""
    f = apply_filters(mart, p)
    labels = labels if labels is not None else severity_dim(mart)
    j = f.join(F.broadcast(labels.select("congestion_level", F.col("label").alias("congestion_label_dynamic"))),
               "congestion_level", "left")
    return j.orderBy(F.col("congestion_level").desc(), "zone_id", "day_of_week").select(
        "zone_id", "hour_of_day", "day_name", "congestion_label_dynamic", "avg_speed_mph", "trip_density",
        "speed_deviation", "congestion_level")
