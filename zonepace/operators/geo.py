"""Zone centroids from polygon vertices (G1, re-aimed from a shapefile reader).

Input: one row per vertex (zone_id, ring, seq, x, y); rings are closed
implicitly (last vertex connects to the first).  Outer rings and holes
carry their own orientation: a hole wound opposite to its outer ring has
negative signed area and is subtracted.  Shoelace sums per ring are a
``lead`` over (zone, ring) ordered by seq, then a grouped sum per zone —
planar coordinates in, planar centroid out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def polygon_centroids(vertices: DataFrame) -> DataFrame:
    """(zone_id, area, longitude, latitude) with x → longitude, y → latitude."""
    w = Window.partitionBy("zone_id", "ring").orderBy("seq")
    first = Window.partitionBy("zone_id", "ring").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    v = vertices.withColumns({
        "x2": F.coalesce(F.lead("x").over(w), F.first("x").over(first)),
        "y2": F.coalesce(F.lead("y").over(w), F.first("y").over(first)),
    })
    cross = F.col("x") * F.col("y2") - F.col("x2") * F.col("y")
    agg = v.groupBy("zone_id").agg(
        (F.sum(cross) / 2.0).alias("area"),
        F.sum((F.col("x") + F.col("x2")) * cross).alias("_cx"),
        F.sum((F.col("y") + F.col("y2")) * cross).alias("_cy"),
    )
    return agg.select("zone_id", "area", (F.col("_cx") / (6.0 * F.col("area"))).alias("longitude"),
                      (F.col("_cy") / (6.0 * F.col("area"))).alias("latitude"))
