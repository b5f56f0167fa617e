"""DBSCAN on sub-cells.

Space is cut into sub-cells of side just under ε/√d, so all points of one lie within ε of
each other.  A sub-cell is one row: its number of points, smallest point and bounding box.

1. Pairs of sub-cells whose boxes come within ε are found by an equi-join on coarse buckets
   (as wide as a neighbour can be away, half of the 3^d offsets probed).  A pair whose boxes lie
   wholly within ε is *full*: every point of one sees every point of the other, and no
   distance is ever computed.  The rest are *partial*.
2. Neighbour counts (D1): full pairs add whole counts.  For partial pairs the points meet in
   packs (at most about ``PACK`` points, a large sub-cell is salted into several), and a
   task adds up hits per point before anything is shuffled.  No pair of points leaves a task.
3. Clusters (D2): a sub-cell with ``min_samples`` points is all core, so only the points of
   smaller ones are counted.  The core points of a sub-cell are one node; full pairs link their
   nodes, partial ones if any two core points lie within ε.  Components are found over
   sub-cells, not points, and numbered by their smallest core point.  A border point joins the
   smallest-numbered cluster that has a core point within ε; the rest is noise (−1).
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepace import config as C
from zonepace.functions.frames import attach_row
from zonepace.functions.ranking import row_numbers

PACK = 256  # points of a pack
TILE = 500_000  # distances computed at once in a task
_SLACK = 1e-9  # boxes this near to ε are settled by their points


def _points(df: DataFrame, key: list[str], features: list[str], id_col: str | None) -> DataFrame:
    """(pid, x0.., the key columns): ``pid`` is a long in the order of the key."""
    cols = [*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)], *[F.col(k) for k in key if k != id_col]]
    if id_col:
        return df.select(F.col(id_col).cast("long").alias("pid"), *cols)
    named = df.select(F.struct(*[F.col(k) for k in key]).alias("_key"), *cols)
    return row_numbers(named, [], ["_key"], "pid").withColumn("pid", F.col("pid").cast("long")).drop("_key")


class Grid:
    """The points of a table, their sub-cells, and the pairs of sub-cells within ε."""

    def __init__(self, df: DataFrame, key: list[str], features: list[str], eps: float, id_col: str | None = None):
        self.key, self.eps, self.d = key, eps, len(features)
        self.xs = [f"x{i}" for i in range(self.d)]
        side = eps / math.sqrt(self.d) * (1 - 10 * _SLACK)
        at = [f"c{i}" for i in range(self.d)]
        named = _points(df, key, features, id_col).withColumns({c: F.floor(F.col(x) / F.lit(side)) for c, x in zip(at, self.xs)})
        named = named.checkpoint(eager=True)
        self.cells = named.groupBy(*at).agg(
            F.min("pid").alias("sub"), F.count(F.lit(1)).alias("n"),
            *[F.min(x).alias(f"lo{i}") for i, x in enumerate(self.xs)], *[F.max(x).alias(f"hi{i}") for i, x in enumerate(self.xs)]).checkpoint(eager=True)
        self.points = named.join(self.cells.select(*at, "sub", "n"), at).drop(*at).checkpoint(eager=True)
        self.pairs = self._cell_pairs(at).checkpoint(eager=True)

    def _cell_pairs(self, at: list[str]) -> DataFrame:
        """(a, b, na, nb, full): every two sub-cells within ε once, each with itself too."""
        reach = math.floor(math.sqrt(self.d) * (1 + 20 * _SLACK)) + 1
        coarse = self.cells.withColumns({f"b{i}": F.floor(F.col(c) / reach) for i, c in enumerate(at)}).drop(*at)
        half = [o for o in itertools.product([-1, 0, 1], repeat=self.d) if not any(o) or next(x for x in o if x) == 1]
        offsets = F.array(*[F.struct(*[F.lit(x).alias(f"o{i}") for i, x in enumerate(o)]) for o in half])
        buckets = [f"b{i}" for i in range(self.d)]
        facts = ["sub", "n", *[f"lo{i}" for i in range(self.d)], *[f"hi{i}" for i in range(self.d)]]
        left = coarse.withColumn("off", F.explode(offsets)).select(
            *[F.col(c).alias(f"l_{c}") for c in facts], *[(F.col(b) + F.col(f"off.o{i}")).alias(b) for i, b in enumerate(buckets)],
            F.expr(" + ".join(f"abs(off.o{i})" for i in range(self.d))).alias("away"))
        right = coarse.select(*[F.col(c).alias(f"r_{c}") for c in facts], *buckets)
        gap = [F.greatest(F.lit(0.0), F.col(f"r_lo{i}") - F.col(f"l_hi{i}"), F.col(f"l_lo{i}") - F.col(f"r_hi{i}")) for i in range(self.d)]
        span = [F.greatest(F.col(f"l_hi{i}") - F.col(f"r_lo{i}"), F.col(f"r_hi{i}") - F.col(f"l_lo{i}")) for i in range(self.d)]
        once = (F.col("away") > 0) | (F.col("l_sub") <= F.col("r_sub"))
        near = F.sqrt(sum(x * x for x in gap)) <= F.lit(self.eps * (1 + _SLACK))
        return left.join(right, buckets).where(once & near).select(
            F.col("l_sub").alias("a"), F.col("r_sub").alias("b"), F.col("l_n").alias("na"), F.col("r_n").alias("nb"),
            (F.sqrt(sum(x * x for x in span)) <= F.lit(self.eps * (1 - _SLACK))).alias("full"))

    def packs(self, points: DataFrame, side: str) -> DataFrame:
        """(side, pack_side): the points of each sub-cell in arrays of at most about ``PACK``."""
        chunk = F.pmod(F.xxhash64("pid"), F.ceil(F.col("n") / PACK))
        return points.groupBy(F.col("sub").alias(side), chunk.alias(f"chunk_{side}")).agg(
            F.collect_list(F.struct("pid", *self.xs)).alias(f"pack_{side}")).drop(f"chunk_{side}")

    def hits(self, pairs: DataFrame, left: DataFrame, right: DataFrame, emit, schema: str) -> DataFrame:
        """``emit(batch, rows, left ids, right ids)`` on the hits of the packs of each pair (a, b, ...) of sub-cells."""
        eps, d = self.eps, self.d
        met = pairs.join(self.packs(left, "a"), "a").join(self.packs(right, "b"), "b")

        def side(column):
            flat = column.flatten()
            bounds = np.asarray(column.offsets)
            return bounds[:-1] - bounds[0], np.diff(bounds), flat.field("pid").to_numpy(), [flat.field(f"x{i}").to_numpy() for i in range(d)]

        def compare(batches):
            for b in batches:
                (sa, na, ida, xa), (sb, nb, idb, xb) = side(b.column("pack_a")), side(b.column("pack_b"))
                size = na.astype(np.int64) * nb
                upto = np.cumsum(size)
                lo = 0
                while lo < len(size):
                    hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] - size[lo] + TILE, side="right")))
                    own = size[lo:hi]
                    row = np.repeat(np.arange(lo, hi), own)
                    nth = np.arange(len(row)) - np.repeat(np.cumsum(own) - own, own)
                    i, j = sa[row] + nth // nb[row], sb[row] + nth % nb[row]
                    far = np.zeros(len(row))
                    for p, q in zip(xa, xb):
                        diff = p[i] - q[j]
                        far += diff * diff
                    hit = np.flatnonzero(np.sqrt(far) <= eps)
                    if len(hit):
                        yield emit(b, row[hit], ida[i[hit]], idb[j[hit]])
                    lo = hi

        return met.mapInArrow(compare, schema)

    def counts(self, below: int | None = None) -> DataFrame:
        """(pid, sub, n, neighbors, key...): points within ε, the point itself included; with ``below``
        only for the points of sub-cells with fewer points than that."""
        pairs, points = self.pairs, self.points
        if below:
            pairs, points = pairs.where((F.col("na") < below) | (F.col("nb") < below)), points.where(F.col("n") < below)

        def add(batch, rows, left, right):
            pid, n = np.unique(np.concatenate([left, right]), return_counts=True)
            return pa.record_batch({"pid": pa.array(pid), "n": pa.array(n.astype(np.int64))})

        ends = F.when(F.col("a") == F.col("b"), F.array(F.struct(F.col("a").alias("sub"), F.col("nb").alias("more")))).otherwise(
            F.array(F.struct(F.col("a").alias("sub"), F.col("nb").alias("more")), F.struct(F.col("b").alias("sub"), F.col("na").alias("more"))))
        whole = pairs.where("full").select(F.inline(ends)).groupBy("sub").agg(F.sum("more").alias("whole"))
        some = self.hits(pairs.where("NOT full").select("a", "b"), self.points, self.points, add, "pid long, n long")
        some = some.groupBy("pid").agg(F.sum("n").alias("some"))
        return points.join(whole, "sub").join(some, "pid", "left").withColumn(
            "neighbors", F.col("whole") + F.coalesce("some", F.lit(0))).drop("whole", "some")


def neighbour_counts(df: DataFrame, key: list[str], features: list[str], eps: float = C.DBSCAN_EPS,
                     min_samples: int = C.DBSCAN_MIN_SAMPLES, id_col: str | None = None) -> DataFrame:
    """Key columns + neighbours (self included) + is_core."""
    counted = Grid(df, key, features, eps, id_col).counts()
    return counted.select(*key, "neighbors", (F.col("neighbors") >= min_samples).alias("is_core"))


def connected_components(edges: DataFrame, nodes: DataFrame, symmetric: bool = False) -> DataFrame:
    """(node, comp) with comp = smallest node id in the component.

    Contracting min-label propagation: each round every node takes the
    smallest label among itself and its neighbours, labels are pointer-
    jumped once (label of label), and the edge list is rewritten onto the
    new labels with self-loops and duplicates dropped.  The edge list
    shrinks as components merge, so late rounds touch few rows; the loop
    ends when no edge is left.  Labels and edges are checkpointed every
    round (reliable storage) to cut lineage.
    """
    lab = nodes.select("node", F.col("node").alias("comp"))
    e = edges.where(F.col("i") != F.col("j")).select("i", "j")
    if not symmetric:  # ε-pairs already hold both directions
        e = e.unionByName(e.select(F.col("j").alias("i"), F.col("i").alias("j"))).distinct()
    e = e.checkpoint(eager=True)
    while not e.isEmpty():
        # m(c) = min over c and its neighbours in the contracted graph.
        m = e.groupBy("i").agg(F.min("j").alias("mn")).select(
            F.col("i").alias("c"), F.least(F.col("i"), F.col("mn")).alias("m"))
        m = m.join(m.select(F.col("c").alias("m"), F.col("m").alias("m2")), "m", "left").select(
            "c", F.least(F.col("m"), F.coalesce(F.col("m2"), F.col("m"))).alias("m")).checkpoint(eager=True)
        lab = lab.join(m.withColumnRenamed("c", "comp"), "comp", "left").select(
            "node", F.coalesce(F.col("m"), F.col("comp")).alias("comp")).checkpoint(eager=True)
        mi = m.select(F.col("c").alias("i"), F.col("m").alias("mi"))
        mj = m.select(F.col("c").alias("j"), F.col("m").alias("mj"))
        e = (e.join(mi, "i", "left").join(mj, "j", "left")
             .select(F.coalesce(F.col("mi"), F.col("i")).alias("i"), F.coalesce(F.col("mj"), F.col("j")).alias("j"))
             .where(F.col("i") != F.col("j")).distinct().checkpoint(eager=True))
    return lab


def dbscan(df: DataFrame, key: list[str], features: list[str], eps: float = C.DBSCAN_EPS,
           min_samples: int = C.DBSCAN_MIN_SAMPLES, id_col: str | None = None) -> DataFrame:
    """Key columns + ``dbscan_label`` (−1 = noise).

    ``id_col``: optional unique long whose order equals the key order; without it the
    points are numbered in key order first.
    """
    grid = Grid(df, key, features, eps, id_col)
    counted = grid.counts(below=min_samples).select("pid", (F.col("neighbors") >= min_samples).alias("enough"))
    points = grid.points.join(counted, "pid", "left").withColumn("core", F.coalesce("enough", F.lit(True))).drop("enough").checkpoint(eager=True)
    core, border = points.where("core"), points.where("NOT core")
    nodes = core.groupBy("sub").agg(F.min("pid").alias("node")).checkpoint(eager=True)

    pairs = grid.pairs.where("a <> b").join(nodes.select(F.col("sub").alias("a"), F.col("node").alias("i")), "a").join(
        nodes.select(F.col("sub").alias("b"), F.col("node").alias("j")), "b")

    def linked(batch, rows, left, right):
        rows = pa.array(np.unique(rows))
        return pa.record_batch({c: batch.column(c).take(rows) for c in ("i", "j")})

    touching = grid.hits(pairs.where("NOT full").select("a", "b", "i", "j"), core, core, linked, "i long, j long")
    comps = connected_components(pairs.where("full").select("i", "j").unionByName(touching), nodes.select("node"))
    # Cluster numbers in order of each component's smallest core point (the component id itself).
    numbers = row_numbers(comps.select("comp").distinct(), [], ["comp"], "cluster").withColumn("cluster", F.col("cluster") - 1)
    clusters = nodes.join(comps.join(numbers, "comp"), "node").select("sub", "cluster").checkpoint(eager=True)

    # Border points: the smallest cluster among the sub-cells that hold a core point within ε.
    ways = grid.pairs.select("a", "b", "full").unionByName(grid.pairs.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "full"))
    ways = ways.join(border.select(F.col("sub").alias("a")).distinct(), "a").join(clusters.withColumnRenamed("sub", "b"), "b")

    def joined(batch, rows, left, right):
        cluster = batch.column("cluster").to_numpy()[rows]
        order = np.lexsort((cluster, left))
        first = order[np.append(True, np.diff(left[order]) != 0)]
        return pa.record_batch({"pid": pa.array(left[first]), "cluster": pa.array(cluster[first])})

    some = grid.hits(ways.where("NOT full").select("a", "b", "cluster"), border, core, joined, "pid long, cluster int")
    whole = border.select("pid", F.col("sub").alias("a")).join(ways.where("full").groupBy("a").agg(F.min("cluster").alias("cluster")), "a")
    reached = some.unionByName(whole.select("pid", "cluster")).groupBy("pid").agg(F.min("cluster").alias("reached"))
    found = points.join(clusters, "sub", "left").join(reached, "pid", "left")
    label = F.when(F.col("core"), F.col("cluster")).otherwise(F.coalesce("reached", F.lit(-1)))
    return found.select(*key, label.alias("dbscan_label"))


def dbscan_metrics(labels: DataFrame, eps: float = C.DBSCAN_EPS, min_samples: int = C.DBSCAN_MIN_SAMPLES) -> DataFrame:
    """Hotspots, noise count / fraction, warning, hotspot size min / max / median, largest label (D3)."""
    sizes = labels.where(F.col("dbscan_label") != -1).groupBy("dbscan_label").agg(F.count(F.lit(1)).alias("size"))
    tot = labels.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("dbscan_label") == -1).alias("n_noise"))
    s = sizes.agg(F.count(F.lit(1)).alias("n_hotspots"), F.min("size").alias("smin"), F.max("size").alias("smax"),
                  F.median("size").alias("smed"),
                  F.min_by("dbscan_label", F.struct(-F.col("size"), F.col("dbscan_label"))).alias("largest"))
    frac = F.col("n_noise") / F.col("n")
    return attach_row(tot, s).select(
        F.col("n_hotspots").cast("long").alias("n_hotspots"),
        F.col("n_noise").cast("long").alias("n_noise"),
        (F.rint(frac * 1e4) / 1e4).alias("noise_fraction"),
        (frac > C.DBSCAN_NOISE_WARN_FRACTION).alias("noise_fraction_warn"),
        F.lit(float(eps)).alias("eps"), F.lit(min_samples).cast("long").alias("min_samples"),
        F.coalesce(F.col("smin"), F.lit(0)).cast("long").alias("hotspot_sizes_min"),
        F.coalesce(F.col("smax"), F.lit(0)).cast("long").alias("hotspot_sizes_max"),
        F.coalesce(F.col("smed").cast("double"), F.lit(0.0)).alias("hotspot_sizes_median"),
        F.coalesce(F.col("largest"), F.lit(-1)).cast("long").alias("largest_hotspot_label"))
