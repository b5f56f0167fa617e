"""Connected components of a link table by contraction and pointer jumping.

Links are (hi, lo) with lo < hi.  Round: every ``hi`` points to its smallest
partner; the pointers are shortened by joining them with themselves until each
ends at a node that points nowhere; both ends of every link are replaced by the
nodes they lead to.  A node that points leaves the graph for good, so each has
one pointer, and the rounds end when no link is left.  Every step is a
written table; nothing is collected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepace.llm.common import written


def _ordered(links: DataFrame, a: str, b: str) -> DataFrame:
    return (links.filter(F.col(a) != F.col(b))
            .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct())


def _shortened(up: DataFrame) -> DataFrame:
    """(node, root) with every root replaced by where its own pointers end."""
    while True:
        above = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
        jumped = written(up.join(above, "root", "left").select("node", F.coalesce("next", "root").alias("root"),
                                                               F.col("next").isNotNull().alias("moved")), "up")
        up = jumped.select("node", "root")
        if jumped.filter("moved").isEmpty():
            return up


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): every linked node with the smallest node of its component; roots included."""
    graph = written(_ordered(links, a, b), "links")
    rounds = []
    while not graph.isEmpty():
        least = written(graph.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root")), "pointers")
        up = _shortened(least)
        rounds.append(up)
        led = up.select(F.col("node").alias("lo"), F.col("root").alias("lo_root"))
        moved = (graph.join(up.withColumnRenamed("node", "hi"), "hi").join(led, "lo", "left")
                 .select("root", F.coalesce("lo_root", "lo").alias("other")))
        graph = written(_ordered(moved, "root", "other"), "links")
    if not rounds:
        return graph.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    up = rounds[0] if len(rounds) == 1 else _shortened(written(reduce(DataFrame.unionByName, rounds), "up"))
    roots = up.select(F.col("root").alias("node")).distinct()
    return up.unionByName(roots.select("node", F.col("node").alias("root")))
