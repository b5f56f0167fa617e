"""Exact quantiles (linear interpolation, numpy's default) that survive skew.

Spark's ``percentile`` aggregate keeps every distinct value of a group in
one buffer, so a zone holding a third of all trips would land in one task.
This operator never gathers a group, and ties collapse before they move:

1. project to (group, value), drop nulls, and count each (group, value) with a
   map-side partial aggregate, so a value that a third of the rows share is
   one row per task;
2. range-partition the distinct values and add up the counts before each
   (``functions/ranking.py``): a value covers the ranks [before, before + count);
3. every probability asks for at most two ranks per group; these few
   targets are first placed in their (partition, group) block, then joined to
   the values of that block, and interpolated.

For inputs bounded by construction (the zone-hour cell table) callers use
``F.percentile`` directly; ``approx=True`` switches to ``percentile_approx``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepace.functions.frames import attach_row
from zonepace.functions.ranking import running_counts


def exact_quantiles(df: DataFrame, group_cols: list[str], value_col: str,
                    probs: list[float], names: list[str] | None = None,
                    approx: bool = False, accuracy: int = 10000,
                    with_count: bool = False) -> DataFrame:
    """One row per group: ``group_cols`` + one column per probability.

    Groups with no non-null value are absent.  ``with_count`` adds ``n``.
    """
    names = names or [f"q{int(round(p * 1000)):04d}" for p in probs]
    g = list(group_cols)
    v = df.select(*[F.col(c) for c in g], F.col(value_col).cast("double").alias("_v"))
    v = v.where(F.col("_v").isNotNull() & ~F.isnan("_v"))

    if approx:
        out = v.groupBy(*g).agg(
            F.percentile_approx("_v", probs, accuracy).alias("_qs"),
            F.count(F.lit(1)).alias("n"),
        )
        cols = [F.col("_qs")[i].alias(n) for i, n in enumerate(names)]
        return out.select(*g, *cols, *(["n"] if with_count else []))

    counted = v.groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_cnt"))
    values = running_counts(counted, g, ["_v"], "_cnt")
    blocks = values.groupBy("_pid", *g).agg(F.min("_before").alias("_lo"), F.max(F.col("_before") + F.col("_cnt")).alias("_hi"))
    totals = blocks.groupBy(*g).agg(F.max("_hi").alias("n"))

    # Interpolation: q = v[lo] + (v[hi] − v[lo]) · frac, ranks 0-based.
    wanted = []
    for i, p in enumerate(probs):
        h = (F.col("n") - 1) * F.lit(float(p))
        lo = F.floor(h).cast("long")
        for role, rank in ((0, lo), (1, F.least(lo + 1, F.col("n") - 1))):
            wanted.append(F.struct(F.lit(i).alias("_pi"), F.lit(role).alias("_role"), rank.alias("_rank"), (h - F.floor(h)).alias("_frac")))
    targets = totals.select(*g, F.inline(F.array(*wanted)))
    at = (F.col("_rank") >= F.col("_lo")) & (F.col("_rank") < F.col("_hi"))
    placed = (blocks.join(targets, g) if g else attach_all(blocks, targets)).where(at).drop("_lo", "_hi")
    picked = (values.join(placed, ["_pid", *g])
              .where((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_cnt")))
              .groupBy(*g, "_pi").agg(F.max(F.when(F.col("_role") == 0, F.col("_v"))).alias("_lo"),
                                      F.max(F.when(F.col("_role") == 1, F.col("_v"))).alias("_hi"), F.max("_frac").alias("_frac"))
              .select(*g, "_pi", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_frac")).alias("_q")))
    wide = picked.groupBy(*g).agg(
        *[F.max(F.when(F.col("_pi") == i, F.col("_q"))).alias(n) for i, n in enumerate(names)]
    )
    if with_count:
        wide = wide.join(totals, on=g) if g else attach_row(wide, totals)
    return wide


def attach_all(blocks: DataFrame, targets: DataFrame) -> DataFrame:
    """Ungrouped case: one block per partition against two targets per probability, both tiny."""
    return blocks.crossJoin(F.broadcast(targets))
