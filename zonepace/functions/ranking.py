"""Row numbers and running counts within groups of any size, without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def running_counts(df: DataFrame, groups: list[str], order: list[str], weight: str) -> DataFrame:
    """``df`` with ``_before`` = sum of ``weight`` over the earlier rows of the group, and ``_pid``.

    Rows (distinct in ``groups`` + ``order``) are range-partitioned, so a hot
    group spreads over many tasks; the sums of the (partition, group) blocks
    before a block are its offset.  The dealt table is checkpointed: a lost
    executor must not sample other range bounds.
    """
    dealt = (df.repartitionByRange(_partitions(df), *groups, *order).withColumn("_pid", F.spark_partition_id())
             .checkpoint(eager=True))
    blocks = dealt.groupBy("_pid", *groups).agg(F.sum(weight).alias("_w"))
    ahead = Window.partitionBy(*groups).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("_pid", *groups, F.coalesce(F.sum("_w").over(ahead), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_pid", *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (dealt.withColumn("_in", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
            .join(offsets, ["_pid", *groups]).withColumn("_before", F.col("_off") + F.col("_in")).drop("_off", "_in"))


def row_numbers(df: DataFrame, groups: list[str], order: list[str], name: str) -> DataFrame:
    """``df`` with a 1-based ascending row number in each group (``groups`` + ``order`` must be unique)."""
    ranked = running_counts(df.withColumn("_one", F.lit(1).cast("long")), groups, order, "_one")
    return ranked.withColumn(name, (F.col("_before") + 1).cast("int")).drop("_before", "_pid", "_one")
