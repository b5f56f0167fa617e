"""Small DataFrame helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Give every row of ``df`` the columns of a one-row aggregate.

    ``one_row`` is a global ``agg(...)`` (exactly one row by construction), so
    it is broadcast and the join is a per-row projection — never a product
    of two data-sized inputs.
    """
    return df.crossJoin(F.broadcast(one_row))
