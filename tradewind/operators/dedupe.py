"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of every key in the given order.

    All other columns, in their stated order, break ties, so the winner never
    depends on how the input was split.  The filter sits directly on the
    window: Spark prunes to one row per key before the shuffle, which also
    keeps a key with very many copies from filling one task.
    """
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], stamps: Sequence[str]) -> DataFrame:
    """Newest row of every key by one or more stamps; missing stamps lose."""
    return pick_one(df, keys, [F.col(s).desc_nulls_last() for s in stamps])


def first_per_key(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    return pick_one(df, keys, [F.col(b).asc_nulls_last() for b in by])
