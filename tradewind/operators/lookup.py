"""Dimension lookups.

No size hints here: the optimizer broadcasts a dimension only while it is under
its size limit and shuffles it beyond; hot keys are split at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_sk(fact: DataFrame, dim: DataFrame, on: str, bk: str, sk: str, default: int) -> DataFrame:
    """Replace a business key by the surrogate key; misses get the default member."""
    keys = dim.select(F.col(bk).alias(on), F.col(sk).alias("_sk"))
    return fact.join(keys, on, "left").withColumn(sk, F.coalesce("_sk", F.lit(default)).cast("long")).drop("_sk", on)


def date_role(dim_date: DataFrame, role: str, columns: list[str]) -> DataFrame:
    """The date dimension under one role: `<role>_date_key` and `<role>_<column>`."""
    return dim_date.select(
        F.col("date_key").alias(f"{role}_date_key"),
        *[F.col(c).alias(f"{role}_{c}") for c in columns],
    )
