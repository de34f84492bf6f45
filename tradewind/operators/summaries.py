"""Histogram, sampling and splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in `bins` equal intervals between the smallest and largest value."""
    x = df.select(F.col(column).cast("double").alias("x")).where("x IS NOT NULL")
    low, high = x.agg(F.min("x")).scalar(), x.agg(F.max("x")).scalar()
    width = (high - low) / bins
    place = F.floor((F.col("x") - low) / F.when(width > 0, width))
    # the largest value belongs to the last bin, a constant column to the first
    bin_no = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)) + 1
    return x.groupBy(bin_no.cast("long").alias("bin")).agg(F.count("*").alias("n"))


def fixed_sample(df: DataFrame, key: str, size: int, seed: int = 42) -> DataFrame:
    """Repeatable sample of at most `size` rows, the same however the input is split."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(size)


def in_test_set(key: str, percent: int = 20, seed: int = 42) -> Column:
    """Repeatable hold-out mark: about `percent` of the keys."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(100)) < percent


def in_stratified_test_set(df: DataFrame, key: str, label: str, percent: int = 20, seed: int = 42) -> Column:
    """Repeatable hold-out mark: `percent` of the keys of every label, by the order of their hashes.

    One hash per label, the one that cuts off this share, reaches the driver.
    """
    spread = F.xxhash64(F.col(key), F.lit(seed))
    cuts = df.groupBy(label).agg(F.percentile_approx(spread, percent / 100, 10_000).alias("cut")).collect()
    mark = F.lit(False)
    for row in cuts:
        mark = F.when(F.col(label).eqNullSafe(F.lit(row[label])), spread <= row["cut"]).otherwise(mark)
    return mark
