"""Top-k, argmax and ranks over groups of any number."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions.numbers import ratio
from tradewind.session import staged

RANGES = 256


def top_k(df: DataFrame, measure: str, k: int, tie: Sequence[str]) -> DataFrame:
    """The k largest by measure; ties go to the smaller key."""
    return df.orderBy(F.col(measure).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in tie]).limit(k)


def name_of_largest(name: str, measure: str) -> Column:
    """Aggregate: name with the largest measure, the smallest name among ties, blank measures aside."""
    place = F.struct((-F.col(measure)).alias("m"), F.col(name).alias("n"))
    return F.min_by(name, F.when(F.col(measure).isNotNull(), place))


def average_rank(c: str, descending: bool = False) -> Column:
    """Rank in which equal values share the mean of their positions (for a handful of rows)."""
    order = F.col(c).desc() if descending else F.col(c).asc()
    return F.rank().over(Window.orderBy(order)) + (F.count("*").over(Window.partitionBy(c)) - 1) / 2


def ranked(df: DataFrame, measure: str, by: Sequence[str] = (), **names: str) -> DataFrame:
    """Standing of every row by falling measure, inside each group of `by` (nulls are a group), whatever the
    number of rows of a group.

    Asked for by keyword, each naming its output column: `dense` and `rank`
    (positions), `above` (share of rows with a larger measure) and `share`
    (measure summed down to this row's value over the whole sum).

    Equal measures are first combined.  The distinct values of all groups are cut into the same ranges,
    positions and sums are formed inside each range of a group, and the totals of the group's earlier
    ranges (256 rows) are added, so no task holds a whole group.  Rows with a NULL measure are left out.
    """
    df = staged(df.where(F.col(measure).isNotNull()))
    number = F.col(measure).cast("double")
    probe = [i / RANGES for i in range(1, RANGES)]
    cuts = sorted(set(df.select(number.alias("_v")).approxQuantile("_v", probe, 0.5 / RANGES)))
    edges = F.array(*[F.lit(float(c)) for c in cuts]) if cuts else F.array().cast("array<double>")
    # range 0 holds the largest measures
    values = df.groupBy(*by, measure).agg(F.count("*").alias("_n"))
    values = values.withColumn("_range", F.size(F.filter(edges, lambda e: e > number)))
    amount = F.col(measure) * F.col("_n")

    totals = values.groupBy(*by, "_range").agg(
        F.count("*").alias("_d"), F.sum("_n").alias("_r"), F.sum(amount).alias("_s")
    )
    # one row per range of a group, so these windows stay small; without groups the broadcast does too
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        *by,
        "_range",
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}0") for c in ("_d", "_r", "_s")],
        *[F.sum(c).over(everything).alias(f"{c}_all") for c in ("_r", "_s")],
    )
    inside = Window.partitionBy(*by, "_range").orderBy(F.col(measure).desc())
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    larger = F.col("_r0") + F.sum("_n").over(upto) - F.col("_n")
    figures = {
        "dense": F.col("_d0") + F.row_number().over(inside),
        "rank": larger + 1,
        "above": larger / F.col("_r_all"),
        "share": ratio(F.col("_s0") + F.sum(amount).over(upto), F.col("_s_all")),
    }
    placed = _same(values, offsets if by else F.broadcast(offsets), [*by, "_range"])
    placed = placed.select(*by, measure, *[figures[f].alias(name) for f, name in names.items()])
    return _same(df, placed, [*by, measure]).select(*df.columns, *names.values())


def _same(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join on equal columns, nulls equal too."""
    right = right.withColumnsRenamed({c: f"_on_{i}" for i, c in enumerate(on)})
    equal = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_on_{i}")) for i, c in enumerate(on)])
    return left.join(right, equal).drop(*[f"_on_{i}" for i in range(len(on))])
