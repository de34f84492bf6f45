"""Exact figures of a score against a label of 0 and 1, for any number of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.session import staged

RANGES = 256
WHOLE = "decimal(38,0)"


def _known(df: DataFrame, score: str, label: str) -> DataFrame:
    return df.select(F.col(score).cast("double").alias("s"), F.col(label).cast("long").alias("y")).where(
        "s IS NOT NULL AND NOT isnan(s) AND y IS NOT NULL"
    )


def area_under_roc(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row: positives, negatives, area.

    The area is the share of (positive, negative) pairs in which the positive scores
    higher, a tie counting half.  Equal scores are counted together; the distinct ones are
    cut into ranges, negatives below a score are summed inside its range, and the
    totals of the lower ranges (256 rows) are added.  No threshold is binned.  Without
    both labels the area is NULL.  Rows without score or label are left out.
    """
    values = _known(df, score, label).groupBy("s").agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n"))
    values = staged(values)
    cuts = sorted(set(values.approxQuantile("s", [i / RANGES for i in range(1, RANGES)], 0.5 / RANGES)))
    edges = F.array(*[F.lit(float(c)) for c in cuts]) if cuts else F.array().cast("array<double>")
    # range 0 holds the smallest scores
    values = values.withColumn("r", F.size(F.filter(edges, lambda e: e < F.col("s"))))
    lower = Window.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = values.groupBy("r").agg(F.sum("n").alias("t")).select("r", F.coalesce(F.sum("t").over(lower), F.lit(0)).alias("o"))
    inside = Window.partitionBy("r").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range
    placed = values.withColumn("below", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(F.broadcast(offsets), "r")
    twice = F.col("p").cast(WHOLE) * (2 * (F.col("below") + F.col("o")) + F.col("n")).cast("decimal(20,0)")
    sums = placed.agg(F.sum("p").alias("positives"), F.sum("n").alias("negatives"), F.sum(twice).alias("twice"))
    pairs = F.col("positives").cast("double") * F.col("negatives").cast("double")
    return sums.select(
        F.coalesce("positives", F.lit(0)).alias("positives"),
        F.coalesce("negatives", F.lit(0)).alias("negatives"),
        F.try_divide(F.col("twice").cast("double") / 2, pairs).alias("area"),
    )


def threshold_figures(df: DataFrame, score: str, label: str, thresholds: Sequence[float]) -> DataFrame:
    """Per threshold: hits, false alarms, misses, precision, recall and F1 of `score >= threshold`, in one pass."""
    known = _known(df, score, label)

    def cell(t: float, y: int) -> Column:
        return F.count_if((F.col("s") >= F.lit(float(t))) & (F.col("y") == y))

    counts = [F.struct(F.lit(float(t)).alias("threshold"), cell(t, 1).alias("hits"), cell(t, 0).alias("false_alarms")) for t in thresholds]
    one = known.agg(F.array(*counts).alias("t"), F.count_if(F.col("y") == 1).alias("positives"))
    rows = one.select(F.explode("t").alias("t"), "positives").select("t.*", "positives")
    precision = F.try_divide("hits", F.col("hits") + F.col("false_alarms"))
    recall = F.try_divide("hits", "positives")
    return rows.select(
        "threshold",
        "hits",
        "false_alarms",
        (F.col("positives") - F.col("hits")).alias("misses"),
        precision.alias("precision"),
        recall.alias("recall"),
        F.try_divide(2 * F.col("hits"), F.col("hits") + F.col("false_alarms") + F.col("positives")).alias("f1"),
    )
