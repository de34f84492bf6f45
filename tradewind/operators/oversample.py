"""Over-sampling of a rare class: exact nearest neighbours inside it, seeded points between a row and one of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.operators.ranking import ranked
from tradewind.session import send_package, staged

BLOCK_ROWS = 2048
CELLS = 1 << 18  # distances times features that are formed at once


def _closest(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Of every pair of blocks, the k rows of the second that are closest to each row of the first."""
        for batch in batches:
            for row in batch.itertuples():
                own, near = (np.array([x["features"] for x in rows], np.float64) for rows in (row.rows, row.others))
                ids, others = (np.array([x["id"] for x in rows], np.int64) for rows in (row.rows, row.others))
                found = []
                step = max(1, CELLS // near.size)
                for lo in range(0, len(own), step):
                    far = ((own[lo : lo + step, None, :] - near[None]) ** 2).sum(axis=2)
                    far[ids[lo : lo + step, None] == others[None]] = np.inf
                    # nearest first, ties to the smaller id
                    order = np.lexsort((np.broadcast_to(others, far.shape), far))[:, :k]
                    at, place = np.repeat(np.arange(len(far)), order.shape[1]), order.ravel()
                    kept = np.isfinite(far[at, place])
                    at, place = at[kept], place[kept]
                    found.append(pd.DataFrame({"id": ids[lo + at], "other": others[place], "distance": far[at, place], "towards": list(near[place])}))
                pairs = pd.concat(found)
                if len(pairs):
                    yield pairs

    return run


def nearest(rows: DataFrame, k: int) -> DataFrame:
    """id, other, distance (squared Euclidean), towards (features of the other), place (from 1): the k nearest
    other rows of each row of (id, features), ties to the smaller id.

    Exact: every block of rows meets every other, as packed rows, and a block pair sends on k rows of
    each of its rows only; these are cut to k again before they are shuffled. Work
    grows with the square of the number of rows, so this is for a rare class. Ids must be different.
    """
    send_package(rows.sparkSession)
    cuts = max(1, -(-rows.count() // BLOCK_ROWS))
    placed = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(cuts)))
    packed = staged(placed.groupBy("block").agg(F.collect_list(F.struct("id", "features")).alias("rows")))
    sent = packed.select("rows", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cuts - 1).cast("long"))).alias("block"))
    met = sent.join(packed.select("block", F.col("rows").alias("others")), "block").select("rows", "others")
    pairs = met.mapInPandas(_closest(k), "id long, other long, distance double, towards array<double>")
    order = Window.partitionBy("id").orderBy("distance", "other")
    return pairs.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _share(seed: int) -> Column:
    """A number from 0 to below 1 of each new row."""
    return F.pmod(F.xxhash64(F.lit(seed), "id", "copy"), F.lit(1 << 30)) / F.lit(float(1 << 30))


def oversample(df: DataFrame, label: str, features: str, ratio: float = 1.0, k: int = 5, rare: int = 1, seed: int = 42) -> DataFrame:
    """label, features, made, origin, towards: all rows of df, and new rows of the rare class until it has
    floor(ratio * rows of all other classes) rows.

    A new row lies between a row of the rare class (origin) and one of its k nearest neighbours there (towards), at a
    seeded share of the way. The different rows of the class make equally many, but for
    one more that a seeded hash deals out. With a single different row, its copies are the new rows.

    Rows without label or features, or with a null among these, stay and make none. A class that is
    large enough, or without any row, gets none. `features` is an array of numbers of one
    length; make its columns comparable first. Results do not depend on files or partitions.
    """
    kept = df.select(
        F.col(label), F.col(features).cast("array<double>").alias(features), F.lit(False).alias("made"),
        *[F.lit(None).cast("array<double>").alias(c) for c in ("origin", "towards")],
    )
    n_rare, n_rest = df.agg(F.count_if(F.col(label) == rare), F.count_if(F.col(label) != rare)).first()
    due = int(ratio * n_rest) - n_rare
    own = df.where(F.col(label) == rare).select(F.col(features).cast("array<double>").alias("features"))
    own = own.where(F.col("features").isNotNull() & ~F.exists("features", lambda x: x.isNull() | F.isnan(x))).distinct()
    own = staged(own.withColumn("id", F.xxhash64("features")))
    n = own.count()
    if due <= 0 or n == 0:
        return kept
    dealt = ranked(own.withColumn("deal", F.xxhash64(F.lit(seed), "id")), "deal", rank="place")
    times = F.lit(due // n) + (F.col("place") <= due % n).cast("long")
    dealt = dealt.withColumn("times", times).where("times > 0").select("id", "features", "times")
    ways = nearest(own, k).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("place", "towards"))).alias("ways"))
    rows = dealt.join(ways, "id", "left").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    way = F.get("ways", F.floor(_share(seed + 1) * F.size("ways")).cast("int"))["towards"]
    rows = rows.withColumn("towards", F.coalesce(way, F.col("features"))).withColumn("share", _share(seed + 2))
    point = F.zip_with("features", "towards", lambda x, y: x + F.col("share") * (y - x))
    new = rows.select(
        F.lit(rare).cast(df.schema[label].dataType).alias(label), point.alias(features), F.lit(True).alias("made"),
        F.col("features").alias("origin"), "towards",
    )
    return kept.unionByName(new)
