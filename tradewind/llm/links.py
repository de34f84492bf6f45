"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.session import staged


def components(links: DataFrame, rounds: int = 40) -> DataFrame:
    """node, component (smallest node reachable) for every node of links (a, b).

    Large-star and small-star rounds by turns: each node links its larger
    neighbours, then itself and its smaller ones, to its smallest neighbour. The
    number of links never grows and the rounds follow the logarithm of the
    longest path. Only a count and a checksum of the links reach the driver.
    Links that have not settled after `rounds` are an error, not a result.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges, last = staged(edges), None
    for _ in range(rounds):
        ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
        both = edges.select(F.explode(ways).alias("e")).select("e.a", "e.b")
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = staged(large)
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        edges = staged(small.where("a <> b").distinct())
        seen = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
        if seen == last:
            break
        last = seen
    else:
        raise RuntimeError(f"components of the links have not settled after {rounds} rounds")
    return edges.select(F.explode(F.array("a", "b")).alias("node"), F.col("b").alias("component")).distinct()
