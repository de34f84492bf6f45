"""Sharding: balanced label propagation over groups of linked documents."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import documents, hash_part, prefix_sums, whole
from tradewind.session import staged

UNITS = 64  # a group is moved in pieces of about a 64th of a shard
LARGE = 100  # unlinked documents over a 100th of a shard are dealt out one by one


def propagate(pieces: DataFrame, n_shards: int, quota: int, rounds: int) -> DataFrame:
    """Move pieces (g, u, bytes, shard) towards the shard that holds most of their group.

    A round joins each piece with the best shard of its group and accepts moves
    in hash order as far as the shard they go to has room. Rounds end early when
    nothing moves. Only one load per shard reaches the driver.
    """
    for _ in range(rounds):
        held = pieces.groupBy("g", "shard").agg(F.sum("bytes").alias("held"))
        best = held.groupBy("g").agg(F.max_by("shard", F.struct("held", (-F.col("shard")).alias("tie"))).alias("best"))
        loads = {r["shard"]: int(r["load"]) for r in pieces.groupBy("shard").agg(F.sum("bytes").alias("load")).collect()}
        room = F.element_at(F.array(*[F.lit(max(0, quota - loads.get(s, 0))) for s in range(n_shards)]), F.col("best") + 1)
        moves = pieces.join(best, "g").where(F.col("best") != F.col("shard"))
        moves = staged(moves.withColumn("_h", F.xxhash64("g", "u")))
        moves = prefix_sums(moves, ["best"], hash_part("_h"), ["_h", "u"], {"before": "bytes"})
        moves = staged(moves.where(F.col("before") + F.col("bytes") <= room).select("g", "u", F.col("best").alias("to")))
        if moves.isEmpty():
            break
        pieces = pieces.join(moves, ["g", "u"], "left").withColumn("shard", F.coalesce("to", "shard")).drop("to")
        pieces = staged(pieces)
    return pieces


def shard(docs: DataFrame, n_shards: int = 16, rounds: int = 6, seed: int = 23) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot, group of every document; law `bytes`.

    Documents with equal texts are linked. Linked documents start in hashed
    shards and move by balanced label propagation under a quota of the mean
    shard. What then exceeds a shard's mean is released and, with the unlinked
    documents, fills the shards up to the mean: the few documents larger than a
    hundredth of a shard (at most 100 a shard, so they may reach the driver)
    go to the emptiest shard, the others fill the remaining room in hash order.
    Shard sizes then differ by about a document of that size, unless one text is larger.

    Null text counts as empty: size 1, CRC 0. Null doc_id is a value like
    others. Repeated rows are linked like other equal texts and get slots of
    their own. No rows give no rows. Other columns are not carried.
    """
    text = whole(F.col("text"))
    rows = staged(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.md5(text.cast("binary")).alias("g"),
            F.xxhash64(F.lit(seed), "doc_id", text).alias("_spread"),
        )
    )
    total = int(rows.agg(F.sum("size")).first()[0] or 0)
    mean = max(1, -(-total // n_shards))
    groups = rows.groupBy("g").agg(F.count("*").alias("n"), F.sum("size").alias("b")).where("n > 1")
    groups = staged(groups.select("g", F.ceil(F.col("b") / max(1, mean // UNITS)).alias("k")))
    marked = staged(rows.join(groups, "g", "left").withColumn("u", F.pmod(F.col("_spread"), F.coalesce("k", F.lit(1)))))
    linked = marked.where(F.col("k").isNotNull())

    pieces = linked.groupBy("g", "u").agg(F.sum("size").alias("bytes"))
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), "g", "u"), F.lit(n_shards)).cast("int"))
    pieces = propagate(staged(pieces), n_shards, mean, rounds)

    placed = staged(linked.join(pieces.select("g", "u", "shard"), ["g", "u"]).withColumn("_h", F.xxhash64("g")))
    placed = prefix_sums(placed, ["shard"], hash_part("_h"), ["_h", "g", "u", "_spread"], {"before": "size"})
    placed = placed.withColumn("shard", F.when(F.col("before") + F.col("size") <= mean, F.col("shard")))
    columns = ["doc_id", "size", "text_crc32", "g", "_spread"]
    placed = staged(placed.select(*columns, "shard"))
    pool = placed.where(F.col("shard").isNull()).select(*columns).unionByName(marked.where(F.col("k").isNull()).select(*columns))
    pool = staged(pool)

    loads = {r["shard"]: int(r["b"]) for r in placed.where(F.col("shard").isNotNull()).groupBy("shard").agg(F.sum("size").alias("b")).collect()}
    loads = [loads.get(s, 0) for s in range(n_shards)]
    large_size = max(1, mean // LARGE)
    large = pool.where(F.col("size") > large_size).groupBy("_spread").agg(F.sum("size").alias("b"))
    heap = [(load, s) for s, load in enumerate(loads)]
    heapq.heapify(heap)
    dealt = []
    for r in sorted(large.collect(), key=lambda r: (-r["b"], r["_spread"])):
        load, s = heapq.heappop(heap)
        dealt.append((r["_spread"], s))
        loads[s] += int(r["b"])
        heapq.heappush(heap, (loads[s], s))
    spark = docs.sparkSession
    where = spark.createDataFrame(dealt, "_spread long, shard int") if dealt else spark.range(0).selectExpr("id AS _spread", "0 AS shard")
    big = pool.where(F.col("size") > large_size).join(where, "_spread").select(*columns, "shard")

    small = pool.where(F.col("size") <= large_size)
    open_bytes = int(small.agg(F.sum("size")).first()[0] or 0)
    level = _level(loads, open_bytes)
    edge, edges = 0, []
    for load in loads:
        edge += max(0, level - load)
        edges.append(edge)
    small = prefix_sums(small.withColumn("_one", F.lit(0)), ["_one"], hash_part("_spread", 14), ["_spread", "doc_id"], {"before": "size"})
    middle = F.col("before") + F.col("size") / 2
    slot_of = F.lit(n_shards - 1)
    for s in reversed(range(n_shards - 1)):
        slot_of = F.when(middle < edges[s], F.lit(s)).otherwise(slot_of)
    small = small.select(*columns, slot_of.cast("int").alias("shard"))

    final = placed.where(F.col("shard").isNotNull()).unionByName(big).unionByName(small)
    final = staged(final.withColumn("_one", F.lit(1).cast("long")))
    order = ["_spread", "doc_id", "size", "text_crc32"]
    numbered = prefix_sums(final, ["shard"], hash_part("_spread"), order, {"slot": "_one"})
    return numbered.select("doc_id", "size", "text_crc32", "shard", "slot", F.col("g").alias("text_md5"))


def _level(loads: list[int], open_bytes: int) -> float:
    """Height to which open_bytes fill shards of these loads."""
    filled, below = sorted(loads), 0
    for i, load in enumerate(filled):
        below += load
        level = (below + open_bytes) / (i + 1)
        if i + 1 == len(filled) or level <= filled[i + 1]:
            return level
    return 0.0


def op3_balanced_shards(spark, folder):
    out = shard(documents(spark, folder))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "text_md5"
    )
