"""Exact top-k search: score everything, refine global score histograms, break ties by id."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.vectors import LONG, blocks, matrix, numbers, quantised
from tradewind.session import staged

ROWS, QUERY_ROWS = 2048, 256  # vectors of a block
PLACE = 16  # bits of a row's place in its block
BINS = 512
WIDE = "decimal(25,0)"  # the width of a bin may be just beyond a long
EXACT = 2**52  # sums below this are exact as doubles


def _query_blocks(data: DataFrame, stored: str, per_block: int) -> DataFrame:
    """The queries among packed vectors, packed again where they lie: (dim, qb, q, q_ids, q_m).
    q numbers a query by its block and place; ids may repeat."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}

        def flush(least: int) -> pd.DataFrame:
            out = []
            for dim, rows in held.items():
                while len(rows) >= least:
                    cut, rows[:] = rows[:per_block], rows[per_block:]
                    q, ids, m = ([r[i] for r in cut] for i in range(3))
                    out.append((dim, q[0], q, ids, b"".join(m)))
                    if not rows:
                        break
            return pd.DataFrame(out, columns=["dim", "qb", "q", "q_ids", "q_m"])

        for rows in batches:
            for row in rows.itertuples():
                at = np.flatnonzero(np.asarray(row.flags, bool))
                m, ids = np.frombuffer(row.m, stored).reshape(-1, row.dim), np.asarray(row.ids)
                held.setdefault(row.dim, []).extend(((row.block << PLACE) + int(j), int(ids[j]), m[j].tobytes()) for j in at)
            yield flush(per_block)
        held = {d: r for d, r in held.items() if r}
        yield flush(1)

    return staged(data.mapInPandas(pack, "dim int, qb long, q array<long>, q_ids array<long>, q_m binary"))


def _tiles(rows: pd.DataFrame, k: int, stored: str, exact: bool):
    """Of every pair of blocks, the scores that are among the tile's own k highest of a query (ties included):
    no other can be among the global ones. Yields the query's numbers and ids, its state, and
    (place of the query, place of the data row, score) of each, with the ids of the data rows."""
    for row in rows.itertuples():
        state = {x["q"]: x for x in row.state}
        at = [i for i, q in enumerate(row.q) if q in state]
        d, q = (matrix(m, stored, row.dim, exact) for m in (row.m, row.q_m))
        if exact:
            s = np.rint(q[at].astype(np.float64) @ d.T.astype(np.float64)).astype(np.int64)
        else:
            s = np.clip(q[at] @ d.T, -LONG, LONG).astype(np.int64)
        own = np.asarray(row.q, np.int64)[at]
        home = np.flatnonzero(own >> PLACE == row.block)
        free = np.ones(s.shape, bool)
        free[home, own[home] & (1 << PLACE) - 1] = False
        if s.shape[1] > k:
            # a query's own row takes the lowest score: one more is kept where it lies
            least = np.partition(np.where(free, s, -LONG), s.shape[1] - k, axis=1)[:, s.shape[1] - k]
            free &= s >= least[:, None]
        i, j = np.nonzero(free)
        lo, need = (np.array([state[x][c] for x in own.tolist()], np.int64) for c in ("lo", "need"))
        yield own, np.asarray(row.q_ids, np.int64)[at], lo, need, i, np.asarray(row.ids, np.int64)[j], s[i, j]


def _count(k: int, width: int, stored: str, exact: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Histogram of each query's scores inside its range."""
        for rows in batches:
            found = []
            for own, _, lo, _, i, _, s in _tiles(rows, k, stored, exact):
                far = (s - lo[i]) if exact else (s.astype(object) - lo[i])  # differences may leave a long
                b = far // width
                inside = np.asarray((b >= 0) & (b < BINS), bool)
                found.append(pd.DataFrame({"q": own[i][inside], "bin": b[inside].astype(np.int32)}))
            if found:
                yield pd.concat(found).groupby(["q", "bin"]).size().rename("n").reset_index()

    return run


def _pick(k: int, stored: str, exact: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Scores above the kth of each query and, of those equal to it, as many as are due by smallest id."""
        for rows in batches:
            found = []
            for own, q_ids, lo, need, i, ids, s in _tiles(rows, k, stored, exact):
                best = pd.DataFrame({"q": own[i], "query_id": q_ids[i], "vec_id": ids, "score": s, "lo": lo[i], "need": need[i]})
                best = best[best["score"] >= best["lo"]].sort_values(["q", "score", "vec_id"], ascending=[True, False, True])
                place = best.groupby(["q", "score"]).cumcount()
                found.append(best[(best["score"] > best["lo"]) | (place < best["need"])])
            if found:
                yield pd.concat(found)[["q", "query_id", "vec_id", "score"]]

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest integer inner products of every query with
    all rows but its own, ties to the smaller vec_id; all, if there are fewer.

    Vectors are packed into blocks where they are read and stay there; blocks of
    queries are sent to them. Every round counts the scores of a query's current
    range in 512 bins, over all blocks, and narrows the range to the bin of the kth
    score, until a bin is one value. The last pass filters by that value.
    Only row count, largest component and dimension reach the driver.

    Vectors without id, null, empty, or with null or non-finite components take no
    part. Rows that share an id all take part: each is a candidate of the others
    and, where `is_query` holds, a query of its own. Vectors of different
    length are not compared. Scores beyond a long are cut to its range. No
    vectors or no queries give no rows. Other columns are not carried.
    """
    rows = quantised(vectors, is_query).where("vec_id IS NOT NULL")
    scale = numbers(rows)
    most = min(LONG, scale.norm)
    exact = scale.norm < EXACT
    data = blocks(rows, scale, ROWS)
    asked = _query_blocks(data, scale.stored, QUERY_ROWS)
    # about one block of data in a cell
    cells = max(1, -(-scale.rows // ROWS))
    data = data.select("dim", "block", "ids", "m", F.pmod(F.xxhash64("block"), F.lit(cells)).alias("cell"))

    state = asked.select("dim", "qb", F.explode("q").alias("q"))
    state = state.withColumns({"lo": F.lit(-most).cast("long"), "need": F.lit(k).cast("long")})
    passes = 1
    while BINS**passes < 2 * most + 1:
        passes += 1

    def tiles(state):
        held = state.groupBy("dim", "qb").agg(F.collect_list(F.struct("q", "lo", "need")).alias("state"))
        sent = asked.join(held, ["dim", "qb"]).withColumn("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long"))))
        return data.join(sent, ["dim", "cell"]).select("dim", "block", "ids", "m", "q", "q_ids", "q_m", "state")

    for p in reversed(range(passes)):
        width = BINS**p
        counts = tiles(state).mapInPandas(_count(k, width, scale.stored, exact), "q long, bin int, n long")
        counts = counts.groupBy("q", "bin").agg(F.sum("n").alias("n"))
        from_top = Window.partitionBy("q").orderBy(F.col("bin").desc())
        upto = F.sum("n").over(from_top)
        counts = counts.withColumns({"upto": upto, "all": F.sum("n").over(Window.partitionBy("q"))})
        joined = counts.join(state, "q").withColumn("need", F.least("need", "all"))
        found = joined.where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))
        state = staged(
            found.select(
                "dim", "qb", "q",
                (F.col("lo").cast(WIDE) + F.col("bin") * F.lit(str(width)).cast(WIDE)).cast("long").alias("lo"),
                (F.col("need") - (F.col("upto") - F.col("n"))).alias("need"),
            )
        )

    best = tiles(state).mapInPandas(_pick(k, scale.stored, exact), "q long, query_id long, vec_id long, score long")
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op8_top_k(spark, folder):
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return top_k(vectors, F.col("vec_id") % 50 == 0)
