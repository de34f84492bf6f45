"""Centroid clustering in whole numbers, its work cut by dimensions as well as by rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.vectors import LONG, blocks, matrix, numbers, quantised
from tradewind.session import staged

ROWS = 1024  # vectors of a block
WIDTH = 32  # components of a slice
SLICES = 16  # at most; wider vectors have wider slices
EXACT = 2**52  # sums below this are exact as doubles
WIDE = 24  # bytes of a distance that may leave a long


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest hash of seed and id, ties to the smaller vector; k rows reach the driver."""
    hashed = F.sha2(F.encode(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), "utf-8"), 256)
    best = rows.select("v", hashed.alias("h")).orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    return np.array([[int(x) for x in r["v"]] for r in best], dtype=object).reshape(len(best), len(best[0]["v"]) if best else 0)


def _packed(d: np.ndarray, stored: str) -> bytes:
    if stored == "wide":
        return b"".join(int(x).to_bytes(WIDE, "little") for x in d.ravel())
    return np.ascontiguousarray(d).astype(stored).tobytes()


def _unpacked(data: bytes, stored: str, k: int) -> np.ndarray:
    if stored == "wide":
        d = np.array([int.from_bytes(data[i : i + WIDE], "little") for i in range(0, len(data), WIDE)], dtype=object)
    else:
        d = np.frombuffer(data, stored).astype(np.int64)
    return d.reshape(-1, k)


class Lloyd:
    """Lloyd's rounds over packed slices of vectors.

    A round is three steps: tasks on a slice of a block form exact partial distances
    to the same slice of every centroid; these are added by block and the nearest
    centroid taken; every slice sums its own components by cluster and gives its part
    of the new centroids. k * dim numbers a round reach the driver, whatever the number of rows.
    """

    def __init__(self, vectors: DataFrame, dim: int, k: int, seed: int) -> None:
        rows = quantised(vectors).where(F.col("dim") == dim)
        self.dim, self.scale = dim, numbers(rows)
        self.width = max(WIDTH, -(-dim // SLICES))
        self.data = blocks(rows, self.scale, ROWS, self.width)
        self.centroids = first_centroids(rows, k, seed)
        self.k = len(self.centroids)
        # a component differs from a centroid's by at most twice the largest
        self.far = dim * (2 * self.scale.largest) ** 2
        self.exact = max(self.far, self.scale.rows * self.scale.largest) <= LONG
        self.stored = "wide" if not self.exact else "<i4" if self.far < 2**31 else "<i8"

    def _distances(self, with_ids: bool) -> DataFrame:
        """(block, part, ids, d): squared distances of a block's rows to all centroids, in one slice of components."""
        centroids, width, dim, exact, far = self.centroids, self.width, self.dim, self.exact, self.far
        stored, kept = self.scale.stored, self.stored

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in batches:
                out = []
                for row in rows.itertuples():
                    lo = row.part * width
                    c = centroids[:, lo : min(lo + width, dim)]
                    x = matrix(row.m, stored, c.shape[1], exact)
                    if far < EXACT:
                        x, c = x.astype(np.float64), c.astype(np.float64)
                    elif exact:
                        c = c.astype(np.int64)
                    d = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :]
                    out.append((row.block, row.part, getattr(row, "ids", None), _packed(np.rint(d) if far < EXACT else d, kept)))
                yield pd.DataFrame(out, columns=["block", "part", "ids", "d"])

        read = self.data.select("block", "part", "m", *(["ids"] if with_ids else []))
        return read.mapInPandas(run, "block long, part int, ids array<long>, d binary")

    def _sums(self, nearest: DataFrame) -> DataFrame:
        """(cluster, j, value): the mean of component j over a cluster's rows, rounded down."""
        width, dim, exact, stored = self.width, self.dim, self.exact, self.scale.stored
        whole = "long" if exact else "decimal(38,0)"

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums: dict[tuple[int, int], list] = {}
            for rows in batches:
                for row in rows.itertuples():
                    m = matrix(row.m, stored, min(width, dim - row.part * width), exact)
                    cluster = np.frombuffer(row.c, "<i4")
                    for c in np.unique(cluster).tolist():
                        own = m[cluster == c]
                        s = sums.setdefault((c, row.part), [0, 0])
                        s[0], s[1] = s[0] + own.sum(0), s[1] + len(own)
            for (c, part), (s, n) in sums.items():
                values = s if exact else [int(x) for x in s]
                yield pd.DataFrame({"cluster": c, "j": part * width + np.arange(len(s)), "s": values, "n": n}).astype({"s": "int64" if exact else object})

        shared = self.data.select("block", "part", "m").join(nearest, "block")
        partial = shared.mapInPandas(run, f"cluster int, j int, s {whole}, n long")
        total = partial.groupBy("cluster", "j").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        return total.select("cluster", "j", F.expr("cast((s - pmod(s, n)) / n as decimal(38,0))" if not exact else "(s - pmod(s, n)) div n").alias("value"))

    def round(self) -> None:
        """Assign every vector, then replace the centroids that have any."""
        k, stored = self.k, self.stored

        def nearest(rows: pd.DataFrame) -> pd.DataFrame:
            d = sum(_unpacked(x, stored, k) for x in rows["d"])
            # the first of equal ones
            return pd.DataFrame([(rows["block"].iloc[0], np.argmin(d, axis=1).astype("<i4").tobytes())], columns=["block", "c"])

        assigned = self._distances(False).groupBy("block").applyInPandas(nearest, "block long, c binary")
        for r in self._sums(assigned).collect():
            self.centroids[r["cluster"], r["j"]] = int(r["value"])

    def assigned(self) -> DataFrame:
        """vec_id, cluster, distance of every vector; distances beyond a long are cut to its range."""
        k, stored = self.k, self.stored

        def nearest(rows: pd.DataFrame) -> pd.DataFrame:
            d = sum(_unpacked(x, stored, k) for x in rows["d"])
            cluster = np.argmin(d, axis=1)
            distance = np.minimum(d[np.arange(len(d)), cluster], LONG).astype(np.int64)
            ids = next(list(i) for p, i in zip(rows["part"], rows["ids"]) if p == 0)
            ids = pd.array([None if x is None or x != x else int(x) for x in ids], dtype="Int64")
            return pd.DataFrame({"vec_id": ids, "cluster": cluster.astype(np.int32), "distance": distance})

        return self._distances(True).groupBy("block").applyInPandas(nearest, "vec_id long, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, seed: int = 2) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256 of every vector of `dim` components.

    Components are floor(256 * x). The first centroids are the k vectors with the smallest
    sha256 of "seed:vec_id"; each of `rounds` rounds assigns all vectors to the nearest
    centroid (ties to the smaller number) and replaces every non-empty centroid by the
    means of its vectors, rounded down; then all are assigned once more. Everything
    is exact, also where sums leave a long; results beyond a long are cut to its range.

    Vectors that are null, of another length, or hold a null or non-finite component take
    no part. Repeated ids and rows are vectors of their own, among the first centroids too;
    a vector with a null id is clustered, but starts a centroid only if there are too few
    others. Fewer than k vectors make fewer clusters. Other columns are not carried.
    No vectors give no rows.
    """
    spark = vectors.sparkSession
    lloyd = Lloyd(vectors, dim, k, seed)
    if lloyd.k == 0:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        lloyd.round()
    placed = staged(lloyd.assigned())
    sums = {r[0]: int(r[1]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}
    total = min(sum(sums.values()), LONG)
    figures = [(c, min(s, LONG), total, hashlib.sha256(",".join(map(str, lloyd.centroids[c])).encode()).hexdigest()) for c, s in sums.items()]
    # k rows
    figures = spark.createDataFrame(figures, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = placed.join(F.broadcast(figures), "cluster")
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_centroids(spark, folder):
    return cluster(spark.read.parquet(f"{folder}/embeddings.parquet"))


def lloyd_sql(k: int = 40, rounds: int = 5, dim: int = 64, seed: int = 2) -> str:
    """The same in SQL, a pair of subqueries for every round."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id,
         [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS v
  FROM embeddings
  WHERE len(embedding) = {dim} AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0)""",
        f"pts AS MATERIALIZED (SELECT rid, unnest(range({dim})) AS j, unnest(v) AS x FROM kept)",
        f"""firsts AS (
  SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) - 1 AS cluster, rid FROM kept
  ORDER BY cluster LIMIT {k})""",
        "c0 AS MATERIALIZED (SELECT cluster, j, x FROM firsts JOIN pts USING (rid))",
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT rid, cluster, d FROM (
    SELECT rid, cluster, sum((p.x - c.x) * (p.x - c.x)) AS d FROM pts p JOIN c{i} c USING (j) GROUP BY rid, cluster)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, cluster) = 1)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, c.j, coalesce((s - ((s % n) + n) % n) // n, c.x)::BIGINT AS x
  FROM c{i} c LEFT JOIN (SELECT cluster, j, sum(x) AS s, count(*) AS n FROM a{i} JOIN pts USING (rid) GROUP BY cluster, j) m
  USING (cluster, j))""")
    return f"""WITH {", ".join(steps)},
named AS (SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY j)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)
SELECT vec_id, cluster::INTEGER AS cluster, d::BIGINT AS distance,
       (sum(d) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (rid) JOIN named USING (cluster)"""


OP13_SQL = lloyd_sql()
