"""Centroid clustering beside a plain version."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import sha
from tradewind.llm import clustering

VECTORS = "vec_id long, embedding array<float>"
FAR = 2**63 - 1


def plain(rows, k, rounds, dim, seed=2):
    cut = lambda x: max(-FAR, min(FAR, math.floor(256 * float(np.float32(x)))))
    kept = [(i, [cut(x) for x in e]) for i, e in rows if e is not None and len(e) == dim and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, sha(f"{seed}:{kept[r][0]}"), kept[r][1]))
    centroids = [list(kept[r][1]) for r in order[:k]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        own = assign()
        for c in range(len(centroids)):
            members = [v for (_, v), (x, _) in zip(kept, own) if x == c]
            if members:
                centroids[c] = [sum(col) // len(members) for col in zip(*members)]
    own = assign()
    each = Counter()
    for c, d in own:
        each[c] += min(d, FAR)
    total = min(sum(each.values()), FAR)
    return Counter((i, c, min(d, FAR), min(each[c], FAR), total, sha(",".join(map(str, centroids[c])))) for (i, _), (c, d) in zip(kept, own))


def made(n, dim, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 6] + rng.normal(size=dim) * 0.4]) for i in range(n)]
    same = [0.5] * dim
    rows += [(10_000 + i, same) for i in range(60)]  # ties
    rows += [rows[3], rows[3], (3, same)]
    rows += [(20_001, None), (20_002, []), (20_003, same[1:]), (20_004, [None, *same[1:]]), (20_005, [float("nan"), *same[1:]]), (20_006, [float("-inf"), *same[1:]])]
    return rows + [(None, same), (None, rows[0][1])]


@pytest.mark.parametrize(("dim", "width", "k"), [(10, 4, 7), (5, 32, 12), (64, 32, 40)])
def test_like_plain(spark, monkeypatch, dim, width, k):
    monkeypatch.setattr(clustering, "ROWS", 50)
    monkeypatch.setattr(clustering, "WIDTH", width)
    rows = made(300, dim)
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    for name in ("cluster", "distance", "block", "part", "v", "dim", "flag"):
        df = df.withColumn(name, F.lit("mine"))
    got = clustering.cluster(df, k=k, rounds=3, dim=dim)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert Counter(map(tuple, got.collect())) == plain(rows, k, 3, dim)


def test_huge_values(spark):
    rows = [(i, [x, -x, 1.0]) for i, x in enumerate([3e38, 1e30, -1e25, 1e18, 2.0, 1.0, -3e38])]
    got = clustering.cluster(spark.createDataFrame(rows, VECTORS), k=3, rounds=2, dim=3)
    assert Counter(map(tuple, got.collect())) == plain(rows, 3, 2, 3)


def test_wide_longs(spark):
    rows = [(i, [x, -x / 3, 1.0]) for i, x in enumerate([3e4, 1e6, -1e5, 7e5, 2.0, 1.0, -3e6])]
    got = clustering.cluster(spark.createDataFrame(rows, VECTORS), k=3, rounds=2, dim=3)
    assert Counter(map(tuple, got.collect())) == plain(rows, 3, 2, 3)


def test_few_and_none(spark):
    rows = [(5, [1.0, 2.0]), (6, [1.0, 2.0])]
    got = clustering.cluster(spark.createDataFrame(rows, VECTORS), k=9, rounds=2, dim=2)
    assert Counter(map(tuple, got.collect())) == plain(rows, 9, 2, 2)
    assert clustering.cluster(spark.createDataFrame([], VECTORS)).count() == 0
    assert clustering.cluster(spark.createDataFrame(rows, VECTORS), dim=7).count() == 0


def test_same_for_any_layout(spark):
    df = spark.createDataFrame(made(200, 6), VECTORS)
    first, second = (Counter(map(tuple, clustering.cluster(df.repartition(n), k=5, rounds=2, dim=6).collect())) for n in (1, 7))
    assert first == second
