"""Over-sampling beside brute force: neighbours, points between them, class ratio."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.operators import oversample as O

SHAPE = "y int, f array<double>"


def made(n=150, seed=2):
    rng = random.Random(seed)
    rows = [(int(i % 5 == 0), [float(rng.randrange(6)), rng.random(), float(rng.randrange(3))]) for i in range(n)]
    return [*rows, rows[0], rows[0], (1, None), (1, [None, 1.0, 2.0]), (None, [1.0, 1.0, 1.0])]


def brute(points, k):
    """The k nearest other points of each, by distance."""
    return {p: sorted(float(((np.array(p) - np.array(q)) ** 2).sum()) for q in points if q != p)[:k] for p in points}


@pytest.mark.parametrize("block", [7, 2048])
def test_nearest_like_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(O, "BLOCK_ROWS", block)
    points = {tuple(f) for y, f in made() if y == 1 and f and None not in f}
    rows = spark.createDataFrame([(i, list(p)) for i, p in enumerate(sorted(points))], "id long, features array<double>")
    got = {}
    for r in O.nearest(rows.repartition(4), 4).orderBy("id", "place").collect():
        got.setdefault(r.id, []).append(r.distance)
    want = brute(points, 4)
    assert {p: pytest.approx(want[p]) for p in points} == {p: got[i] for i, p in enumerate(sorted(points))}


@pytest.mark.parametrize("ratio", [1.0, 0.61])
def test_new_rows_lie_between_neighbours(spark, ratio):
    rows = made()
    df = spark.createDataFrame(rows, SHAPE)
    out = O.oversample(df.repartition(5), "y", "f", ratio, k=3)
    got = out.collect()
    rare, rest = (sum(y == c for y, _ in rows) for c in (1, 0))
    new = [r for r in got if r.made]
    assert len(got) - len(new) == len(rows) and len(new) == int(ratio * rest) - rare
    points = {tuple(f) for y, f in rows if y == 1 and f and None not in f}
    near = brute(points, 3)
    made_by = dict.fromkeys(points, 0)
    for r in new:
        a, b, p = np.array(r.origin), np.array(r.towards), np.array(r.f)
        assert r.y == 1 and tuple(a) in points and tuple(b) in points
        assert ((a - b) ** 2).sum() <= near[tuple(a)][-1] + 1e-12
        t = (p - a) @ (b - a) / ((b - a) @ (b - a))
        assert 0 <= t < 1 and np.allclose(p, a + t * (b - a))
        made_by[tuple(a)] += 1
    assert max(made_by.values()) - min(made_by.values()) <= 1
    again = O.oversample(df.repartition(2), "y", "f", ratio, k=3).where("made")
    assert sorted(r.f for r in again.collect()) == sorted(r.f for r in new)


def test_few_and_none(spark):
    one = O.oversample(spark.createDataFrame([(1, [1.0, 2.0]), *[(0, [float(i), 0.0]) for i in range(5)]], SHAPE), "y", "f")
    assert [r.f for r in one.where("made").collect()] == [[1.0, 2.0]] * 4
    assert O.oversample(spark.createDataFrame([(0, [1.0])], SHAPE), "y", "f").where("made").count() == 0
    assert O.oversample(spark.createDataFrame([(1, [1.0]), (1, [2.0]), (0, [1.0])], SHAPE), "y", "f").count() == 3
    assert O.oversample(spark.createDataFrame([], SHAPE), "y", "f").where(F.lit(True)).count() == 0
