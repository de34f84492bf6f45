"""Exact score figures beside plain counts."""

import random

import pytest

from tradewind.operators.metrics import area_under_roc, threshold_figures


def made(n=700, levels=40, seed=3):
    rng = random.Random(seed)
    return [(rng.randrange(levels) / levels + (rng.random() < 0.2), int(rng.random() < 0.3)) for _ in range(n)]


@pytest.mark.parametrize("levels", [1, 5, 100_000])
def test_area_counts_every_pair(spark, levels):
    rows = made(levels=levels)
    good, bad = ([s for s, y in rows if y == c] for c in (1, 0))
    want = sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad))
    odd = [*rows, (None, 1), (0.5, None), (float("nan"), 0)]
    got = area_under_roc(spark.createDataFrame(odd, "score double, y int").repartition(5), "score", "y").first()
    assert (got.positives, got.negatives) == (len(good), len(bad)) and got.area == pytest.approx(want, abs=1e-12)


def test_area_of_one_label_or_none(spark):
    one = area_under_roc(spark.createDataFrame([(0.1, 1), (0.2, 1)], "score double, y int"), "score", "y").first()
    assert tuple(one) == (2, 0, None)
    assert tuple(area_under_roc(spark.createDataFrame([], "score double, y int"), "score", "y").first()) == (0, 0, None)


def test_figures_at_thresholds(spark):
    rows = made()
    got = {r.threshold: r for r in threshold_figures(spark.createDataFrame(rows, "score double, y int"), "score", "y", [0.0, 0.5, 9.0]).collect()}
    for t, r in got.items():
        hits = sum(s >= t and y == 1 for s, y in rows)
        alarms = sum(s >= t and y == 0 for s, y in rows)
        misses = sum(y for _, y in rows) - hits
        assert (r.hits, r.false_alarms, r.misses) == (hits, alarms, misses)
        assert r.precision == (hits / (hits + alarms) if hits + alarms else None)
        assert r.recall == hits / (hits + misses) and r.f1 == pytest.approx(2 * hits / (2 * hits + alarms + misses))
