import math
import random

import numpy as np
import pytest

from skyloom.operators.metrics import confusion_matrix, roc_curve


def brute(rows, drop):
    """The published curve: cumulated counts at each distinct score, highest first."""
    scores = sorted({s for s, _ in rows}, reverse=True)
    tps = np.array([sum(y for s, y in rows if s >= t) for t in scores])
    fps = np.array([sum(not y for s, y in rows if s >= t) for t in scores])
    keep = np.ones(len(scores), bool)
    if drop and len(scores) > 2:
        bend = (np.diff(tps, 2) != 0) | (np.diff(fps, 2) != 0)
        keep[1:-1] = bend
    points = [(f / fps[-1], t / tps[-1], s) for f, t, s, k in zip(fps, tps, scores, keep) if k]
    return sorted([(0.0, 0.0, scores[0] + 1), *points])


def scored(spark, rows):
    return spark.createDataFrame(rows, "score double, target boolean")


def points(df):
    return sorted((r.fpr, r.tpr, r.threshold) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    base = [(round(rng.random() ** 4, 2 + i % 2), rng.random() < 0.4) for i in range(700)]
    return base + [(0.25, i % 3 == 0) for i in range(350)]


@pytest.mark.parametrize("drop", [True, False])
@pytest.mark.parametrize("buckets", [1, 5, 256])
def test_roc(spark, rows, drop, buckets):
    got = points(roc_curve(scored(spark, rows), drop_intermediate=drop, buckets=buckets))
    expected = brute(rows, drop)
    assert len(got) == len(expected)
    assert np.allclose(got, expected, atol=1e-12)


def test_roc_is_monotone_and_ends_at_one(spark, rows):
    got = points(roc_curve(scored(spark, rows)))
    assert got[0][:2] == (0.0, 0.0) and got[-1][:2] == (1.0, 1.0)
    assert all(a[1] <= b[1] for a, b in zip(got, got[1:]))


@pytest.mark.parametrize("drop", [True, False])
def test_tied_scores_give_one_step(spark, drop):
    df = scored(spark, [(0.5, True), (0.5, False), (0.5, True)])
    assert points(roc_curve(df, drop_intermediate=drop)) == [(0.0, 0.0, 1.5), (1.0, 1.0, 0.5)]


def test_one_class_only(spark):
    got = roc_curve(scored(spark, [(0.2, True), (0.4, True)])).collect()
    assert all(math.isnan(r.fpr) for r in got)
    assert sorted(r.tpr for r in got) == [0.0, 0.5, 1.0]


def test_no_rows(spark):
    assert roc_curve(scored(spark, [])).count() == 0


def test_confusion_matrix(spark):
    rows = [(True, True)] * 3 + [(True, False)] * 2 + [(False, True)]
    df = spark.createDataFrame(rows, "target boolean, prediction boolean")
    assert [tuple(r) for r in confusion_matrix(df).collect()] == [("False", 0, 1), ("True", 2, 3)]


def test_confusion_matrix_of_one_class_has_both_rows(spark):
    df = spark.createDataFrame([(False, False)], "target boolean, prediction boolean")
    assert [tuple(r) for r in confusion_matrix(df).collect()] == [("False", 1, 0), ("True", 0, 0)]
