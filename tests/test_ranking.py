import math
import random

import numpy as np
import pytest

from skyloom.operators.ranking import (
    MOST_BUCKETS,
    bucket_count,
    column_medians,
    column_moments,
    running_totals,
)


def columns():
    rng = random.Random(3)
    n = 3001
    return {
        "spread": [rng.lognormvariate(0, 4) for _ in range(n)],
        "third": [7.0 if i % 3 == 0 else rng.uniform(0, 14) for i in range(n)],
        "most": [1.0] * (n - 200) + [rng.random() for _ in range(200)],
        "two": [float(i % 2) for i in range(n)],
        "gaps": [None if i % 4 == 0 else math.nan if i % 5 == 0 else float(i) for i in range(n)],
        "few": [None] * (n - 2) + [1.0, 4.0],
        "none": [None] * n,
        "negative": [-rng.random() * 10**rng.randrange(6) for _ in range(n)],
    }


@pytest.fixture(scope="module")
def wide(spark):
    data = columns()
    rows = list(zip(*data.values()))
    schema = ", ".join(f"{c} double" for c in data)
    return spark.createDataFrame(rows, schema).repartition(5).cache()


def expected():
    out = {}
    for name, values in columns().items():
        known = [v for v in values if v is not None and not math.isnan(v)]
        if known:
            out[name] = float(np.median(known))
    return out


@pytest.mark.parametrize("limit, accuracy", [(1_000_000, 10_000), (200, 50), (5, 20), (0, 1000)])
def test_median_is_exact_at_any_limit(wide, limit, accuracy):
    got = column_medians(wide, wide.columns, limit=limit, accuracy=accuracy)
    assert got == pytest.approx(expected(), rel=0, abs=0)


def test_even_count_takes_the_midpoint(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (float("nan"),)], "v double")
    assert column_medians(df, ["v"]) == {"v": 2.5}


def test_moments(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1.0,), (2.0,), (6.0,)], "v double")
    mean, std = column_moments(df, {"v": F.col("v")})["v"]
    assert (mean, std) == pytest.approx((3.0, np.std([1, 2, 6])))


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("buckets", [1, 2, 7, 256])
def test_running_totals(spark, descending, buckets):
    rng = random.Random(5)
    # Nearly all values crowd into a tiny part of the range.
    keys = sorted({rng.random() ** 30 for _ in range(500)} | {0.5, 1.0})
    rows = [(k, rng.randrange(5), rng.randrange(5)) for k in keys]
    df = spark.createDataFrame(rows, "s double, a long, b long")
    got = running_totals(df, "s", ["a", "b"], descending=descending, buckets=buckets).collect()
    ordered = rows[::-1] if descending else rows
    sums = np.cumsum([[a, b] for _, a, b in ordered], axis=0).tolist()
    following = [list(r[1:]) for r in ordered[1:]] + [[None, None]]
    expected = {r[0]: (*s, *f) for r, s, f in zip(ordered, sums, following)}
    assert {r.s: (r.cum_a, r.cum_b, r.next_a, r.next_b) for r in got} == expected


def test_running_totals_of_one_and_no_row(spark):
    df = spark.createDataFrame([(0.5, 2)], "s double, a long")
    assert [r.cum_a for r in running_totals(df, "s", ["a"]).collect()] == [2]
    assert running_totals(df.filter("a < 0"), "s", ["a"]).count() == 0


def test_bucket_count_is_bounded():
    assert bucket_count(0) == bucket_count(5_000) == 64
    assert bucket_count(10**9) == 5_000
    assert bucket_count(10**15) == MOST_BUCKETS


@pytest.mark.parametrize("ends", [(0.0, 0.05), (0.9, 1.0), (0.97, 0.99), (0.3, 0.3)])
def test_median_where_the_quantiles_miss(spark, monkeypatch, ends):
    """The bracket is forced to a wrong place for some rounds, with more values left than may be ranked."""
    from pyspark.sql import functions as F
    from skyloom.operators import ranking

    rng = random.Random(8)
    values = [float(rng.choice([rng.randrange(40), rng.random() * 100])) for _ in range(1501)]
    df = spark.createDataFrame([(v, v if i % 2 else None) for i, v in enumerate(values)], "a double, b double")
    real, rounds = ranking._bracket, []

    def wrong(searches, accuracy):
        rounds.append({c: s.inside for c, s in searches.items()})
        if len(rounds) > 4:
            return real(searches, accuracy)
        return [
            F.percentile_approx(F.when(s.holds(F.col(c)), F.col(c)), list(ends), accuracy).alias(c)
            for c, s in searches.items()
        ]

    monkeypatch.setattr(ranking, "_bracket", wrong)
    got = column_medians(df, ["a", "b"], limit=20)
    assert got == {"a": np.median(values), "b": np.median(values[1::2])}
    sizes = [r["a"] for r in rounds if "a" in r]
    assert len(sizes) > 1 and sizes == sorted(sizes, reverse=True)
