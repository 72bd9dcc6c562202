import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.operators.model import (
    enrich,
    fit_classifier,
    fit_preparation,
    load_model,
    model_weights,
    save_model,
    score,
    score_linear,
)

FEATURES = ["a", "b", "c"]


def make_rows():
    rng = random.Random(2)
    out = []
    for i in range(1500):
        a, b, c = rng.gauss(0, 20), rng.uniform(0, 100), rng.expovariate(0.01)
        y = a * 0.1 + b * 0.02 + rng.gauss(0, 2) > 1
        if i % 17 == 0:
            b = None
        if i % 23 == 0:
            c = math.nan
        out.append((i, a, b, c, y))
    return out


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(
        make_rows(), "id int, a double, b double, c double, target boolean"
    ).cache()


def newton():
    rows = make_rows()
    x = np.array([[math.nan if v is None else v for v in r[1:4]] for r in rows])
    y = np.array([r[4] for r in rows], float)
    x = np.where(np.isnan(x), np.nanmedian(x, axis=0), x)
    z = (x - x.mean(0)) / x.std(0)
    design = np.c_[z, np.ones(len(z))]
    ridge = np.diag([1.0, 1.0, 1.0, 0.0])
    w = np.zeros(4)
    for _ in range(25):
        p = 1 / (1 + np.exp(-design @ w))
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + ridge
        w -= np.linalg.solve(hessian, design.T @ (p - y) + ridge @ w)
    return x, z, design, w


@pytest.fixture(scope="module")
def model(train):
    return fit_classifier(train, FEATURES)


def test_preparation(train):
    x, z, _, _ = newton()
    prepared = fit_preparation(train, FEATURES)
    filled = prepared.impute(train).orderBy("id").select(*FEATURES).collect()
    assert np.allclose(filled, x)
    scaled = prepared.standardise(train).orderBy("id").select(*FEATURES).collect()
    assert np.allclose(scaled, z)


def test_weights_match_an_independent_solver(model):
    *_, w = newton()
    assert np.allclose(list(model_weights(model).values()), w, atol=1e-5)
    assert list(model_weights(model)) == [*FEATURES, "intercept"]


def test_scores(model, train):
    _, _, design, w = newton()
    got = score(train, model).orderBy("id").collect()
    p = 1 / (1 + np.exp(-design @ w))
    assert np.allclose([r.score for r in got], p, atol=1e-5)
    assert [r.prediction for r in got] == [bool(v) for v in p > 0.5]
    assert score(train, model).columns == [*train.columns, "prediction", "score"]


def test_column_order_does_not_matter(model, train):
    turned = score(train.select("c", "id", "b", "a"), model)
    straight = score(train, model)
    difference = turned.select("id", "score").exceptAll(straight.select("id", "score"))
    assert difference.count() == 0


def test_save_and_load(model, train, tmp_path):
    path = str(tmp_path / "model")
    save_model(model, path)
    again = score(train, load_model(path)).select("id", "score")
    assert again.exceptAll(score(train, model).select("id", "score")).count() == 0


def test_constant_and_empty_features(spark):
    rows = [(float(i), 3.0, None, i > 5) for i in range(12)]
    df = spark.createDataFrame(rows, "a double, same double, empty double, target boolean")
    fitted = fit_classifier(df, ["a", "same", "empty"])
    weights = model_weights(fitted)
    assert list(weights) == ["a", "same", "intercept"]
    assert weights["same"] == pytest.approx(0.0, abs=1e-9)


def test_one_class_is_refused(spark):
    df = spark.createDataFrame([(1.0, True), (2.0, True)], "a double, target boolean")
    with pytest.raises(ValueError):
        fit_classifier(df, ["a"])


def test_linear_score(spark):
    df = spark.createDataFrame([(1.0, 2.0), (0.0, 0.0)], "a double, b double")
    got = score_linear(df, {"b": 0.5, "a": -1.0}, 0.0).collect()
    assert [r.score for r in got] == [0.5, 0.5]
    assert [r.prediction for r in got] == [False, False]


def test_enrich_keeps_unknown_requests(spark):
    requests = spark.createDataFrame([(1, "x"), (2, "?"), (3, None)], "id int, airport_id string")
    latest = spark.createDataFrame([("x", 4.0)], "entity_id string, m double")
    got = enrich(requests, latest, entity="airport_id", columns=["m"]).orderBy("id").collect()
    assert [r.m for r in got] == [4.0, None, None]


def test_no_python_in_scoring(model, train):
    plan = score(train, model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan.split("InMemoryRelation")[0]


def test_nan_in_a_request_takes_the_median(model, spark):
    df = spark.createDataFrame([(1.0, None, 2.0), (1.0, math.nan, 2.0)], "a double, b double, c double")
    one, two = score(df, model).select("score").collect()
    assert one == two
    assert score(df.withColumn("b", F.lit(None).cast("double")), model).first().score == one[0]
