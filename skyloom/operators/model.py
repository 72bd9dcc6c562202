"""Imputation, scaling, logistic regression and scoring."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.values import nan_to_null
from skyloom.operators.ranking import column_medians, column_moments

_VECTOR, _LABEL = "_vector", "_label"


@dataclass(frozen=True)
class Preparation:
    """Median, mean and population deviation of each feature, in feature order."""

    statistics: dict[str, tuple[float, float, float]]

    @property
    def features(self) -> list[str]:
        return list(self.statistics)

    def imputed(self, name: str) -> Column:
        median = self.statistics[name][0]
        return F.coalesce(nan_to_null(F.col(name)), F.lit(median))

    def standardised(self, name: str) -> Column:
        _, mean, std = self.statistics[name]
        return (self.imputed(name) - F.lit(mean)) / F.lit(std)

    def impute(self, df: DataFrame) -> DataFrame:
        """M1."""
        return df.withColumns({name: self.imputed(name) for name in self.features})

    def standardise(self, df: DataFrame) -> DataFrame:
        """M2, on imputed values."""
        return df.withColumns({name: self.standardised(name) for name in self.features})

    def stage(self) -> SQLTransformer:
        """M1 and M2 as one stage that saves, loads and runs on a stream."""
        terms = []
        for name, numbers in self.statistics.items():
            median, mean, std = (f"CAST('{n!r}' AS DOUBLE)" for n in numbers)
            known = f"nanvl(CAST(`{name}` AS DOUBLE), CAST(NULL AS DOUBLE))"
            terms.append(f"(coalesce({known}, {median}) - {mean}) / {std} AS `_z_{name}`")
        return SQLTransformer(statement=f"SELECT *, {', '.join(terms)} FROM __THIS__")


def fit_preparation(train: DataFrame, features: list[str]) -> Preparation:
    """A2, A3: statistics of the imputed features; features without a value are left out.

    A constant feature is divided by one.
    """
    medians = column_medians(train, features)
    imputed = {c: F.coalesce(nan_to_null(F.col(c)), F.lit(m)) for c, m in medians.items()}
    moments = column_moments(train, imputed)
    return Preparation({c: (medians[c], mean, std or 1.0) for c, (mean, std) in moments.items()})


def fit_classifier(
    train: DataFrame,
    features: list[str],
    label: str = "target",
    *,
    c: float = 1.0,
    max_iter: int = 100,
    tol: float = 1e-9,
) -> PipelineModel:
    """M1 to M4: the whole model on a training set.

    ``c`` is the inverse strength of an L2 penalty set against the summed loss;
    the library averages the loss, hence ``1 / (c * rows)``. The training set is
    read once per iteration, so pass a written table or a cached frame.
    """
    size = train.agg(
        F.count("*").alias("rows"), F.count_if(F.col(label).cast("boolean")).alias("late")
    ).first()
    if size.late in (0, size["rows"]):
        raise ValueError("the training set needs rows of both classes")
    preparation = fit_preparation(train, features)
    pipeline = Pipeline(
        stages=[
            preparation.stage(),
            VectorAssembler(
                inputCols=[f"_z_{name}" for name in preparation.features], outputCol=_VECTOR
            ),
            LogisticRegression(
                featuresCol=_VECTOR,
                labelCol=_LABEL,
                regParam=1.0 / (c * size["rows"]),
                elasticNetParam=0.0,
                standardization=False,
                maxIter=max_iter,
                tol=tol,
            ),
        ]
    )
    labelled = train.select(*features, F.col(label).cast("double").alias(_LABEL))
    return pipeline.fit(labelled)


def save_model(model: PipelineModel, path: str) -> None:
    """S15."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """S15."""
    return PipelineModel.load(path)


def score(df: DataFrame, model: PipelineModel) -> DataFrame:
    """M5, M6, M8: ``prediction`` (boolean) and ``score``, on a batch or a stream.

    Features are taken by name, whatever the order of the request columns.
    """
    scored = model.transform(df)
    return scored.select(
        *df.columns,
        (F.col("prediction") > 0).alias("prediction"),
        vector_to_array("probability")[1].alias("score"),
    )


def model_weights(model: PipelineModel) -> dict[str, float]:
    """Weights on the standardised features, and the intercept; one number per feature."""
    assembler, classifier = model.stages[-2], model.stages[-1]
    names = [name.removeprefix("_z_") for name in assembler.getInputCols()]
    weights = dict(zip(names, (float(w) for w in classifier.coefficients)))
    return {**weights, "intercept": float(classifier.intercept)}


def score_linear(df: DataFrame, weights: dict[str, float], intercept: float) -> DataFrame:
    """P19, M6 with given weights: a plain expression inside code generation."""
    margin = F.lit(float(intercept))
    for name, weight in weights.items():
        margin = margin + F.lit(float(weight)) * F.col(name)
    probability = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
    return df.withColumn("score", probability).withColumn("prediction", F.col("score") > 0.5)


def enrich(
    requests: DataFrame, latest: DataFrame, *, entity: str, columns: list[str]
) -> DataFrame:
    """M9: add the newest features of each request's entity; requests are all kept.

    ``latest`` has one row per entity and is joined by equality without a hint:
    from its size Spark broadcasts it or shuffles both sides. On a stream pass a
    written table, whose size is known when the query is planned.
    """
    found = latest.select(F.col("entity_id").alias("_e"), *columns)
    return requests.join(found, requests[entity] == found["_e"], "left").drop("_e")
