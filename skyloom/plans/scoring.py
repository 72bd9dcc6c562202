"""M8, M9: scoring requests with a saved model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from skyloom.operators.model import enrich, score
from skyloom.sources.store import FeatureStore


def enrich_and_score(
    requests: DataFrame,
    latest: DataFrame,
    model: PipelineModel,
    *,
    entity: str = "airport_id",
    columns: tuple[str, ...] = ("average_departure_delay",),
) -> DataFrame:
    """Look up the current airport features of each request, then score it."""
    return score(enrich(requests, latest, entity=entity, columns=list(columns)), model)


def score_from_store(
    requests: DataFrame,
    store: FeatureStore,
    model: PipelineModel,
    entity: str = "airport_id",
    *,
    group: str = "airport",
    columns: tuple[str, ...] = ("average_departure_delay",),
) -> DataFrame:
    """Requests with the current features of a group and their score; the history is not read."""
    latest = store.read_latest(store.group(group), list(columns))
    return enrich_and_score(requests, latest, model, entity=entity, columns=columns)


def score_instances(
    spark: SparkSession, instances: list[list[float]], features: list[str], model: PipelineModel
) -> DataFrame:
    """A few request vectors typed in by hand; ``features`` names their positions."""
    schema = ", ".join(f"`{name}` double" for name in features)
    return score(spark.createDataFrame([tuple(map(float, i)) for i in instances], schema), model)
