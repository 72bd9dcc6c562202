"""M8, M9 on a stream of requests."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from skyloom.plans.scoring import score_from_store
from skyloom.sources.store import FeatureStore


def score_stream(
    requests: DataFrame,
    store: FeatureStore,
    model: PipelineModel,
    path: str,
    checkpoint: str,
    *,
    available_now: bool = False,
    **options,
) -> StreamingQuery:
    """Arriving requests with the features that are current when their micro-batch runs, and their score.

    Every micro-batch reads the table of latest records anew, so an ingest between two batches
    reaches the second. Each batch writes a folder of its own, which a repeated batch replaces:
    each request is scored once in the output. ``options`` go to ``score_from_store``.
    """

    def each(batch: DataFrame, number: int) -> None:
        scored = score_from_store(batch, store, model, **options)
        scored.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = requests.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
