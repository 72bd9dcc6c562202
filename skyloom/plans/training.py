"""Training sets, training and evaluation as one application."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from skyloom.operators.dataset import (
    JOINED_FEATURES,
    RAW_FEATURES,
    SPLIT_DATE,
    first_rows,
    joined_training_rows,
    raw_training_rows,
    split_parts,
)
from skyloom.operators.metrics import confusion_matrix, roc_curve
from skyloom.operators.model import fit_classifier, load_model, save_model, score
from skyloom.session import materialise, scratch_path
from skyloom.sources.flights import scan_by_header, scan_read_instances
from skyloom.sources.store import FeatureStore
from skyloom.sources.tables import read_metrics, write_metrics, write_parts


@dataclass(frozen=True)
class Evaluation:
    """M7: metric tables of a scored test set."""

    model: PipelineModel
    scored: DataFrame
    confusion: DataFrame
    roc: DataFrame


def raw_rows(spark: SparkSession, path: str) -> DataFrame:
    """Labelled rows straight from the raw files, with ``FlightDate``."""
    return raw_training_rows(scan_by_header(spark, path))


def joined_rows(
    store: FeatureStore, spine: DataFrame, keep: list[str] | None = None, **options
) -> DataFrame:
    """Labelled rows from request rows and the feature store, with ``timestamp``."""
    joined = store.serve(spine, {"flight": ["*"], "airport": ["*"]}, **options)
    return joined_training_rows(joined, keep)


def evaluate(
    model: PipelineModel,
    test: DataFrame,
    label: str = "target",
    *,
    order: list[str] | None = None,
    limit: int | None = None,
    buckets: int | None = None,
    output: str | None = None,
) -> Evaluation:
    """M5 to M7, A4, A5 on the test set, or on its first ``limit`` rows in ``order``.

    The scored rows are written once, below ``output`` if named, and read by both metrics.
    """
    rows = first_rows(test, order or [], limit)
    base = output or scratch_path(test.sparkSession, "evaluation")
    scored = materialise(score(rows, model), "scored", f"{base}/scored")
    return Evaluation(
        model,
        scored,
        confusion_matrix(scored, label),
        roc_curve(scored, label, buckets=buckets, path=f"{base}/roc_counts"),
    )


def train_and_evaluate(
    rows: DataFrame,
    time: str,
    features: list[str],
    *,
    split: str = SPLIT_DATE,
    output: str | None = None,
    **options,
) -> Evaluation:
    """Split and write the datasets, fit, save, reload, evaluate, record the metrics.

    ``output`` is a folder of the shared file system; everything the steps hand
    on is a table in it. The rows are computed once for both datasets.
    """
    base = output or scratch_path(rows.sparkSession, "training")
    train, test = write_parts(split_parts(rows, time, split), f"{base}/datasets")
    save_model(fit_classifier(train, features), f"{base}/model")
    result = evaluate(load_model(f"{base}/model"), test, output=base, **options)
    write_metrics(result.roc, result.confusion, f"{base}/metrics")
    roc, confusion = read_metrics(rows.sparkSession, f"{base}/metrics")
    return Evaluation(result.model, result.scored, confusion, roc)


def run_raw_training(
    spark: SparkSession, training_data: str, test_split_date: str = SPLIT_DATE, **options
) -> Evaluation:
    """The training job on raw files."""
    rows = raw_rows(spark, training_data)
    return train_and_evaluate(rows, "FlightDate", RAW_FEATURES, split=test_split_date, **options)


def run_joined_training(
    store: FeatureStore,
    read_instances: str,
    test_split_date: str = SPLIT_DATE,
    *,
    exact: tuple[str, ...] = (),
    bucket: str = "1 day",
    max_age: str | None = None,
    **options,
) -> Evaluation:
    """The training job on request rows and the feature store."""
    spine = scan_read_instances(store.spark, read_instances)
    rows = joined_rows(store, spine, exact=exact, bucket=bucket, max_age=max_age)
    return train_and_evaluate(rows, "timestamp", JOINED_FEATURES, split=test_split_date, **options)
