"""Streaming readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyloom.schemas import RAW_SCHEMA
from skyloom.sources.events import EVENTS_SCHEMA
from skyloom.sources.flights import CSV_DIALECT


def stream_raw(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Raw CSV files as they arrive in a folder."""
    reader = spark.readStream.options(**CSV_DIALECT).schema(RAW_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(path)


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as a stream."""
    return (
        spark.readStream.schema(EVENTS_SCHEMA)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
