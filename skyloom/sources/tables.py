"""Sinks for features, datasets and metrics."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.functions.values import utc
from skyloom.schemas import avro_schema


#: The folder column of files that are partitioned by the day of their time.
DAY = "event_date"


def write_features(
    df: DataFrame,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    name: str = "Record",
    by_day: str | None = None,
) -> None:
    """Write the declared columns, in schema order, after a type check.

    ``by_day`` names a time column: every UTC day of it gets a folder, so that a range is read
    from its days only. A large day is written by many tasks. ``fmt="avro"`` needs the Avro
    package on the cluster.
    """
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} are missing")
    wrong = [f.name for f in schema if df.schema[f.name].dataType != f.dataType]
    if wrong:
        raise TypeError(f"columns {wrong} do not have the declared type")
    rows = df.select(*schema.names)
    if by_day:
        rows = rows.withColumn(DAY, utc_day(F.col(by_day))).hint("rebalance", DAY)
    writer = rows.write.mode("overwrite").format(fmt)
    if by_day:
        writer = writer.partitionBy(DAY)
    if fmt == "avro":
        writer = writer.option("avroSchema", json.dumps(avro_schema(schema, name, "skyloom")))
    writer.save(path)


def utc_day(time: Column) -> Column:
    """The day in UTC, whatever the zone of the session."""
    return F.date_from_unix_date(F.floor(F.unix_micros(time) / 86_400_000_000).cast("int"))


def scan_features(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    start: datetime | None = None,
    end: datetime | None = None,
    time: str = "timestamp",
) -> DataFrame:
    """Feature files written earlier, all rows or those in ``[start, end)``.

    Of files partitioned by day only the days of the range are listed.
    """
    df = spark.read.format(fmt).schema(schema).load(path)
    by_day = DAY in df.columns
    if start is not None:
        df = df.filter(F.col(time) >= F.lit(utc(start)))
        df = df.filter(F.col(DAY) >= F.lit(utc(start).date())) if by_day else df
    if end is not None:
        df = df.filter(F.col(time) < F.lit(utc(end)))
        df = df.filter(F.col(DAY) <= F.lit(utc(end).date())) if by_day else df
    return df.select(*schema.names)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header line in every file of the folder.

    The output stays sharded; readers take the folder.
    """
    df.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """A train or test set."""
    if fmt == "csv":
        write_csv(df, path)
    else:
        df.write.mode("overwrite").format(fmt).save(path)


def write_parts(df: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Both datasets of a frame with a column ``part`` in one pass, read back.

    Each part is a folder, so reading one does not touch the other.
    """
    df.write.mode("overwrite").partitionBy("part").parquet(path)
    parts = df.sparkSession.read.schema(df.schema).parquet(path)
    return tuple(parts.filter(F.col("part") == p).drop("part") for p in ("train", "test"))


def write_metrics(roc: DataFrame, confusion: DataFrame, path: str) -> None:
    """The curve and the labelled matrix as two tables below ``path``."""
    roc.write.mode("overwrite").parquet(f"{path}/roc_curve")
    confusion.write.mode("overwrite").parquet(f"{path}/confusion_matrix")


def read_metrics(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The curve and the matrix as recorded."""
    roc = spark.read.schema("fpr double, tpr double, threshold double").parquet(f"{path}/roc_curve")
    matrix = spark.read.schema("actual string, predicted_false long, predicted_true long")
    return roc, matrix.parquet(f"{path}/confusion_matrix")
