"""Readers of the raw flight files and of the files the jobs exchange."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.schemas import FLIGHT_SCHEMA, RAW_SCHEMA, READ_INSTANCE_SCHEMA
from skyloom.sources.tables import scan_features

# A quote inside a quoted field is doubled, not escaped.
CSV_DIALECT = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def scan_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line, header lines included, column ``line``."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def decode_lines(
    lines: DataFrame, columns: list[str] | None = None, line: str = "line"
) -> DataFrame:
    """Lines to text columns by position, all 109 or those named.

    Missing fields are null and fields beyond the last are ignored. ``from_csv``
    converts every field of its schema, so the schema ends at the last column
    wanted.
    """
    wanted = columns or RAW_SCHEMA.names
    last = max(RAW_SCHEMA.names.index(name) for name in wanted)
    ddl = ", ".join(f"`{name}` STRING" for name in RAW_SCHEMA.names[: last + 1])
    parsed = F.from_csv(F.col(line), ddl, CSV_DIALECT)
    others = [c for c in lines.columns if c != line]
    return lines.withColumn("_raw", parsed).select(
        *others, *[F.col("_raw")[name].alias(name) for name in wanted]
    )


def scan_raw(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S1 to S3 in one reader: CSV files bound by position; header rows stay in."""
    return spark.read.options(**CSV_DIALECT).schema(RAW_SCHEMA).csv(path)


def scan_by_header(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """CSV bound by the names in its header row; every value stays text.

    All files must have the header of the first: one with other names, or the same in
    another order, stops the job. Header rows repeated inside a file are dropped. Types
    are never inferred: a clock text such as ``0930`` would become 930.
    """
    options = {**CSV_DIALECT, "header": True, "inferSchema": False}
    schema = spark.read.options(**options).csv(path).schema
    df = spark.read.options(**options, enforceSchema=False).schema(schema).csv(path)
    df = df.select(*columns) if columns else df
    repeated = reduce(and_, [F.col(f"`{c}`").eqNullSafe(F.lit(c)) for c in df.columns])
    return df.where(~repeated)


def scan_read_instances(spark: SparkSession, path: str) -> DataFrame:
    """Request rows ``flight, airport, timestamp``; both ids stay text."""
    return (
        spark.read.options(**CSV_DIALECT, header=True)
        .schema("flight string, airport string, timestamp string")
        .csv(path)
        .withColumn("timestamp", F.to_timestamp("timestamp"))
        .select(*READ_INSTANCE_SCHEMA.names)
    )


def scan_flights(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Typed flights written earlier, all or those in ``[start, end)``."""
    return scan_features(spark, path, FLIGHT_SCHEMA, fmt, start, end)
