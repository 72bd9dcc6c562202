"""Training sets: completed flights, labels, time split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.values import exceeds, parse_double

# A flight is late when it arrives over 15 minutes after schedule;
# rows from this date on are the test set.
LATE_MINUTES = 15
SPLIT_DATE = "2021-12-20"

RAW_FEATURES = ["DepDelay", "TaxiOut", "Distance"]
JOINED_FEATURES = [
    "departure_delay_minutes",
    "taxi_out_minutes",
    "distance_miles",
    "average_departure_delay",
]


def is_late(arrival_delay: Column) -> Column:
    """Strictly over the limit; a missing delay is not late."""
    return exceeds(arrival_delay, LATE_MINUTES)


def raw_training_rows(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """P13, P14, P16 on raw text rows: features may be null, as in the files."""
    cancelled = exceeds(parse_double(F.col("Cancelled")), 0)
    diverted = exceeds(parse_double(F.col("Diverted")), 0)
    return raw.filter(~(cancelled | diverted)).select(
        *(keep or []),
        *[parse_double(F.col(c)).alias(c) for c in RAW_FEATURES],
        is_late(parse_double(F.col("ArrDelay"))).alias("target"),
        "FlightDate",
    )


def joined_training_rows(joined: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """P13, P15, P16 on served rows: identifiers and the leaking arrival delay go."""
    completed = joined.filter(~F.coalesce(F.col("is_cancelled"), F.lit(False)))
    return completed.select(
        *(keep or []),
        *JOINED_FEATURES,
        is_late(F.col("arrival_delay_minutes")).alias("target"),
        "timestamp",
    )


def _sides(df: DataFrame, time: str, split: str) -> tuple[Column, Column]:
    at = F.lit(split).cast(df.schema[time].dataType)
    return F.col(time) < at, F.col(time) >= at


def time_split(
    df: DataFrame, time: str, split: str = SPLIT_DATE, day: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows before the split and rows from it on; the time column goes.

    A row without a time is in neither part. Two filters on one plan; where ``day`` names the
    folder column of a source partitioned by the day of ``time``, each part reads its own folders.
    """
    train, test = _sides(df, time, split)
    if day:
        at = F.lit(split).cast("date")
        train, test = train & (F.col(day) <= at), test & (F.col(day) >= at)
    return df.filter(train).drop(time), df.filter(test).drop(time)


def split_parts(df: DataFrame, time: str, split: str = SPLIT_DATE) -> DataFrame:
    """P17 as one frame with a column ``part``, for a source that is costly to compute twice."""
    train, test = _sides(df, time, split)
    parted = df.withColumn("part", F.when(train, "train").when(test, "test"))
    return parted.filter(F.col("part").isNotNull()).drop(time)


def first_rows(df: DataFrame, order: list[str], n: int | None = None) -> DataFrame:
    """L1: the first ``n`` rows in a named order; by default all of them."""
    return df if n is None else df.orderBy(*order).limit(n)
