"""Raw text rows to typed flights, with the rejected rows beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.functions.values import (
    departure_time,
    exceeds,
    iso_utc,
    parse_double,
    text_or_empty,
)
from skyloom.schemas import FLIGHT_SCHEMA

HEADER_REASON = "header"

# The raw columns a flight is made of.
SOURCE_COLUMNS = [
    "Year",
    "FlightDate",
    "Reporting_Airline",
    "Flight_Number_Reporting_Airline",
    "OriginAirportID",
    "DepDelay",
    "TaxiOut",
    "WheelsOff",
    "ArrDelay",
    "Cancelled",
    "Diverted",
    "Distance",
]

_NUMBERS = {
    "departure_delay_minutes": "DepDelay",
    "arrival_delay_minutes": "ArrDelay",
    "taxi_out_minutes": "TaxiOut",
    "distance_miles": "Distance",
}


def judge_flights(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Typed columns and a ``reason`` that is null for good rows; no shuffle.

    ``keep`` names raw columns to pass on, such as a sequence number. Blank or
    short rows and unreadable cancel flags are rejected with a reason rather than
    stopping the job.

    The typed record is opened by ``inline``: a filter on its columns stays above
    it, so each text is parsed once per row. As a plain projection the optimizer
    would copy every parse into the filter below it.
    """
    cancelled = parse_double(F.col("Cancelled"))
    diverted = parse_double(F.col("Diverted"))
    shape = (
        F.when(F.col("Year") == "Year", HEADER_REASON)
        .when(F.coalesce(F.length("WheelsOff"), F.lit(0)) != 4, "wheels_off_length")
        .when(F.coalesce(F.length("FlightDate"), F.lit(0)) != 10, "flight_date_length")
        .when(F.coalesce(F.length("Distance"), F.lit(0)) == 0, "no_distance")
    )
    record = F.struct(
        shape.alias("shape"),
        departure_time(F.col("FlightDate"), F.col("WheelsOff")).alias("timestamp"),
        F.concat(
            text_or_empty(F.col("Reporting_Airline")),
            F.lit("//"),
            text_or_empty(F.col("Flight_Number_Reporting_Airline")),
        ).alias("flight_number"),
        text_or_empty(F.col("OriginAirportID")).alias("origin_airport_id"),
        cancelled.alias("cancelled"),
        diverted.alias("diverted"),
        *[parse_double(F.col(source)).alias(name) for name, source in _NUMBERS.items()],
    )
    # The second flag is looked at only when the first is not set.
    is_cancelled = F.when(
        F.col("cancelled").isNotNull(),
        F.when(exceeds(F.col("cancelled"), 0), F.lit(True)).when(
            F.col("diverted").isNotNull(), exceeds(F.col("diverted"), 0)
        ),
    )
    typed = raw.select(*(keep or []), F.inline(F.array(record))).withColumn(
        "is_cancelled", is_cancelled
    )
    reason = F.when(F.col("is_cancelled").isNull(), "cancel_flag").when(
        F.col("timestamp").isNull(), "time"
    )
    for name in _NUMBERS:
        reason = reason.when(F.col(name).isNull(), name)
    return typed.withColumn("reason", F.coalesce(F.col("shape"), reason))


def clean_flights(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The flights every later step reads."""
    good = judge_flights(raw, keep).filter(F.col("reason").isNull())
    return good.select(*(keep or []), *FLIGHT_SCHEMA.names)


def rejected_flights(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """What ``clean_flights`` leaves out, with the first reason; header rows excepted."""
    bad = judge_flights(raw, keep).filter(
        F.col("reason").isNotNull() & (F.col("reason") != HEADER_REASON)
    )
    return bad.select(*(keep or []), "flight_number", "reason")


def read_instances(flights: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The request rows of the point-in-time join, time as ISO text."""
    return flights.select(
        *(keep or []),
        F.col("flight_number").alias("flight"),
        F.col("origin_airport_id").alias("airport"),
        iso_utc(F.col("timestamp")).alias("timestamp"),
    )
