"""The ``events`` test table in the shape of raw flight rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.schemas import RAW_SCHEMA

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)


def scan_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def raw_flights(events: DataFrame, more: dict[str, Column] | None = None) -> DataFrame:
    """Events as raw text rows plus ``event_id``; columns not listed are null.

    ``k`` of the JSON text plants the bad values: an empty field is null, as the
    CSV reader gives it.
    """
    events = events.withColumn("_k", F.get_json_object("props", "$.k").cast("int"))
    k, value = F.col("_k"), F.col("value")
    delay = value - F.lit(50.0)
    ts = F.col("ts")

    def text(column):
        return column.cast("string")

    filled = {
        "Year": text(F.year(ts)),
        "FlightDate": F.date_format(ts, "yyyy-MM-dd"),
        "Reporting_Airline": F.upper(F.substring("event_type", 1, 2)),
        "Flight_Number_Reporting_Airline": text(F.col("user_id")),
        "OriginAirportID": text(F.lit(10000) + F.col("user_id") % 20),
        "DepDelay": text(F.round(delay, 2)),
        "ArrDelay": F.when(k != 1, text(F.round(delay + (k - 50) / F.lit(5.0), 2))),
        "TaxiOut": text(k),
        "WheelsOff": F.when(k == 2, "2400").when(k != 0, F.date_format(ts, "HHmm")),
        "Cancelled": F.when(k == 3, "1.00").otherwise("0.00"),
        "Diverted": F.when(k == 4, "1.00").otherwise("0.00"),
        "Distance": F.when(k != 5, text(F.round(value * 10))),
        **(more or {}),
    }
    empty = F.lit(None).cast("string")
    return events.select(
        "event_id", *[filled.get(name, empty).alias(name) for name in RAW_SCHEMA.names]
    )


def raw_lines(events: DataFrame) -> DataFrame:
    """Raw rows as CSV text; two fields hold a comma or quotes, as real files do."""
    city = F.concat_ws(", ", "event_type", F.col("user_id").cast("string"))
    tail = F.concat(F.lit('N"'), F.col("user_id").cast("string"), F.lit('"'))
    raw = raw_flights(events, {"OriginCityName": city, "Tail_Number": tail})
    line = F.to_csv(F.struct(*RAW_SCHEMA.names), {"quote": '"', "escape": '"'})
    return raw.select("event_id", line.alias("line"))
