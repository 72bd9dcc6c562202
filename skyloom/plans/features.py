"""The feature job: raw files to the three feature outputs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from skyloom.operators.clean import clean_flights, read_instances, rejected_flights
from skyloom.operators.windows import sliding_mean
from skyloom.schemas import AIRPORT_SCHEMA, FLIGHT_SCHEMA
from skyloom.sources.flights import scan_flights, scan_raw
from skyloom.sources.tables import write_csv, write_features


@dataclass(frozen=True)
class FeatureOutputs:
    """Where the job writes."""

    airports: str
    flights: str
    read_instances: str
    rejects: str | None = None
    open_airports: str | None = None


def airport_delays(
    flights: DataFrame, size: str = "4 hours", slide: str = "1 hour", **options
) -> DataFrame:
    """Mean departure delay per airport and window."""
    return sliding_mean(
        flights,
        key="origin_airport_id",
        time="timestamp",
        value="departure_delay_minutes",
        name="average_departure_delay",
        size=size,
        slide=slide,
        **options,
    )


def run_feature_job(
    spark: SparkSession, source: str, outputs: FeatureOutputs, fmt: str = "parquet", **options
) -> None:
    """S1 to S3, P12, S8 to S10.

    The text is parsed once: the flights are written, and the two other outputs
    read back only the columns they need. Nothing is held in memory between them.
    Flights and airport features are partitioned by day.
    """
    raw = scan_raw(spark, source)
    write_features(clean_flights(raw), outputs.flights, FLIGHT_SCHEMA, fmt, "Flight", "timestamp")
    flights = scan_flights(spark, outputs.flights, fmt)
    write_features(
        airport_delays(flights, **options), outputs.airports, AIRPORT_SCHEMA, fmt, "Airport", "timestamp"
    )
    write_csv(read_instances(flights), outputs.read_instances)
    if outputs.rejects:
        rejected_flights(raw).write.mode("overwrite").parquet(outputs.rejects)
