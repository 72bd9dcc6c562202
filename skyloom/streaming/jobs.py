"""The feature job on files as they arrive."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from skyloom.operators.clean import clean_flights, read_instances, rejected_flights
from skyloom.plans.features import FeatureOutputs
from skyloom.schemas import AIRPORT_SCHEMA, FLIGHT_SCHEMA
from skyloom.sources.flights import scan_flights
from skyloom.streaming.features import open_airport_delays, streaming_airport_delays, write_stream
from skyloom.streaming.sources import stream_raw


def start_feature_stream(
    spark: SparkSession,
    source: str,
    outputs: FeatureOutputs,
    checkpoint: str,
    *,
    delay: str = "1 hour",
    max_files: int | None = None,
    available_now: bool = False,
    **windows,
) -> list[StreamingQuery]:
    """Flights from arriving text files, and airport features from the flights written.

    The text is parsed by the first query only; the second follows the table the
    first one writes. With ``available_now`` the first ends before the second starts.

    Read instances (from the flights written) and rejects (from the text) are written
    where ``outputs`` names a folder. A folder ``open_airports`` gets, with
    ``available_now``, the windows still open at the end of the input; they are written
    anew each time, since later input adds to them. ``windows`` are the size, slide and
    feature time of the airport features.
    """
    arriving = stream_raw(spark, source, max_files)
    flights = clean_flights(arriving).select(*FLIGHT_SCHEMA.names)
    first = write_stream(
        flights, outputs.flights, f"{checkpoint}/flights", available_now=available_now
    )
    if available_now:
        first.awaitTermination()
    written = spark.readStream.schema(FLIGHT_SCHEMA).parquet(outputs.flights)
    second = write_stream(
        streaming_airport_delays(written, delay=delay, **windows),
        outputs.airports,
        f"{checkpoint}/airports",
        available_now=available_now,
    )
    queries = [first, second]
    if outputs.read_instances:
        queries.append(
            write_stream(
                read_instances(written), outputs.read_instances, f"{checkpoint}/read_instances",
                available_now=available_now, fmt="csv", header=True, quote='"', escape='"',
            )
        )
    if outputs.rejects:
        queries.append(
            write_stream(
                rejected_flights(arriving), outputs.rejects, f"{checkpoint}/rejects", available_now=available_now
            )
        )
    if available_now:
        for query in queries[1:]:
            query.awaitTermination()
        if outputs.open_airports:
            closed = spark.read.schema(AIRPORT_SCHEMA).parquet(outputs.airports)
            rows = open_airport_delays(scan_flights(spark, outputs.flights), closed, delay=delay, **windows)
            rows.write.mode("overwrite").parquet(outputs.open_airports)
    return queries
