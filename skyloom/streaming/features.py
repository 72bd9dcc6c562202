"""E5: the sliding airport features on a stream."""

from __future__ import annotations

from datetime import timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyloom.operators.windows import pane_sums, seconds, sliding_mean, stamped_windows


def streaming_airport_delays(
    flights: DataFrame,
    *,
    delay: str = "1 hour",
    size: str = "4 hours",
    slide: str = "1 hour",
    feature_time: str = "window_start",
) -> DataFrame:
    """Windowed means behind a watermark.

    Two aggregations follow each other: rows are summed into panes, by each task before the
    shuffle, and a pane is added to its windows once the watermark has passed it. State
    and shuffles so hold panes, not copies of rows. In append mode a window is written
    once, when the watermark passes its end; windows still open at the end of the input are
    not written (see ``drain_airport_delays``).
    """
    panes = pane_sums(
        flights.withWatermark("timestamp", delay),
        key="origin_airport_id",
        time="timestamp",
        value="departure_delay_minutes",
        size=size,
        slide=slide,
    )
    whole = panes.groupBy(F.window(F.window_time("pane"), size, slide).alias("w"), "origin_airport_id").agg(
        (F.sum("_sum") / F.nullif(F.sum("_count"), F.lit(0))).alias("average_departure_delay")
    )
    return stamped_windows(whole, "origin_airport_id", "average_departure_delay", size, feature_time)


def open_airport_delays(
    flights: DataFrame,
    closed: DataFrame,
    *,
    delay: str = "1 hour",
    size: str = "4 hours",
    slide: str = "1 hour",
    feature_time: str = "window_start",
) -> DataFrame:
    """The windows that a drained stream of ``flights`` has left open, with the rows they have so far.

    Together with ``closed``, what the stream has written, these are all windows of the input.
    Only flights that can reach an open window are read.
    """
    last = flights.agg(F.max("timestamp").alias("last")).first().last
    if last is None:
        return closed.limit(0)
    watermark = last - timedelta(seconds=seconds(delay))
    found = sliding_mean(
        flights,
        key="origin_airport_id",
        time="timestamp",
        value="departure_delay_minutes",
        name="average_departure_delay",
        size=size,
        slide=slide,
        feature_time=feature_time,
        # a window that starts on this moment has ended when the watermark passes, and is written
        start=watermark.astimezone(timezone.utc) - timedelta(seconds=seconds(size)),
    )
    return found.join(closed, ["timestamp", "origin_airport_id"], "left_anti").select(*closed.columns)


def drain_airport_delays(
    arriving: DataFrame, flights: DataFrame, path: str, checkpoint: str, **options
) -> DataFrame:
    """All windows of a bounded input: those that the stream closes and those open at its end.

    ``arriving`` is the stream and ``flights`` the same rows as a table.
    """
    delay = options.pop("delay", "1 hour")
    closed = drain(streaming_airport_delays(arriving, delay=delay, **options), path, checkpoint)
    return closed.unionByName(open_airport_delays(flights, closed, delay=delay, **options))


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    *,
    available_now: bool = False,
    fmt: str = "parquet",
    **options,
) -> StreamingQuery:
    """Append to files; file log and checkpoint make each row appear once."""
    writer = (
        df.writeStream.format(fmt)
        .options(**options)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def drain(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream to the end of its present input and return what it wrote."""
    query = write_stream(df, path, checkpoint, available_now=True)
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)
