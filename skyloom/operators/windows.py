"""Sliding event-time means."""

from __future__ import annotations

import math
import re
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.values import utc

_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds(span: str) -> int:
    """``"4 hours"`` to seconds."""
    match = re.fullmatch(r"\s*(\d+)\s*(second|minute|hour|day)s?\s*", span)
    if not match or int(match[1]) == 0:
        raise ValueError(f"not a time span: {span!r}")
    return int(match[1]) * _SECONDS[match[2]]


def _shift(timestamp: Column, by_seconds: int) -> Column:
    return F.timestamp_micros(F.unix_micros(timestamp) + F.lit(by_seconds * 1_000_000))


def _feature_time(start: Column, size: str, feature_time: str) -> Column:
    if feature_time == "window_start":
        return start
    if feature_time == "window_end":
        return _shift(start, seconds(size))
    raise ValueError("feature_time is window_start or window_end")


def _in_range(
    df: DataFrame, time: str, size: str, start: datetime | None, end: datetime | None
) -> DataFrame:
    """Rows that can reach a window starting in ``[start, end)``; this filter reaches the scan."""
    if start is not None:
        df = df.filter(F.col(time) >= F.lit(utc(start)))
    if end is not None:
        df = df.filter(F.col(time) < _shift(F.lit(utc(end)), seconds(size)))
    return df


def _starts_in_range(column: Column, start: datetime | None, end: datetime | None) -> Column:
    keep = F.lit(True)
    if start is not None:
        keep = keep & (column >= F.lit(utc(start)))
    if end is not None:
        keep = keep & (column < F.lit(utc(end)))
    return keep


def sliding_mean(
    df: DataFrame,
    *,
    key: str,
    time: str,
    value: str,
    name: str,
    size: str = "4 hours",
    slide: str = "1 hour",
    feature_time: str = "window_start",
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Mean of ``value`` per key and sliding window: ``timestamp, key, name``.

    Rows are first summed into panes, which each task does before
    the shuffle, so the shuffle carries one row per key, pane and task however
    many rows a key has. Each pane is then copied to the windows that cover it;
    copying rows instead would multiply the input by size / slide. A pane is as long as the
    greatest span that divides both size and slide, so that it lies in a window as a whole or not
    at all. Windows are aligned to the epoch and half open.

    ``feature_time="window_start"`` stamps a window with its start, before its
    rows are known; ``"window_end"`` is free of that leak. ``start`` and ``end``
    limit the window starts and prune the scan.
    """
    panes = pane_sums(
        _in_range(df, time, size, start, end), key=key, time=time, value=value, size=size, slide=slide
    )
    windows = (
        panes.select(key, F.explode(covering_starts(F.col("pane.start"), size, slide)).alias("_start"), "_sum", "_count")
        .filter(_starts_in_range(F.col("_start"), start, end))
        .groupBy(key, "_start")
        .agg((F.sum("_sum") / F.nullif(F.sum("_count"), F.lit(0))).alias(name))
    )
    return windows.select(
        _feature_time(F.col("_start"), size, feature_time).alias("timestamp"), key, name
    )


def pane_sums(
    df: DataFrame, *, key: str, time: str, value: str, size: str = "4 hours", slide: str = "1 hour"
) -> DataFrame:
    """Sum and count per key and pane: ``key, pane, _sum, _count``; valid on a stream."""
    width = math.gcd(seconds(size), seconds(slide))
    return df.groupBy(F.col(key), F.window(time, f"{width} seconds").alias("pane")).agg(
        F.sum(value).alias("_sum"), F.count(value).alias("_count")
    )


def covering_starts(pane: Column, size: str, slide: str) -> Column:
    """The starts of all windows that cover the pane with this start, latest first."""
    size_us, slide_us = seconds(size) * 1_000_000, seconds(slide) * 1_000_000
    at = F.unix_micros(pane)
    latest = F.floor(at / F.lit(slide_us)) * F.lit(slide_us)
    steps = [F.timestamp_micros(latest - F.lit(k * slide_us)) for k in range(-(-size_us // slide_us))]
    if size_us % slide_us == 0:
        return F.array(*steps)
    return F.filter(F.array(*steps), lambda start: F.unix_micros(start) > at - F.lit(size_us))


def sliding_mean_rows(
    df: DataFrame,
    *,
    key: str,
    time: str,
    value: str,
    name: str,
    size: str = "4 hours",
    slide: str = "1 hour",
    feature_time: str = "window_start",
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """The same by the built-in sliding window, which copies every row."""
    windows = (
        _in_range(df, time, size, start, end)
        .groupBy(F.window(time, size, slide).alias("w"), F.col(key))
        .agg(F.avg(value).alias(name))
        .filter(_starts_in_range(F.col("w.start"), start, end))
    )
    return stamped_windows(windows, key, name, size, feature_time)


def stamped_windows(windows: DataFrame, key: str, name: str, size: str, feature_time: str) -> DataFrame:
    """``timestamp, key, name`` of windows in a column ``w``."""
    return windows.select(
        _feature_time(F.col("w.start"), size, feature_time).alias("timestamp"), key, name
    )
