"""Point-in-time joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.operators.windows import seconds

_E, _T, _SIDE, _BUCKET, _FOUND = "_entity", "_time", "_side", "_bucket", "_found"
_RANK = "_rank"


# Sequences take the upper 64 bits of a rank, 62 bits of a hash the rest: 38 digits hold both.
_HASH_BITS = 62
_LOWEST = -(1 << 63)


def version_rank(sequence: Column, *others: Column | str) -> Column:
    """Orders versions by sequence, then by a hash of ``others``; of a fixed width, so that it can be
    kept in a hash aggregation. A null sequence ranks below all others."""
    high = F.coalesce(sequence.cast("long"), F.lit(_LOWEST).cast("long")).cast("decimal(19,0)")
    low = F.shiftrightunsigned(F.xxhash64(*others), 64 - _HASH_BITS).cast("decimal(19,0)")
    return high * F.lit(1 << _HASH_BITS).cast("decimal(19,0)") + low


def newest_versions(df: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    """One row per key, the one with the highest sequence; null is the lowest.

    Rows with one sequence are told apart by a hash, so that a repeated task gives
    the same row. Each task reduces its own rows before the shuffle: a key with
    many versions costs one row per task and never one large group. Where all values
    have a fixed width they are reduced by hash, without sorting rows first.
    """
    others = [c for c in df.columns if c not in keys]
    kinds = {f.name: f.dataType for f in df.schema}
    whole = T.TimestampType, T.TimestampNTZType, T.DateType
    fixed = (T.NumericType, T.BooleanType, *whole)
    if all(isinstance(kinds[c], fixed) for c in others) and isinstance(kinds[sequence], (T.IntegralType, *whole)):
        order = F.col(sequence)
        if isinstance(kinds[sequence], T.DateType):
            order = F.unix_date(order)
        elif isinstance(kinds[sequence], whole):
            order = F.unix_micros(order.cast("timestamp"))
        ranked = df.withColumn(_RANK, version_rank(order, *others))
        best = ranked.groupBy(*keys).agg(*[F.max_by(c, _RANK).alias(c) for c in others])
        return best.select(*df.columns)
    rank = F.struct(F.col(sequence), F.xxhash64(*others))
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*others), rank).alias("_best"))
    return best.select(*keys, *[F.col("_best")[c].alias(c) for c in others]).select(*df.columns)


#: Buckets of one width in a bucket of the next, so that no search group has more than twice as many rows.
_STEP = 3600


def bucket_widths(bucket: str) -> list[int]:
    """Seconds of the buckets of each level, narrow ones inside wide ones, up to a day at least."""
    widths = [seconds(bucket)]
    while widths[-1] < 86_400:
        widths.append(widths[-1] * _STEP)
    return widths


def _resolve(instants: DataFrame, records: DataFrame, widths: list[int]) -> DataFrame:
    """For each (entity, time) of ``instants`` the newest (time, record) at or before it.

    Time is cut into buckets so that one entity with many rows is spread over
    many groups. A bucket that is asked for begins with the newest record before it, which
    stands in for all earlier ones. To find that is the same search among the last
    records of the buckets, a row for each, in wider buckets: the level above. Only the
    widest buckets, at least a day each, are searched entity by entity.

    A group holds distinct times only: at most the number of distinct times in a
    narrow bucket on either side, and above that the narrow buckets in a wide one.
    """
    keys, number = [_E], F.lit(0)
    if widths:
        width = widths[0] * 1_000_000
        number = F.floor(F.unix_micros(_T) / F.lit(width))
        keys = [_E, _BUCKET]
    records = records.select(_E, _T, F.lit(0).alias(_SIDE), number.alias(_BUCKET), _FOUND)
    instants = instants.select(_E, _T, F.lit(1).alias(_SIDE), number.alias(_BUCKET))
    known = records
    if widths:
        tails = records.groupBy(_E, _BUCKET).agg(F.max_by(_FOUND, _T).alias(_FOUND))
        tails = tails.select(_E, F.col(_FOUND)["time"].alias(_T), _FOUND)
        asked = instants.select(_E, _BUCKET).distinct()
        # the last moment before the bucket
        before = F.timestamp_micros(F.col(_BUCKET) * F.lit(width) - 1).cast(records.schema[_T].dataType)
        carried = _resolve(asked.select(_E, before.alias(_T)), tails, widths[1:])
        into = F.floor((F.unix_micros(_T) + 1) / F.lit(width))
        known = records.unionByName(
            carried.select(
                _E, F.col(_FOUND)["time"].alias(_T), F.lit(0).alias(_SIDE), into.alias(_BUCKET), _FOUND
            )
        )
    so_far = (
        Window.partitionBy(*keys)
        .orderBy(_T, _SIDE)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        known.unionByName(instants, allowMissingColumns=True)
        .withColumn(_FOUND, F.last(_FOUND, ignorenulls=True).over(so_far))
        .filter((F.col(_SIDE) == 1) & F.col(_FOUND).isNotNull())
        .select(_E, _T, _FOUND)
    )


BUCKETS = ["30 days", "1 day", "1 hour", "1 minute", "1 second"]


def choose_bucket(keys: list[tuple[DataFrame, str, str]], limit: int = 5_000_000) -> str:
    """The widest bucket in which no entity has more than ``limit`` distinct times.

    ``keys`` lists frames with their entity and time columns. One job counts the distinct
    times of the narrowest buckets and adds the counts up from width to width, so what it
    shuffles shrinks at each; the narrowest holds a million times at most and needs no check.
    """
    points = None
    for df, entity, time in keys:
        part = df.select(F.col(entity).cast("string").alias(_E), F.col(time).alias(_T))
        points = part if points is None else points.unionByName(part)
    points = points.filter(F.col(_E).isNotNull() & F.col(_T).isNotNull())
    micros = F.unix_micros(_T).alias("_start")
    counts, most = points.select(_E, micros).distinct().withColumn("_n", F.lit(1)), []
    for bucket in reversed(BUCKETS):
        width = F.lit(seconds(bucket) * 1_000_000)
        name = f"_{len(most)}"
        counts = (
            counts.groupBy(_E, (F.floor(F.col("_start") / width) * width).alias("_start"))
            .agg(F.sum("_n").alias("_n"), *[F.max(c).alias(c) for c in most])
            .withColumn(name, F.col("_n"))
        )
        most.append(name)
    largest = counts.agg(*[F.max(c).alias(c) for c in most]).first()
    for bucket, size in zip(BUCKETS, reversed(largest), strict=True):
        if (size or 0) <= limit:
            return bucket
    return BUCKETS[-1]


def as_of_join(
    spine: DataFrame,
    features: DataFrame,
    *,
    entity: str,
    time: str,
    feature_entity: str = "entity_id",
    feature_time: str = "feature_time",
    columns: list[str],
    sequence: str | None = None,
    max_age: str | None = None,
    bucket: str = "1 day",
    matched_time: str | None = None,
    requests: DataFrame | None = None,
) -> DataFrame:
    """Left join of each spine row to the newest record at or before its time.

    Every spine row is kept once. A null inside the newest record stays null; it
    is not filled from an older one. Records must be unique per entity and time,
    as feature tables are; otherwise name the ``sequence`` column that decides.
    ``max_age`` leaves older records out. ``matched_time`` names an output column
    for the time of the record found. ``bucket`` bounds the search groups; with
    ``"auto"`` it is chosen by counting distinct times first. ``requests`` is a frame with
    the same entities and times as the spine, for a spine that is costly to compute
    more than once, such as the result of an earlier join.

    Only the distinct (entity, time) pairs of the spine take part in the search,
    so repeated requests collapse before the shuffle. The answers return to the
    rows by an equality join, which adaptive execution turns into a broadcast
    when the answers are small and splits when one pair holds many rows.
    """
    requests = spine if requests is None else requests
    if bucket == "auto":
        bucket = choose_bucket([(requests, entity, time), (features, feature_entity, feature_time)])
    records = features.filter(F.col(feature_entity).isNotNull() & F.col(feature_time).isNotNull())
    if sequence:
        records = newest_versions(records, [feature_entity, feature_time], sequence)
    found = F.struct(F.col(feature_time).alias("time"), F.struct(*columns).alias("record"))
    records = records.select(
        F.col(feature_entity).alias(_E), F.col(feature_time).alias(_T), found.alias(_FOUND)
    )
    instants = (
        requests.select(F.col(entity).alias(_E), F.col(time).alias(_T))
        .filter(F.col(_E).isNotNull() & F.col(_T).isNotNull())
        .distinct()
    )
    resolved = _resolve(instants, records, bucket_widths(bucket))
    if max_age:
        age = F.unix_micros(_T) - F.unix_micros(F.col(_FOUND)["time"])
        resolved = resolved.filter(age <= seconds(max_age) * 1_000_000)
    answers = resolved.select(
        F.col(_E).alias("_e"),
        F.col(_T).alias("_t"),
        *[F.col(_FOUND)["record"][c].alias(c) for c in columns],
        *([F.col(_FOUND)["time"].alias(matched_time)] if matched_time else []),
    )
    on = (spine[entity] == answers["_e"]) & (spine[time] == answers["_t"])
    return spine.join(answers, on, "left").drop("_e", "_t")


def exact_time_join(
    spine: DataFrame,
    features: DataFrame,
    *,
    entity: str,
    time: str,
    feature_entity: str = "entity_id",
    feature_time: str = "feature_time",
    columns: list[str],
    sequence: str | None = None,
) -> DataFrame:
    """The same answer by one equality join, where records exist at each spine time."""
    records = features
    if sequence:
        records = newest_versions(records, [feature_entity, feature_time], sequence)
    records = records.select(
        F.col(feature_entity).alias("_e"), F.col(feature_time).alias("_t"), *columns
    )
    on = (spine[entity] == records["_e"]) & (spine[time] == records["_t"])
    return spine.join(records, on, "left").drop("_e", "_t")
