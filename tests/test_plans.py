"""The physical plans that the operators are meant to have."""

import re

import pytest
from pyspark.sql import functions as F

from skyloom.catalog.queries import flights, spine, written_flights
from skyloom.operators.asof import as_of_join
from skyloom.operators.clean import SOURCE_COLUMNS, clean_flights
from skyloom.operators.metrics import confusion_matrix
from skyloom.operators.ranking import running_totals
from skyloom.plans.features import airport_delays
from skyloom.schemas import FLIGHT_SCHEMA
from skyloom.sources.events import raw_flights, raw_lines, scan_events
from skyloom.sources.flights import decode_lines, scan_flights, scan_raw
from skyloom.sources.tables import write_csv, write_features

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cleaning_is_one_generated_stage(spark):
    text = plan(flights(spark, SF))
    assert "Exchange" not in text and "Python" not in text
    assert len(re.findall(r"\*\(1\) (Project|Filter|Generate)", text)) >= 3
    # Each number is parsed once: the filter reads columns, not texts.
    assert "RLIKE" not in text[text.index("Filter") : text.index("Generate")]


def test_line_decoding_stops_at_the_last_field_wanted(spark):
    df = decode_lines(raw_lines(scan_events(spark, SF)), ["Year", "Distance"])
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    text = df._jdf.queryExecution().analyzed().toString().split("to_csv")[0]
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    parsed = text[text.index("from_csv") :]
    assert "StructField(Distance" in parsed and "StructField(Div5TailNum" not in parsed
    assert df.columns == ["event_id", "Year", "Distance"]


def test_sliding_mean_sums_before_the_shuffle(spark):
    text = plan(airport_delays(flights(spark, SF)))
    assert text.count("Exchange hashpartitioning") == 2
    assert "partial_sum" in text and "partial_count" in text
    assert "Expand" not in text


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_asof_windows_are_split_by_entity_and_day(spark, no_broadcast):
    rows = written_flights(spark, SF)
    joined = as_of_join(
        spine(rows),
        airport_delays(rows),
        entity="airport",
        time="timestamp",
        feature_entity="origin_airport_id",
        feature_time="timestamp",
        columns=["average_departure_delay"],
    )
    text = plan(joined)
    assert "SinglePartition" not in text and "Cartesian" not in text and "NestedLoop" not in text
    assert "SortMergeJoin" in text
    assert re.search(r"Exchange hashpartitioning\(_entity#\d+, _bucket#\d+L", text)
    joined.collect()
    assert "ReusedExchange" in plan(joined)


def test_running_totals_order_only_bucket_sums_in_one_task(spark):
    df = spark.range(1000).select((F.col("id") / 7.0).alias("s"), F.lit(1).alias("n"))
    text = plan(running_totals(df, "s", ["n"]))
    single = text[text.index("Exchange SinglePartition") :]
    # Below the one unpartitioned window lies the aggregate over buckets.
    assert "HashAggregate" in single or "SortAggregate" in single
    assert text.count("Exchange SinglePartition") == 1


def test_confusion_matrix_shuffles_four_counts(spark):
    df = spark.range(100).select((F.col("id") > 3).alias("target"), (F.col("id") > 9).alias("prediction"))
    text = plan(confusion_matrix(df))
    assert "partial_count" in text and text.count("Exchange") == 1


@pytest.fixture
def small_skew_limits(spark, no_broadcast):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "5000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "5000",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_hot_request_is_split_by_adaptive_execution(spark, small_skew_limits):
    """A third of the requests have one entity and one time."""
    hot = F.col("id") % 3 == 0
    time = F.timestamp_seconds(F.when(hot, 500_000).otherwise(F.col("id") * 60))
    rows = spark.range(0, 60_000, 1, 16).select(
        "id", F.when(hot, "hot").otherwise((F.col("id") % 50).cast("string")).alias("e"), time.alias("t")
    )
    features = spark.range(0, 20_000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("entity_id"),
        F.timestamp_seconds(F.col("id") * 90).alias("feature_time"),
        F.col("id").alias("x"),
    )
    joined = as_of_join(rows, features, entity="e", time="t", columns=["x"])
    assert len(joined.collect()) == 60_000
    assert "SortMergeJoin(skew=true)" in plan(joined)


def test_scans_read_only_the_columns_needed(spark, tmp_path):
    write_csv(raw_flights(scan_events(spark, SF)).drop("event_id"), str(tmp_path / "csv"))
    rows = clean_flights(scan_raw(spark, str(tmp_path / "csv")))
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        text = plan(rows)
        schema = re.search(r"ReadSchema: struct<(.*?)>", text)[1]
        assert sorted(f.split(":")[0] for f in schema.split(",")) == sorted(SOURCE_COLUMNS)
        write_features(rows, str(tmp_path / "flights"), FLIGHT_SCHEMA)
        text = plan(airport_delays(scan_flights(spark, str(tmp_path / "flights"))))
        schema = re.search(r"ReadSchema: struct<(.*?)>", text)[1]
        assert sorted(f.split(":")[0] for f in schema.split(",")) == [
            "departure_delay_minutes", "origin_airport_id", "timestamp",
        ]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_a_range_of_flights_is_read_from_its_days(spark, tmp_path):
    from datetime import datetime

    rows = flights(spark, SF)
    write_features(rows, str(tmp_path / "flights"), FLIGHT_SCHEMA, by_day="timestamp")
    part = scan_flights(spark, str(tmp_path / "flights"), start=datetime(2024, 1, 5, 6), end=datetime(2024, 1, 7))
    text = plan(part)
    days = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "event_date" in days and ">= 2024-01-05" in days and "<= 2024-01-07" in days
    expected = rows.filter("timestamp >= timestamp '2024-01-05 06:00:00' AND timestamp < timestamp '2024-01-07'")
    assert part.columns == FLIGHT_SCHEMA.names and part.count() == expected.count() > 0
    assert scan_flights(spark, str(tmp_path / "flights")).count() == rows.count()


def test_the_split_date_reaches_the_partitions(spark, tmp_path):
    from skyloom.operators.dataset import time_split

    write_features(flights(spark, SF), str(tmp_path / "flights"), FLIGHT_SCHEMA, by_day="timestamp")
    by_day = spark.read.parquet(str(tmp_path / "flights"))
    whole = time_split(by_day, "timestamp", "2024-01-20")
    parts = time_split(by_day, "timestamp", "2024-01-20", day="event_date")
    for pruned, all_days in zip(parts, whole, strict=True):
        assert "event_date" in plan(pruned).split("PartitionFilters: [")[1].split("]")[0]
        assert pruned.count() == all_days.count() > 0
