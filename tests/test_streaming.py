import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skyloom.operators.clean import clean_flights
from skyloom.operators.model import enrich, fit_classifier, score
from skyloom.operators.windows import sliding_mean
from skyloom.session import materialise, scratch_path
from skyloom.sources.tables import write_csv
from skyloom.plans.features import FeatureOutputs, airport_delays
from skyloom.schemas import AIRPORT_GROUP, AIRPORT_SCHEMA, RAW_COLUMNS
from skyloom.sources.flights import scan_flights
from skyloom.streaming.features import drain, drain_airport_delays, streaming_airport_delays
from skyloom.streaming.jobs import start_feature_stream
from skyloom.sources.store import FeatureStore
from skyloom.streaming.scoring import score_stream
from skyloom.streaming.sources import stream_raw

START = datetime(2024, 1, 1)


def raw_rows(n=600):
    rng = random.Random(9)
    rows = []
    for i in range(n):
        t = START + timedelta(minutes=5 * i + rng.randrange(5))
        values = dict.fromkeys(RAW_COLUMNS)
        values.update(
            Year="2024", FlightDate=t.strftime("%Y-%m-%d"), WheelsOff=t.strftime("%H%M"),
            Reporting_Airline="AA", Flight_Number_Reporting_Airline=str(i),
            OriginAirportID=rng.choice(["1", "1", "2"]), DepDelay=str(rng.randrange(60)),
            ArrDelay="1", TaxiOut=str(rng.randrange(30)), Distance="100", Cancelled="0",
            Diverted="0",
        )
        rows.append(values)
    return rows


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """Three CSV files in event-time order, as three arrivals."""
    base = tmp_path_factory.mktemp("arrivals")
    schema = ", ".join(f"{c} string" for c in RAW_COLUMNS)
    rows = [tuple(r.values()) for r in raw_rows()]
    for part in range(3):
        df = spark.createDataFrame(rows[part * 200 : part * 200 + 200], schema).coalesce(1)
        write_csv(df, f"{base}/{part}")
    return str(base)


def windows(df):
    got = df.select(F.col("timestamp").cast("timestamp_ntz"), "origin_airport_id", "average_departure_delay")
    return {(r[0], r[1]): round(r[2], 9) for r in got.collect()}


@pytest.mark.parametrize("max_files", [None, 1])
def test_closed_windows_equal_the_batch(spark, files, max_files):
    flights = clean_flights(stream_raw(spark, f"{files}/*", max_files))
    base = scratch_path(spark, "stream")
    got = windows(drain(streaming_airport_delays(flights), f"{base}/out", f"{base}/checkpoint"))

    raw = spark.read.option("header", True).csv(f"{files}/*")
    batch = clean_flights(raw)
    last = batch.agg(F.max("timestamp").cast("timestamp_ntz")).first()[0]
    whole = windows(
        sliding_mean(
            batch,
            key="origin_airport_id",
            time="timestamp",
            value="departure_delay_minutes",
            name="average_departure_delay",
        )
    )
    closed = {k: v for k, v in whole.items() if k[0] + timedelta(hours=4) <= last - timedelta(hours=1)}
    assert closed and got == closed


@pytest.mark.parametrize("options", [{}, {"delay": "3 hours", "size": "5 hours", "slide": "2 hours", "feature_time": "window_end"}])
def test_drained_windows_equal_the_batch(spark, files, options):
    base = scratch_path(spark, "stream")
    batch = clean_flights(spark.read.option("header", True).csv(f"{files}/*"))
    arriving = clean_flights(stream_raw(spark, f"{files}/*", 1))
    got = drain_airport_delays(arriving, batch, f"{base}/out", f"{base}/checkpoint", **options)
    whole = airport_delays(batch, **{k: v for k, v in options.items() if k != "delay"})
    assert got.count() == whole.count() and windows(got) == windows(whole)


def test_the_stream_copies_panes_not_rows(spark, files):
    flights = clean_flights(stream_raw(spark, f"{files}/*"))
    plan = streaming_airport_delays(flights)._jdf.queryExecution().analyzed().toString()
    above = plan[: plan.index("Expand")] if "Expand" in plan else plan
    below = plan[len(above) :]
    assert above.count("Aggregate") == 1 and below.count("Aggregate") == 1 and below.count("Expand") <= 1


def test_restart_does_not_repeat(spark, files):
    flights = clean_flights(stream_raw(spark, f"{files}/*"))
    base = scratch_path(spark, "stream")
    features = streaming_airport_delays(flights)
    first = drain(features, f"{base}/out", f"{base}/checkpoint").count()
    assert drain(features, f"{base}/out", f"{base}/checkpoint").count() == first


def test_model_on_a_stream(spark, files):
    batch = clean_flights(spark.read.option("header", True).csv(f"{files}/*"))
    labelled = batch.withColumn("target", F.col("departure_delay_minutes") > 30)
    features = ["departure_delay_minutes", "average"]
    latest = materialise(
        batch.groupBy(F.col("origin_airport_id").alias("entity_id")).agg(
            F.avg("departure_delay_minutes").alias("average")
        ),
        "latest",
    )
    train = enrich(labelled, latest, entity="origin_airport_id", columns=["average"])
    model = fit_classifier(train, features)
    arriving = clean_flights(stream_raw(spark, f"{files}/*"))
    found = enrich(arriving, latest, entity="origin_airport_id", columns=["average"])
    base = scratch_path(spark, "stream")
    got = drain(score(found, model), f"{base}/out", f"{base}/checkpoint")
    expected = score(enrich(batch, latest, entity="origin_airport_id", columns=["average"]), model)
    columns = ["flight_number", "score", "prediction"]
    assert got.count() == expected.count() == 600
    assert got.select(columns).exceptAll(expected.select(columns)).count() == 0


@pytest.mark.parametrize("available_now", [True, False])
def test_feature_job_on_a_stream(spark, files, available_now):
    base = scratch_path(spark, "stream-job")
    outputs = FeatureOutputs(f"{base}/airports", f"{base}/flights", "")
    queries = start_feature_stream(
        spark, f"{files}/*", outputs, f"{base}/checkpoint", available_now=available_now
    )
    for query in queries:
        if query.isActive:
            query.processAllAvailable()
            query.stop()
    flights = scan_flights(spark, outputs.flights)
    assert flights.count() == 600
    last = flights.agg(F.max("timestamp").cast("timestamp_ntz")).first()[0]
    whole = windows(airport_delays(flights))
    closed = {k: v for k, v in whole.items() if k[0] + timedelta(hours=4) <= last - timedelta(hours=1)}
    assert windows(spark.read.schema(AIRPORT_SCHEMA).parquet(outputs.airports)) == closed


def test_drained_job_writes_all_outputs(spark, files, tmp_path):
    bad = dict(raw_rows(1)[0], Distance=None)
    schema = ", ".join(f"{c} string" for c in RAW_COLUMNS)
    write_csv(spark.createDataFrame([tuple(bad.values())], schema).coalesce(1), f"{tmp_path}/in/bad")
    write_csv(spark.read.schema(schema).option("header", True).csv(f"{files}/*"), f"{tmp_path}/in/good")
    base = scratch_path(spark, "stream-job")
    outputs = FeatureOutputs(*[f"{base}/{n}" for n in ("airports", "flights", "instances", "rejects", "open")])
    start_feature_stream(spark, f"{tmp_path}/in/*", outputs, f"{base}/checkpoint", available_now=True)
    flights = scan_flights(spark, outputs.flights)
    instances = spark.read.option("header", True).csv(outputs.read_instances)
    assert instances.columns == ["flight", "airport", "timestamp"] and instances.count() == 600
    rejects = spark.read.parquet(outputs.rejects).collect()
    assert [r.reason for r in rejects] == ["no_distance"]
    closed, left = (windows(spark.read.schema(AIRPORT_SCHEMA).parquet(p)) for p in (outputs.airports, outputs.open_airports))
    assert left and not closed.keys() & left.keys() and closed | left == windows(airport_delays(flights))


def test_features_that_change_between_two_batches(spark, files, tmp_path):
    """Each micro-batch is scored with the features that are current when it runs."""
    store = FeatureStore(spark, str(tmp_path / "store"))
    store.create(AIRPORT_GROUP)
    batch = clean_flights(spark.read.option("header", True).csv(f"{files}/*"))
    airports = batch.select(F.col("origin_airport_id").alias("id")).distinct()
    seen = {}

    def ingest(hour, value):
        rows = airports.withColumns(
            {"timestamp": F.lit(START + timedelta(hours=hour)).cast("timestamp"), "average_departure_delay": F.lit(value)}
        )
        store.ingest(AIRPORT_GROUP, rows, entity_id="id", feature_time="timestamp")

    ingest(5, 10.0)
    labelled = batch.withColumns(
        {"target": F.col("departure_delay_minutes") > 30, "average_departure_delay": F.rand(1)}
    )
    model = fit_classifier(labelled, ["departure_delay_minutes", "average_departure_delay"])
    base = str(tmp_path / "run")
    for step, (hour, value) in enumerate([(None, None), (9, 20.0), (7, 30.0)]):
        if hour:
            ingest(hour, value)  # the last one is late and older
        part = spark.read.schema(", ".join(f"{c} string" for c in RAW_COLUMNS)).option("header", True).csv(f"{files}/{step}")
        write_csv(part, f"{base}/in/{step}")
        arriving = clean_flights(stream_raw(spark, f"{base}/in/*"))
        score_stream(
            arriving, store, model, f"{base}/out", f"{base}/checkpoint", available_now=True, entity="origin_airport_id"
        ).awaitTermination()
        scored = spark.read.parquet(f"{base}/out")
        assert scored.count() == 200 * (step + 1)
        seen[step] = {r[0] for r in scored.filter(F.col("batch") == step).select("average_departure_delay").collect()}
    assert seen == {0: {10.0}, 1: {20.0}, 2: {20.0}}
