import pytest
from pyspark.sql import functions as F

from skyloom.operators.dataset import first_rows, raw_training_rows, split_parts, time_split
from skyloom.operators.model import fit_classifier
from skyloom.plans.features import FeatureOutputs, airport_delays, run_feature_job
from skyloom.plans.scoring import score_from_store, score_instances
from skyloom.plans.training import run_joined_training, run_raw_training
from skyloom.schemas import AIRPORT_GROUP, AIRPORT_SCHEMA, FLIGHT_GROUP, FLIGHT_SCHEMA, RAW_COLUMNS
from skyloom.session import scratch_path
from skyloom.sources.events import raw_flights, raw_lines, scan_events
from skyloom.sources.flights import scan_flights
from skyloom.sources.store import FeatureStore
from skyloom.sources.tables import write_csv, write_dataset, write_features
from skyloom.streaming.scoring import score_stream

SF = "/root/testdata/sf0.001"
SPLIT = "2024-01-20"


@pytest.fixture(scope="module")
def outputs(spark):
    base = scratch_path(spark, "job")
    raw_lines(scan_events(spark, SF)).select("line").write.text(f"{base}/raw")
    out = FeatureOutputs(f"{base}/airports", f"{base}/flights", f"{base}/instances", f"{base}/bad")
    run_feature_job(spark, f"{base}/raw", out)
    return out


@pytest.fixture(scope="module")
def store(spark, outputs):
    made = FeatureStore(spark, scratch_path(spark, "store"))
    made.create(FLIGHT_GROUP)
    made.create(AIRPORT_GROUP)
    made.ingest_files(
        FLIGHT_GROUP, outputs.flights, entity_id="flight_number", feature_time="timestamp"
    )
    made.ingest_files(
        AIRPORT_GROUP, outputs.airports, entity_id="origin_airport_id", feature_time="timestamp"
    )
    return made


def test_feature_job_accounts_for_every_row(spark, outputs):
    flights = scan_flights(spark, outputs.flights).count()
    rejects = spark.read.parquet(outputs.rejects).count()
    assert flights + rejects == scan_events(spark, SF).count()
    instances = spark.read.option("header", True).csv(outputs.read_instances)
    assert instances.columns == ["flight", "airport", "timestamp"]
    assert instances.count() == flights


def test_joined_training(store, outputs):
    result = run_joined_training(store, outputs.read_instances, SPLIT, exact=("flight",))
    as_of = run_joined_training(store, outputs.read_instances, SPLIT)
    matrix = [tuple(r) for r in result.confusion.collect()]
    assert matrix == [tuple(r) for r in as_of.confusion.collect()]
    assert sum(sum(r[1:]) for r in matrix) == result.scored.count() > 0
    # The label follows the features, so the model must be nearly right.
    assert matrix[0][2] + matrix[1][1] < 0.05 * result.scored.count()


def test_raw_training_evaluates_the_first_rows_on_request(spark):
    path = scratch_path(spark, "raw")
    write_csv(raw_flights(scan_events(spark, SF)).drop("event_id"), path)
    whole = run_raw_training(spark, path, SPLIT)
    features = ["DepDelay", "TaxiOut", "Distance"]
    got = score_instances(spark, [[-4.0, 16.0, 153], [300, 16, 3500]], features, whole.model)
    assert [r.prediction for r in got.collect()] == [False, True]
    part = run_raw_training(spark, path, SPLIT, order=["DepDelay"], limit=50)
    assert part.scored.count() == 50 < whole.scored.count()
    assert whole.roc.filter("fpr = 1 and tpr = 1").count() == 1


def test_scoring_from_the_store(spark, store, outputs):
    flights = scan_flights(spark, outputs.flights)
    model = fit_classifier(
        flights.join(
            store.read_latest(AIRPORT_GROUP), F.col("origin_airport_id") == F.col("entity_id")
        ).withColumn("target", F.col("arrival_delay_minutes") > 15),
        ["distance_miles", "departure_delay_minutes", "taxi_out_minutes", "average_departure_delay"],
    )
    requests = spark.createDataFrame(
        [(481.0, -6.0, 13.0, "10008"), (481.0, 300.0, 13.0, "none")],
        "distance_miles double, departure_delay_minutes double, taxi_out_minutes double, airport_id string",
    )
    got = score_from_store(requests, store, model).orderBy("departure_delay_minutes").collect()
    assert [r.prediction for r in got] == [False, True]
    assert got[1].average_departure_delay is None


def test_stream_scores_equal_the_batch(spark, store, outputs):
    flights = scan_flights(spark, outputs.flights)
    features = ["distance_miles", "departure_delay_minutes", "taxi_out_minutes"]
    model = fit_classifier(
        flights.withColumn("target", F.col("arrival_delay_minutes") > 15), features
    )
    arriving = spark.readStream.schema(FLIGHT_SCHEMA).parquet(outputs.flights)
    base = scratch_path(spark, "stream")
    score_stream(
        arriving, store, model, f"{base}/out", f"{base}/checkpoint", available_now=True, entity="origin_airport_id"
    ).awaitTermination()
    got = spark.read.parquet(f"{base}/out")
    batch = score_from_store(flights, store, model, "origin_airport_id")
    columns = ["flight_number", "average_departure_delay", "score", "prediction"]
    assert got.count() == batch.count() == flights.count()
    assert got.select(columns).exceptAll(batch.select(columns)).count() == 0


def raw_frame(spark, rows):
    names = ["FlightDate", "DepDelay", "ArrDelay", "TaxiOut", "Distance", "Cancelled", "Diverted"]
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))


def test_null_rules_of_the_raw_dataset(spark):
    rows = [
        ("2021-12-19", "1", "16", "2", "3", "0", "0"),
        ("2021-12-20", "1", "15", None, "3", None, None),
        ("2021-12-20", None, None, "2", "3", "0.00", None),
        ("2021-12-21", "1", "nan", "2", "x", "0", "0"),
        ("2021-12-21", "1", "99", "2", "3", "1", None),
        ("2021-12-21", "1", "99", "2", "3", None, "1.00"),
        (None, "1", "99", "2", "3", "0", "0"),
    ]
    train, test = time_split(raw_training_rows(raw_frame(spark, rows)), "FlightDate")
    assert [tuple(r) for r in train.collect()] == [(1.0, 2.0, 3.0, True)]
    assert sorted((tuple(r) for r in test.collect()), key=str) == [
        (1.0, 2.0, None, False), (1.0, None, 3.0, False), (None, 2.0, 3.0, False),
    ]


def test_midnight_of_the_split_is_test(spark):
    df = spark.sql(
        "select 1 as id, timestamp '2021-12-19 23:59:59' as t "
        "union all select 2, timestamp '2021-12-20 00:00:00' union all select 3, null"
    )
    train, test = time_split(df, "t")
    assert ([r.id for r in train.collect()], [r.id for r in test.collect()]) == ([1], [2])
    parts = {r.id: r.part for r in split_parts(df, "t").collect()}
    assert parts == {1: "train", 2: "test"}


def test_first_rows(spark):
    df = spark.range(20)
    assert first_rows(df, [], None).count() == 20
    assert [r.id for r in first_rows(df, ["id"], 3).collect()] == [0, 1, 2]


def test_write_features_checks_the_schema(spark, tmp_path):
    df = spark.sql("select timestamp '2021-01-01' as timestamp, 'a' as origin_airport_id")
    with pytest.raises(ValueError):
        write_features(df, str(tmp_path / "x"), AIRPORT_SCHEMA)
    with pytest.raises(TypeError):
        write_features(
            df.withColumn("average_departure_delay", F.lit("1")), str(tmp_path / "y"), AIRPORT_SCHEMA
        )


def test_dataset_formats(spark, tmp_path):
    df = spark.sql("select 1.5D as a, true as target, cast(null as double) as b")
    for fmt in ("csv", "parquet"):
        write_dataset(df, str(tmp_path / fmt), fmt)
        back = spark.read.schema(df.schema).option("header", True).format(fmt)
        assert [tuple(r) for r in back.load(str(tmp_path / fmt)).collect()] == [(1.5, True, None)]


def test_unknown_raw_columns_are_ignored_by_flights(spark):
    assert set(FLIGHT_SCHEMA.names).isdisjoint(RAW_COLUMNS)
    assert airport_delays(spark.createDataFrame([], FLIGHT_SCHEMA)).count() == 0
