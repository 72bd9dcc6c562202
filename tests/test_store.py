from datetime import datetime, timedelta
from pathlib import Path

import random

import pytest
from pyspark.sql import functions as F

from skyloom.schemas import Feature, FeatureGroup
from skyloom.sources.store import FeatureStore, latest_records

GROUP = FeatureGroup("g", (Feature("x", "DOUBLE", "a number"), Feature("y", "STRING")), "about g")
START = datetime(2024, 1, 1)


def at(hours):
    return START + timedelta(hours=hours)


def source(spark, rows):
    df = spark.createDataFrame(rows, "id string, t timestamp_ntz, x double, y string, seq long")
    return df.withColumn("t", F.col("t").cast("timestamp"))


@pytest.fixture
def store(spark, tmp_path):
    made = FeatureStore(spark, str(tmp_path / "store"))
    made.create(GROUP)
    return made


def ingest(store, rows, **options):
    df = source(store.spark, rows)
    store.ingest(GROUP, df, entity_id="id", feature_time="t", **options)


def content(df):
    got = df.withColumn("feature_time", F.col("feature_time").cast("timestamp_ntz"))
    return sorted(tuple(r) for r in got.collect())


def test_registry_round_trip(store):
    assert store.group("g") == GROUP
    assert store.read(GROUP).count() == 0


def test_highest_sequence_wins_within_and_across_ingests(store):
    ingest(store, [("a", at(0), 1.0, "1", 1), ("a", at(0), 2.0, "2", 3), ("a", at(1), 5.0, "5", 1)],
           sequence="seq")
    ingest(store, [("a", at(0), 9.0, "9", 2), ("a", at(1), 6.0, "6", 2)], sequence="seq")
    assert content(store.read(GROUP)) == [("a", at(0), 2.0, "2"), ("a", at(1), 6.0, "6")]


def test_other_days_are_left_alone(store, tmp_path):
    ingest(store, [("a", at(0), 1.0, "", 1), ("a", at(30), 2.0, "", 1)], sequence="seq")
    files = lambda day: sorted(p.name for p in Path(store.path).glob(f"**/*={day}/*.parquet"))
    before = files("2024-01-02")
    ingest(store, [("b", at(1), 3.0, "", 1)], sequence="seq")
    assert before and files("2024-01-02") == before
    assert len(content(store.read(GROUP))) == 3


def test_same_ingest_twice_changes_nothing(store):
    rows = [("a", at(h), float(h), None, h) for h in range(50)]
    ingest(store, rows, sequence="seq")
    once = content(store.read(GROUP))
    ingest(store, rows, sequence="seq")
    assert content(store.read(GROUP)) == once


def test_without_sequence_the_later_ingest_wins(store):
    ingest(store, [("a", at(0), 1.0, "1", 0)])
    ingest(store, [("a", at(0), 2.0, "2", 0)])
    assert content(store.read(GROUP)) == [("a", at(0), 2.0, "2")]


def test_feature_subset_leaves_the_others_null(store):
    ingest(store, [("a", at(0), 1.0, "1", 0)], feature_ids=["x"])
    assert content(store.read(GROUP)) == [("a", at(0), 1.0, None)]


def test_feature_subset_keeps_stored_features(store):
    ingest(store, [("a", at(0), 1.0, "k", 0), ("b", at(1), 2.0, "m", 0)])
    ingest(store, [("a", at(0), 5.0, "ignored", 1), ("c", at(1), 7.0, "ignored", 1)], feature_ids=["x"])
    assert sorted(content(store.read(GROUP))) == [
        ("a", at(0), 5.0, "k"), ("b", at(1), 2.0, "m"), ("c", at(1), 7.0, None),
    ]


def test_feature_subsets_out_of_order(store):
    """Each feature keeps its own highest version, in whatever order subsets arrive."""
    ingest(store, [("a", at(0), 1.0, "no", 5), ("b", at(0), 1.0, "no", 5)], feature_ids=["x"], sequence="seq")
    ingest(store, [("a", at(0), 9.0, "y", 3)], feature_ids=["y"], sequence="seq")
    assert content(store.read(GROUP)) == [("a", at(0), 1.0, "y"), ("b", at(0), 1.0, None)]
    ingest(store, [("a", at(0), 2.0, "z", 4)], sequence="seq")
    assert content(store.read(GROUP))[0] == ("a", at(0), 1.0, "z")
    ingest(store, [("a", at(0), None, "z", 6)], feature_ids=["x"], sequence="seq")
    assert content(store.read(GROUP))[0] == ("a", at(0), None, "z")
    ingest(store, [("a", at(0), 7.0, "w", None)], sequence="seq")
    assert content(store.read(GROUP))[0] == ("a", at(0), None, "z")


def test_an_unnumbered_ingest_follows_numbered_ones(store):
    ingest(store, [("a", at(0), 1.0, "1", 5)], sequence="seq")
    ingest(store, [("a", at(0), 2.0, "2", 0)], feature_ids=["x"])
    assert content(store.read(GROUP)) == [("a", at(0), 2.0, "1")]


def test_a_late_older_record_does_not_become_the_latest(store):
    ingest(store, [("a", at(30), 1.0, "new", 1), ("b", at(2), 5.0, "b", 1)], sequence="seq")
    ingest(store, [("a", at(1), 9.0, "old", 9)], sequence="seq")
    assert content(store.read_latest(GROUP)) == [("a", at(30), 1.0, "new"), ("b", at(2), 5.0, "b")]
    ingest(store, [("a", at(30), 7.0, "corrected", 2)], feature_ids=["x"], sequence="seq")
    assert content(store.read_latest(GROUP, None, ["a"])) == [("a", at(30), 7.0, "new")]
    assert content(store.read_latest(GROUP, None, None, at(10))) == [("a", at(30), 7.0, "new")]


def test_latest_against_the_history(spark, tmp_path):
    made = FeatureStore(spark, str(tmp_path / "few"))
    made.create(GROUP, buckets=3)
    assert made.create(GROUP) == GROUP and made._declared_buckets("g") == 3
    draw = random.Random(2)
    for step in range(5):
        rows = [
            (draw.choice("abcdefgh"), at(draw.randrange(100)), float(draw.randrange(9)), draw.choice("pqr"), draw.randrange(50))
            for _ in range(25)
        ]
        ingest(made, rows, feature_ids=draw.choice([None, ["x"], ["y"]]), sequence="seq")
        newest = {}
        for row in content(made.read(GROUP)):
            newest[row[0]] = max(newest.get(row[0], row), row, key=lambda r: r[1])
        assert content(made.read_latest(GROUP)) == sorted(newest.values())


def test_latest_reads_neither_the_history_nor_other_buckets(store):
    ingest(store, [(f"e{k}", at(k), float(k), "", 0) for k in range(40)])
    named = store.read_latest(GROUP, ["x"], ["e7", "none"])
    text = named._jdf.queryExecution().executedPlan().toString()
    assert "/tables/" not in text and text.count("FileScan") == 1
    assert "bucket" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert content(named) == [("e7", at(7), 7.0)]


def test_wrong_type_is_refused(store):
    df = source(store.spark, [("a", at(0), 1.0, "1", 0)]).withColumn("x", F.lit("text"))
    with pytest.raises(TypeError):
        store.ingest(GROUP, df, entity_id="id", feature_time="t")


def test_rows_without_key_or_time_are_not_stored(store):
    ingest(store, [(None, at(0), 1.0, "1", 0), ("a", None, 1.0, "1", 0)])
    assert content(store.read(GROUP)) == []


def test_create_again_keeps_the_table(store):
    ingest(store, [("a", at(0), 1.0, "1", 0)])
    store.create(GROUP)
    assert store.read(GROUP).count() == 1


def test_latest(store):
    ingest(store, [("a", at(h), float(h), None, 0) for h in range(60)] + [("b", at(2), 7.0, "", 0)])
    assert content(store.read_latest(GROUP, ["x"])) == [("a", at(59), 59.0), ("b", at(2), 7.0)]
    assert content(store.read_latest(GROUP, ["x"], ["b", "none"])) == [("b", at(2), 7.0)]


def test_latest_keeps_a_null_feature(spark):
    df = source(spark, [("a", at(0), 1.0, "1", 0), ("a", at(1), None, None, 0)])
    got = latest_records(df, entity="id", time="t").select("id", "x", "y")
    assert [tuple(r) for r in got.collect()] == [("a", None, None)]


def test_serve_two_groups(spark, tmp_path):
    made = FeatureStore(spark, str(tmp_path / "two"))
    one = made.create(FeatureGroup("one", (Feature("x", "DOUBLE"), Feature("y", "STRING"))))
    two = made.create(FeatureGroup("two", (Feature("z", "DOUBLE"),)))
    rows = source(spark, [("a", at(0), 1.0, "p", 0), ("b", at(4), 2.0, "q", 0)])
    made.ingest(one, rows, entity_id="id", feature_time="t")
    made.ingest(two, rows.withColumnRenamed("x", "z"), entity_id="id", feature_time="t")
    spine = spark.createDataFrame(
        [(1, "a", "b", at(5)), (2, "b", "a", at(3)), (3, "a", None, at(0))],
        "id int, one string, two string, timestamp timestamp_ntz",
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    got = made.serve(spine, {"one": ["x"], "two": ["*"]})
    assert {r.id: (r.x, r.z) for r in got.collect()} == {
        1: (1.0, 2.0), 2: (None, 1.0), 3: (1.0, None),
    }


def test_range_reads_only_its_days(store):
    ingest(store, [("a", at(h), float(h), None, 0) for h in range(96)])
    part = store.read(GROUP, ["x"], at(30), at(50))
    assert sorted(r.x for r in part.collect()) == [float(h) for h in range(30, 50)]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "feature_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


@pytest.mark.parametrize("max_age", [None, "5 hours"])
def test_serve_with_a_known_range(spark, store, max_age):
    ingest(store, [("a", at(h), float(h), None, 0) for h in (0, 28, 60)])
    spine = spark.createDataFrame(
        [(1, "a", at(26)), (2, "a", at(29)), (3, "a", at(40))], "id int, g string, t timestamp_ntz"
    ).withColumn("t", F.col("t").cast("timestamp"))
    options = dict(time="t", max_age=max_age)
    known = store.serve(spine, {"g": ["x"]}, between=(at(26), at(41)), **options)
    unknown = store.serve(spine, {"g": ["x"]}, **options)
    found = {r.id: r.x for r in known.collect()}
    assert found == {r.id: r.x for r in unknown.collect()}
    assert found == ({1: 0.0, 2: 28.0, 3: 28.0} if max_age is None else {1: None, 2: 28.0, 3: None})


def test_a_large_day_is_spread_over_tasks(store):
    ingest(store, [("a", at(0), 1.0, None, 0)])
    merged = store.read(GROUP).hint("rebalance", "feature_time")
    assert "REBALANCE" in merged._jdf.queryExecution().executedPlan().toString()
