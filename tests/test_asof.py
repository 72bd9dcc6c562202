import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skyloom.operators.asof import (
    BUCKETS,
    as_of_join,
    bucket_widths,
    choose_bucket,
    exact_time_join,
    newest_versions,
)
from skyloom.operators.windows import seconds

START = datetime(2024, 1, 1)


def at(minutes):
    return START + timedelta(minutes=minutes)


def frame(spark, rows, schema):
    df = spark.createDataFrame(rows, schema)
    for name, kind in df.dtypes:
        if kind == "timestamp_ntz":
            df = df.withColumn(name, F.col(name).cast("timestamp"))
    return df


def spine_of(spark, rows):
    return frame(spark, rows, "id int, e string, t timestamp_ntz")


def features_of(spark, rows):
    return frame(spark, rows, "entity_id string, feature_time timestamp_ntz, x double, y string")


def join(spine, features, **options):
    return as_of_join(spine, features, entity="e", time="t", columns=["x", "y"], **options)


def answers(df):
    return {r.id: (r.x, r.y) for r in df.collect()}


def brute(spine, features, max_age=None):
    out = {}
    for i, e, t in spine:
        best = None
        for fe, ft, x, y in features:
            if e is not None and t is not None and fe == e and ft is not None and ft <= t:
                if best is None or ft > best[0]:
                    best = (ft, x, y)
        if best and max_age is not None and t - best[0] > max_age:
            best = None
        out[i] = best[1:] if best else (None, None)
    return out


@pytest.fixture(scope="module")
def data():
    rng = random.Random(7)
    entities = ["hot"] * 6 + ["a", "b", "c"]
    spine = [(i, rng.choice(entities), at(rng.randrange(10 * 1440))) for i in range(800)]
    # A third of the requests are for one entity at one time.
    spine += [(800 + i, "hot", at(5000)) for i in range(400)]
    spine += [(2000, None, at(1)), (2001, "a", None), (2002, "unknown", at(9)), (2003, "a", at(-9))]
    keys = {(rng.choice(["hot"] * 6 + ["a", "b"]), rng.randrange(10 * 1440)) for _ in range(500)}
    features = [
        (e, at(m), None if rng.random() < 0.2 else float(m), rng.choice([None, "y"]))
        for e, m in sorted(keys)
    ]
    return spine, features


@pytest.mark.parametrize("bucket", ["1 second", "1 hour", "1 day", "30 days", "auto"])
def test_against_brute_force(spark, data, bucket):
    spine, features = data
    got = join(spine_of(spark, spine), features_of(spark, features), bucket=bucket)
    assert got.count() == len(spine)
    assert answers(got) == brute(spine, features)


def test_max_age(spark, data):
    spine, features = data
    got = join(spine_of(spark, spine), features_of(spark, features), max_age="3 hours")
    assert answers(got) == brute(spine, features, timedelta(hours=3))


def test_equal_time_matches_and_nulls_of_the_newest_stay(spark):
    features = features_of(spark, [("a", at(0), 1.0, "old"), ("a", at(5), None, None)])
    spine = spine_of(spark, [(1, "a", at(4)), (2, "a", at(5)), (3, "a", at(5000))])
    got = join(spine, features, matched_time="found")
    assert answers(got) == {1: (1.0, "old"), 2: (None, None), 3: (None, None)}
    found = {r.id: r.found for r in got.withColumn("found", F.col("found").cast("timestamp_ntz")).collect()}
    assert found == {1: at(0), 2: at(5), 3: at(5)}


def test_sequence_decides_on_double_keys(spark):
    rows = [("a", at(1), 1.0, "x", 5), ("a", at(1), 2.0, "y", 9), ("a", at(1), 3.0, "z", 7)]
    schema = "entity_id string, feature_time timestamp_ntz, x double, y string, seq int"
    features = frame(spark, rows, schema)
    spine = spine_of(spark, [(1, "a", at(1)), (2, "a", at(1)), (3, "a", at(2))])
    expected = {1: (2.0, "y"), 2: (2.0, "y"), 3: (2.0, "y")}
    assert answers(join(spine, features, sequence="seq")) == expected
    exact = exact_time_join(
        spine, features, entity="e", time="t", columns=["x", "y"], sequence="seq"
    )
    assert answers(exact) == {**expected, 3: (None, None)}


def test_exact_join_equals_as_of_join_on_own_times(spark, data):
    _, features = data
    spine = [(i, e, t) for i, (e, t, _, _) in enumerate(features)]
    left, right = spine_of(spark, spine), features_of(spark, features)
    exact = exact_time_join(left, right, entity="e", time="t", columns=["x", "y"])
    assert answers(exact) == answers(join(left, right))


def test_shuffled_join_gives_the_same(spark, data):
    spine, features = data
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = answers(join(spine_of(spark, spine), features_of(spark, features)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == brute(spine, features)


def test_newest_versions_keeps_column_order(spark):
    df = spark.createDataFrame([(1, "a", 1, None), (2, "a", 1, "v")], "s int, e string, t int, v string")
    got = newest_versions(df, ["e", "t"], "s")
    assert got.columns == ["s", "e", "t", "v"]
    assert [tuple(r) for r in got.collect()] == [(2, "a", 1, "v")]


def test_bucket_narrows_until_no_entity_is_too_dense(spark):
    rows = [(i, "hot" if i % 3 else "b", at(i)) for i in range(3000)]
    spine = spine_of(spark, rows)
    key = [(spine, "e", "t")]
    assert choose_bucket(key, limit=2000) == "30 days"
    assert choose_bucket(key, limit=1000) == "1 day"
    assert choose_bucket(key, limit=40) == "1 hour"
    assert choose_bucket(key, limit=1) == "1 minute"
    assert choose_bucket([(spine.withColumn("t", F.lit(None).cast("timestamp")), "e", "t")]) == BUCKETS[0]
    same = spine.withColumn("t", F.timestamp_seconds(F.lit(5)))
    assert choose_bucket([(same, "e", "t")], limit=10) == BUCKETS[0]  # repeated times are one row of a search
    dense = spine.withColumn("t", F.timestamp_micros(F.lit(10**15) + F.col("id")))
    assert choose_bucket([(dense, "e", "t")], limit=10) == BUCKETS[-1]


def test_buckets_are_counted_by_one_job(spark):
    spine = spine_of(spark, [(i, "hot", at(i)) for i in range(50)])
    spark.sparkContext.setJobGroup("count-buckets", "")
    try:
        choose_bucket([(spine, "e", "t")], limit=1)
    finally:
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("count-buckets")
        spark.sparkContext.setJobGroup("", "")
    assert 0 < len(jobs) <= 8  # the stages of one query, each a job under adaptive execution


@pytest.mark.parametrize("bucket", ["1 second", "7 seconds", "1 minute", "1 hour", "1 day", "30 days"])
def test_levels_of_buckets_are_bounded(bucket):
    widths = bucket_widths(bucket)
    assert widths[0] == seconds(bucket) and widths[-1] >= 86_400
    for narrow, wide in zip(widths, widths[1:], strict=False):
        assert wide % narrow == 0 and wide // narrow <= 3600


@pytest.mark.parametrize("bucket", ["1 second", "1 minute"])
def test_narrow_buckets_over_years(spark, bucket):
    """Records and requests far apart, before and after the epoch, and on the edges of buckets."""
    draw = random.Random(3)
    edges = [datetime(1969, 12, 31, 23, 59, 59), datetime(1970, 1, 1), datetime(1970, 1, 1, 1), datetime(2030, 5, 31)]
    times = edges + [START + timedelta(microseconds=draw.randrange(4 * 10**14)) for _ in range(150)]
    features = [("hot", t, float(k), None) for k, t in enumerate(times)]
    asked = [t + timedelta(microseconds=draw.choice([-1, 0, 1, 10**9])) for t in times] + [datetime(1950, 1, 1)]
    spine = [(k, "hot", t) for k, t in enumerate(asked)]
    got = join(spine_of(spark, spine), features_of(spark, features), bucket=bucket)
    assert answers(got) == brute(spine, features)


def test_fixed_width_versions_are_reduced_by_hash(spark):
    rows = [("a", 1, 5.0, None, True), ("a", 3, None, at(1), False), ("a", 3, None, at(1), False), ("b", None, 2.0, None, None)]
    df = frame(spark, rows, "e string, s long, x double, t timestamp_ntz, f boolean")
    best = newest_versions(df, ["e"], "s")
    text = best._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in text and "SortAggregate" not in text
    got = [tuple(r) for r in best.withColumn("t", F.col("t").cast("timestamp_ntz")).collect()]
    assert sorted(got) == [("a", 3, None, at(1), False), ("b", None, 2.0, None, None)]
    extremes = [("a", s, float(k), None, None) for k, s in enumerate([-(1 << 63), (1 << 63) - 1, 0])]
    assert newest_versions(frame(spark, extremes, "e string, s long, x double, t timestamp_ntz, f boolean"), ["e"], "s").first().x == 1.0


def test_null_sequence_is_the_lowest(spark):
    rows = [("a", None, 1.0), ("a", 3, 2.0), ("b", None, 5.0)]
    df = spark.createDataFrame(rows, "e string, s int, x double")
    got = newest_versions(df, ["e"], "s").collect()
    assert sorted((r.e, r.s, r.x) for r in got) == [("a", 3, 2.0), ("b", None, 5.0)]
