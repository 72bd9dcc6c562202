import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from skyloom.functions.values import departure_time, exceeds, iso_utc, parse_double

NUMBERS = [
    "12.00", "-6", "+3.5", ".5", "5.", "1e3", "1E-2", "1.e2", "nan", "NaN", "+nan", "-NAN",
    "inf", "-inf", "Infinity", "+INFINITY", " 7 ", "\t8\n", "1_000", "1_0.0_1", "1__0", "_1",
    "1_", "1.0d", "1f", "2D", "3F", "0x10", "0x1p3", "", " ", ".", "e5", "1e", "--1", "abc",
    "12a", "1 2", "infin", "nano", "1e400", "1_0e1_0",
]


def as_python(text):
    try:
        return float(text)
    except ValueError:
        return None


def test_parse_double_takes_what_python_takes(spark):
    df = spark.createDataFrame([(t,) for t in NUMBERS], "t string")
    for text, value in df.select("t", parse_double(F.col("t"))).collect():
        expected = as_python(text)
        if expected is not None and math.isnan(expected):
            assert value is not None and math.isnan(value), text
        else:
            assert value == expected, text


def test_parse_double_on_random_texts(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choices("00123.eE+-_ dfxXnaiN", k=rng.randrange(1, 7))) for _ in range(20_000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for text, value in df.select("t", parse_double(F.col("t"))).collect():
        expected = as_python(text)
        assert (value == expected) or (value != value and expected != expected), (text, value)


TIMES = [
    ("2021-12-20", "0930", datetime(2021, 12, 20, 9, 30)),
    ("2021-12-20", "0000", datetime(2021, 12, 20)),
    ("2021-12-20", "2359", datetime(2021, 12, 20, 23, 59)),
    ("2024-02-29", "1200", datetime(2024, 2, 29, 12)),
    ("2021-12-20", "2400", None),
    ("2021-12-20", "1260", None),
    ("2021-02-30", "1200", None),
    ("2021-13-01", "1200", None),
    ("2021-12-20", "12ab", None),
    ("2021-12-20", " 930", None),
    ("20-12-2021", "0930", None),
    (None, "0930", None),
]


def test_departure_time(spark):
    df = spark.createDataFrame([(d, w) for d, w, _ in TIMES], "d string, w string")
    got = df.select(departure_time(F.col("d"), F.col("w")).cast("timestamp_ntz")).collect()
    assert [r[0] for r in got] == [t for _, _, t in TIMES]


def test_iso_utc(spark):
    df = spark.range(1).select(F.lit("2021-12-20 09:30:00").cast("timestamp").alias("t"))
    assert df.select(iso_utc(F.col("t"))).first()[0] == "2021-12-20T09:30:00Z"


@pytest.mark.parametrize(
    "value, expected", [(15.0, False), (15.01, True), (None, False), (float("nan"), False)]
)
def test_missing_values_compare_as_false(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(exceeds(F.col("v"), 15)).first()[0] is expected
