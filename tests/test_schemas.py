from datetime import datetime
from typing import NamedTuple, Optional

import pytest
from pyspark.sql import types as T

from skyloom.schemas import (
    AIRPORT_GROUP,
    FLIGHT_SCHEMA,
    RAW_COLUMNS,
    Feature,
    FeatureGroup,
    avro_schema,
    record_schema,
)


def test_raw_columns():
    assert len(RAW_COLUMNS) == len(set(RAW_COLUMNS)) == 109
    assert RAW_COLUMNS[0] == "Year" and RAW_COLUMNS[54] == "Distance"
    assert RAW_COLUMNS[-1] == "Div5TailNum"


def test_record_schema_types_and_nullability():
    assert FLIGHT_SCHEMA["timestamp"] == T.StructField("timestamp", T.TimestampType(), True)
    assert not FLIGHT_SCHEMA["is_cancelled"].nullable
    assert FLIGHT_SCHEMA["distance_miles"].dataType == T.DoubleType()


@pytest.mark.parametrize("kind", [int, list, dict, Optional[int], bytes])
def test_unsupported_type_is_refused(kind):
    record = NamedTuple("record", [("x", kind)])
    with pytest.raises(NotImplementedError):
        record_schema(record)


def test_avro_schema():
    record = NamedTuple("record", [("at", Optional[datetime]), ("id", str), ("ok", bool)])
    avro = avro_schema(record_schema(record), "R", "space")
    assert avro["fields"][0]["type"] == [{"type": "long", "logicalType": "timestamp-micros"}, "null"]
    assert [f["type"] for f in avro["fields"][1:]] == ["string", "boolean"]


def test_groups_check_their_features():
    with pytest.raises(ValueError):
        Feature("x", "INT64")
    with pytest.raises(ValueError):
        FeatureGroup("g", (Feature("x", "BOOL"), Feature("x", "DOUBLE")))
    with pytest.raises(KeyError):
        AIRPORT_GROUP.select(["nothing"])
    assert AIRPORT_GROUP.select(["*"]) == ["average_departure_delay"]
    assert AIRPORT_GROUP.schema["average_departure_delay"].metadata["comment"]
