"""Schemas, typed records and feature groups."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from types import NoneType, UnionType
from typing import Union, get_args, get_origin, get_type_hints

from pyspark.sql import types as T

# The column names of the on-time performance files, by position.
RAW_COLUMNS = """
Year Quarter Month DayofMonth DayOfWeek FlightDate
Reporting_Airline DOT_ID_Reporting_Airline IATA_CODE_Reporting_Airline Tail_Number
Flight_Number_Reporting_Airline
OriginAirportID OriginAirportSeqID OriginCityMarketID Origin OriginCityName
OriginState OriginStateFips OriginStateName OriginWac
DestAirportID DestAirportSeqID DestCityMarketID Dest DestCityName
DestState DestStateFips DestStateName DestWac
CRSDepTime DepTime DepDelay DepDelayMinutes DepDel15 DepartureDelayGroups DepTimeBlk
TaxiOut WheelsOff WheelsOn TaxiIn
CRSArrTime ArrTime ArrDelay ArrDelayMinutes ArrDel15 ArrivalDelayGroups ArrTimeBlk
Cancelled CancellationCode Diverted
CRSElapsedTime ActualElapsedTime AirTime Flights Distance DistanceGroup
CarrierDelay WeatherDelay NASDelay SecurityDelay LateAircraftDelay
FirstDepTime TotalAddGTime LongestAddGTime
DivAirportLandings DivReachedDest DivActualElapsedTime DivArrDelay DivDistance
Div1Airport Div1AirportID Div1AirportSeqID Div1WheelsOn
Div1TotalGTime Div1LongestGTime Div1WheelsOff Div1TailNum
Div2Airport Div2AirportID Div2AirportSeqID Div2WheelsOn
Div2TotalGTime Div2LongestGTime Div2WheelsOff Div2TailNum
Div3Airport Div3AirportID Div3AirportSeqID Div3WheelsOn
Div3TotalGTime Div3LongestGTime Div3WheelsOff Div3TailNum
Div4Airport Div4AirportID Div4AirportSeqID Div4WheelsOn
Div4TotalGTime Div4LongestGTime Div4WheelsOff Div4TailNum
Div5Airport Div5AirportID Div5AirportSeqID Div5WheelsOn
Div5TotalGTime Div5LongestGTime Div5WheelsOff Div5TailNum
""".split()

RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])


_SPARK_TYPES = {
    str: T.StringType(),
    bool: T.BooleanType(),
    float: T.DoubleType(),
    datetime: T.TimestampType(),
}


def record_schema(record: type) -> T.StructType:
    """The ``StructType`` of an annotated class; ``Optional`` fields are nullable."""
    fields = []
    for name, hint in get_type_hints(record).items():
        nullable = False
        if get_origin(hint) in (Union, UnionType):
            options = [a for a in get_args(hint) if a is not NoneType]
            nullable = len(options) < len(get_args(hint))
            hint = options[0] if len(options) == 1 else hint
        if hint not in _SPARK_TYPES:
            raise NotImplementedError(f"field {name}: type {hint} has no column type")
        fields.append(T.StructField(name, _SPARK_TYPES[hint], nullable))
    return T.StructType(fields)


_AVRO_TYPES = {
    T.StringType(): "string",
    T.BooleanType(): "boolean",
    T.DoubleType(): "double",
    T.TimestampType(): {"type": "long", "logicalType": "timestamp-micros"},
}


def avro_schema(schema: T.StructType, name: str, namespace: str) -> dict:
    """The Avro record of a schema, for the ``avroSchema`` option of the Avro writer."""
    fields = []
    for field in schema:
        if field.dataType not in _AVRO_TYPES:
            raise NotImplementedError(f"field {field.name}: {field.dataType} has no Avro type")
        avro = _AVRO_TYPES[field.dataType]
        fields.append({"name": field.name, "type": [avro, "null"] if field.nullable else avro})
    return {"type": "record", "namespace": namespace, "name": name, "fields": fields}


# The feature value types of the registry.
VALUE_TYPES = {
    "STRING": T.StringType(),
    "BOOL": T.BooleanType(),
    "DOUBLE": T.DoubleType(),
}


@dataclass(frozen=True)
class Feature:
    name: str
    value_type: str
    description: str = ""

    def __post_init__(self):
        if self.value_type not in VALUE_TYPES:
            raise ValueError(f"feature {self.name}: unknown value type {self.value_type}")

    @property
    def field(self) -> T.StructField:
        comment = {"comment": self.description}
        return T.StructField(self.name, VALUE_TYPES[self.value_type], True, comment)


@dataclass(frozen=True)
class FeatureGroup:
    """An entity type: features keyed by ``entity_id`` and versioned by ``feature_time``."""

    name: str
    features: tuple[Feature, ...]
    description: str = ""

    def __post_init__(self):
        names = [f.name for f in self.features]
        if len(set(names)) < len(names):
            raise ValueError(f"group {self.name}: a feature is declared twice")

    @property
    def feature_names(self) -> list[str]:
        return [f.name for f in self.features]

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField("entity_id", T.StringType(), True),
                T.StructField("feature_time", T.TimestampType(), True),
                *[f.field for f in self.features],
            ]
        )

    def record_schema(self, entity: str, time: str = "timestamp") -> T.StructType:
        """The schema of the files a group is loaded from; only the time may be missing."""
        return T.StructType(
            [
                T.StructField(time, T.TimestampType(), True),
                T.StructField(entity, T.StringType(), False),
                *[T.StructField(f.name, VALUE_TYPES[f.value_type], False) for f in self.features],
            ]
        )

    def select(self, wanted: list[str] | None) -> list[str]:
        """Resolve a feature list; ``["*"]`` or nothing means every feature."""
        if not wanted or list(wanted) == ["*"]:
            return self.feature_names
        unknown = [w for w in wanted if w not in self.feature_names]
        if unknown:
            raise KeyError(f"group {self.name} has no features {unknown}")
        return list(wanted)


FLIGHT_GROUP = FeatureGroup(
    "flight",
    (
        Feature("origin_airport_id", "STRING", "Airport the flight left from"),
        Feature("is_cancelled", "BOOL", "Cancelled or diverted"),
        Feature("departure_delay_minutes", "DOUBLE", "Departure delay"),
        Feature("arrival_delay_minutes", "DOUBLE", "Arrival delay"),
        Feature("taxi_out_minutes", "DOUBLE", "Time from gate to wheels off"),
        Feature("distance_miles", "DOUBLE", "Length of the flight"),
    ),
    "One flight number",
)

AIRPORT_GROUP = FeatureGroup(
    "airport",
    (
        Feature(
            "average_departure_delay",
            "DOUBLE",
            "Mean departure delay in windows of 4 h that start every hour",
        ),
    ),
    "One airport of departure",
)

FLIGHT_SCHEMA = FLIGHT_GROUP.record_schema("flight_number")
AIRPORT_SCHEMA = AIRPORT_GROUP.record_schema("origin_airport_id")
READ_INSTANCE_SCHEMA = T.StructType(
    [
        T.StructField("flight", T.StringType(), False),
        T.StructField("airport", T.StringType(), False),
        T.StructField("timestamp", T.TimestampType(), True),
    ]
)
