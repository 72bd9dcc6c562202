import csv
import io
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from skyloom.operators.clean import clean_flights, read_instances, rejected_flights
from skyloom.schemas import RAW_COLUMNS
from skyloom.sources.flights import (
    decode_lines,
    scan_by_header,
    scan_lines,
    scan_raw,
    scan_read_instances,
)
from skyloom.sources.tables import write_csv

GOOD = {
    "Year": "2021", "FlightDate": "2021-12-20", "Reporting_Airline": "AA",
    "Flight_Number_Reporting_Airline": "123", "OriginAirportID": "13851", "DepDelay": "-6.00",
    "ArrDelay": "12.00", "TaxiOut": "13.00", "WheelsOff": "0930", "Cancelled": "0.00",
    "Diverted": "0.00", "Distance": "481.00", "OriginCityName": "Oklahoma City, OK",
}


def line(extra=(), **changes):
    row = {**GOOD, **changes}
    out = io.StringIO()
    csv.writer(out).writerow([row.get(c, "") for c in RAW_COLUMNS] + list(extra))
    return out.getvalue().rstrip("\r\n")


HEADER = ",".join(RAW_COLUMNS)
KEPT = {
    "1": {},
    "2": {"OriginCityName": 'The "big" city, XX'},
    "3": {"DepDelay": "nan"},
    "4": {"DepDelay": "1_000"},
    "5": {"Cancelled": "1.00"},
    "6": {"Diverted": "2"},
    "7": {"Cancelled": "nan"},
    "8": {"OriginAirportID": ""},
    "9": {"Cancelled": "1", "Diverted": ""},
    "10": {"TaxiOut": " 13 "},
}
BAD = {
    "20": ({"WheelsOff": ""}, "wheels_off_length"),
    "21": ({"WheelsOff": "930"}, "wheels_off_length"),
    "22": ({"FlightDate": "2021-12-2"}, "flight_date_length"),
    "23": ({"Distance": ""}, "no_distance"),
    "24": ({"Cancelled": ""}, "cancel_flag"),
    "25": ({"Diverted": "x"}, "cancel_flag"),
    "26": ({"WheelsOff": "2400"}, "time"),
    "27": ({"FlightDate": "2021-02-30"}, "time"),
    "28": ({"WheelsOff": "ab30"}, "time"),
    "29": ({"DepDelay": ""}, "departure_delay_minutes"),
    "30": ({"ArrDelay": ""}, "arrival_delay_minutes"),
    "31": ({"TaxiOut": "1.0d"}, "taxi_out_minutes"),
    "32": ({"Distance": "far"}, "distance_miles"),
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("raw")
    number = "Flight_Number_Reporting_Airline"
    rows = [line(**{number: n}, **c) for n, c in KEPT.items()]
    bad = [line(**{number: n}, **c) for n, (c, _) in BAD.items()]
    more = [line(extra=["beyond", "end"], **{number: "11"}), "2021,4,12"]
    (path / "a.csv").write_text("\n".join([HEADER + ",", *rows, HEADER, "", *more]) + "\n")
    (path / "b.csv").write_text("\r\n".join([HEADER, *bad]) + "\r\n")
    return str(path)


def readers(spark, folder):
    return [scan_raw(spark, folder), decode_lines(scan_lines(spark, folder))]


@pytest.mark.parametrize("which", [0, 1])
def test_good_rows_are_kept(spark, folder, which):
    flights = clean_flights(readers(spark, folder)[which])
    rows = {r.flight_number: r for r in flights.collect()}
    assert set(rows) == {f"AA//{n}" for n in [*KEPT, "11"]}
    assert rows["AA//1"].departure_delay_minutes == -6.0
    assert rows["AA//4"].departure_delay_minutes == 1000.0
    assert rows["AA//3"].departure_delay_minutes != rows["AA//3"].departure_delay_minutes
    flags = {n: rows[f"AA//{n}"].is_cancelled for n in ("1", "5", "6", "7", "9")}
    assert flags == {"1": False, "5": True, "6": True, "7": False, "9": True}
    assert rows["AA//8"].origin_airport_id == ""
    at = flights.select(F.col("timestamp").cast("timestamp_ntz")).distinct().collect()
    assert [r[0] for r in at] == [datetime(2021, 12, 20, 9, 30)]


@pytest.mark.parametrize("which", [0, 1])
def test_bad_rows_are_rejected_with_a_reason(spark, folder, which):
    rejects = rejected_flights(readers(spark, folder)[which]).collect()
    found = {r.flight_number.removeprefix("AA//"): r.reason for r in rejects if "AA" in r[0]}
    assert found == {n: reason for n, (_, reason) in BAD.items()}
    others = [r for r in rejects if "AA" not in r.flight_number]
    assert {r.reason for r in others} == {"wheels_off_length"}


def test_quotes(spark, folder):
    cities = scan_raw(spark, folder).select("OriginCityName").distinct().collect()
    assert {"Oklahoma City, OK", 'The "big" city, XX'} <= {r[0] for r in cities}


def test_header_bound_scan_keeps_text(spark, tmp_path):
    (tmp_path / "m.csv").write_text('WheelsOff,Year,"City"\n0930,2021,"a, b"\n')
    df = scan_by_header(spark, str(tmp_path), ["Year", "WheelsOff"])
    assert [tuple(r) for r in df.collect()] == [("2021", "0930")]


def test_read_instances_round_trip(spark, folder, tmp_path):
    flights = clean_flights(scan_raw(spark, folder))
    out = str(tmp_path / "instances")
    write_csv(read_instances(flights), out)
    assert (spark.read.text(out).filter("value = 'flight,airport,timestamp'").count()) >= 1
    back = scan_read_instances(spark, out)
    assert dict(back.dtypes) == {"flight": "string", "airport": "string", "timestamp": "timestamp"}
    assert back.count() == flights.count()
    assert back.filter("timestamp = '2021-12-20 09:30:00'").count() == flights.count()


def test_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("p,q\n1,2\np,q\n3,4\n")
    rows = {(r.q, r.p) for r in scan_by_header(spark, str(tmp_path), ["q", "p"]).collect()}
    assert rows == {("2", "1"), ("4", "3")}
    (tmp_path / "b.csv").write_text("q,p\n5,6\n")
    with pytest.raises(Exception, match="header"):
        scan_by_header(spark, str(tmp_path)).collect()
