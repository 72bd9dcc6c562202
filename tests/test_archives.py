import zipfile

import pytest

from skyloom.operators.clean import clean_flights, rejected_flights
from skyloom.schemas import RAW_COLUMNS
from skyloom.sources.archives import extract_lines, scan_archives, write_extracted
from skyloom.sources.flights import scan_raw


def make_zip(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in members.items():
            archive.writestr(name, text)


def test_extract(spark, tmp_path):
    long = "".join(f"{i},x\r\n" for i in range(45_000))
    make_zip(tmp_path / "flights_present_2021_12.zip", {"a.csv": long, "readme.html": "<html>"})
    make_zip(tmp_path / "flights_present_2022_1.zip", {"b.csv": "1,é\n\n2,\"z\"", "sub/c.csv": "no"})
    (tmp_path / "note.txt").write_text("not an archive")
    lines = extract_lines(scan_archives(spark, str(tmp_path)))
    got = {(r[0], r[1]): r[2] for r in lines.groupBy("file_year", "file_month").count().collect()}
    assert got == {(2021, 12): 45_000, (2022, 1): 3}
    texts = [r.line for r in lines.filter("file_year = 2022").collect()]
    assert texts == ["1,é", "", '2,"z"']
    assert lines.filter("line rlike '[\\r\\n]'").count() == 0

    out = str(tmp_path / "out")
    write_extracted(lines, out)
    back = spark.read.text(out)
    assert back.filter("file_year = 2021 and file_month = 12").count() == 45_000


def test_a_month_is_added_to_those_extracted(spark, tmp_path):
    out = str(tmp_path / "out")
    for month, text in ((11, "a\nb"), (12, "c"), (11, "d")):
        folder = tmp_path / f"in-{text[0]}"
        folder.mkdir()
        make_zip(folder / f"2021_{month}.zip", {"f.csv": text})
        write_extracted(extract_lines(scan_archives(spark, str(folder))), out)
    rows = {(r.file_year, r.file_month, r.value) for r in spark.read.text(out).collect()}
    assert rows == {(2021, 11, "d"), (2021, 12, "c")}


@pytest.mark.parametrize("members", [{"a.csv": "1", "b.csv": "2"}, {"a.txt": "1"}])
def test_exactly_one_csv(spark, tmp_path, members):
    make_zip(tmp_path / "f_2021_12.zip", members)
    with pytest.raises(Exception, match="expected one CSV file"):
        extract_lines(scan_archives(spark, str(tmp_path))).count()


def test_name_without_month(spark, tmp_path):
    make_zip(tmp_path / "flights.zip", {"a.csv": "1"})
    with pytest.raises(Exception, match="no month"):
        extract_lines(scan_archives(spark, str(tmp_path))).collect()


def test_extracted_months_feed_the_feature_job(spark, tmp_path):
    row = dict.fromkeys(RAW_COLUMNS, "")
    row.update(
        Year="2021", FlightDate="2021-12-20", Reporting_Airline="AA",
        Flight_Number_Reporting_Airline="7", OriginAirportID="1", DepDelay="3", ArrDelay="4",
        TaxiOut="5", WheelsOff="0930", Cancelled="0", Diverted="0", Distance="100",
    )
    text = "\n".join([",".join(RAW_COLUMNS), ",".join(row.values()), ""])
    for month in (11, 12):
        make_zip(tmp_path / f"f_2021_{month}.zip", {"f.csv": text})
    out = str(tmp_path / "out")
    write_extracted(extract_lines(scan_archives(spark, str(tmp_path))), out)
    raw = scan_raw(spark, out)
    assert clean_flights(raw).count() == 2 and rejected_flights(raw).count() == 0
    december = clean_flights(raw.filter("file_month = 12"), ["file_month"])
    assert december.count() == 1
    plan = december._jdf.queryExecution().executedPlan().toString()
    assert "file_month" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_archives_are_opened_by_path(spark, tmp_path):
    make_zip(tmp_path / "f_2021_12.zip", {"f.csv": "1\n2"})
    lines = extract_lines(scan_archives(spark, str(tmp_path)))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan[plan.index("binaryFile") :].split("ReadSchema")[1]
    held = extract_lines(scan_archives(spark, str(tmp_path), with_content=True))
    assert sorted(lines.collect()) == sorted(held.collect()) and lines.count() == 2


def test_packed_archives_as_files(spark, tmp_path):
    from skyloom.catalog.archives import pack_lines, write_archives

    rows = [",".join(["x"] * 5 + [f"2021-{m:02}-01"]) for m in (1, 2, 2)]
    lines = spark.createDataFrame([(r,) for r in rows], "line string")
    write_archives(pack_lines(lines), f"{tmp_path}/zip")
    back = extract_lines(scan_archives(spark, f"{tmp_path}/zip")).where("NOT line LIKE 'Year%'")
    assert sorted((r.file_month, r.line) for r in back.collect()) == sorted((int(r[-5:-3]), r) for r in rows)
