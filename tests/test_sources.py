"""Readers, writers and generators."""

import datetime as dt
import json

import pytest

from headway.sources import files, generators
from tests.conftest import values


def test_columnar_document_with_gaps(spark, tmp_path):
    doc = {"daily": {"time": ["2023-01-01", "2023-01-02"], "precipitation_sum": [1.5, None], "snowfall_sum": [0, 2]}}
    (tmp_path / "w.json").write_text(json.dumps(doc))
    got = files.read_weather_documents(spark, str(tmp_path / "w.json")).orderBy("date").collect()
    assert [(r["date"], r["precipitation_mm"], r["snowfall_cm"], r["rain_mm"]) for r in got] == [
        (dt.date(2023, 1, 1), 1.5, 0.0, None), (dt.date(2023, 1, 2), None, 2.0, None),
    ]


def test_ragged_array_pages(spark, tmp_path):
    (tmp_path / "page-0.json").write_text(json.dumps([{"a": 1, "b": "x"}, {"a": 2}]))
    (tmp_path / "page-1.json").write_text(json.dumps([{"c": True}]))
    got = files.read_record_pages(spark, str(tmp_path), "a long, b string, c boolean", array_pages=True)
    assert values(got) == [(1, "x", None), (2, None, None), (None, None, True)]


def test_holidays_default_to_nationwide(spark, tmp_path):
    days = [{"date": "2023-01-01", "localName": "N", "global": False}, {"date": "2023-07-04", "localName": "I"}]
    (tmp_path / "h.json").write_text(json.dumps(days, indent=1))
    got = files.read_holidays(spark, str(tmp_path / "h.json"), array_pages=True)
    assert values(got, "event_name", "nationwide", "expected_attendance", "impact_level") == [
        ("I", True, 0, "High"), ("N", False, 0, "High"),
    ]


def test_csv_keeps_blanks_quotes_and_nulls(frame, spark, tmp_path):
    df = frame([(1, ' padded "x", y '), (2, None)], "id long, name string")
    files.write_csv(df, str(tmp_path / "t.csv"))
    assert values(files.read_csv(spark, str(tmp_path / "t.csv"), "id long, name string")) == values(df)


def test_read_table_falls_back_to_csv_and_coerces_dates(frame, spark, tmp_path):
    df = frame([("2023-01-01", 1), ("oops", 2)], "date string, n int")
    base = str(tmp_path / "t")
    files.write_csv(df, f"{base}.csv")
    got = files.read_table(spark, base, "date string, n int")
    assert values(got, "n", "date") == [(1, dt.date(2023, 1, 1)), (2, None)]
    frame([("2024-01-01", 7)], "date string, n int").write.parquet(f"{base}.parquet")
    assert values(files.read_table(spark, base), "n", "date") == [(7, dt.date(2024, 1, 1))]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_table(spark, str(tmp_path / "absent"), "n int")


def test_csv_to_parquet_reports_bytes(frame, spark, tmp_path):
    df = frame([(i, "same text") for i in range(2000)], "id long, name string")
    files.write_csv(df, str(tmp_path / "t.csv"))
    tables = {"t": (str(tmp_path / "t.csv"), str(tmp_path / "t.parquet"), "id long, name string")}
    report = files.csv_to_parquet(spark, tables).first()
    assert report["csv_bytes"] > report["parquet_bytes"] > 0
    assert report["size_ratio"] == report["parquet_bytes"] / report["csv_bytes"]
    assert spark.read.parquet(str(tmp_path / "t.parquet")).count() == 2000


def test_recurring_events_first_series_wins(frame):
    days = [dt.date(2023, 4, 4), dt.date(2023, 4, 5), dt.date(2023, 4, 3), dt.date(2023, 12, 6)]
    got = generators.recurring_events(frame([(d,) for d in days], "date date"))
    assert values(got, "date", "expected_attendance", "impact_level") == [
        (dt.date(2023, 4, 4), 19000, "Medium"), (dt.date(2023, 4, 5), 45000, "High"),
    ]


def test_calendar_per_series(frame):
    bounds = frame([("a", dt.date(2023, 2, 27), dt.date(2023, 3, 1)), ("b", dt.date(2023, 1, 1), dt.date(2023, 1, 1))], "k string, low date, high date")
    assert [k for k, _ in values(generators.calendar(bounds))] == ["a", "a", "a", "b"]


def test_seed_events(spark):
    seeds = generators.seed_events(spark)
    assert seeds.columns == generators.event_columns()
    assert seeds.count() == 36 and seeds.where("nationwide").count() == 0


def test_export_head_is_ordered_and_bounded(frame, spark, tmp_path):
    df = frame([(i % 7, i) for i in range(50)], "d int, i int")
    files.export_head(df, ["d", "i"], str(tmp_path / "h.csv"), rows=5)
    assert values(files.read_csv(spark, str(tmp_path / "h.csv"), "d int, i int")) == [(0, 0), (0, 7), (0, 14), (0, 21), (0, 28)]


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text("b,extra,a\n1.5,q,7\n,r,8\n")
    got = files.read_csv(spark, str(tmp_path / "t.csv"), "a INT, b DOUBLE, missing STRING")
    assert got.columns == ["a", "b", "missing"]
    assert values(got) == [(7, 1.5, None), (8, None, None)]


def test_csv_lines_that_do_not_fit_can_be_counted(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,x\nnone,y\n")
    got = files.read_csv(spark, str(tmp_path / "t.csv"), "a INT, b STRING", bad_rows="bad").cache()
    assert values(got) == [(1, "x", None), (None, "y", "none,y")]


def test_pages_without_a_schema_have_the_union_of_keys(spark, tmp_path):
    (tmp_path / "page-0.json").write_text(json.dumps([{"a": 1}, {"a": 2, "late": "z"}]))
    (tmp_path / "page-1.json").write_text(json.dumps([{"c": True}]))
    got = files.read_record_pages(spark, str(tmp_path), array_pages=True)
    assert values(got, "a", "c", "late") == [(1, None, None), (2, None, "z"), (None, True, None)]


def test_weather_document_over_several_lines(spark, tmp_path):
    doc = {"daily": {"time": ["2023-01-01"], "precipitation_sum": [1.5]}}
    (tmp_path / "w.json").write_text(json.dumps(doc, indent=2))
    got = files.read_weather_documents(spark, str(tmp_path / "w.json"), multi_line=True).first()
    assert (got["date"], got["precipitation_mm"]) == (dt.date(2023, 1, 1), 1.5)


def test_a_folder_of_csv_files_is_converted(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b\n1,x\n2,y\n")
    (tmp_path / "two.csv").write_text("c\n3\n")
    report = files.csv_folder_to_parquet(spark, str(tmp_path), {"one": "a BIGINT, b STRING"})
    rows = {r["table_name"]: r for r in report.collect()}
    assert set(rows) == {"one", "two"} and rows["one"]["csv_bytes"] == 12
    assert all(r["parquet_bytes"] > 0 and r["size_ratio"] > 0 for r in rows.values())
    assert values(spark.read.parquet(str(tmp_path / "one.parquet"))) == [(1, "x"), (2, "y")]


def test_a_folder_of_three_headers_lands_in_full(spark, tmp_path):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("id,name,n\n1,x,3\n2,y,oops\n")
    (folder / "b.csv").write_text("n,id\n7,4\n")
    (folder / "c.csv").write_text('name,id,extra\n"a, b",5,q\nz,6,r\n')
    (folder / "d.csv").write_text("id,name,n\n8,,9\n")
    schema = "id long, name string, n int"
    rows = files.read_csv_folder(spark, str(folder), schema)
    assert values(rows, "id", "name", "n") == [
        (1, "x", 3), (2, "y", None), (4, None, 7), (5, "a, b", None), (6, "z", None), (8, None, 9),
    ]
    by_file = {r["file"].rpartition("/")[2]: (r["records"], r["bad_records"]) for r in files.bad_rows_by_file(spark, str(folder), schema).collect()}
    assert by_file == {"a.csv": (2, 1), "b.csv": (1, 0), "c.csv": (2, 0), "d.csv": (1, 0)}
    report = files.csv_to_parquet(spark, {"t": (str(folder), str(tmp_path / "t.parquet"), schema)}).first()
    assert (report["table_name"], report["records"], report["bad_records"]) == ("t", 6, 1)
    assert spark.read.parquet(str(tmp_path / "t.parquet")).count() == 6


def test_a_folder_without_a_schema_has_the_union_of_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,n\n1,3\n")
    (tmp_path / "b.csv").write_text("n,other\nx,2.5\n")
    rows = files.read_csv_folder(spark, str(tmp_path))
    assert set(rows.columns) == {"id", "n", "other"} and dict(rows.dtypes)["n"] == "string"
    assert values(rows, "id", "n", "other") == [(1, "3", None), (None, "x", 2.5)]


def test_headers_are_found_without_sorting_lines(spark, tmp_path):
    """One header per file, however many files a task reads, and no line is sorted by its file."""
    for i in range(12):
        (tmp_path / f"{i}.csv").write_text("\n".join([f"a{i % 3},b", *[f"{j},x" for j in range(50)]]) + "\n")
    found = files.csv_headers(spark, str(tmp_path))
    assert sorted(r["header"] for r in found.collect()) == sorted(f"a{i % 3},b" for i in range(12))
    assert found.select("file").distinct().count() == 12
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
