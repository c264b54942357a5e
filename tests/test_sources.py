"""Excel, CSV and Parquet in and out; header detection; the watched folder."""

import datetime as dt

import pytest

from ledgerlens.operators.filters import FilterSpec
from ledgerlens.plans.pipeline import Pipeline
from ledgerlens.plans.rules import Condition, RuleSet, Segment
from ledgerlens.sources import load, sinks
from ledgerlens.sources.xlsx import Workbook, write_workbook
from ledgerlens.streaming.watch import watch_folder, windowed_counts

HEAD = ["Year", " Month ", "Customer", "JobfileNumber", "Turnover in EUR", "Gross Billing Tax Excl. in EUR"]


def _book(path, before, rows, head=HEAD):
    write_workbook(str(path), {"data": (before[0] if before else head, [*before[1:], *([head] if before else []), *rows]), "second": (["ignored"], [["x"]])})
    return str(path)


@pytest.mark.parametrize("at, wanted", [(0, 0), (2, 2), (14, 14), (15, 0)])
def test_header_detection(at, wanted):
    assert load.detect_header([["x"]] * at + [[" Year", "Customer ", "JobfileNumber"]]) == wanted
    assert load.detect_header([["Year", "Customer"]]) == 0 and load.detect_header([]) == 0


def test_names():
    assert load.column_names([" a ", None, "a", ""]) == ["a", "Unnamed: 1", "a.1", "Unnamed: 3"]


def test_extracts_end_to_end(spark, tmp_path):
    a = _book(tmp_path / "a.xlsx", [["Filters"], ["Exported data limited"]], [[2023, 5, "A & <B>", "J1", 10.5, 1], [2023, 13, "C", "J2", -3, None], [None, None, None, None, None, None]])
    b = _book(tmp_path / "b.xlsx", [], [[2023, 6, "A & <B>", "J1", 99, 1], [2023, 6, "D", "J3", "n/a", 1]])
    c = tmp_path / "c.csv"
    c.write_text('﻿some preamble\nYear,Month,Customer,JobfileNumber,Zone 3 Label\n2023,7,"E, F",J4,"two\nlines"\n', encoding="utf-8")
    bad = tmp_path / "bad.xlsx"
    bad.write_bytes(b"not a workbook")
    df, errors = load.read_extracts(spark, [a, b, str(bad), str(c), str(tmp_path / "x.pdf")])
    assert [e[0] for e in errors] == ["bad.xlsx", "x.pdf"]
    rows = {r.JobfileNumber: r for r in df.where("`__source_file__` <> 'b.xlsx'").collect()}
    assert set(rows) == {"J1", "J2", "J4"} and rows["J1"].Customer == "A & <B>" and float(rows["J1"]["Turnover in EUR"]) == 10.5 and rows["J4"]["Zone 3 Label"] == "two\nlines" and rows["J4"].Month == 7
    p = Pipeline(spark).read([a, b, str(c)])
    assert not p.errors and p.df.count() == 4
    done = p.filter(FilterSpec()).aggregate().classify(RuleSet((Segment("big", "AND", (Condition("CA_EUR", ">", "5"),)),)))
    assert {r.Customer: r.segment for r in done.df.collect()} == {"A & <B>": "big", "C": "Non classe", "D": "Non classe", "E, F": "Non classe"}
    out = tmp_path / "out.xlsx"
    sinks.write_xlsx(done.view(["big"]), done.report(), str(out))
    rows = list(Workbook(out.read_bytes()).rows())
    assert rows[0][1][0] == "Customer" and rows[1][1][0] == "A & <B>" and dt.datetime(2023, 5, 1) in rows[1][1]
    sinks.write_csv_file(done.df, str(tmp_path / "o.csv"))
    text = (tmp_path / "o.csv").read_bytes()
    assert text.startswith(b"\xef\xbb\xbfCustomer") and b"2023-05-01" in text
    sinks.write_csv(done.df, str(tmp_path / "parts"))
    assert spark.read.csv(str(tmp_path / "parts"), header=True).count() == 4
    for day in ("2024-01-01", "2024-02-01", "2024-02-01"):
        sinks.write_snapshot(done.df.select("Customer", "segment"), str(tmp_path / "snap"), day)
    assert spark.read.parquet(str(tmp_path / "snap")).count() == 8
    landed, _ = load.land(spark, [a, b], str(tmp_path / "land"))
    again, _ = load.land(spark, [a, b], str(tmp_path / "land"))
    assert landed.count() == again.count() == 4
    with pytest.raises(ValueError):
        Pipeline(spark, df=df).report()


def test_no_files(spark):
    df, errors = load.read_extracts(spark, [])
    assert df.count() == 0 and "Customer" in df.columns and not errors


def test_sheet_limit(tmp_path, monkeypatch):
    monkeypatch.setattr("ledgerlens.sources.xlsx.MAX_ROWS", 3)
    with pytest.raises(ValueError):
        write_workbook(str(tmp_path / "x.xlsx"), {"s": (["a"], ([i] for i in range(5)))})
    assert not list(tmp_path.iterdir())


def test_watched_folder(spark, tmp_path):
    rows = spark.createDataFrame([("J1", 2), ("J1", 1), ("J2", 3)], "JobfileNumber string, load_seq long")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    got = []
    watch_folder(spark, str(tmp_path / "in"), rows.schema, str(tmp_path / "cp"), lambda df, n: got.extend(df.collect())).awaitTermination()
    assert sorted((r.JobfileNumber, r.load_seq) for r in got) == [("J1", 1), ("J2", 3)]


def test_windowed_counts_on_a_stream(spark, tmp_path):
    t = dt.datetime(2024, 1, 1, 10)
    rows = spark.createDataFrame([(t, "a"), (t + dt.timedelta(minutes=5), "a"), (t + dt.timedelta(hours=9), "b")], "ts timestamp, event_type string")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = windowed_counts(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.event_type, r.n) for r in spark.table("counts").collect()) == [("a", 2), ("b", 1)]


def test_first_line_of_a_parquet_folder(spark, tmp_path):
    """Lines are ordered by file name, not by the order in which Spark reads splits, the largest first."""
    folder = tmp_path / "x.parquet"
    one = "Year int, Month int, Customer string, JobfileNumber string"
    for name, rows in (("part-0", [(2023, 1, "first", "J1")]), ("part-1", [(2023, 2, "second", "J1")] + [(2023, 3, "x" * 50, f"K{i}") for i in range(2000)])):
        spark.createDataFrame(rows, one).coalesce(1).write.parquet(str(tmp_path / name))
        folder.mkdir(exist_ok=True)
        next((tmp_path / name).glob("*.parquet")).rename(folder / f"{name} a.parquet")
    p = Pipeline(spark).read([str(folder)])
    assert p.df.where("JobfileNumber = 'J1'").first().Customer == "first"
    assert tuple(p.summary().first()) == (2001, len(p.columns()), 2, 1) and p.preview(3).count() == 3
    assert not p.is_empty() and p.filter(FilterSpec(years=[1900])).is_empty()
    with pytest.raises(ValueError):
        p.clients()


def test_landing_copy_sees_new_and_changed_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    a, b = tmp_path / "in" / "a.csv", tmp_path / "in" / "b.csv"
    a.write_text("Year,Customer,JobfileNumber\n2023,A,J1\n")
    read = lambda p: load.land(spark, [p], str(tmp_path / "land"))[0].count()
    for p in (str(tmp_path / "in"), str(tmp_path / "in" / "*.csv")):
        b.unlink(missing_ok=True)
        assert read(p) == 1
        b.write_text("Year,Customer,JobfileNumber\n2023,B,J2\n2023,B,J3\n")
        assert read(p) == 3
        b.write_text("Year,Customer,JobfileNumber\n2023,B,J2\n")
        assert read(p) == 2
