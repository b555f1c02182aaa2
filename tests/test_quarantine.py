"""CSV with bad rows set aside."""

import random

import pytest
from pyspark.sql import functions as F

from daypanel.plans import jobs
from daypanel.sources import quarantine as q
from daypanel.sources.tables import READING_SCHEMA

HEADER = "date,client_id,consumption_kwh"
GOOD = ["2023-01-01,C1,1.5", ",,", '2023-01-06,"C,1",7', '"2023-01-07",C1,', "2023-01-08,C1,NaN"]
BAD = {
    "2023-13-01,C1,2": "date: '2023-13-01' is no date",
    "2023-01-03,C1,x": "consumption_kwh: 'x' is no double",
    "2023-01-04,C1": "not 3 cells",
    "2023-01-05,C1,3,4": "not 3 cells",
}


def write(path, lines):
    path.write_text("\n".join([HEADER, *lines]) + "\n")


def listed(spark, folder):
    rows = spark.read.parquet(str(folder)).collect()
    return sorted((r["file"].rsplit("/", 1)[1], r["line"], r["text"], r["reason"]) for r in rows)


def test_good_rows_go_on_and_bad_ones_are_listed(spark, tmp_path):
    source = tmp_path / "raw files"
    source.mkdir()
    pick, lines, expected = random.Random(3), {}, []
    for name in ("a.csv", "b.csv", "c.csv"):
        lines[name] = [pick.choice([*GOOD, *BAD, ""]) for _ in range(200)] if name != "c.csv" else GOOD
        write(source / name, lines[name])
        expected += [(name, n, line, BAD[line]) for n, line in enumerate(lines[name], 2) if line in BAD]
    good = q.read_csv_checked(spark, str(source), READING_SCHEMA, str(tmp_path / "bad"), None)
    assert listed(spark, tmp_path / "bad") == sorted(expected)
    assert good.columns == READING_SCHEMA.fieldNames()
    assert good.count() == sum(line in GOOD for name in lines for line in lines[name])
    assert good.where(F.isnan("consumption_kwh")).isEmpty() and not good.where("client_id = 'C,1'").isEmpty()


def test_lines_are_numbered_across_pieces_of_a_file(spark, tmp_path):
    lines = [f"2023-01-01,C{n},{'x' if n % 997 == 5 else n}" for n in range(20_000)]
    write(tmp_path / "a.csv", lines)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        good = q.read_csv_checked(spark, str(tmp_path / "a.csv"), READING_SCHEMA, str(tmp_path / "bad"))
        assert good.count() == 20_000 - 21
        found = [(line, text) for _, line, text, _ in listed(spark, tmp_path / "bad")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert found == [(n + 2, lines[n]) for n in range(5, 20_000, 997)]


def test_more_bad_files_than_are_named(spark, tmp_path, monkeypatch):
    source = tmp_path / "raw"
    source.mkdir()
    for name in "abc":
        write(source / f"{name}.csv", ["2023-01-01,C1,1", "2023-01-01,C1,x"])
    monkeypatch.setattr(q, "NAMED_FILES", 1)
    q.read_csv_checked(spark, str(source), READING_SCHEMA, str(tmp_path / "bad"), None)
    assert [(name, line) for name, line, _, _ in listed(spark, tmp_path / "bad")] == [("a.csv", 3), ("b.csv", 3), ("c.csv", 3)]


def test_too_many_bad_rows_raise_after_they_are_listed(spark, tmp_path):
    write(tmp_path / "a.csv", [GOOD[0]] * 98 + ["2023-01-04,C1"] * 2)
    source, bad = str(tmp_path / "a.csv"), str(tmp_path / "bad")
    with pytest.raises(q.BadRows, match="2 of 100") as error:
        q.read_csv_checked(spark, source, READING_SCHEMA, bad)
    assert (error.value.rows, error.value.bad) == (100, 2)
    assert [line for _, line, _, _ in listed(spark, bad)] == [100, 101]
    assert q.read_csv_checked(spark, source, READING_SCHEMA, bad, 0.02).count() == 98


def test_a_clean_and_an_empty_file(spark, tmp_path):
    bad = str(tmp_path / "bad")
    write(tmp_path / "a.csv", ["2023-01-04,C1"])
    q.read_csv_checked(spark, str(tmp_path / "a.csv"), READING_SCHEMA, bad, None)
    write(tmp_path / "b.csv", GOOD)
    assert q.read_csv_checked(spark, str(tmp_path / "b.csv"), READING_SCHEMA, bad, 0).count() == len(GOOD)
    assert spark.read.parquet(bad).isEmpty()
    write(tmp_path / "c.csv", [])
    assert q.read_csv_checked(spark, str(tmp_path / "c.csv"), READING_SCHEMA, bad, 0).isEmpty()


def test_another_header_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("date,consumption_kwh,client_id\n2023-01-01,1,C1\n")
    with pytest.raises(Exception, match="(?i)header"):
        q.read_csv_checked(spark, str(tmp_path / "a.csv"), READING_SCHEMA, str(tmp_path / "bad"))


def test_inputs_of_the_jobs(spark, tmp_path):
    (tmp_path / "clients.csv").write_text("client_id,region\nC1,Sul\nC2\n")
    (tmp_path / "climate.csv").write_text("date,region,temperature,humidity\n2023-01-01,Sul,20,60\n")
    write(tmp_path / "readings.csv", ["2023-01-01,C1,1", "2023-01-02,C1,x"])
    paths = [str(tmp_path / f"{n}.csv") for n in ("clients", "climate", "readings")]
    inputs = jobs.read_inputs(spark, *paths, quarantine=str(tmp_path / "bad"), max_bad_share=0.5)
    assert [df.count() for df in inputs] == [1, 1, 1]
    assert {n: len(listed(spark, tmp_path / "bad" / n)) for n in ("clients", "climate", "readings")} == {
        "clients": 1, "climate": 0, "readings": 1,
    }
