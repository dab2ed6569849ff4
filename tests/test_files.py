"""Ingest of landing files: headers, lineage, schema log, rescued fields, checkpoints, progress."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from obslake.sources import landing as L
from obslake.streaming import bronze as B
from obslake.streaming import schema_log

NARROW = "date,serial_number,failure"
WIDE = "smart_7_raw,failure,serial_number,date"


def put(root: Path, release: str, name: str, *lines: str, end: str = "\n") -> Path:
    path = root / f"release={release}" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(end.join([*lines, ""]).encode())
    return path


def run(spark, root: Path, which: str = "a", **options):
    return B.run_bronze(spark, str(root / f"landing-{which}"), str(root / "bronze"), str(root / f"checkpoint-{which}"), query_name=None, **options)


def rows(spark, root: Path) -> dict:
    return {r.serial_number: r for r in B.read_bronze(spark, str(root / "bronze")).collect()}


def test_files_of_different_headers_meet_by_name(spark, tmp_path):
    a = tmp_path / "landing-a"
    put(a, "2031-Q2-r1", "one.csv", NARROW, "2031-04-05,K1,0")
    put(a, "2031-Q2-r12", "two.csv", WIDE, "77,1,K2,2031-04-06", end="\r\n")
    (a / "release=2031-Q2-r1" / "notes.json").write_text("{}")
    put(a, "2031-Q2-r1", "empty.csv")
    (a / "release=2031-Q2-r1" / "nothing.csv").write_bytes(b"")
    (batch,) = run(spark, tmp_path)
    assert (batch.batch, batch.files, batch.rows, batch.rescued_rows, batch.columns) == (0, 2, 2, 0, 4)
    got = rows(spark, tmp_path)
    assert (got["K1"].date, got["K1"].failure, got["K1"].smart_7_raw) == ("2031-04-05", "0", None)
    assert (got["K2"].date, got["K2"].failure, got["K2"].smart_7_raw) == ("2031-04-06", "1", "77")
    assert [(r.source_quarter, r.source_revision) for r in (got["K1"], got["K2"])] == [("2031-Q2", 1), ("2031-Q2", 12)]
    assert got["K2"].source_file.endswith("release=2031-Q2-r12/two.csv") and got["K2"].file_modification_time is not None
    assert run(spark, tmp_path) == []


def test_columns_are_kept_over_runs(spark, tmp_path):
    a, log = tmp_path / "landing-a", B.schema_folder(str(tmp_path / "bronze"))
    assert schema_log.known_columns(spark, log) == (0, [])
    put(a, "2031-Q2-r1", "one.csv", NARROW, "2031-04-05,K1,0")
    run(spark, tmp_path)
    assert schema_log.known_columns(spark, log) == (1, NARROW.split(","))
    put(a, "2031-Q3-r1", "two.csv", "Failure,serial_number,added", "1,K2,x")
    run(spark, tmp_path)
    put(a, "2031-Q4-r1", "three.csv", NARROW, "2031-10-05,K3,0")
    run(spark, tmp_path)
    assert schema_log.known_columns(spark, log) == (2, [*NARROW.split(","), "added"])
    got = rows(spark, tmp_path)
    assert [got[k].added for k in ("K1", "K2", "K3")] == [None, "x", None]
    assert [got[k].failure for k in ("K1", "K2", "K3")] == ["0", "1", "0"]  # names match in either case
    plan = B.read_bronze(spark, str(tmp_path / "bronze")).select("added")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<added:string>" in plan


def test_schema_log_takes_in_what_another_query_wrote(spark, tmp_path, monkeypatch):
    log = str(tmp_path / "log")
    schema_log.extend(spark, log, ["a,b"])
    known, calls = schema_log.known_columns, []

    def late(session, folder):
        if not calls:  # what this query has read is no longer the newest
            calls.append(known(session, folder))
            schema_log.extend(session, folder, ["b,theirs"])
            return calls[0]
        return known(session, folder)

    monkeypatch.setattr(schema_log, "known_columns", late)
    assert schema_log.extend(spark, log, ["ours"]) == ["a", "b", "theirs", "ours"]
    assert schema_log.extend(spark, log, ["ours,a", "B"]) == ["a", "b", "theirs", "ours"]
    assert known(spark, log) == (3, ["a", "b", "theirs", "ours"])


def test_surplus_fields_are_rescued(spark, tmp_path):
    a = tmp_path / "landing-a"
    lines = ["2031-04-05,K1,0", '2031-04-05,K2,0,more,"a, ""b""",', "2031-04-05,K3", '"2031, really",K4,""', '"x""y",K5,1,"é,漢"']
    put(a, "2031-Q2-r1", "one.csv", "﻿" + NARROW, "", lines[0], "   ", *lines[1:], NARROW)
    (batch,) = run(spark, tmp_path)
    assert (batch.rows, batch.rescued_rows) == (5, 2)
    got = rows(spark, tmp_path)
    assert got["K1"]._rescued_data is None and got["K1"].date == "2031-04-05"
    assert json.loads(got["K2"]._rescued_data) == {"_c3": "more", "_c4": 'a, "b"', "_c5": ""}
    assert got["K3"]._rescued_data is None and got["K3"].failure is None
    assert (got["K4"].date, got["K4"].failure, got["K4"]._rescued_data) == ("2031, really", "", None)
    assert got["K5"].date == 'x"y' and json.loads(got["K5"]._rescued_data) == {"_c3": "é,漢"}


def test_written_landing_comes_back_as_it_was(spark, tmp_path):
    values = [None, "", " ", " x ", 'say "hi"', "a,b", '"', "é", "nul\u0000l", "#", "-"]
    data = [(f"k{i}", v, values[-1 - i], "2031-Q1-r1" if i % 2 else "2031-Q2-r3") for i, v in enumerate(values)]
    frame = spark.createDataFrame(data, "serial_number string, one string, two string, release string")
    L.write_landing(frame, str(tmp_path / "landing-a"))
    got = L.read_landing(spark, str(tmp_path / "landing-a"), str(tmp_path / "headers"))
    release = F.concat("source_quarter", F.lit("-r"), F.col("source_revision").cast("string"))
    assert {tuple(r) for r in got.select("serial_number", "one", "two", release).collect()} == set(data)


@pytest.mark.parametrize("header", ["date,DATE", "date,source_file", "date,_rescued_data"])
def test_ambiguous_headers_are_rejected(header):
    with pytest.raises(ValueError, match="landing header names"):
        L.header_columns(header)


def test_unnamed_columns_are_called_by_position():
    assert L.header_columns('date,"x, y",,z') == ["date", "x, y", "_c2", "z"]


def test_a_path_outside_the_contract_fails_the_batch(spark, tmp_path):
    put(tmp_path / "landing-a", "2031-Q5-r1", "one.csv", NARROW, "2031-04-05,K1,0")
    with pytest.raises(Exception, match="Source path must contain release=YYYY-QN-rN: .*release=2031-Q5-r1/one.csv"):
        run(spark, tmp_path)
    with pytest.raises(FileNotFoundError):
        B.read_bronze(spark, str(tmp_path / "bronze"))


def test_two_checkpoints_and_a_failed_batch_keep_every_row_once(spark, tmp_path, monkeypatch):
    for which, release in (("a", "2031-Q1-r1"), ("b", "2032-Q1-r1")):
        for n in range(3):
            put(tmp_path / f"landing-{which}", release, f"{n}.csv", NARROW, *[f"2031-01-0{n + 1},{which}{n}{k},0" for k in range(4)])
    written, whole = [], B.ingest_batch

    def failing(lines, batch, query_id, bronze_path):
        out = whole(lines, batch, query_id, bronze_path)
        written.append((query_id, batch))
        if batch == 1 and len(written) == 2:
            raise RuntimeError("lost after the write")  # the checkpoint does not know of this batch
        return out

    monkeypatch.setattr(B, "ingest_batch", failing)
    with pytest.raises(Exception, match="lost after the write"):
        run(spark, tmp_path, "a", max_files_per_trigger=1)
    again = run(spark, tmp_path, "a", max_files_per_trigger=1)
    other = run(spark, tmp_path, "b", max_files_per_trigger=1)
    assert [b.batch for b in again] == [1, 2] and [b.batch for b in other] == [0, 1, 2]
    assert written[1] == written[2] and len({q for q, _ in written}) == 2
    assert all(b.rows == 4 and b.files == 1 and b.duration_ms > 0 for b in again + other)
    serials = [r.serial_number for r in B.read_bronze(spark, str(tmp_path / "bronze")).collect()]
    assert sorted(serials) == sorted(f"{w}{n}{k}" for w in "ab" for n in range(3) for k in range(4))


def test_a_large_file_is_read_in_several_blocks(spark, tmp_path):
    """Lines of later blocks find the header of their file; each line is parsed once."""
    lines = [f"2031-04-05,K{i},{i % 2}" for i in range(20_000)]
    put(tmp_path / "landing-a", "2031-Q2-r1", "one.csv", NARROW, *lines)
    put(tmp_path / "landing-a", "2031-Q2-r2", "two.csv", ",".join(reversed(NARROW.split(","))), *[",".join(reversed(x.split(","))) for x in lines])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        got = L.read_landing(spark, str(tmp_path / "landing-a"), str(tmp_path / "headers"))
        assert got.rdd.getNumPartitions() > 5
        seen = got.groupBy("date", "serial_number", "failure").agg(F.count_distinct("source_revision").alias("n"), F.count("*").alias("all"))
        assert seen.where("n = 2 AND all = 2").count() == 20_000 == seen.count()
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_csv") == 2  # one a header
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
