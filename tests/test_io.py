"""Readers and writers, the yearly fold, snapshots and logs."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from folioscope.operators import quality as K
from folioscope.sources import io
from folioscope.streaming import incremental as I


def test_letters_by_folder_and_file(spark, tmp_path):
    for name, text in (("1977_cleaned.txt", "a\r\nb"), ("1980_cleaned.txt", " "), ("notes.txt", "x"), ("1981.md", "y")):
        (tmp_path / name).write_bytes(text.encode())
    assert sorted(tuple(r) for r in io.read_letters(spark, str(tmp_path)).collect()) == [("1977_cleaned.txt", 1977, "a\r\nb"), ("1980_cleaned.txt", 1980, " ")]
    assert [tuple(r)[1:] for r in io.one_letter(spark, str(tmp_path / "1977_cleaned.txt")).collect()] == [(1977, "a\r\nb")]
    with pytest.raises(FileNotFoundError):
        io.one_letter(spark, str(tmp_path / "1999_cleaned.txt"))


def test_record_files_of_every_kind(spark, tmp_path):
    files = {"2016_chunks_2tier.json": '[{"a": 1}, 5, "x"]', "bad.json": "{not json", "object.json": '{"a": 1}', "empty.json": "[]"}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    got = io.read_records(spark, str(tmp_path))
    rows = sorted((r["file"], r["pos"], r["json"]) for r in got.collect())
    assert rows == [("2016_chunks_2tier.json", 0, '{"a":1}'), ("2016_chunks_2tier.json", 1, "5"), ("2016_chunks_2tier.json", 2, '"x"'), ("bad.json", 0, "{not json"), ("object.json", 0, 'no array: {"a": 1}')]
    found = {(r["file"], r["pos"], r["rule"]) for r in K.validate(got).collect()}
    assert {("bad.json", 0, "not_json"), ("object.json", 0, "not_json"), ("2016_chunks_2tier.json", 1, "not_object")} <= found
    with pytest.raises(Exception, match="not a JSON array"):
        io.read_records(spark, str(tmp_path), strict=True).collect()
    years = got.select(io.year_of_records(F.col("file")).alias("y")).distinct().collect()
    assert {r[0] for r in years} == {2016, None}


def test_statements_and_writers(spark, tmp_path):
    (tmp_path / "income.csv").write_text("ticker,yearReport,Net Sales (Bn)\nABC,2024,12\nABC,2023,\n")
    s = io.read_statements(spark, str(tmp_path / "income.csv"))
    assert s.columns == ["ticker", "yearreport", "net_sales__bn"] and sorted(tuple(r) for r in s.collect()) == [("ABC", 2023, None), ("ABC", 2024, 12.0)]
    io.write_csv(s, str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).count() == 2
    rows = spark.createDataFrame([(2016, 1, "b"), (2016, 0, "a"), (2017, 0, None)], "year int, pos int, content string")
    io.write_records(rows, str(tmp_path / "lines"), "year")
    assert spark.read.json(str(tmp_path / "lines")).count() == 3
    io.write_json_arrays(rows, str(tmp_path / "arrays"), "year")
    text = {r["year"]: r["value"] for r in spark.read.text(str(tmp_path / "arrays"), wholetext=True).collect()}
    assert json.loads(text[2016]) == [{"pos": 0, "content": "a"}, {"pos": 1, "content": "b"}] and json.loads(text[2017]) == [{"pos": 0}]
    assert json.loads(io.to_json_rows(rows.where("year = 2017")).collect()[0][0]) == {"year": 2017, "pos": 0}


def test_year_folded_twice_counts_once(spark):
    year = lambda *rows: spark.createDataFrame(rows, "item string, year int")
    one = I.fold_master(None, year(("a", 1977), ("a", 1977), ("b", 1977)))
    two = I.fold_master(I.fold_master(one, year(("a", 1978))), year(("a", 1978), ("c", 1978)))
    assert {r["item"]: (r["first_year"], r["last_year"], r["n_years"]) for r in two.collect()} == {"a": (1977, 1978, 2), "b": (1977, 1977, 1), "c": (1978, 1978, 1)}


def test_snapshot_is_made_once_and_logs_grow(spark, tmp_path):
    made = []

    def make():
        made.append(1)
        return spark.range(3)

    path = str(tmp_path / "snap")
    assert I.reuse_snapshot(spark, path, make).count() == 3 and I.reuse_snapshot(spark, path, make).count() == 3 and len(made) == 1
    for _ in range(2):
        I.append_log(spark.createDataFrame([("q", "a")], "question string, answer string"), str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).where("logged_at is not null").count() == 2
