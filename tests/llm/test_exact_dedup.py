"""Exact dedup against groups of equal texts."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from brute import lower
from compare import duck_rows, spark_rows
from folioscope.llm import exact_dedup as X

SCHEMA = "doc_id long, text string"


def test_query_equals_sql(spark, sf_dir):
    assert spark_rows(X.op4_exact_dedup(spark, sf_dir)) == duck_rows(X.OP4_SQL, sf_dir)


@pytest.mark.parametrize("keep", ["min", "max"])
def test_odd_rows(spark, keep):
    rows = [(1, None), (2, ""), (3, "Ab"), (4, "aB"), (5, "É"), (6, "é"), (7, "x" * 2_000_000), (8, "X" * 2_000_000), (9, " ab"), (10, "a\x00b")]
    rows += [(i, "copy") for i in range(11, 400)]
    df = spark.createDataFrame([(i, t, "z", 1) for i, t in rows], "doc_id long, text string, keep_id string, h long")
    got = {r["doc_id"]: r for r in X.exact_dedup(df, keep=keep).collect()}
    size, best = Counter(lower(t) for _, t in rows), {}
    for i, t in rows:
        best[lower(t)] = (min if keep == "min" else max)(i, best.get(lower(t), i))
    for i, t in rows:
        r, low = got[i], lower(t)
        assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (best[low], size[low], best[low] == i, hashlib.sha256(low.encode()).hexdigest())


def test_repeated_null_and_no_rows(spark):
    twice = X.exact_dedup(spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (1, "b")], SCHEMA)).collect()
    assert sorted((str(r["doc_id"]), r["keep_id"], r["group_size"], r["kept"]) for r in twice) == [("1", 1, 1, True), ("1", 1, 3, True), ("1", 1, 3, True), ("None", 1, 3, False)]
    assert X.exact_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_collisions_are_told_apart(spark, monkeypatch):
    """With a hash that takes few values, bytes still decide."""
    monkeypatch.setattr(X.F, "md5", lambda c: F.lpad(F.length(c).cast("string"), 32, "0"))
    rows = [(1, "aa"), (2, "bb"), (3, "AA"), (4, "cc"), (5, "bb"), (6, "ccc")]
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in X.exact_dedup(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: (1, 2), 3: (1, 2), 2: (2, 2), 5: (2, 2), 4: (4, 1), 6: (6, 1)}


def test_stage(spark):
    df = spark.createDataFrame([(3, "a", "x"), (2, "A", None), (5, "b", "y")], "doc_id long, text string, source string")
    got = X.drop_copies(spark, df, "")
    assert got.columns == df.columns and sorted(r["doc_id"] for r in got.collect()) == [2, 5]
