"""The pipeline: each stage's decisions take effect on what the next one gets."""

from __future__ import annotations

import corpus_pipeline
from brute import lower, near_components
from folioscope.llm.quality_rules import op7_quality_rules


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept, columns = {"start": {r["doc_id"]: r["text"] for r in docs.collect()}}, docs.columns
    last = "start"
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == columns
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert set(kept[name]) <= set(kept[last])
        last = name
    assert set(kept["quality_rules"]) == {r[0] for r in op7_quality_rules(spark, sf_dir).where("kept").collect()}
    first = {}
    for i in sorted(kept["quality_rules"]):
        first.setdefault(lower(kept["quality_rules"][i]), i)
    assert set(kept["exact_dedup"]) == set(first.values())
    label = near_components(kept["exact_dedup"], 80)[1]
    assert set(kept["near_dedup"]) == set(label.values())
    assert set(kept["secret_scan"]) == set(kept["near_dedup"])
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in pieces} == set(kept["near_dedup"])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "secret_scan", "packing"]


def test_rows_without_an_id(spark):
    """Of a text's rows without an id one stays if no row with an id has the text; near copies likewise."""
    text = {x: [f"{x}{i}" for i in range(100)] for x in "abcd"}
    near = " ".join([*text["a"][:-1], "end"])
    lone, twin, base = " ".join(text["b"]), " ".join(text["c"]), " ".join(text["a"])
    rows = [(1, base, "a"), (None, base, "b"), (None, near, "c"), (None, lone, "d"), (None, lone.upper(), "d"), (None, twin, "e"), (7, twin, "f"), (None, " ".join(text["d"]), "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    stages = dict(corpus_pipeline.STAGES)
    exact = stages["exact_dedup"](spark, docs, "")
    assert exact.columns == docs.columns and sorted((str(r[0]), r[2]) for r in exact.collect()) == [("1", "a"), ("7", "f"), ("None", "c"), ("None", "d"), ("None", "g")]
    for given in (docs, exact):
        assert sorted((str(r[0]), r[2]) for r in stages["near_dedup"](spark, given, "").collect()) == [("1", "a"), ("7", "f"), ("None", "d"), ("None", "g")]


def test_repeated_rows_and_clashing_names(spark):
    """Of rows that repeat an id and its text one stays; columns may be named as the stages name their own."""
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, "a b", "x", 1), (1, "a b", "x", 1), (1, "A b", "y", 1), (1, long, "z", 2), (2, long, "z", 2), (3, None, None, None), (4, "", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key string, kept long")
    stages = dict(corpus_pipeline.STAGES)
    exact = stages["exact_dedup"](spark, docs, "")
    assert exact.columns == docs.columns and sorted((r[0], r[1]) for r in exact.where("text <> ''").collect()) == [(1, "A b"), (1, long)]
    assert [r[0] for r in exact.where("coalesce(text, '') = ''").collect()] == [3]
    near = stages["near_dedup"](spark, docs, "")
    assert near.columns == docs.columns and {r[0] for r in near.collect()} == {1, 3, 4}
    empty = docs.limit(0)
    assert all(stages[k](spark, empty, "").columns == docs.columns and stages[k](spark, empty, "").isEmpty() for k in ("exact_dedup", "near_dedup", "secret_scan"))
    assert stages["packing"](spark, empty, "").isEmpty() and stages["secret_scan"](spark, docs, "").count() == len(rows)
