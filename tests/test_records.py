"""Record validation: odd texts, and how often a record's kinds are told."""

from __future__ import annotations

import json
import re

import pytest

from folioscope.operators import quality as K
from folioscope.plans.catalogue import QUERIES


def findings(spark, texts):
    rows = K.validate(spark.createDataFrame([("f", i, t) for i, t in enumerate(texts)], "file string, pos long, json string")).collect()
    return {i: {r.rule for r in rows if r.pos == i} for i in range(len(texts))}


def test_odd_records(spark):
    whole = {k: {"array": [], "object": {}, "string": "s", "boolean": False, "integer": 1}[v.rstrip("?")] for k, v in K.METADATA.items()}
    text = lambda **m: json.dumps({"chunk_id": "2016-S03-T1-001", "content": "y" * 100, "metadata": {**whole, **m}})
    got = findings(spark, ["x", None, "null", "[1]", "{}", '{"chunk_id": null, "content": 1, "metadata": null}', text(), text(themes=None), text(themes={}), text(letter_year=1.5)])
    assert got[0] == got[1] == {"not_json"} and got[2] == got[3] == {"not_object"}
    assert got[4] == {"missing_key:chunk_id", "missing_key:content", "missing_key:metadata"}
    assert got[5] == {"wrong_type:chunk_id", "wrong_type:content", "metadata_not_object"}
    assert [got[i] - got[6] for i in (7, 8, 9)] == [{"metadata_type:themes"}, {"metadata_type:themes"}, {"metadata_type:letter_year"}] and "metadata_type:themes" not in got[6]


@pytest.mark.parametrize("name", ["planted_defects", "first_diagnostics"])
def test_kinds_are_told_once(spark, sf_dir, name):
    """Rules look them up: a schema costs a walk over the value, and there are a hundred rules."""
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"schema_?of_?variant|SchemaOfVariant", plan)) < 15
