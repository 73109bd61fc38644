"""Work of a row that is stated once: small files are dealt over all tasks, and rules are not repeated in the plan."""

from __future__ import annotations

import pytest

from folioscope.plans.catalogue import QUERIES


def plan(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["chunk_records", "table_extraction"])
def test_customers_are_dealt(spark, sf_dir, name):
    """One file of customers is one split; the letters made of it are work for all."""
    assert "RepartitionByExpression [c_custkey" in plan(spark, sf_dir, name)


def test_blocks_of_a_section_are_found_once(spark, sf_dir):
    assert plan(spark, sf_dir, "chunk_records").count("aggregate(sequence") == 1
