"""Every registered query of the package's own operators against its SQL, or at least run to the end."""

from __future__ import annotations

import pytest

from compare import duck_rows, spark_rows
from folioscope.plans.catalogue import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    names, rows = spark_rows(QUERIES[name](spark, sf_dir))
    assert rows and len(set(names)) == len(names)
    if name in ORACLE_SQL:
        assert (names, rows) == duck_rows(ORACLE_SQL[name], sf_dir)


def test_every_sql_has_a_query():
    assert set(ORACLE_SQL) <= set(QUERIES)
