"""Ranking by blocks against every pair compared one by one."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import numpy as np

from compare import duck_rows, spark_rows
from folioscope.operators import retrieval as O
from folioscope.plans.catalogue import ORACLE_SQL, QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def cosine(a, b):
    """None where it has no value, else rounded half up at six digits."""
    if not a or not b or len(a) != len(b) or None in a or None in b:
        return None
    dot = lambda x, y: sum(u * v for u, v in zip(x, y, strict=True))
    if not dot(a, a) or not dot(b, b):
        return float("nan")
    return float(Decimal(repr(dot(a, b) / (dot(a, a) ** 0.5 * dot(b, b) ** 0.5))).quantize(Decimal("0.000001"), ROUND_HALF_UP))


def test_vectors_by_blocks(spark):
    """Copies that tie, scores half way between two roundings, zero, null and empty vectors, and others of another length."""
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.integers(-3, 4, 4)]) for i in range(300)]
    rows += [(300 + i, [1.0, 2.0, 0.0, 1.0]) for i in range(100)] + [(400, [0.0] * 4), (401, None), (402, []), (403, [1.0, 2.0]), (405, [2.0, 1.0]), (406, [1.0, None, 2.0, 1.0])]
    asked = [(i, v) for i, v in rows if i % 3 == 0]
    v, q = spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame(asked, "query_id long, query_embedding array<float>")
    got = {(r.query_id, r["rank"]): (r.vec_id, None if r.score is None else "nan" if r.score != r.score else r.score) for r in O.vector_top_k(v, q, 7, rows=50, asked=20).collect()}
    want = {}
    for i, a in asked:
        scored = [(cosine(b, a), j) for j, b in rows if j != i]
        scored.sort(key=lambda x: (x[0] is None, x[0] is not None and x[0] == x[0], 0 if x[0] is None or x[0] != x[0] else -x[0], x[1]))
        want |= {(i, n + 1): (j, None if s is None else "nan" if s != s else s) for n, (s, j) in enumerate(scored[:7])}
    assert got == want


def test_no_pair_is_a_row(spark, sf_dir):
    """The plan has no join of vectors with queries, and is the same for any number of blocks."""
    v = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    q = v.selectExpr("vec_id query_id", "embedding query_embedding")
    plans = [O.vector_top_k(v, q, 3, *sizes)._jdf.queryExecution().optimizedPlan().toString() for sizes in ((10, 10), (100000, 100000))]
    assert "NOT (vec_id" not in plans[0] and plans[0].count("\n") == plans[1].count("\n") and "CoGroup" in plans[0]


def test_hybrid_with_a_zero_vector(spark, tmp_path):
    """The SQL ranks NaN first; division by zero was an error before."""
    rows = [(i, [float((i * k) % 7 - 3) for k in range(1, 5)] if i % 40 else [0.0] * 4, i % 3) for i in range(200)]
    spark.createDataFrame(rows, SCHEMA + ", label int").coalesce(1).write.parquet(str(tmp_path / "out"))
    next((tmp_path / "out").glob("*.parquet")).rename(tmp_path / "embeddings.parquet")
    assert spark_rows(QUERIES["hybrid_rrf"](spark, str(tmp_path))) == duck_rows(ORACLE_SQL["hybrid_rrf"], str(tmp_path))
