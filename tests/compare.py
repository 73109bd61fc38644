"""Rows of a Spark query and of DuckDB SQL as comparable multisets."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, bool):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if hasattr(v, "as_integer_ratio") and not isinstance(v, int):
        return float(f"{float(v):.9g}")
    return v


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(plain(v) for v in r) for r in df.select(*[f"`{n}`" for n in names]).collect())


def duck_rows(sql: str, sf_dir: str) -> tuple[list[str], Counter]:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for p in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in got.fetchall())
