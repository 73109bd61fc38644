"""Shared helpers: tables, scratch folders, ASCII lower-casing, words, hashes and connected components."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: White space that separates words; everything else is part of a word.
SEP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one of our own only where none is set (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
            spark.sparkContext.setCheckpointDir(base)
        return base
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir names no shared folder")
    base = tempfile.mkdtemp(prefix="folioscope-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(base)
    return base


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared checkpoint folder, so that a lost executor loses nothing."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts lineage like cut(), and takes less disk where rows are many."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Texts of ASCII alone take the byte-wise path of lower()."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words(text: Column) -> Column:
    """Maximal runs of characters other than space and U+0009 to U+000D."""
    return F.array_remove(F.split(text, SEP), "")


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once for each row, also where body uses it inside other lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def counted(df: DataFrame, rows: int = 100_000, most: int | None = None) -> tuple[DataFrame, int]:
    """cut(), then at most one partition for so many rows, and the number of rows: small results aren't dealt over many
    empty tasks, large ones keep their partitions, as the number follows the count. most: a bound on the rows where one is
    known, so that small results aren't written as many empty files either."""
    done = cut(df if most is None else df.coalesce(max(1, -(-most // rows))))
    n = done.count()
    return done.coalesce(max(1, -(-n // rows))), n


def settle(df: DataFrame, rows: int = 100_000, most: int | None = None) -> DataFrame:
    """counted() without the number."""
    return counted(df, rows, most)[0]


def free_name(df: DataFrame, name: str) -> str:
    """The name, with low lines after it until df has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keyed(docs: DataFrame, key: str) -> DataFrame:
    """docs with a key that is never null: doc_id, or for each row without one a value of its own above all ids."""
    without = docs.where("doc_id is null")
    own = F.col("doc_id") if docs.schema["doc_id"].dataType.simpleString() == "string" else F.col("doc_id").cast("long")
    if without.isEmpty():
        return docs.withColumn(key, own)
    top, number = docs.agg(F.max("doc_id")).first()[0], F.monotonically_increasing_id()
    if docs.schema["doc_id"].dataType.simpleString() == "string":
        above = F.concat(F.lit(top or ""), F.lpad(number.cast("string"), 20, "0"))
    else:
        above = F.lit(top or 0).cast("long") + 1 + number
    return docs.where("doc_id is not null").withColumn(key, own).union(cut(without.withColumn(key, above)))


#: Edges whose components one task finds; more are spread over many.
TOGETHER = 1 << 20


def least_labels(src: np.ndarray, dst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vertices and the smallest vertex of the component of each: union-find on arrays, where in each round every root
    takes the smallest root next to it and paths are halved until they are flat."""
    ids, at = np.unique(np.concatenate([src, dst]), return_inverse=True)
    a, b = at[: len(src)], at[len(src) :]
    root = np.arange(len(ids))
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return ids, ids[root]


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, label): the smallest vertex reachable from every vertex of undirected edges (src, dst); vertices without edges
    are absent.

    Up to TOGETHER distinct edges, 16 MB of numbers, go to one task, which needs no rounds. Beyond that labels are
    propagated with pointer jumping: each round is two equi-joins and one partial aggregation over narrow rows, so a
    vertex with very many edges is summed map-side. Lineage is cut each round. The result is the same.
    """
    pairs = edges.where("src <> dst").select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
    pairs, n = counted(pairs.distinct())
    if n <= TOGETHER:

        def together(batches):
            held = [(b["src"].to_numpy(), b["dst"].to_numpy()) for b in batches]
            if held:
                ids, label = least_labels(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))
                for at in range(0, len(ids), 100_000):
                    yield pd.DataFrame({"id": ids[at : at + 100_000], "label": label[at : at + 100_000]})

        kind = edges.schema["src"].dataType.simpleString()
        return cut(pairs.coalesce(1).mapInPandas(together, f"id {kind}, label {kind}"))
    both = settle(pairs.union(pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"))), most=2 * n)
    labels, n = counted(both.groupBy(F.col("src").alias("id")).agg(F.least(F.first("src"), F.min("dst")).alias("label")), most=2 * n)
    for _ in range(rounds):
        near = both.join(labels, both.dst == labels.id).groupBy("src").agg(F.min("label").alias("near"))
        step = labels.join(near, labels.id == near.src).select("id", F.least("label", "near").alias("mid"), F.col("label").alias("old"))
        root = labels.select(F.col("id").alias("mid"), F.col("label").alias("up"))
        new = settle(step.join(root, "mid", "left").select("id", F.least("mid", F.coalesce("up", "mid")).alias("label"), "old"), most=n)
        moved = not new.where("label <> old").isEmpty()
        labels = new.select("id", "label")
        if not moved:
            return labels
    raise RuntimeError("components did not settle")
