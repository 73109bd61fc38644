"""Links between records: parents and children, neighbours, orphans, context, first occurrences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def child_lists(children: DataFrame, parent: str, child: str) -> DataFrame:
    """Per parent the sorted ids of its children as one string, and their number."""
    return children.groupBy(parent).agg(F.array_join(F.array_sort(F.collect_list(F.col(child).cast("bigint"))), ",").alias("children"), F.count(F.lit(1)).alias("n_children"))


def orphans(children: DataFrame, parents: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Children whose parent does not exist; a null parent is no orphan."""
    return children.where(F.col(key).isNotNull()).join(parents.select(F.col(parent_key).alias(key)), key, "left_anti")


def bad_parents(children: DataFrame, parents: DataFrame, key: str, parent_key: str, wrong: Column) -> DataFrame:
    """Children whose parent exists and meets the condition `wrong`, over the parents' columns."""
    return children.join(parents.where(wrong).select(F.col(parent_key).alias(key)), key, "left_semi")


def neighbours(rows: DataFrame, key: str, order: str, summary: Column) -> DataFrame:
    """previous_summary and next_summary within key; an empty summary counts as none."""
    w = Window.partitionBy(key).orderBy(order)
    own = F.nullif(summary, F.lit(""))
    return rows.withColumn("previous_summary", F.lag(own).over(w)).withColumn("next_summary", F.lead(own).over(w))


def expand_context(seeds: DataFrame, rows: DataFrame, key: str, order: str, reach: int) -> DataFrame:
    """Rows within `reach` places of a seed of the same key, once each, with the distance to the nearest seed."""
    s = seeds.select(F.col(key).alias("_k"), F.explode(F.sequence(F.col(order) - reach, F.col(order) + reach)).alias("_o"), F.col(order).alias("_s"))
    near = s.groupBy("_k", "_o").agg(F.min(F.abs(F.col("_o") - F.col("_s"))).alias("distance"))
    return rows.join(near, (F.col(key) == F.col("_k")) & (F.col(order) == F.col("_o"))).drop("_k", "_o")


def earliest(rows: DataFrame, tag: str, time: str, item: str) -> DataFrame:
    """Per tag the item of the smallest (time, item), and how many items have the tag."""
    return rows.groupBy(tag).agg(F.min(F.struct(time, item)).alias("x"), F.count_distinct(item).alias("n_items")).select(tag, F.col(f"x.{item}").alias("first_item"), F.col(f"x.{time}").alias("first_seen"), "n_items")


def recurrence(rows: DataFrame, item: str, year: str, key: str) -> DataFrame:
    """Years an item appears in: first, last, how many, which, and its number of distinct sources."""
    return rows.groupBy(item).agg(
        F.min(year).alias("first_seen_year"), F.max(year).alias("last_seen_year"), F.count_distinct(year).alias("n_years"),
        F.array_join(F.array_sort(F.collect_set(F.col(year).cast("string"))), ",").alias("year_list"), F.count_distinct(key).alias("n_sources"),
    )


def scorecard(scores: DataFrame, id_: str, weights: dict[str, float], gates: dict[str, float], accept: float = 4.2, revise: float = 3.0) -> DataFrame:
    """Weighted score out of the dimension columns; ACCEPT needs the score and every gate."""
    total = sum((F.col(k) * w for k, w in weights.items()), F.lit(0.0)) / sum(weights.values())
    passed = F.lit(True)
    for k, least in gates.items():
        passed = passed & (F.col(k) >= least)
    return scores.select(id_, F.round(total, 6).alias("score"), F.when((total >= accept) & passed, "ACCEPT").when(total >= revise, "REVISE").otherwise("REJECT").alias("decision"))


def same_topic(seeds: DataFrame, rows: DataFrame, key: str, topic: str, year: str, reach: int = 1) -> DataFrame:
    """(seed, key, distance) of rows of a seed's topic within `reach` years of it, itself left out. The seed's years are
    spelled out, so the join is on topic and year."""
    s = seeds.select(F.col(key).alias("seed"), F.col(topic).alias("_t"), F.col(year).alias("_y"), F.explode(F.sequence(F.col(year) - reach, F.col(year) + reach)).alias("_o"))
    near = rows.join(s, (F.col(topic) == F.col("_t")) & (F.col(year) == F.col("_o")) & (F.col(key) != F.col("seed")))
    return near.select("seed", key, F.abs(F.col("_o") - F.col("_y")).alias("distance"))
