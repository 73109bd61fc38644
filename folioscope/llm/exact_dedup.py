"""Exact dedup: 128-bit content hash, a stable id stays, bytes compared inside groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, cut, free_name, keyed, table

#: Members of a group that are compared with one copy of the text that stays.
SLICE = 64


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. The 128-bit hash (MD5 of the normalised text) forms the
    groups; members of groups of two or more are compared byte by byte with the row that stays, and rows whose bytes
    differ are grouped anew by hash and SHA-256, so a collision never merges two texts. Only hashes and ids are
    shuffled for grouping; sums are partial and comparisons go in slices, so one text may hold any share of the rows.

    Null texts count as empty, and all empty texts are one group. Repeated rows with the same id count as rows:
    each is returned, and group_size counts them. Rows with a null id keep a null id and never stay if the group has
    another id. Other columns of docs are ignored. An empty table gives no rows. keep is "min" or "max".
    """
    pick = {"min": F.min, "max": F.max}[keep]
    text = F.coalesce(F.col(text_col), F.lit(""))
    raw = docs.select(F.col(id_col).alias("id"), ascii_lower(text).alias("norm"))
    hashed = cut(raw.select("id", F.unhex(F.md5("norm")).alias("h"), F.sha2("norm", 256).alias("sha")))
    several = cut(hashed.groupBy("h").agg(F.count(F.lit(1)).alias("group_size"), pick("id").alias("keep_id")).where("group_size > 1"))
    odd = cut(_unlike(docs.select(F.col(id_col).alias("id"), text.alias("text")), hashed, several))
    if odd.isEmpty():  # no collision: groups are those of the hash
        out = hashed.join(several, "h", "left").select("id", F.coalesce("keep_id", "id").alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), "sha")
    else:
        sub = hashed.join(odd, ["id", "h"], "left").select("id", "h", "sha", F.when(F.col("odd"), F.col("sha")).otherwise("").alias("sub"))
        groups = cut(sub.groupBy("h", "sub").agg(F.count(F.lit(1)).alias("group_size"), pick("id").alias("keep_id")))
        out = sub.join(groups, ["h", "sub"])
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"))


def _unlike(docs: DataFrame, hashed: DataFrame, several: DataFrame) -> DataFrame:
    """(id, h, odd) of members of a group of several whose bytes differ from those of the row that stays. A large group is
    compared in slices of about SLICE members, each with its own copy of that row's text, so no task holds a group."""
    slices = F.ceil(F.col("n") / SLICE).cast("int")
    dup = hashed.join(several, "h").where("id is not null").select("id", "h", F.col("keep_id").alias("rep"), F.col("group_size").alias("n")).distinct()
    held = docs.join(dup, "id").select("id", "h", "rep", slices.alias("slices"), ascii_lower(F.col("text")).alias("norm"))
    # A repeated id can hold other texts too, of other hashes; those say nothing about this group.
    own = held.where(F.unhex(F.md5("norm")) == F.col("h"))
    rep = own.where("id = rep").dropDuplicates(["h"]).select("h", F.col("norm").alias("rep_norm"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    member = own.withColumn("slice", F.pmod(F.xxhash64("id"), F.col("slices")).cast("int"))
    return member.join(rep, ["h", "slice"]).where("norm <> rep_norm").select("id", "h", F.lit(True).alias("odd")).distinct()


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), keep="max")


OP4_SQL = """
with n as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t from documents),
g as (select t, max(doc_id) keep_id, count(*) group_size from n group by t)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256 from n join g using (t)
"""


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of equal texts the document with the smallest doc_id stays; columns are those of docs. A row
    without a doc_id goes only if a row with one, or another without, stays for its text. Null and empty texts are one
    text. Of rows that repeat a doc_id and its text one stays (the first by its columns as JSON). An empty table stays so."""
    key, place = free_name(docs, "_key"), free_name(docs, "_place")
    rows = keyed(docs, key)
    kept = exact_dedup(rows.select(key, "text"), id_col=key, keep="min").where("kept").select(key, "text_sha256")
    if rows.groupBy(key).count().where("count > 1").isEmpty():
        return rows.join(kept.select(key), key, "left_semi").select(docs.columns)
    sha = free_name(docs, "_sha")
    own = rows.withColumn(sha, F.sha2(ascii_lower(F.coalesce("text", F.lit(""))), 256))
    stay = own.join(kept.distinct().withColumnRenamed("text_sha256", sha), [key, sha], "left_semi")
    first = Window.partitionBy(key, sha).orderBy(F.to_json(F.struct(*docs.columns)))
    return stay.withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).select(docs.columns)
