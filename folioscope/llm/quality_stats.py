"""Text statistics as Spark columns, shared by the two learned quality operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, words


def removed(text: Column, char: str) -> Column:
    """How often one character occurs."""
    return (F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))).cast("long")


def repeat_words(ws: Column, width: int = 5) -> Column:
    """Words that lie in a window of `width` words found twice or more in the text, the first one included.

    Windows are compared by 64-bit hash. Texts without a repeated window stop after one distinct; the others sort
    (hash, position) pairs once, so the cost is n log n however often a window occurs.
    """

    def of(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        positions = let(
            pairs,
            lambda s: F.sort_array(
                F.transform(
                    F.filter(s, lambda e, k: (F.get(s, k - 1)["x"] == e["x"]) | F.coalesce(F.get(s, k + 1)["x"] == e["x"], F.lit(False))),
                    lambda e: e["i"],
                )
            ),
        )
        covered = let(
            positions,
            lambda p: F.aggregate(
                F.transform(p, lambda v, k: F.least(F.lit(width), F.coalesce(F.get(p, k + 1) - v, F.lit(width)))), F.lit(0).cast("long"), lambda a, v: a + v
            ),
        )
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered)

    hashes = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - width), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))
    return F.when(F.size(ws) < width + 1, F.lit(0).cast("long")).otherwise(let(ws, lambda w: let(hashes(w), of)))


def base_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", extra: tuple = ()) -> DataFrame:
    """(id, text, ws, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) and the named extra columns."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    one = docs.select(F.col(id_col), text.alias("text"), *extra).withColumn("ws", words(F.col("text")))
    return one.select(
        id_col, "text", "ws", *extra,
        F.size("ws").cast("long").alias("n_words"),
        F.length(F.array_join("ws", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        repeat_words(F.col("ws")).alias("n_repeat_words"),
    )


def per_word(name: str) -> Column:
    return F.col(name) / F.greatest(F.col("n_words"), F.lit(1))


#: Features that both learners see; every one is a rate, so long and short texts are alike.
RATES = ("symbols", "repeats", "dup_lines", "upper", "bangs", "pipes", "distinct", "word_len", "n_words")


def rates(stats: DataFrame, id_col: str = "doc_id", keep: tuple = ()) -> DataFrame:
    """Feature columns from base_stats; its own columns but text and ws stay if named in keep."""
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    return stats.select(
        id_col, *keep,
        per_word("n_symbols").alias("symbols"),
        per_word("n_repeat_words").alias("repeats"),
        per_word("n_dup_lines").alias("dup_lines"),
        (F.regexp_count("text", F.lit("[A-Z]")) / chars).alias("upper"),
        (removed(F.col("text"), "!") / F.greatest(F.size("ws"), F.lit(1))).alias("bangs"),
        (removed(F.col("text"), "|") / F.greatest(F.size("ws"), F.lit(1))).alias("pipes"),
        (F.size(F.array_distinct("ws")) / F.greatest(F.size("ws"), F.lit(1))).alias("distinct"),
        (F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))).alias("word_len"),
        *([] if "n_words" in keep else ["n_words"]),
    )


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, bound: int, label_col: str = "quality", id_col: str = "doc_id") -> list:
    """At most `bound` labelled rows outside the held-out fold: [(label, feature, ...)].

    The rows with the smallest hash of the id are taken, so the choice does not depend on partitioning; their ids, at
    most `bound` of them, are what is broadcast, and the features of `bound` rows are what reaches the driver.
    """
    chosen = (
        labels.select(F.col(id_col), F.col(label_col).cast("int").alias("y")).where(F.col("y").isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
        .groupBy(id_col).agg(F.max("y").alias("y")).orderBy(F.xxhash64(id_col), id_col).limit(bound)
    )
    rows = rates(base_stats(docs.select(id_col, "text").join(F.broadcast(chosen), id_col), id_col, extra=("y",)), id_col, keep=("y",))
    return sorted(tuple(r) for r in rows.drop(id_col).select("y", *RATES).collect())
