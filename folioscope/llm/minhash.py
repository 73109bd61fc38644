"""MinHash near-dedup: SuperMinHash signatures, banding, verification on full sets, connected components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, counted, cut, free_name, keyed, settle, table
from .shingles import band_keys, shingle_set, superminhash, word_list

#: Buckets of up to so many classes give all their pairs; larger ones compare with hubs, then exactly (linked()).
SMALL = 32
HUBS = 2
#: A candidate pair brings two sets along, so that many fewer of them go to a task than of narrow rows.
WIDE = 20
#: Rounds with new hubs of each of the two kinds of buckets at most, before what is left is compared exactly.
ROUNDS = 3


def _key(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def signatures(docs: DataFrame, bands: int, rows: int, width: int) -> DataFrame:
    """(doc_id, key, n_shingles, bands) from (doc_id, text); key stands for the sequence of words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo in range(0, len(b), 500):
                part = b.iloc[lo : lo + 500]
                words = [word_list(t) for t in part["text"]]
                sets = [shingle_set(w, width) for w in words]
                keys = band_keys(superminhash(sets, bands * rows), bands, rows)
                yield pd.DataFrame({"doc_id": part["doc_id"].values, "key": [_key(w) for w in words], "n_shingles": [len(s) for s in sets], "bands": [k if len(s) else k[:0] for k, s in zip(keys, sets, strict=True)]})

    return docs.mapInPandas(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, key binary, n_shingles long, bands array<long>")


def full_sets(docs: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """(cls, shingles) of the classes named, from the text of each class's own document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            words = [word_list(t) for t in b["text"]]
            own = [i for i, w in enumerate(words) if _key(w) == b["key"].iloc[i]]
            yield pd.DataFrame({"cls": b["cls"].iloc[own].values, "shingles": [shingle_set(words[i], width).view(np.int64) for i in own]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.join(classes, F.col("doc_id") == F.col("cls")).select("cls", "key", "text")
    return texts.mapInPandas(run, f"cls {kind}, shingles array<long>").dropDuplicates(["cls"])


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union. b may be the hub of very many pairs: the join on it
    is a plain one of two shuffled sides, which Spark splits where it is skewed."""
    left = pairs.join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("sa")), "a")
    both = F.size(F.array_intersect("sa", "sb")).cast("long")
    union = F.size("sa") + F.size("sb") - both
    return left.join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("sb")), "b").where(100 * both >= percent * union).select("a", "b")


def rare_prefix(classes: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, int]:
    """(cls, n, left, x): of each class the elements x among which it shares one with every class at `percent` or more: a
    prefix filter, which loses nothing. Elements have one order, rarest first, so texts that share a template alone seldom
    meet. left: how many of the class's n elements are x or come after it. Elements of one set alone take their places and
    are left out. classes: (cls), each once. With the number of rows."""
    of = classes.select("cls").join(sets, "cls").select("cls", F.size("shingles").cast("long").alias("n"), F.explode("shingles").alias("x"))
    shared = of.groupBy("x").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    held = of.join(shared, "x").groupBy("cls", "n").agg(F.sort_array(F.collect_list(F.struct("df", "x"))).alias("held"))
    placed = held.select("cls", "n", F.size("held").alias("k"), F.posexplode("held").alias("at", "e")).select("cls", "n", (F.col("k") - F.col("at")).cast("long").alias("left"), F.col("e.x").alias("x"))
    return counted(placed.where(100 * F.col("left") >= percent * F.col("n")))


def rare_pairs(prefix: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes of unlike labels, among them every one at `percent` or more. Of a pair to be found, the first
    common element has the rest of both sets for the intersection, which bounds its place: (100 + percent) * left >=
    percent * (n of one + n of the other), and that is 2 * percent * n at least for the smaller set. prefix: rare_prefix()
    with the label of each class."""
    x, y = prefix.where((100 + percent) * F.col("left") >= 2 * percent * F.col("n")).alias("x"), prefix.alias("y")
    smaller = (F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.cls") < F.col("y.cls")))
    enough = (100 + percent) * F.least("x.left", "y.left") >= percent * (F.col("x.n") + F.col("y.n"))
    found = x.join(y, (F.col("x.x") == F.col("y.x")) & smaller & enough & (F.col("x.label") != F.col("y.label")))
    return found.select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b")).distinct()


def hubs(members: DataFrame, salt: int = 0) -> DataFrame:
    """(h, hubs): the HUBS classes of each bucket that collide most, one from each of as many slices by hash, with their
    labels. Maxima are partial, so no task holds a bucket. members: (h, cls, score, label)."""
    slot = F.pmod(F.xxhash64("cls", F.lit(salt)), F.lit(HUBS))
    best = [F.max(F.when(slot == k, F.struct("score", F.negative("cls").alias("low"), "label"))).alias(f"x{k}") for k in range(HUBS)]
    found = members.groupBy("h").agg(*best).select("h", F.array_compact(F.array(*[f"x{k}" for k in range(HUBS)])).alias("x"))
    return found.select("h", F.transform("x", lambda x: F.struct(F.negative(x["low"]).alias("hub"), x["label"].alias("label"))).alias("hubs"))


def hub_pairs(members: DataFrame, of: DataFrame) -> DataFrame:
    """(a, b): every class with the hubs of its buckets (hubs()) that have another label, each pair once. A member of a
    bucket gives one row at most, and of a class's buckets with the same hubs one goes on."""
    other = lambda x: x["label"] != F.col("label")
    met = members.join(of, "h").where(F.exists("hubs", other)).select("cls", F.filter("hubs", other).alias("hubs")).distinct()
    return met.select(F.col("cls").alias("a"), F.explode("hubs.hub").alias("b")).distinct()


def named(members: DataFrame, label: DataFrame) -> DataFrame:
    """members with the label of their class, which is its own where it has no link yet."""
    return members.join(label.withColumnRenamed("id", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))


def labelled(members: DataFrame, rows: int, label: DataFrame) -> DataFrame:
    """named() of up to so many rows, computed once: a round reads it several times."""
    return cut(named(members, label).coalesce(max(1, -(-rows // 100_000))))


def parted(members: DataFrame) -> DataFrame:
    """members (h, cls, score, label) of the buckets h that hold several components, with the main one: that of the class
    that collides most."""
    main = members.groupBy("h").agg(F.max_by("label", F.struct("score", F.negative("cls"))).alias("main"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("h", "main")
    return members.join(main, "h")


def linked(buckets: DataFrame, n: int, sets: DataFrame, percent: int) -> DataFrame:
    """(id, label) of classes with a link: the components of all pairs of a bucket that are confirmed on full sets.

    buckets: (h, c, cls, score), n rows, c of them with h. All pairs in buckets of up to SMALL classes; in larger ones every
    class with the hubs, then up to ROUNDS times, as long as that finds links, in buckets of several components every class
    with new hubs from outside the main one. The classes that are still apart do the same in buckets by their rare elements,
    which part families that share common ones. Each round is linear in its buckets and a hub takes in what is near it, so
    few links are left for the last step, which compares all that is still apart exactly (rare_pairs): no pair is left out.
    Labels are joined once a round, to the buckets that still hold several components.
    """
    small = buckets.where(F.col("c") <= SMALL).select("h", "cls")
    few = small.alias("x").join(small.alias("y"), "h").where("x.cls < y.cls").select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b"))
    large, n_large = counted(buckets.where(F.col("c") > SMALL).select("h", "cls", "score"), most=n)
    alone = large.withColumn("label", F.col("cls"))
    to_hub = hub_pairs(alone, hubs(alone))
    links = settle(verify(few.union(to_hub).distinct(), sets, percent))
    label = components(links.toDF("src", "dst"))
    if not n_large:
        return label

    def rounds(members: DataFrame, rows: int, links: DataFrame, label: DataFrame, salt: int) -> tuple[DataFrame, DataFrame, DataFrame, int]:
        """Links and labels after the rounds, and the members that are still parted by these, with their number."""
        for k in range(ROUNDS + 1):
            rest, left = counted(parted(labelled(members, rows, label)), most=rows)
            if not left or k == ROUNDS:
                break
            pairs = hub_pairs(rest, hubs(rest.where("label <> main"), salt + k))
            # The sets and labels of all classes are read each time, so that the number of tasks does not follow what is left.
            more, found = counted(verify(pairs, sets, percent), most=WIDE * HUBS * rows)
            if not found:
                break
            links = links.union(more)
            label = components(links.toDF("src", "dst"))
            members = rest.drop("label", "main")  # links only merge components: a bucket of one stays so
        return links, label, rest, left

    links, label, rest, n_rest = rounds(large, n_large, links, label, 1)
    if not n_rest:
        return label
    prefix, rows = rare_prefix(rest.select("cls").distinct(), sets, percent)
    members = prefix.select(F.col("x").alias("h"), "cls", F.col("left").alias("score"), "n")
    links, label, rest, n_rest = rounds(members, rows, links, label, 1 + ROUNDS)
    if not n_rest:
        return label
    # An element whose classes have one label gives no pair, so what is left of the prefixes is enough.
    left = rest.select(F.col("h").alias("x"), "cls", F.col("score").alias("left"), "n", "label")
    more, found = counted(verify(rare_pairs(left, percent), sets, percent))
    return components(links.union(more).toDF("src", "dst")) if found else label


def near_dedup(docs: DataFrame, percent: int = 85, bands: int = 21, rows: int = 6, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept.

    A document's set: its distinct `width`-word shingles after lower-casing A-Z; with fewer words the whole sequence as
    one. Texts of the same words are one class, so copies are never compared. Classes that share a band of the
    SuperMinHash signature (bands * rows slots; a link at exactly 0.85 is missed with probability 5e-5) are candidates,
    and all of them are settled on full sets (linked()), so no pair of a bucket is left out. component_id is the smallest id reachable, kept whether it is the row's own.

    Null and empty texts and texts without words have the empty set and link with nothing: their component is their
    own id. Repeated rows repeat their result; an id that has several texts links if one of them does; a null id is
    never kept and gets the component of its words. Other columns are ignored; an empty table gives no rows.
    """
    picked = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    signed = cut(signatures(picked, bands, rows, width))
    filled = signed.where("n_shingles > 0")
    classes = filled.groupBy("key").agg(F.min("doc_id").alias("cls"), F.first("bands").alias("bands")).where("cls is not null")
    banded = classes.select("cls", F.explode("bands").alias("h"))
    crowded = banded.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    buckets, n = counted(banded.join(crowded, "h").select("h", "c", "cls"))
    score = buckets.groupBy("cls").agg(F.sum("c").alias("score"))
    wanted = classes.select("cls", "key").join(score.select("cls"), "cls")
    sets = settle(full_sets(picked, wanted, width), 20_000, n)
    label = linked(buckets.join(score, "cls").select("h", "c", "cls", "score"), n, sets, percent)
    of_key = classes.select("key", "cls").join(label.withColumnRenamed("id", "cls"), "cls", "left").select("key", F.coalesce("label", "cls").alias("label"))
    out = signed.select("doc_id", "key", "n_shingles").join(of_key, "key", "left")
    out = out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("label")).otherwise(F.col("doc_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))).withColumnRenamed("doc_id", id_col)


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component of links at 0.8 or more over five words (25 bands of 5; a link at exactly 0.8 is
    missed with probability 5e-5) the smallest doc_id stays; columns are those of docs. A row without a doc_id goes only if
    another row of its component stays; rows with one come first. Null and empty texts stay. Rows that repeat a doc_id stay
    or go together. An empty table stays so."""
    key = free_name(docs, "_key")
    rows = keyed(docs, key)
    kept = near_dedup(rows.select(key, "text"), percent=80, bands=25, rows=5, id_col=key).where("kept").select(key).distinct()
    return rows.join(kept, key, "left_semi").select(docs.columns)
