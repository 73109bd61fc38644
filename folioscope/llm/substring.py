"""Substring dedup: MinHash banding of paragraphs, verification, and removal by components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import counted, settle, table, written
from .minhash import linked
from .shingles import HASHES, ODD, mix, windows, word_list

#: A word begins a paragraph where the hash of it and the word before is the lowest among so many on either side.
REACH = 6
#: Words that a paragraph has at most.
LONGEST = 64
TOP = np.uint64(2**64 - 1)


#: Words that are described at once, if no text is longer.
WORDS = 1 << 18
#: Slots of a task's memory of the keys that it has met.
SLOTS = 1 << 18


def cuts(h: np.ndarray, lens: np.ndarray, reach: int = REACH, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """First words and sizes of the paragraphs of texts whose words' hashes stand one after another in h (lens: words of
    each text). Cut where the content says, so that a passage is cut alike wherever it stands: at strict local minima of
    the hashes of word pairs, and every `longest` words where there are none."""
    total, ends = len(h), np.cumsum(lens)
    if not total:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(lens)), lens)
    place = np.arange(total) - np.repeat(ends - lens, lens)
    inside = np.flatnonzero(text[1:] == text[:-1])  # pairs of words of one text; `reach` high values part the texts
    g = mix(h[:-1] * ODD[3] + h[1:])[inside]
    at = inside + reach * (text[inside] + 1)
    low, k = np.full(total + reach * (len(lens) + 2), TOP), 1
    low[at] = g
    while k < reach:  # low[i] becomes the least of `reach` values from i on, by doubling
        step = min(k, reach - k)
        low = np.minimum(low[:-step], low[step:])
        k += step
    first, n = inside + 1, lens[text[inside]]
    own = place[first]
    keep = (g < low[at - reach]) & (g < low[at + 1]) & (own >= reach) & (own <= n - reach) & (n >= 2 * reach + 2)
    starts = np.sort(np.concatenate([(ends - lens)[lens > 0], first[keep]]))
    sizes = np.diff(np.append(starts, total))
    if (parts := -(-sizes // longest)).max() > 1:
        step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        starts, whole = np.repeat(starts, parts) + step * longest, np.repeat(sizes, parts) - step * longest
        sizes = np.minimum(whole, longest)
    return starts.astype(np.int64), sizes.astype(np.int64)


def paragraphs(h: np.ndarray, reach: int = REACH, longest: int = LONGEST) -> np.ndarray:
    """First words of one text's paragraphs."""
    return cuts(h, np.array([len(h)]), reach, longest)[0]


def word_blocks(texts: list[str], most: int = WORDS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end, word hashes, words of each text) of runs of texts with about `most` words; every text is whole."""
    lo, n, held, lens = 0, 0, [], []
    for i, text in enumerate(texts):
        words = word_list(text)
        held.append(words)
        lens.append(len(words))
        n += len(words)
        if n >= most or i + 1 == len(texts):
            yield lo, i + 1, np.fromiter(map(HASHES.__getitem__, chain.from_iterable(held)), np.uint64, n), np.array(lens, np.int64)
            lo, n, held, lens = i + 1, 0, [], []


def text_windows(h: np.ndarray, lens: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the window that starts at each word, and for each text the first word at which none does. A text with fewer
    words than a window is one window."""
    out, ends = np.zeros(len(h), np.uint64), np.cumsum(lens)
    if len(h) >= width:
        out[: len(h) - width + 1] = windows(h, width)  # those that reach into the next text are never looked at
    for i in np.flatnonzero((lens > 0) & (lens < width)):
        lo = ends[i] - lens[i]
        out[lo] = windows(h[lo : ends[i]], width)[0]
    return out, ends - np.minimum(lens, width) + (lens > 0)


def contents(h: np.ndarray, lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Hash of the words lo .. lo + n - 1, for each pair."""
    at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
    place = at - np.repeat(lo, n)
    sums = np.add.reduceat(mix(h[at] + place.astype(np.uint64) * ODD[4]), np.cumsum(n) - n)
    return mix(sums + n.astype(np.uint64)).view(np.int64)


def shingle_bounds(starts: np.ndarray, sizes: np.ndarray, none: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end of the windows of paragraphs; none: for each paragraph its text's first word without a window. A short
    paragraph is told by one window."""
    lo = np.minimum(starts, none - 1)
    return lo, np.minimum(np.maximum(starts + sizes - width + 1, lo + 1), none)


class Met:
    """A task's memory of keys: for each the first class and document and how much of it has been handed on (0 one
    document, 1 several, 3 several classes too). A fixed number of slots; a key that loses its slot is new again, which
    costs a row and changes no result."""

    def __init__(self, slots: int = SLOTS) -> None:
        self.key, self.cls, self.doc, self.told = np.zeros(slots, np.int64), np.zeros(slots, np.int64), np.zeros(slots, np.int64), np.full(slots, -1, np.int8)

    def take(self, key: np.ndarray, cls: np.ndarray, doc: np.ndarray, multi: np.ndarray, mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of a batch's distinct keys with the class and document of their first row, and whether it has several documents
        and classes: what is known by now, and whether that has to be handed on."""
        slot = (key.view(np.uint64) % np.uint64(len(self.key))).astype(np.int64)
        told = self.told[slot]
        old = (self.key[slot] == key) & (told >= 0)
        multi = multi | old & ((self.doc[slot] != doc) | (told > 0))
        mixed = mixed | old & ((self.cls[slot] != cls) | (told > 1))
        now = np.where(multi, 1 + 2 * mixed, 0).astype(np.int8)
        new = ~old | (now > told)
        fresh = slot[~old]
        self.key[fresh], self.cls[fresh], self.doc[fresh] = key[~old], cls[~old], doc[~old]
        self.told[slot] = now
        self.told[slot[self.key[slot] != key]] = -1  # two keys of the batch for one slot: neither is remembered
        return now, new


def banded(docs: DataFrame, bands: int, width: int) -> DataFrame:
    """(doc_id, span, cls, key, part, known): one row per paragraph and band; span is 128 * first word + words.

    Pre-aggregated by batch and by task: of a key only the first row, the first after it is met in a second document, and
    the first after it is met with a second class have the key as part and meet other tasks; the rest have a part of their
    own. So no key gathers more rows than a few for each task, whatever its share of the table. known: 0 where the task
    has met the key in one document, else 1, or 3 where its classes differ too.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        met = Met()
        for b in batches:
            ids, texts = b["doc_id"], b["text"].tolist()
            code = pd.util.hash_array(ids.values).view(np.int64)
            for at, end, h, lens in word_blocks(texts):
                starts, sizes = cuts(h, lens)
                if not len(starts):
                    continue
                text = np.searchsorted(np.cumsum(lens), starts, side="right")
                content = contents(h, starts, sizes)
                w, none = text_windows(h, lens, width)
                bounds = np.stack(shingle_bounds(starts, sizes, none[text], width), 1).reshape(-1)
                keys = np.empty((len(starts), bands), np.uint64)
                for k in range(bands):
                    keys[:, k] = mix(np.minimum.reduceat(np.append(mix(w ^ ODD[k]), TOP), bounds)[::2] + np.uint64(k))
                span = (starts - (np.cumsum(lens) - lens)[text]) * 128 + sizes
                key = keys.reshape(-1).view(np.int64)
                order = np.argsort(key, kind="stable")
                key, row = key[order], order // bands
                cls, doc, span, own_row = content[row], code[at + text[row]], span[row], at + text[row]
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                length = np.diff(np.append(first, len(key)))
                multi = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
                mixed = np.minimum.reduceat(cls, first) != np.maximum.reduceat(cls, first)
                known, new = met.take(key[first], cls[first], doc[first], multi, mixed)
                known, alone = np.repeat(known, length), np.ones(len(key), bool)
                alone[first[new]] = False
                # Until a second document is met every row has to be found by its key.
                alone &= known > 0
                own = mix(cls.view(np.uint64) + own_row.astype(np.uint64) * ODD[1] + span.astype(np.uint64) * ODD[2]).view(np.int64)
                yield pd.DataFrame({"doc_id": ids.values[own_row], "span": span, "cls": cls, "key": key, "part": np.where(alone, own, key), "known": known.astype(np.int8)})

    return docs.mapInPandas(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, span long, cls long, key long, part long, known byte")


def class_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(cls, shingles) of the classes wanted (doc_id, span, cls), from the texts of the documents that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans, classes = b.column("spans"), b.column("classes")
            bounds = spans.offsets.to_numpy()
            span_of, class_of = spans.values.to_numpy(), classes.values.to_numpy()
            for at, end, h, lens in word_blocks(b.column("text").to_pylist()):
                lo, hi = bounds[at], bounds[end]
                span, cls = span_of[lo:hi], class_of[lo:hi]
                text = np.searchsorted(bounds[at + 1 : end + 1] - lo, np.arange(hi - lo), side="right")
                # Rows that repeat an id may hold another text, where a span is not what it was.
                ok = (span >> 7) + (span & 127) <= lens[text]
                span, cls, text = span[ok], cls[ok], text[ok]
                if not len(span):
                    continue
                start, size = (np.cumsum(lens) - lens)[text] + (span >> 7), span & 127
                same = contents(h, start, size) == cls
                start, size, cls, text = start[same], size[same], cls[same], text[same]
                if not len(cls):
                    continue
                w, none = text_windows(h, lens, width)
                first, last = shingle_bounds(start, size, none[text], width)
                n = last - first
                owner = np.repeat(np.arange(len(n)), n)
                x = w[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())]
                order = np.lexsort((x, owner))
                x, owner = x[order], owner[order]
                distinct = np.concatenate([[True], (x[1:] != x[:-1]) | (owner[1:] != owner[:-1])])
                x, owner = x[distinct], owner[distinct]
                offsets = np.searchsorted(owner, np.arange(len(cls) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.view(np.int64)))], ["cls", "shingles"])

    of = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("span", "cls")).alias("x")).select("doc_id", F.col("x.span").alias("spans"), F.col("x.cls").alias("classes"))
    return docs.join(of, "doc_id").select("text", "spans", "classes").mapInArrow(run, "cls long, shingles array<long>").dropDuplicates(["cls"])


def live_paragraphs(docs: DataFrame, bands: int, width: int) -> DataFrame:
    """(doc_id, span, cls, key, mixed): one row per paragraph and band whose key several documents have; mixed: whether
    they have it with several classes."""
    group = Window.partitionBy("part")
    live = (F.max("known").over(group) > 0) | (F.min("doc_id").over(group) != F.max("doc_id").over(group))
    mixed = (F.col("known") > 1) | (F.min("cls").over(group) != F.max("cls").over(group))
    rows = banded(docs, bands, width).select("doc_id", "span", "cls", "key", live.alias("live"), mixed.alias("mixed"))
    return written(rows.where("live").drop("live"), "paragraphs")


def repeated_spans(docs: DataFrame, percent: int = 80, bands: int = 3, width: int = 5, least: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans to remove: (doc_id, start, n_words, first_doc_id, component_id), in words of the lower-cased text from 0.

    Paragraphs are cut by content (paragraphs()), as line breaks don't bound repeated passages. Each has `bands` bands
    of one min-hash over its `width`-word shingles; paragraphs at a Jaccard similarity of 0.8 share one with
    probability 0.992, equal ones always. Keys of a single document are dropped before anything is joined. Classes of
    equal paragraphs that collide are verified on their shingle sets (100 * intersection >= percent * union) and
    linked, all that share a key (minhash.linked()). Of each component the first occurrence (smallest doc_id) stays and those in other documents go. Runs of
    neighbouring paragraphs that go are one span; spans below `least` words are left alone. Repeats within one
    document only are not touched.

    Null and empty texts and null ids have no paragraphs. Rows that repeat an id are one document. Other columns are
    ignored; an empty table gives no rows.
    """
    picked = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where("doc_id is not null")
    found = live_paragraphs(picked, bands, width)
    mixed = found.where("mixed").groupBy("key", "cls").agg(F.min(F.struct("doc_id", "span")).alias("at"))
    members, n = counted(mixed.join(mixed.groupBy("key").agg(F.count(F.lit(1)).alias("c")), "key"))
    wanted = members.groupBy("cls").agg(F.min("at").alias("at")).select("at.doc_id", "at.span", "cls")
    sets = settle(class_sets(picked, wanted, width), 50_000, n)
    label = linked(members.select(F.col("key").alias("h"), "c", "cls", F.lit(1).alias("score")), n, sets, percent)
    once = found.select("doc_id", "span", "cls").distinct()
    grouped = once.join(label.withColumnRenamed("id", "cls"), "cls", "left").select("doc_id", "span", F.coalesce("label", "cls").alias("component_id"))
    first = grouped.groupBy("component_id").agg(F.min("doc_id").alias("first_doc_id"))
    gone = grouped.join(first, "component_id").where("doc_id <> first_doc_id")
    gone = gone.withColumn("start", F.shiftright("span", 7)).withColumn("end", F.col("start") + F.col("span").bitwiseAND(127))
    within = Window.partitionBy("doc_id").orderBy("start", "end")
    before = F.max("end").over(within.rowsBetween(Window.unboundedPreceding, -1))
    run = gone.withColumn("new", F.coalesce(F.col("start") > before, F.lit(True)).cast("int")).withColumn("run", F.sum("new").over(within))
    spans = run.groupBy("doc_id", "run").agg(
        F.min("start").alias("start"), (F.max("end") - F.min("start")).alias("n_words"), F.min("first_doc_id").alias("first_doc_id"), F.min("component_id").alias("component_id")
    )
    return spans.where(F.col("n_words") >= least).drop("run").withColumnRenamed("doc_id", id_col)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(table(spark, sf_dir, "documents"))
