"""Packing by minimum bin slack: a bitset subset-sum over the histogram of remainders fills windows."""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache
from struct import pack as pack_ids

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import MARKS, Memo
from .common import cut, shuffle_partitions, table

ODD = re.compile("[\x1c-\x1f]")


class WordEncoder:
    """Ids (little-endian unsigned 32-bit) of a lower-casing word-end BPE of the tokenizers library.

    Its pre-tokens never span white space, so chunks between white space are looked up in a cache; words that are new
    go to the library's model. Letters alone are one pre-token, so such chunks, and those with one mark after them, need
    no pattern.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.find = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+").findall
        spare = iter(range(256, 512))
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        self.visible = [chr(b) if b in plain else chr(next(spare)) for b in range(256)]
        self.words = Memo(self._word)
        self.chunks = Memo(self._chunk)
        self.tokenize = self.tok.model.tokenize

    def _word(self, word: str) -> bytes:
        shown = word if word.isascii() and word.isalpha() else "".join([self.visible[b] for b in word.encode()])
        ids = [t.id for t in self.tokenize(shown)]
        return pack_ids(f"<{len(ids)}I", *ids)

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isalpha():
            return self._word(chunk)
        if chunk[-1] in MARKS and chunk[:-1].isalpha():
            return self.chunks[chunk[:-1]] + self.words[chunk[-1]]
        return b"".join(map(self.words.__getitem__, self.find(chunk)))

    def encode(self, text: str) -> bytes:
        # The library finds its special tokens before it splits words, and its tables of letters are older than ours.
        if "<|" in text and any(s in text for s in self.special) or not text.isascii() and any(unicodedata.category(c) == "Cn" for c in set(text)):
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        plain = text if text.isascii() else unicodedata.normalize("NFC", text).replace("Σ", "σ")
        plain = plain.lower()
        if ODD.search(plain):  # white space for str.split, not for the library
            return b"".join(map(self.words.__getitem__, self.find(plain)))
        return b"".join(map(self.chunks.__getitem__, plain.split()))


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def powers(n: int) -> list[int]:
    """n as powers of two, largest first."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def plan(counts: dict[int, int], capacity: int, slack: int) -> list[tuple]:
    """Segments (length, first rank, copies in a window, first sequence, first offset) that place every piece.

    counts: pieces of each length below capacity. Each round takes the longest length left and finds, by subset-sum
    over the other lengths (a bitset, with counts split in powers of two), the multiset that leaves least slack; it is
    read back from the layers and repeated as often as the counts allow, so every round uses a length up. A longest
    length that leaves more than `slack` is put aside: its pieces are cut into powers of two, which need no padding
    (copies 0 marks those). At most one round a length: the plan is bounded by capacity, whatever the number of rows.
    """
    left, done, out, sequence = {k: v for k, v in counts.items() if v}, dict.fromkeys(counts, 0), [], 0
    while left:
        longest = max(left)
        need = capacity - longest
        reach, layers = 1, []
        full = (1 << (need + 1)) - 1
        for length in sorted((k for k in left if k <= need), reverse=True):
            rest, k = min(left[length] - (length == longest), need // length), 1
            while rest > 0:
                k = min(k, rest)
                layers.append((length, k, reach))
                reach |= (reach << (length * k)) & full
                rest, k = rest - k, k * 2
            if reach >> need & 1:
                break
        best = reach.bit_length() - 1
        if need - best > slack:
            n = left.pop(longest)
            out.append((longest, done[longest], 0, sequence, 0))
            done[longest] += n
            sequence += n * len(powers(longest))
            continue
        use, s = {longest: 1}, best
        for length, k, before in reversed(layers):
            if not before >> s & 1:
                s -= length * k
                use[length] = use.get(length, 0) + k
        times, at = min(left[k] // v for k, v in use.items()), 0
        for length, v in use.items():
            out.append((length, done[length], v, sequence, at))
            at += v * length
            done[length] += v * times
            left[length] -= v * times
            if not left[length]:
                del left[length]
        sequence += times
    return out


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """(doc_id, start, length, crc, parts, doc_tokens): whole windows and the remainder of every document; parts has
    the checksums of a remainder's cut into powers of two."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, tail = word_encoder(path), np.array([end_id], "<u4").tobytes()
        for b in batches:
            rows = []
            for doc, text in zip(b["doc_id"].tolist(), b["text"].tolist(), strict=True):
                ids = own.encode(text) + tail
                n = len(ids) // 4
                for start in range(0, n, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    length, parts, at = len(piece) // 4, [], 0
                    if length < capacity:
                        for p in powers(length):
                            parts.append(zlib.crc32(piece[4 * at : 4 * (at + p)]))
                            at += p
                    rows.append((doc, start, length, zlib.crc32(piece), parts, n))
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "crc", "parts", "doc_tokens"]).astype({"doc_id": b["doc_id"].dtype} if b["doc_id"].notna().all() else {})

    return docs.mapInPandas(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, start long, length long, crc long, parts array<long>, doc_tokens long")


def pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 1, slack: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of sequences of `capacity` ids.

    A document is its ids and then end_id; null and empty texts are end_id alone. Windows of capacity stand alone, the
    remainders are packed by plan(): each sequence has at most `slack` ids of padding, or is a power of two long and
    has none. Only the histogram of lengths, at most capacity numbers, reaches the driver. Ranks within a length come
    from salted row numbers plus summed counts, so one length may hold any share of the rows. Repeated rows and null
    ids are packed as they come; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    picked = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    salts = max(64, shuffle_partitions(spark))
    salted = token_pieces(picked, path, capacity, end_id).withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "crc"), F.lit(salts)))
    pieces = cut(salted)
    count = pieces.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = count.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    before = cut(before.withColumn("salt", F.col("salt").cast("long")))
    lengths = {r[0]: r[1] for r in pieces.groupBy("length").agg(F.count(F.lit(1))).collect()}
    whole = lengths.pop(capacity, 0)
    segments: dict[int, list] = {capacity: [(0, 1, 0, 0)]}
    for length, lo, copies, sequence, at in plan(lengths, capacity, slack):
        segments.setdefault(length, []).append((lo, copies, whole + sequence, at))
    arrays = {k: np.array(sorted(v), np.int64) for k, v in segments.items()}
    kind = docs.schema[id_col].dataType.simpleString()

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for length, g in b.groupby("length", sort=False):
                seg, rank = arrays[int(length)], g["rank"].to_numpy(np.int64)
                s = seg[np.searchsorted(seg[:, 0], rank, side="right") - 1]
                i, copies = rank - s[:, 0], s[:, 1]
                to = g[["doc_id", "start", "length", "crc", "doc_tokens"]].copy()
                n = np.maximum(copies, 1)
                to["sequence_id"], to["offset"] = s[:, 2] + i // n, s[:, 3] + (i % n) * int(length)
                out.append(to[copies > 0])
                if (copies == 0).any():
                    own, parts = to[copies == 0], g["parts"][copies == 0].tolist()
                    cuts = powers(int(length))
                    starts = np.concatenate([[0], np.cumsum(cuts)[:-1]])
                    first = s[copies == 0, 2] + i[copies == 0] * len(cuts)
                    for k, size in enumerate(cuts):
                        out.append(own.assign(start=own["start"] + int(starts[k]), length=size, crc=[p[k] for p in parts], sequence_id=first + k, offset=0))
            if out:
                yield pd.concat(out, ignore_index=True).rename(columns={"crc": "ids_crc32"})

    local = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "start", "crc"))
    ranked = pieces.withColumn("local", local).join(before, ["length", "salt"]).select("doc_id", "start", "length", "crc", "parts", "doc_tokens", (F.col("before") + F.col("local") - 1).alias("rank"))
    out = ranked.mapInPandas(place, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return out if id_col == "doc_id" else out.withColumnRenamed("doc_id", id_col)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document that is left, packed. Null and empty texts are the end id alone; null ids and
    repeated rows are packed as they come; an empty table gives no rows."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))
