"""Byte-level BPE by a hierarchical-bitmap rank queue, with exact decoding."""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from struct import pack as pack_ids

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Entries of a generation of each of a worker's caches.
CACHE = 250_000
RUN = re.compile(r"\s\s")
#: ASCII characters that are no letters, digits or white space.
MARKS = frozenset("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
#: What a pattern has that takes a run of letters, with a space before or without, as one pre-token.
LETTERS = r" ?\p{L}+"


class RankQueue:
    """Pops the smallest (rank, position). Buckets per rank hold positions; words of 256 bits show which buckets have any,
    a word above them which of them have a bit, and find-first-set on either level leads to the lowest. push() and pop()
    say what it does; merge() has them in line, as a call costs as much as they do."""

    def __init__(self, ranks: int) -> None:
        self.words = [0] * ((ranks >> 8) + 1)
        self.bit = [1 << k for k in range(max(256, len(self.words)))]
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            heapq.heappush(bucket, position)
            return
        self.buckets[rank] = [position]
        w = rank >> 8
        self.top |= self.bit[w]
        self.words[w] |= self.bit[rank & 255]

    def pop(self) -> tuple[int, int] | None:
        if not self.top:
            return None
        w = (self.top & -self.top).bit_length() - 1
        bits = self.words[w]
        rank = (w << 8) + (bits & -bits).bit_length() - 1
        bucket = self.buckets[rank]
        if len(bucket) > 1:
            return rank, heapq.heappop(bucket)
        del self.buckets[rank]
        self.words[w] = bits = bits & (bits - 1)
        if not bits:
            self.top ^= self.bit[w]
        return rank, bucket[0]


def merge(piece: bytes, ranks: dict[bytes, int], queue: RankQueue) -> list[int]:
    """Ids of one pre-token: again and again the pair of lowest rank, leftmost first, becomes one token.

    Tokens are a linked list over byte positions. An entry of the queue is stale when its left token is gone or the
    pair at its place has another rank by now; such entries are skipped. The queue is empty before and after.
    """
    get = ranks.get
    whole = get(piece)
    if whole is not None:
        return [whole]
    n, words, buckets, top, bit, heappush, heappop = len(piece), queue.words, queue.buckets, 0, queue.bit, heapq.heappush, heapq.heappop
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the token that starts here
    pair = [get(piece[i : i + 2], -1) for i in range(n - 1)]
    pair.append(-1)
    for i, r in enumerate(pair):
        if r >= 0:
            if r in buckets:
                buckets[r].append(i)  # positions come in order, so the list is a heap
            else:
                buckets[r] = [i]
                w = r >> 8
                top |= bit[w]
                words[w] |= bit[r & 255]
    while top:
        w = (top & -top).bit_length() - 1
        bits = words[w]
        low = bits & -bits
        rank = (w << 8) + low.bit_length() - 1
        bucket = buckets[rank]
        if len(bucket) > 1:
            i = heappop(bucket)
        else:
            i = bucket[0]
            del buckets[rank]
            words[w] = bits = bits ^ low
            if not bits:
                top ^= bit[w]
        if pair[i] != rank:
            continue
        j = end[i]
        pair[j] = -1
        end[i] = k = end[j]
        h, new, old = before[i], -1, -1
        if k < n:
            before[k] = i
            new = get(piece[i : end[k]], -1)
        pair[i] = new
        if h >= 0:
            old = get(piece[h:k], -1)
            if old == pair[h]:
                old = -1
            else:
                pair[h] = old
        for r, at in ((new, i), (old, h)):
            if r >= 0:
                if r in buckets:
                    heappush(buckets[r], at)
                else:
                    buckets[r] = [at]
                    w = r >> 8
                    top |= bit[w]
                    words[w] |= bit[r & 255]
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Memo(dict):
    """Cache in two generations: what was used since the last change survives the next."""

    def __init__(self, make) -> None:
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= 64:
            if len(self) >= CACHE:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers, and back."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        size = max(self.ranks.values()) + 1
        self.queue = RankQueue(size)
        self.tokens: list[bytes] = [b""] * size
        for t, r in self.ranks.items():
            self.tokens[r] = t
        # The library's \s is the property White_Space; that of the module regex has four control characters more.
        self.find = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        # What stands before the run of letters can't take letters or a space where all of it begins with an apostrophe.
        self.letters = LETTERS in pattern and all(x.startswith("'") for x in pattern.split(LETTERS)[0].split("|") if x)
        self.pieces = Memo(self._piece)
        self.first = Memo(lambda chunk: self._chunk(chunk, "", self.first))
        self.later = Memo(lambda chunk: self._chunk(chunk, " ", self.later))
        self.line = self.pieces["\n"]

    def _piece(self, piece: str) -> bytes:
        raw = piece.encode("utf-8")
        ids = merge(raw, self.ranks, self.queue)
        return pack_ids(f"<{len(ids)}I", *ids)

    def _chunk(self, chunk: str, lead: str, cache: Memo) -> bytes:
        """Ids of what lies between white space: letters, or letters and one mark, need no pattern."""
        if self.letters:
            if chunk.isalpha():
                return self._piece(lead + chunk)
            if chunk[-1:] in MARKS and chunk[:-1].isalpha():
                return cache[chunk[:-1]] + self.first[chunk[-1]]
        return b"".join(map(self.pieces.__getitem__, self.find(lead + chunk)))

    def encode(self, text: str) -> bytes:
        """A lone space between other characters always begins a pre-token and a lone line feed always is one, so
        texts without runs of white space are looked up word by word; others go through the pattern whole."""
        if not text or text[0].isspace() or text[-1].isspace() or RUN.search(text):
            return b"".join(map(self.pieces.__getitem__, self.find(text)))
        out, later = [], self.later.__getitem__
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            out.append(self.first[first] + b"".join(map(later, rest)))
        return self.line.join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ids (binary, little-endian unsigned 32-bit) and decoded (binary). Null texts count as empty and
    give no ids; rows are independent, so there is no shuffle, and repeated rows or null ids need nothing special."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = encoder(path, pattern)
        for b in batches:
            ids = [own.encode(t) for t in b["text"]]
            yield pd.DataFrame({"id": b["id"], "ids": ids, "decoded": [own.decode(x) for x in ids]})

    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return picked.mapInPandas(run, f"id {kind}, ids binary, decoded binary").withColumnRenamed("id", id_col)


def digest(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """encode() reduced to counts and hashes before it leaves the worker."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = encoder(path, pattern)
        for b in batches:
            rows = []
            for t in b["text"]:
                ids = own.encode(t)
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(own.decode(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"]).assign(id=b["id"].values)[["id", "n_tokens", "ids_sha256", "decoded_sha256"]]

    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return picked.mapInPandas(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
