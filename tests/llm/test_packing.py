"""Packing: ids against the library, every id in one piece, little padding; the plan on its own."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from folioscope.llm import packing as K

PATH = P.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = K.WordEncoder(PATH)


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["", " ", "Don't STOP", "İstanbul ΣΑΣ ς straße", "é ﬁ ½", "a\x1cb\u0085c d e", "<|endoftext|> a <|x|>", "日本語 🙂👩‍👧", "x" * 3000, "​A‍", "12345 a1b2", "I'M we'LL", "\x00\x7f a", "ǅ Ω Å", ":\U0003d000 \U00010940a"])
def test_odd_texts(text):
    assert np.frombuffer(OWN.encode(text), "<u4").tolist() == library(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    assert np.frombuffer(OWN.encode(text), "<u4").tolist() == library(text)


def check(rows, texts, capacity=2048, slack=20):
    """texts: list of (doc_id, text) with distinct ids."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == {i for i, _ in texts}
    for i, text in texts:
        own, at = [*library(text or ""), 1], 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            part = np.array(own[at : at + r["length"]], "<u4").tobytes()
            assert (r["start"], len(part) // 4, r["ids_crc32"], r["doc_tokens"]) == (at, r["length"], zlib.crc32(part), len(own)), i
            at += r["length"]
        assert at == len(own)
    padding = 0
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= capacity
        if at & (at - 1):
            padding += capacity - at
            assert capacity - at <= slack
    return padding, len(sequences)


def test_whole_table(spark, sf_dir):
    texts = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check(K.op10_packing(spark, sf_dir).collect(), texts)


def test_odd_rows(spark):
    texts = [(1, None), (2, ""), (3, "word " * 2047), (4, "word " * 2048), (5, "word " * 9000), *[(i, "same text here") for i in range(10, 1500)]]
    df = spark.createDataFrame([(i, t, 7, "s") for i, t in texts], "doc_id long, text string, length int, salt string")
    check(K.pack(df, PATH).collect(), texts)
    assert K.pack(df.limit(0), PATH).count() == 0
    got = K.pack(spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], "doc_id long, text string"), PATH).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == len(got) and sum(r["length"] for r in got) == 9


def placed(counts, capacity, slack):
    used, starts = Counter(), defaultdict(list)
    segments = defaultdict(list)
    for length, lo, copies, sequence, at in K.plan(counts, capacity, slack):
        segments[length].append((lo, copies, sequence, at))
    for length, n in counts.items():
        for rank in range(n):
            lo, copies, sequence, at = max(s for s in segments[length] if s[0] <= rank)
            if copies:
                starts[sequence + (rank - lo) // copies].append((at + (rank - lo) % copies * length, length))
            used[length] += 1
    return starts


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 63), st.integers(1, 30), max_size=25))
def test_plan_fills_windows(counts):
    starts = placed(counts, 64, 2)
    for s in starts.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert 62 <= at <= 64 or not at & (at - 1)


def test_plan_does_not_grow_with_rows():
    r = random.Random(6)
    counts = {k: r.randrange(1, 10**9) for k in range(1, 2048)}
    assert len(K.plan(counts, 2048, 20)) < 60_000
