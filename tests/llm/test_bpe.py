"""Encoding against the library, the queue against a plain merge, and exact round trips."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from folioscope.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
OWN = bpe.Encoder(PATH, P.PATTERN)
ODD = ["", " ", "\n", "a", "don't  stop\n\n\nnow ", "été 日本語 🙂🙂 العربية", "\x1c\x1d\u0085 x", "a" * 5000, "ab" * 3000, " " * 4000, "x\ty\r\nz", "<|endoftext|>", "1234567890" * 30, "!?" * 700, " a b", "é" * 99, "\x00\x01"]


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    assert ids(OWN.encode(text)) == LIBRARY.encode_ordinary(text)
    assert OWN.decode(OWN.encode(text)) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_any_text(text):
    assert ids(OWN.encode(text)) == LIBRARY.encode_ordinary(text)


def plain_merge(piece):
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, i = min((RANKS.get(a + b, 1 << 60), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == 1 << 60:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [RANKS[x] for x in parts]


def test_queue_agrees_with_a_plain_merge():
    r = random.Random(4)
    for n in (1, 2, 24, 25, 400, 1500):
        piece = bytes(r.choice(b"aabcdee thing\xc3\xa9") for _ in range(n))
        assert bpe.merge(piece, RANKS, OWN.queue) == plain_merge(piece)


def test_queue_pops_in_order():
    r, q, want = random.Random(5), bpe.RankQueue(300_000), []
    for _ in range(3000):
        x = (r.randrange(300_000), r.randrange(50))
        q.push(*x)
        want.append(x)
    assert [q.pop() for _ in want] == sorted(want) and q.pop() is None


def test_whole_table(spark, sf_dir):
    texts = {r[0]: r[1] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: r for r in bpe.op9_byte_bpe(spark, sf_dir).collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        want = np.array(LIBRARY.encode_ordinary(t), "<u4").tobytes()
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (len(want) // 4, hashlib.sha256(want).hexdigest(), hashlib.sha256(t.encode()).hexdigest())


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, b"x"), (1, "a b", None), (None, "a b", None), (2, "", None)], "doc_id long, text string, ids binary")
    got = bpe.encode(df, PATH, P.PATTERN).collect()
    assert sorted(len(ids(bytes(r["ids"]))) for r in got) == [0, 0, 2, 2] and {bytes(r["decoded"]) for r in got} == {b"", b"a b"}
    assert bpe.encode(df.limit(0), PATH, P.PATTERN).count() == 0 and bpe.digest(df, PATH, P.PATTERN).count() == 4
