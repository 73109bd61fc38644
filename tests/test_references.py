"""Queries without SQL against plain restatements of their rules."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from folioscope.operators import segment as S
from folioscope.plans.catalogue import QUERIES

SPACE = re.compile(r"\s+")
CLOSED = tuple(".?!:\"')")


def header_like(x):
    words = x.split()
    return bool(x) and len(x) <= 80 and 2 <= len(words) <= 5 and x[-1] not in ".,;:?!" and sum(w[0].isupper() for w in words) >= 0.7 * len(words)


def heal(lines):
    out = []
    for i, line in enumerate(lines):
        if S.BREAK in line:
            before = next((x.strip() for x in reversed(out) if x.strip()), "")
            after = next((x.strip() for x in lines[i + 1 :] if x.strip() and S.BREAK not in x), "")
            first = (after.split() or [""])[0].lower()
            if (not before.endswith(CLOSED) or after[:1].islower() or first in S.CONTINUES) and not header_like(after):
                while out and not out[-1].strip():
                    out.pop()
                continue
        out.append(line)
    return out


def join(lines):
    done, cur, gap = [], [], False
    for line in lines:
        x = line.strip()
        if not x:
            if cur and cur[-1].endswith(CLOSED):
                done.append(" ".join(cur))
                cur, gap = [], False
            elif cur:
                gap = True
            continue
        goes_on = x.split()[0].lower() in S.JOINS or x[0].islower()
        if cur and gap and not goes_on:
            done.append(" ".join(cur))
            cur = [x]
        elif cur and not cur[-1].endswith(CLOSED):
            cur[-1] += " " + x
        else:
            cur.append(x)
        gap = False
    return done + [" ".join(cur)] * bool(cur)


def fixture():
    r = random.Random(2)
    words = ["We", "bought", "mills", "and", "the", "Net", "Worth", "of", "it.", "Then?", "It", "grew,", "Sources", "\"so\"", "for"]
    texts = []
    for _ in range(120):
        lines = []
        for _ in range(r.randint(1, 14)):
            lines.append(r.choice(["", " ", S.BREAK, " ".join(r.choice(words) for _ in range(r.randint(1, 6)))]))
        texts.append(lines)
    return texts


def test_page_breaks_and_sentences(spark):
    texts = fixture()
    df = spark.createDataFrame(list(enumerate(texts)), "i long, lines array<string>")
    got = df.select("i", S.heal_page_breaks(F.col("lines")).alias("h"), S.join_sentences(F.col("lines")).alias("j")).collect()
    for row in got:
        assert row["h"] == heal(texts[row["i"]]), texts[row["i"]]
        assert row["j"] == join(texts[row["i"]]), texts[row["i"]]


def test_sentences_of_the_table(spark, sf_dir):
    texts = {r["doc_id"]: re.sub("\r\n?", "\n", r["text"] or "").split("\n") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {}
    for r in QUERIES["sentence_safe_join"](spark, sf_dir).collect():
        got.setdefault(r["doc_id"], []).append((r["para_no"], r["paragraph"]))
    assert got == {i: list(enumerate(p)) for i, t in texts.items() if (p := join(t))}


def test_headers_of_the_table(spark, sf_dir):
    """Every header that is found obeys each rule, and titles on lines of their own are found."""
    texts = {r["doc_id"]: [x.strip() for x in re.sub("\r\n?", "\n", r["text"] or "").split("\n")] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["section_headers"](spark, sf_dir).collect():
        lines, i = texts[r["doc_id"]], r["idx"]
        x, words = lines[i], lines[i].split()
        near = [lines[k] if 0 <= k < len(lines) else "" for k in (i - 1, i + 1)]
        assert 3 <= len(x) <= 80 and 2 <= len(words) <= 7 and not x[0].islower() and not x.endswith(",")
        assert not near[0] or not near[1] or near[0].endswith((".", ":")) or S.BREAK in near[0]
    rows = [(1, i, line) for i, line in enumerate(["Some prose that ends.", "", "Insurance Operations", "", "We did well.", "Textile Mills", "and more", "Sources of Reported Funds", ""])]
    df = spark.createDataFrame(rows, "doc_id long, idx int, line string")
    assert [r["line"] for r in S.section_headers(df).where("is_header").orderBy("idx").collect()] == ["Insurance Operations", "Textile Mills", "Sources of Reported Funds"]


def test_clusters_are_those_of_the_nearest_centre(spark, sf_dir):
    vectors = {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    of = {r["vec_id"]: r["cluster"] for r in QUERIES["kmeans_clusters"](spark, sf_dir).collect()}
    assert set(of) == set(vectors)
    centre = {c: np.mean([vectors[i] for i in of if of[i] == c], axis=0) for c in set(of.values())}
    near = sum(min(centre, key=lambda c: ((vectors[i] - centre[c]) ** 2).sum()) == of[i] for i in of)
    assert near >= 0.95 * len(of)  # the centres of the last step but one are what rows were dealt by


@pytest.mark.parametrize("missing", ["folioscope.llm.queries", "corpus_pipeline"])
def test_entry_without_optional_parts(monkeypatch, missing):
    import importlib

    real = importlib.import_module

    def broken(name, *more):
        if name == missing:
            raise ImportError(name)
        return real(name, *more)

    monkeypatch.setattr(__spark_entry__.importlib, "import_module", broken)
    names = set(__spark_entry__.queries())
    assert set(QUERIES) <= names and "pipeline" not in names and set(__spark_entry__.oracle_sql()) <= names
