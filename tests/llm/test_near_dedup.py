"""Near-dedup against all pairs, and on odd tables."""

from __future__ import annotations

import random

import numpy as np
import pytest

from brute import groups, near_components
from folioscope.llm import common, minhash
from folioscope.llm.minhash import drop_near_copies, near_dedup, op1_minhash_dedup
from folioscope.llm.shingles import shingle_set, superminhash, word_list

SCHEMA = "doc_id long, text string"


def check(df, texts):
    sets, label = near_components(texts)
    got = {r["doc_id"]: r for r in df.collect()}
    assert set(got) == set(texts)
    for i, r in got.items():
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[i]), label[i], label[i] == i), i


def test_whole_table(spark, sf_dir):
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    check(op1_minhash_dedup(spark, sf_dir), texts)


def test_chains_and_large_buckets(spark):
    """Chains of small edits, where the ends are unlike, and many variants of one text, in several families."""
    r = random.Random(1)
    texts, n = {}, 0
    for family in range(4):
        base = [f"w{family}x{r.randrange(900)}" for _ in range(160)]
        for _ in range(70):
            own = base[:]
            own[r.randrange(160)] = f"e{r.randrange(9999)}"
            texts[n], n = " ".join(own), n + 1
    for _ in range(6):
        own = [f"c{r.randrange(5000)}" for _ in range(120)]
        for _ in range(12):
            own = own[:]
            own[r.randrange(120)] = f"e{r.randrange(9999)}"
            texts[n], n = " ".join(own), n + 1
    check(near_dedup(spark.createDataFrame(list(texts.items()), SCHEMA)), texts)


def test_pairs_inside_a_template(spark):
    """Texts of one template collide without links; the few true pairs among them meet in large buckets alone."""
    r = random.Random(4)
    base, texts = [f"t{k}" for k in range(304)], {}
    for i in range(120):
        both = [f"p{i // 2}a", f"p{i // 2}b"] if i < 40 else []  # 302 of 354 shingles; the others have 300 of 356
        texts[i] = " ".join(base + both + [f"u{i}x{r.randrange(9999)}" for _ in range(28 - len(both))])
    assert len(set(near_components(texts)[1].values())) == 100
    check(near_dedup(spark.createDataFrame(list(texts.items()), SCHEMA)), texts)


def test_pairs_of_short_texts_of_one_template(spark):
    """800 texts of 24 words, 22 of them the same in all: 400 pairs share the first word too, at 19 of 21 shingles."""
    base = [f"t{k}" for k in range(22)]
    texts = {i: " ".join([f"p{i // 2}", *base, f"u{i}"]) for i in range(800)}
    check(near_dedup(spark.createDataFrame(list(texts.items()), SCHEMA)), texts)


def test_labels_are_joined_once_a_round(spark, monkeypatch):
    """Two families that stay apart in their large buckets: each join to the labels is computed once, whatever reads it,
    and gives one row for each member of a bucket."""
    r = random.Random(6)
    base, texts = [f"t{k}" for k in range(304)], {}
    for i in range(120):
        texts[i] = " ".join(base + [f"u{i}x{r.randrange(9999)}" for _ in range(28)])
    other = [f"o{k}" for k in range(160)]
    for i in range(120, 200):
        texts[i] = " ".join(other[:-1] + [f"e{i}"])
    given, made, plain = [], spark.sparkContext.accumulator(0), minhash.named

    def named(members, label):
        given.append(members.count())
        joined = plain(members, label)

        def run(batches):
            for b in batches:
                made.add(b.num_rows)
                yield b

        return joined.mapInArrow(run, joined.schema)

    monkeypatch.setattr(minhash, "named", named)
    check(near_dedup(spark.createDataFrame(list(texts.items()), SCHEMA)), texts)
    assert len(given) >= 2 and made.value == sum(given), (given, made.value)


@pytest.mark.parametrize("together", [0, 1 << 20])
def test_components_in_one_task_and_in_many(spark, monkeypatch, together):
    r = random.Random(5)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 480)] + [(7, 7)]
    want = groups({v for e in edges for v in e}, edges)
    monkeypatch.setattr(common, "TOGETHER", together)
    got = dict(map(tuple, common.components(spark.createDataFrame(edges, "src long, dst long")).collect()))
    assert got == {i: x for i, x in want.items() if any(i in e and e[0] != e[1] for e in edges)}
    words = common.components(spark.createDataFrame([("b", "c"), ("é", "b")], "src string, dst string")).collect()
    assert dict(map(tuple, words)) == {"b": "b", "c": "b", "é": "b"}


def test_odd_rows(spark):
    long = " ".join(f"v{i % 977}a{i % 31}" for i in range(60_000))
    texts = {1: None, 2: "", 3: " \n\t", 4: "one two", 5: "ONE  two", 6: "one two three four five six", 7: long, 8: long + " end", 9: "Été a b c d e", 10: "été a b c d e"}
    df = spark.createDataFrame([(i, t, i, "x") for i, t in texts.items()], "doc_id long, text string, component_id long, key string")
    check(near_dedup(df), texts)
    twice = near_dedup(df.union(df)).collect()
    assert len(twice) == 2 * len(texts) and len({tuple(r) for r in twice}) == len(texts)
    null = near_dedup(spark.createDataFrame([(None, "one two"), (4, "one two"), (None, None)], SCHEMA)).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in null if r["doc_id"]) == [(4, 4, True)]
    assert not any(r["kept"] for r in null if r["doc_id"] is None)
    assert near_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_stage_keeps_columns(spark):
    df = spark.createDataFrame([(1, "a b c d e f", "en", 3), (2, "A b c d e f", "en", 4), (3, None, None, None)], "doc_id long, text string, lang string, n_chars long")
    got = drop_near_copies(spark, df, "")
    assert got.columns == df.columns and {r[0] for r in got.collect()} == {1, 3}


@pytest.mark.parametrize("share", [0.5, 0.85])
def test_signature_estimates_similarity(share):
    r = random.Random(3)
    m, errors = 128, []
    for _ in range(20):
        n = 300
        both = int(n * 2 * share / (1 + share))
        a = [f"s{r.random()}" for _ in range(n)]
        b = a[:both] + [f"t{r.random()}" for _ in range(n - both)]
        x, y = (np.unique(np.array([hash(w) & (2**63 - 1) for w in s], np.uint64)) for s in (a, b))
        sig = superminhash([x, y], m)
        true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        errors.append((sig[0] == sig[1]).mean() - true)
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.06


def test_signature_is_independent_of_the_batch():
    sets = [shingle_set(word_list(t)) for t in ("a b c d e f g h", "", "one two", " ".join(map(str, range(5000))))]
    whole = superminhash(sets, 64)
    assert all((superminhash([s], 64)[0] == whole[i]).all() for i, s in enumerate(sets))
