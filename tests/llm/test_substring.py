"""Repeated passages: planted ones are found, clean documents stay, spans hold what they say."""

from __future__ import annotations

import random

import numpy as np

from brute import lower, shingles, words
from folioscope.llm.common import components
from folioscope.llm.shingles import word_hashes
from folioscope.llm.substring import Met, op2_substring_dedup, paragraphs, repeated_spans

SCHEMA = "doc_id long, text string"


def prose(r, n, tag):
    return [f"{tag}{r.randrange(10**6)}" for _ in range(n)]


def test_planted_passages(spark):
    r = random.Random(1)
    passage, edited = prose(r, 120, "p"), prose(r, 150, "q")
    rows, plain = [], set()
    for i in range(60):
        own = prose(r, 150, f"d{i}x")
        if i % 3 == 0:
            at = r.randrange(150)
            own[at:at] = passage
        elif i % 3 == 1:
            other = edited[:]
            other[75] = f"e{i}"
            own += other
        else:
            plain.add(i)
        rows.append((i, " ".join(own) if i % 2 else "\n\n".join(own)))
    spans = repeated_spans(spark.createDataFrame(rows, SCHEMA)).collect()
    text, first = {i: words(lower(t)) for i, t in rows}, {0: passage, 1: edited}
    assert {s["doc_id"] for s in spans} == {i for i in range(60) if i % 3 < 2} - {0, 1}
    for i in set(range(2, 60)) - plain:
        gone = set()
        for s in (s for s in spans if s["doc_id"] == i):
            gone |= {text[i][k] for k in range(s["start"], s["start"] + s["n_words"])}
            assert s["first_doc_id"] == i % 3
        shared = set(first[i % 3])
        assert len(gone & shared) >= 0.6 * len(shared)
        assert len(gone - shared) <= 30


def test_pairs_inside_a_frequent_phrase(spark):
    """Paragraphs of 13 words, 9 of them the same in all; pairs that share 12 have 8 of 10 shingles in common."""
    rows = []
    for i in range(60):
        own = [f"c{k}" for k in range(9)] + [f"p{i}x{k}" for k in range(3)]
        rows += [(2 * i, " ".join(own + [f"a{i}"])), (2 * i + 1, " ".join(own + [f"b{i}"]))]
    got = repeated_spans(spark.createDataFrame(rows, SCHEMA), least=10).collect()
    assert sorted((s["doc_id"], s["start"], s["n_words"], s["first_doc_id"]) for s in got) == [(2 * i + 1, 0, 13, 2 * i) for i in range(60)]


def test_recall_of_pairs_against_all_pairs(spark):
    """Of paragraphs that have one at a Jaccard similarity of 0.8 or more in an earlier document nine in ten go at least;
    documents that share no shingle with others lose nothing."""
    r, texts = random.Random(8), []
    for i in range(300):  # one edit in a copy; some families have many copies
        own = prose(r, 40, f"f{i % 40}x") if i < 40 or i % 5 == 0 else texts[i % 40][:]
        if i >= 40:
            own[r.choice([0, 1, 38, 39])] = f"e{i}"
        texts.append(own)
    got = repeated_spans(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], SCHEMA), least=1).collect()
    cut = []
    for i, t in enumerate(texts):
        h = word_hashes(t)
        starts = [*paragraphs(h), len(t)]
        cut += [(i, int(a), " ".join(t[a:b])) for a, b in zip(starts, starts[1:], strict=False)]
    sets = [shingles(p) for *_, p in cut]
    gone = {(s["doc_id"], k) for s in got for k in range(s["start"], s["start"] + s["n_words"])}
    found = wanted = 0
    for j, (doc, at, text) in enumerate(cut):
        if any(cut[k][0] < doc and 100 * len(sets[k] & sets[j]) >= 80 * len(sets[k] | sets[j]) for k in range(j)):
            wanted += 1
            found += all((doc, at + k) in gone for k in range(len(text.split())))
    assert wanted > 300 and found >= 0.9 * wanted, (found, wanted)
    clean = {doc for doc in range(len(texts))} - {d for j, (d, *_) in enumerate(cut) for k in range(len(cut)) if cut[k][0] != d and sets[k] & sets[j]}
    assert not clean & {s["doc_id"] for s in got}


def test_pairs_inside_a_common_template(spark):
    """300 pairs of 13-word texts of one template, each text one paragraph, at 0.8: every second copy is found but for
    what three bands miss."""
    rows = []
    for i in range(300):
        own = [f"c{k}" for k in range(11)] + [f"p{i}"]
        rows += [(2 * i, " ".join([*own, f"a{i}"])), (2 * i + 1, " ".join([*own, f"b{i}"]))]
    got = {s["doc_id"] for s in repeated_spans(spark.createDataFrame(rows, SCHEMA), least=5).collect()}
    assert len(got & set(range(1, 600, 2))) >= 290


def test_memory_of_keys_hands_on_what_matters():
    """Whatever the slots, rows that meet by key tell of every key whether it has several documents and classes."""
    r = np.random.default_rng(4)
    for slots in (1, 7, 64, 4096):
        met, seen, sent = Met(slots), {}, {}
        for _ in range(60):
            rows = sorted({(int(k), int(c), int(d)) for k, c, d in zip(r.integers(0, 40, 30), r.integers(0, 3, 30), r.integers(0, 500, 30), strict=True)})
            groups = {}
            for k, c, d in rows:
                groups.setdefault(k, []).append((c, d))
                seen.setdefault(k, []).append((c, d))
            keys = np.array(list(groups))
            multi = np.array([len({d for _, d in g}) > 1 for g in groups.values()])
            mixed = np.array([len({c for c, _ in g}) > 1 for g in groups.values()])
            known, new = met.take(keys, np.array([g[0][0] for g in groups.values()]), np.array([g[0][1] for g in groups.values()]), multi, mixed)
            for (k, g), n, at in zip(groups.items(), known, new, strict=True):
                for j, (c, d) in enumerate(g):
                    sent.setdefault(k, []).append((c, d, int(n), n == 0 or (at and j == 0)))
        for k, rows in sent.items():
            meet = [(c, d, n) for c, d, n, at in rows if at]
            live = max(n for *_, n in meet) > 0 or len({d for _, d, _ in meet}) > 1
            assert live == (len({d for _, d in seen[k]}) > 1)
            together = len({c for c, *_ in meet}) > 1
            classes = {c for c, _, n, at in rows if n > 1 or (at and together)}
            assert not live or classes == ({c for c, _ in seen[k]} if len({c for c, _ in seen[k]}) > 1 else set())


def test_whole_table_spans_are_in_their_documents(spark, sf_dir):
    texts = {r[0]: words(lower(r[1])) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    spans = op2_substring_dedup(spark, sf_dir).collect()
    assert spans
    for s in spans:
        assert 0 <= s["start"] and s["start"] + s["n_words"] <= len(texts[s["doc_id"]]) and s["n_words"] >= 20 and s["first_doc_id"] < s["doc_id"]
    whole = {}
    for i in sorted(texts):
        whole.setdefault(" ".join(texts[i]), []).append(i)
    by = {}
    for s in spans:
        by.setdefault(s["doc_id"], []).append(s)
    for same in whole.values():  # of equal documents all but the first go whole
        for i in same[1:]:
            if len(texts[i]) >= 20:
                assert sum(s["n_words"] for s in by[i]) == len(texts[i]), i


def test_a_path_that_only_spark_reads(spark, sf_dir):
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.store.link./in", f"file://{sf_dir}")
    got, want = (sorted(map(tuple, op2_substring_dedup(spark, d).collect())) for d in ("viewfs://store/in", sf_dir))
    assert got == want and got


def test_components_of_few_links_are_not_counted_again(spark):
    """The driver keeps plans and code of every query, and linked() asks for components after each round."""
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 6)], "src long, dst long")
    spark.sparkContext.setJobGroup("few links", "")
    assert sorted(map(tuple, components(edges).collect())) == [(1, 1), (2, 1), (3, 1), (5, 5), (6, 5)]
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("few links"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 6, jobs


def test_odd_rows(spark):
    same = " ".join(f"w{i}" for i in range(100))
    rows = [(1, None), (2, ""), (3, " \n"), (4, same), (5, same.upper()), (5, same), (None, same), (6, "short text"), (7, "short text"), (8, "x " * 100_000)]
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], SCHEMA + ", start int, key string")
    got = repeated_spans(df).collect()
    assert [(s["doc_id"], s["start"], s["n_words"], s["first_doc_id"]) for s in got] == [(5, 0, 100, 4)]
    assert repeated_spans(df.limit(0)).count() == 0


def test_cuts_follow_content():
    r = random.Random(2)
    core = prose(r, 300, "c")
    cuts = []
    for k in range(5):
        before = prose(r, 10 + 17 * k, "b")
        s = paragraphs(word_hashes(before + core))
        cuts.append({int(x) - len(before) for x in s if x - len(before) > 12})
        gaps = np.diff(np.append(s, len(before) + 300))
        assert gaps.min() >= 1 and gaps.max() <= 64
    assert all(c == cuts[0] for c in cuts)
