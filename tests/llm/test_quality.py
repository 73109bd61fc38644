"""Statistics, decision list and rule ensemble."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from brute import words
from folioscope.llm import quality_rules as Q
from folioscope.llm import rule_ensemble as E
from folioscope.llm.quality_stats import RATES, base_stats, rates, training_rows

SCHEMA = "doc_id long, text string"


def stats(text):
    text = text or ""
    ws = words(text)
    windows = Counter(tuple(ws[i : i + 5]) for i in range(len(ws) - 4))
    inside = {i + k for i in range(len(ws) - 4) if windows[tuple(ws[i : i + 5])] > 1 for k in range(5)}
    full = [x for x in text.split("\n") if words(x)]
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(full) - len(set(full)), len(inside)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_whole_table(spark, sf_dir):
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: r for r in Q.op7_quality_rules(spark, sf_dir).collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        want = stats(t)
        assert tuple(got[i][n] for n in NAMES) == want, i
        failed = want[0] < 10 or 100 * want[4] > 20 * want[0]
        assert got[i]["base_failed"] == failed and not (failed and got[i]["kept"])


def test_odd_texts(spark):
    r = random.Random(2)
    texts = [None, "", " \n ", "a b c d e", "a b c d e a b c d e", "x " * 50_000, "é b c d", "a\n\na\n a\nb", "#*$%&|<>" * 3, " ".join(r.choice("ab") for _ in range(3000)), " ".join(str(r.randrange(400)) for _ in range(60_000)), "a\rb\x0bc\x0cd e f g a\rb c"]
    df = spark.createDataFrame([(i, t, 1, "q") for i, t in enumerate(texts)], "doc_id long, text string, n_words int, ws string")
    got = {x["doc_id"]: x for x in Q.quality_rules(df, []).collect()}
    for i, t in enumerate(texts):
        assert tuple(got[i][n] for n in NAMES) == stats(t), i
    assert Q.quality_rules(df.limit(0), []).count() == 0


def planted(n, seed):
    r = np.random.default_rng(seed)
    x = r.random((n, len(RATES)))
    bad = (x[:, 0] > 0.7) | ((x[:, 1] > 0.5) & (x[:, 6] <= 0.4))
    return [(int(not b), *v) for b, v in zip(bad, x.tolist(), strict=True)]


def test_decision_list_finds_planted_rules():
    rules, test = Q.learn(planted(2000, 1)), planted(1000, 2)
    hit = [any(all((row[1 + RATES.index(f)] > c) if op == ">" else (row[1 + RATES.index(f)] <= c) for f, op, c in rule) for rule in rules) for row in test]
    assert np.mean([h == (row[0] == 0) for h, row in zip(hit, test, strict=True)]) > 0.93
    assert Q.learn([]) == [] and Q.learn([(1, *[0.0] * len(RATES))] * 50) == []


def test_ensemble_is_sparse_and_right(spark):
    model = E.fit(planted(2000, 1), names=RATES, use=RATES)
    test = spark.createDataFrame([(r[0], *r[1:]) for r in planted(1000, 2)], ["y", *RATES])
    acc = test.select(F.avg(((E.score(model) >= 0.5).cast("int") == F.col("y")).cast("int"))).first()[0]
    assert acc > 0.9 and 0 < len(model[1]) < 150
    assert E.fit([])[1] == [] and E.fit([(1, *[0.0] * len(RATES))] * 50)[1] == []


def auc(pairs):
    good, bad = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])


def test_classifier_on_the_held_out_fold(spark, sf_dir):
    d = sf_dir.replace("sf0.001", "sf0.01")
    got = E.op3_quality_classifier(spark, d).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{d}/documents.parquet").count()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    assert auc([(r["score"], labels[r["doc_id"]]) for r in got if r["held_out"] and labels.get(r["doc_id"]) is not None]) > 0.9


def test_training_rows_leave_the_fold_out(spark):
    docs = spark.createDataFrame([(i, f"text {i} a b c", 0) for i in range(100)], "doc_id long, text string, quality int")
    labels = spark.createDataFrame([(i, 1, None) for i in range(90)] + [(None, 1, 1), (5, None, 0)], "doc_id long, quality int, toxic int")
    rows = training_rows(docs, labels, 1000)
    assert len(rows) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(90))
    assert len(training_rows(docs, labels, 7)) == 7 and training_rows(docs, labels.limit(0), 7) == []


def test_score_ignores_other_columns_and_odd_rows(spark):
    model = (0.5, [(1.0, [("n_words", ">", 2.5)])])
    df = spark.createDataFrame([(1, None, 9.0), (None, "a b c", None), (1, "", 1.0)], "doc_id long, text string, score double")
    got = E.classify(df, model).collect()
    assert len(got) == 3 and sorted(round(r["score"], 3) for r in got) == [0.622, 0.622, 0.818]


def test_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = Q.drop_rejected(spark, docs, sf_dir)
    verdicts = {r["doc_id"] for r in Q.op7_quality_rules(spark, sf_dir).where("kept").collect()}
    rows = got.collect()
    assert got.columns == docs.columns and {r["doc_id"] for r in rows} == verdicts
    texts = {r["doc_id"]: tuple(r) for r in docs.collect()}
    assert all(tuple(r) == texts[r["doc_id"]] for r in rows)


def test_rates_have_no_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], SCHEMA)
    assert all(v is not None for r in rates(base_stats(df)).collect() for v in r)


def test_compiled_score_equals_the_model_on_the_table(spark, sf_dir):
    """The column expression and the same rules and weights in numpy give every document one score."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = E.fit_quality(spark, docs, sf_dir)
    x = {r["doc_id"]: r for r in rates(base_stats(docs)).collect()}
    assert model[1]
    for r in E.classify(docs, model).collect():
        total = model[0] + sum(w for w, rule in model[1] if all((x[r["doc_id"]][f] > c) if op == ">" else (x[r["doc_id"]][f] <= c) for f, op, c in rule))
        assert abs(r["score"] - 1 / (1 + np.exp(-total))) < 1e-9


def test_verdict_on_the_held_out_fold(spark, sf_dir):
    """Of held-out documents that pass the base limits the list keeps most good ones and rejects most bad ones."""
    d = sf_dir.replace("sf0.001", "sf0.01")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    rows = [r for r in Q.op7_quality_rules(spark, d).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and labels.get(r["doc_id"]) is not None and not r["base_failed"]]
    good, bad = [r["kept"] for r in rows if labels[r["doc_id"]]], [r["kept"] for r in rows if not labels[r["doc_id"]]]
    assert np.mean(good) > 0.9 and np.mean(bad) < 0.3, (np.mean(good), np.mean(bad))
