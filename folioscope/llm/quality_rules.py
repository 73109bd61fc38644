"""Quality rules: base limits, then a decision list learned by sequential covering, as Spark conditions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .quality_stats import RATES, base_stats, rates, training_rows

#: Most labelled rows that the learner sees.
TRAINING_ROWS = 8_000


def _gain(p0: float, n0: float, p: np.ndarray, n: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.nan_to_num(p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), nan=-1.0, neginf=-1.0)


def _grow(x: np.ndarray, y: np.ndarray, cuts: list[np.ndarray], most: int) -> list[tuple[int, str, float]]:
    rule, inside = [], np.ones(len(y), bool)
    while len(rule) < most and (n0 := (inside & ~y).sum()):
        p0, best = (inside & y).sum(), (0.0, None)
        for f, c in enumerate(cuts):
            if not len(c):
                continue
            for op in (">", "<="):
                m = (x[:, f, None] > c) if op == ">" else (x[:, f, None] <= c)
                p, n = m[inside & y].sum(0).astype(float), m[inside & ~y].sum(0).astype(float)
                g = _gain(p0, n0, p, n)
                k = int(g.argmax())
                if g[k] > best[0] + 1e-9:
                    best = (g[k], (f, op, float(c[k])))
        if best[1] is None:
            break
        rule.append(best[1])
        inside &= _holds(x, [best[1]])
    return rule


def _middle(v: np.ndarray, y: np.ndarray, op: str, c: float) -> float:
    """The threshold halfway between it and the nearest reject on its side, so that the margin is shared."""
    if op == ">":
        beyond = v[y & (v > c)]
        return float((max(c, v[~y & (v <= c)].max(initial=c)) + np.quantile(beyond, 0.02)) / 2) if len(beyond) else c
    beyond = v[y & (v <= c)]
    return float((min(v[~y & (v > c)].min(initial=np.inf), 2 * c - beyond.max()) + beyond.max()) / 2) if len(beyond) else c


def _holds(x: np.ndarray, rule: list) -> np.ndarray:
    m = np.ones(len(x), bool)
    for f, op, c in rule:
        m &= (x[:, f] > c) if op == ">" else (x[:, f] <= c)
    return m


def learn(rows: list, precision: float = 0.95, most_rules: int = 12, most_terms: int = 4, least: int = 5, seed: int = 7) -> list:
    """Ordered conjunctions [(feature, op, threshold), ...] that mark rejects, from rows (label, features...).

    Each round grows a conjunction on two thirds of what is left by information gain, prunes its last terms on the
    other third, and stops when a rule covers fewer than `least` rejects or is less precise than `precision` on
    either part. Rows that a rule covers are taken out before the next round. Without rows of both labels: no rules.
    """
    if not rows or len({r[0] for r in rows}) < 2:
        return []
    data = np.array(rows, float)
    x, y = data[:, 1:], data[:, 0] == 0
    order = np.random.default_rng(seed).permutation(len(y))
    x, y = x[order], y[order]
    fold = np.arange(len(y)) % 3 == 0
    rules, left = [], np.ones(len(y), bool)
    for _ in range(most_rules):
        a, b = left & ~fold, left & fold
        if y[a].sum() < least:
            break
        cuts = [np.unique(np.quantile(np.concatenate([x[a][y[a]][:, f], x[a][:, f]]), np.linspace(0.0, 1.0, 41))) for f in range(x.shape[1])]
        rule = _grow(x[a], y[a], cuts, most_terms)

        def worth(r: list) -> float:
            m = _holds(x[b], r)
            return (int((m & y[b]).sum()) - int((m & ~y[b]).sum())) / max(1, int(m.sum()))

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        m, mb = _holds(x, rule) & left, _holds(x, rule) & b
        if not rule or (m & y).sum() < least or (m & y).sum() < precision * m.sum() or (mb & y).sum() < precision * mb.sum():
            break
        rules.append([(RATES[f], op, _middle(x[left, f], y[left], op, c)) for f, op, c in rule])
        left &= ~m
    return rules


def verdict(rules: list) -> Column:
    """The decision list as one ordered conditional: the first rule that holds rejects, no rule keeps."""
    if not rules:
        return F.lit(True)
    out = F
    for rule in rules:
        cond = F.lit(True)
        for name, op, c in rule:
            cond = cond & ((F.col(name) > c) if op == ">" else (F.col(name) <= c))
        out = out.when(cond, F.lit(False))
    return out.otherwise(F.lit(True))


def quality_rules(docs: DataFrame, rules: list, id_col: str = "doc_id", text_col: str = "text", min_words: int = 10, repeat_percent: int = 20) -> DataFrame:
    """Per document: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    base_failed: fewer than min_words words, or 100 * n_repeat_words > repeat_percent * n_words. kept: not
    base_failed and no learned rule rejects. Null and empty texts have no words, so they fail the base limits.
    Repeated rows give repeated results; ids may be null; other columns are ignored.
    """
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    x = rates(base_stats(docs.select(id_col, text_col), id_col, text_col), id_col, keep=base)
    return x.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(rules)).select(id_col, *base, "base_failed", "kept")


def fit_rules(spark: SparkSession, docs: DataFrame, sf_dir: str, bound: int = TRAINING_ROWS) -> list:
    return learn(training_rows(docs, table(spark, sf_dir, "labels"), bound))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules(docs, fit_rules(spark, docs, sf_dir))


def drop_rejected(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the base limits or the learned list reject go; columns are those of docs. Null and
    empty texts have too few words, so they go; null ids and repeated rows are judged like others; an empty table stays so."""
    rules = fit_rules(spark, docs, sf_dir)
    own = [c for c in docs.columns if c not in ("doc_id", "text")]
    packed = docs.select("doc_id", "text", F.struct(*own).alias("own")) if own else docs.select("doc_id", "text", F.struct(F.lit(0).alias("none")).alias("own"))
    stats = rates(base_stats(packed.withColumn("raw", F.col("text")), extra=("own", "raw")), keep=("n_words", "n_repeat_words", "own", "raw"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    kept = stats.where(~failed & verdict(rules))
    return kept.select(*[F.col("raw").alias("text") if c == "text" else F.col(c) if c == "doc_id" else F.col(f"own.{c}").alias(c) for c in docs.columns])

