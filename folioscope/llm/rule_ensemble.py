"""Quality classifier: rules from tree paths, lasso logistic weights, compiled to Spark columns."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .quality_stats import RATES, base_stats, held_out, rates, training_rows

#: Most labelled rows that the fit sees.
TRAINING_ROWS = 8_000
#: Not used as an input: windows of words cost more than all else and add nothing to the share of distinct words.
FEATURES = tuple(x for x in RATES if x != "repeats")


def _split(x: np.ndarray, g: np.ndarray, idx: np.ndarray, rng: np.random.Generator, least: int) -> tuple | None:
    """Feature and threshold that lower the squared error of g over idx most."""
    best = (1e-9, None)
    for f in rng.permutation(x.shape[1])[: max(2, 2 * x.shape[1] // 3)]:
        order = idx[np.argsort(x[idx, f], kind="stable")]
        v, s = x[order, f], np.cumsum(g[order])
        n = np.arange(1, len(v))
        ok = (v[1:] > v[:-1]) & (n >= least) & (len(v) - n >= least)
        if not ok.any():
            continue
        gain = np.where(ok, s[:-1] ** 2 / n + (s[-1] - s[:-1]) ** 2 / (len(v) - n) - s[-1] ** 2 / len(v), -np.inf)
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (gain[k], (int(f), float((v[k] + v[k + 1]) / 2)))
    return best[1]


def tree_rules(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, share: float = 0.5, rate: float = 0.2, least: int = 8, seed: int = 11) -> list:
    """Paths from the root to every node of boosted trees on random halves: conjunctions of (feature, op, threshold)."""
    rng, out, at = np.random.default_rng(seed), {}, np.full(len(y), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    for _ in range(trees):
        g = y - 1 / (1 + np.exp(-at))
        rows = rng.permutation(len(y))[: max(2 * least, int(share * len(y)))]
        grow = [((), rows, np.arange(len(y)))]
        while grow:
            path, own, every = grow.pop()
            cut = _split(x, g, own, rng, least) if len(path) < depth and len(own) >= 2 * least else None
            if path:
                out.setdefault(path, None)
            if cut is None:
                p = 1 / (1 + np.exp(-at[own]))
                at[every] += rate * np.clip(g[own].sum() / max((p * (1 - p)).sum(), 1e-3), -4, 4)
                continue
            f, c = cut
            for op, side in (("<=", x[:, f] <= c), (">", x[:, f] > c)):
                grow.append(((*path, (f, op, c)), own[side[own]], every[side[every]]))
    return list(out)


def matrix(x: np.ndarray, rules: list) -> np.ndarray:
    out = np.ones((len(x), len(rules)))
    for j, rule in enumerate(rules):
        for f, op, c in rule:
            out[:, j] *= x[:, f] <= c if op == "<=" else x[:, f] > c
    return out


def lasso_logistic(m: np.ndarray, y: np.ndarray, penalty: float = 0.002, steps: int = 500) -> tuple[float, np.ndarray]:
    """Intercept and weights by accelerated proximal gradient on the mean log-loss plus penalty times the L1 norm."""
    mean = m.mean(0)
    a = m - mean
    step = 4.0 / max(1e-9, np.linalg.norm(a, 2) ** 2 / len(y) + 1)
    b = z_b = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    w = z = np.zeros(m.shape[1])
    t = 1.0
    for _ in range(steps):
        r = 1 / (1 + np.exp(-(z_b + a @ z))) - y
        nb, nw = z_b - step * r.mean(), z - step * (a.T @ r) / len(y)
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * penalty, 0)
        nt = (1 + (1 + 4 * t * t) ** 0.5) / 2
        z_b, z = nb + (t - 1) / nt * (nb - b), nw + (t - 1) / nt * (nw - w)
        b, w, t = nb, nw, nt
    return float(b - mean @ w), w


def fit(rows: list, names: tuple = RATES, use: tuple = FEATURES, **options) -> tuple[float, list]:
    """(intercept, [(weight, rule)]) from rows (label, features in the order of names).

    With no rows the score is one half; with one label only, the intercept alone speaks for it.
    """
    if not rows:
        return 0.0, []
    data = np.array(rows, float)
    x, y = data[:, [1 + names.index(u) for u in use]], data[:, 0]
    if len(set(y)) < 2:
        return (4.0 if y[0] else -4.0), []
    rules = tree_rules(x, y, **options)
    if not rules:
        return float(np.log(y.mean() / (1 - y.mean()))), []
    m = matrix(x, rules)
    _, first = np.unique(np.packbits(m.astype(bool), axis=0).T, axis=0, return_index=True)
    keep = sorted(int(i) for i in first if 0 < m[:, i].mean() < 1)
    b, w = lasso_logistic(m[:, keep], y)
    return b, [(float(v), [(use[f], op, c) for f, op, c in rules[i]]) for i, v in zip(keep, w, strict=True) if abs(v) > 1e-4]


def score(model: tuple[float, list]) -> Column:
    """Logistic of the weighted rules as one column expression over the feature columns."""
    total = F.lit(model[0])
    for w, rule in model[1]:
        cond = F.lit(True)
        for name, op, c in rule:
            cond = cond & ((F.col(name) > c) if op == ">" else (F.col(name) <= c))
        total = total + F.when(cond, F.lit(w)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def classify(docs: DataFrame, model: tuple[float, list], id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """Per document: id, held_out, score, predicted. Null and empty texts score as texts of no words; repeated rows
    and null ids give a row each; other columns are ignored."""
    x = rates(base_stats(docs.select(id_col, text_col), id_col, text_col), id_col)
    out = x.select(id_col, held_out(id_col).alias("held_out"), score(model).alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def fit_quality(spark: SparkSession, docs: DataFrame, sf_dir: str, bound: int = TRAINING_ROWS) -> tuple[float, list]:
    return fit(training_rows(docs, table(spark, sf_dir, "labels"), bound))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return classify(docs, fit_quality(spark, docs, sf_dir))
