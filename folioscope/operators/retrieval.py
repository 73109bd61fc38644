"""Keyword, vector and hybrid ranking."""

from __future__ import annotations

from collections.abc import Callable
from decimal import ROUND_HALF_UP, Decimal
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def terms(rows: DataFrame, id_: str, text: str) -> DataFrame:
    """(id, term): lower-case ASCII letter runs, one row per occurrence."""
    return rows.select(id_, F.explode(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z]+"), F.lit(0))).alias("term"))


def bm25(docs: DataFrame, queries: DataFrame, k: int, doc_id: str = "doc_id", query_id: str = "item_id", text: str = "text", k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """The k best documents of each query: (query_id, doc_id, score, rank). Counts cover all documents; only postings
    of the queries' terms are joined, and a document's score is a partial sum."""
    counted = terms(docs, doc_id, text).groupBy(doc_id, "term").agg(F.count(F.lit(1)).alias("tf"))
    length = counted.groupBy(doc_id).agg(F.sum("tf").alias("dl"))
    total = docs.agg(F.count(F.lit(1)).alias("n")).crossJoin(length.agg((F.sum("dl")).alias("words")))  # one row each
    asked = terms(queries, query_id, text).distinct()
    live = counted.join(asked.select("term").distinct(), "term", "left_semi")
    df = live.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weighed = live.join(df, "term").join(length, doc_id).join(F.broadcast(total))
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    score = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / (F.col("words") / F.col("n"))))
    sums = weighed.select(doc_id, "term", score.alias("s")).join(asked, "term").groupBy(query_id, doc_id).agg(F.round(F.sum("s"), 6).alias("score"))
    return top_k(sums, query_id, [F.desc("score"), F.col(doc_id)], k)


def top_k(rows: DataFrame, key: str, order: list[Column], k: int) -> DataFrame:
    """rank within key; Spark keeps k rows a partition before the shuffle."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("rank") <= k)


def cosine(a: Column, b: Column) -> Column:
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))
    return dot / (norm(a) * norm(b))


def vector_top_k(vectors: DataFrame, queries: DataFrame, k: int, rows: int = 16384, asked: int = 2048) -> DataFrame:
    """(query_id, vec_id, score, rank) of queries (query_id, query_embedding) against all vectors (vec_id, embedding), each
    pair compared. Both sides are dealt by hash into blocks of about `rows` vectors and `asked` queries, so a task holds one
    block of either, however many there are; a pair of blocks gives at most k rows a query."""
    vectors, queries = vectors.where("vec_id is not null"), queries.where("query_id is not null")
    blocks = lambda d, name, most: d.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / most)).cast("int").alias(name))
    sizes = F.broadcast(blocks(vectors, "nv", rows).crossJoin(blocks(queries, "nq", asked)))  # one row
    dealt = lambda id_, n: F.pmod(F.xxhash64(id_), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = vectors.crossJoin(sizes).select("vec_id", "embedding", dealt("vec_id", "nv").alias("vb"), every("nq").alias("qb"))
    right = queries.crossJoin(sizes).select("query_id", "query_embedding", every("nv").alias("vb"), dealt("query_id", "nq").alias("qb"))
    best = left.groupBy("vb", "qb").cogroup(right.groupBy("vb", "qb")).applyInArrow(partial(_best_of_blocks, k=k), "query_id bigint, vec_id bigint, score double")
    return top_k(best.withColumn("score", F.round("score", 6)), "query_id", [F.desc("score"), F.col("vec_id")], k)


NULL, NAN = -2.0, 2.0  # places of scores that are no number in the order of cosines: missing ones last, NaN first


def _by_length(column: pa.ChunkedArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix) of the vectors of each length; those that are null, empty or have a null in them are in none."""
    lists = column.combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    lengths = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    flat, start = lists.flatten(), np.cumsum(lengths) - lengths
    values, missing = flat.to_numpy(zero_copy_only=False).astype(np.float64), flat.is_null().to_numpy(zero_copy_only=False)
    whole = np.concatenate([[0], np.cumsum(missing)])
    whole = (whole[start + lengths] == whole[start]) & (lengths > 0)
    found = []
    for n in np.unique(lengths[whole]):
        at = np.flatnonzero(whole & (lengths == n))
        found.append((at, values[start[at][:, None] + np.arange(n)]))
    return found


def _dots(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Dot products row by row, summed in the order of the elements as the column function does."""
    total = np.zeros(len(x))
    for i in range(x.shape[1]):
        total += x[:, i] * y[:, i]
    return total


def _millionths(scores: np.ndarray, exact: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Scores rounded half up at six digits, as whole numbers, and the scores; those so near a half that the order of the sum
    decides are taken from exact(places) and rounded as decimals."""
    scaled = scores * 1e6
    out = np.floor(scaled + 0.5)
    near = np.flatnonzero(np.abs(np.abs(scaled - out) - 0.5) < 1e-4)
    if len(near):
        scores = scores.copy()
        scores[near] = exact(near)
        out[near] = [float(Decimal(repr(float(v))).scaleb(6).quantize(Decimal(1), ROUND_HALF_UP)) for v in scores[near]]
    return out, scores


def _best_of_blocks(left: pa.Table, right: pa.Table, k: int, tile: int = 1 << 21) -> pa.Table:
    """The k best vectors of a block for each query of a block by rounded cosine, then vec_id. Matrix products find who can
    be among them, with what rounding could lift; the order among these is that of the exact sums."""
    vec, query = (t.column(n).to_numpy() for t, n in ((left, "vec_id"), (right, "query_id")))
    vectors, queries = _by_length(left.column("embedding")), _by_length(right.column("query_embedding"))
    norms = [np.sqrt(_dots(x, x)) for _, x in vectors]
    got: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    known = np.zeros(len(query), bool)
    step = max(1, tile // max(1, len(vec)))
    for at, y in queries:
        known[at] = True
        same = next((j for j, (_, x) in enumerate(vectors) if x.shape[1] == y.shape[1]), None)
        for a in range(0, len(at), step):
            rows, ys = at[a : a + step], y[a : a + step]
            s = np.full((len(rows), len(vec)), NULL)
            if same is not None:
                (places, x), own, norm = vectors[same], np.sqrt(_dots(ys, ys)), norms[same]
                with np.errstate(all="ignore"):
                    c = ys @ x.T / (own[:, None] * norm)
                c[np.isnan(c)] = NAN
                if len(places) == len(vec):
                    s = c
                else:
                    s[:, places] = c
                back = np.zeros(len(vec), np.int64)
                back[places] = np.arange(len(places))
            got.append(_chosen(s, query[rows], vec, k, lambda r, v: _dots(x[back[v]], ys[r]) / (norm[back[v]] * own[r])))  # noqa: B023  called at once
    rest = np.flatnonzero(~known)
    for a in range(0, len(rest), step):
        rows = rest[a : a + step]
        got.append(_chosen(np.full((len(rows), len(vec)), NULL), query[rows], vec, k, None))
    ids, others, scores = (np.concatenate(c) if got else np.zeros(0) for c in (zip(*got, strict=True) if got else ((), (), ())))
    return pa.table({"query_id": pa.array(ids, pa.int64()), "vec_id": pa.array(others, pa.int64()), "score": pa.array(np.where(scores == NAN, np.nan, scores), pa.float64(), mask=scores == NULL)})


def _chosen(s: np.ndarray, query: np.ndarray, vec: np.ndarray, k: int, exact: Callable[[np.ndarray, np.ndarray], np.ndarray] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query ids, vector ids, scores) of the k best of each row of s, no query with itself."""
    s[query[:, None] == vec] = -np.inf
    least = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k] if s.shape[1] > k else np.full(len(s), NULL)
    r, v = np.nonzero((s >= (least - 1.1e-6)[:, None]) & (s > -np.inf))  # what rounds to the same as the k-th is no further
    found = s[r, v]
    number = np.flatnonzero((found > NULL) & (found < NAN))
    rounded = found * 1e6
    if len(number):
        rounded[number], found[number] = _millionths(found[number], lambda near: exact(r[number[near]], v[number[near]]))
    order = np.lexsort((vec[v], -rounded, r))
    r, v, found = r[order], v[order], found[order]
    place = np.arange(len(r)) - np.searchsorted(r, r)
    kept = place < k
    r, v, found = r[kept], v[kept], found[kept]
    number = np.flatnonzero((found > NULL) & (found < NAN))
    if len(number):
        found[number] = exact(r[number], v[number])
    return query[r], vec[v], found


def reciprocal_rank_fusion(rankings: list[DataFrame], query: str, item: str, k: int, constant: int = 60) -> DataFrame:
    """Sum of 1 / (constant + rank) over rankings (query, item, rank)."""
    every = rankings[0].select(query, item, "rank")
    for r in rankings[1:]:
        every = every.union(r.select(query, item, "rank"))
    fused = every.groupBy(query, item).agg(F.round(F.sum(1.0 / (constant + F.col("rank"))), 6).alias("score"))
    return top_k(fused, query, [F.desc("score"), F.col(item)], k)


def overlap_pairs(left: DataFrame, right: DataFrame, left_id: str, right_id: str, token: str, least: float) -> DataFrame:
    """Pairs of token sets with a Jaccard similarity of at least `least`, by equi-join on tokens: (left, right, jaccard)."""
    a, b = left.select(left_id, token).distinct(), right.select(right_id, token).distinct()
    na, nb = a.groupBy(left_id).agg(F.count(F.lit(1)).alias("na")), b.groupBy(right_id).agg(F.count(F.lit(1)).alias("nb"))
    shared = a.join(b, token).groupBy(left_id, right_id).agg(F.count(F.lit(1)).alias("shared"))
    j = F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared"))
    return shared.join(na, left_id).join(nb, right_id).select(left_id, right_id, F.round(j, 6).alias("jaccard")).where(F.col("jaccard") >= least)
