"""Secret scans: candidate tokens scored by a random forest that is compiled to Spark columns."""

from __future__ import annotations

import random
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, table

KEYWORDS = "token|secret|passwd|password|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|credential|bearer"
NEGATIVE = "commit|sha1|sha256|sha512|md5|checksum|digest|revision|uuid|guid|integrity|etag|example|sample|dummy|version|build|isbn"
DICTIONARY = (
    "the|and|for|user|name|get|set|your|here|key|token|secret|password|change|example|sample|test|dummy|placeholder|insert|value|"
    "local|lib|python|java|node|module|src|main|index|file|path|data|config|factory|service|manager|build|version|release|http|www|"
    "com|org|html|image|content|page|list|item|time|date|number|string|type|class|public|private|static|return|import|export"
)
#: A candidate: a private key from its BEGIN to its END line; a run of token characters that starts after none of them
#: and has a digit, 16 long at least; or 8 characters at least after a name that ends in a key word or in one more part
#: (client_secret, DB_PASSWORD, SECRET_KEY), a sign and perhaps a quote. A sign of equality ends a name and may pad a
#: value, so it never lies within one. The short look behind comes first, as the long one tries every length.
CANDIDATE = (
    r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----(?:[^-]*+-----END [A-Z ]{0,30}PRIVATE KEY-----)?|\bA[KS]IA[A-Z0-9]{16}\b"
    r"|(?<![A-Za-z0-9+/_~-])(?=[A-Za-z+/_~-]*+[0-9])[A-Za-z0-9+/_~-]{16,}={0,2}"
    rf"|(?<=[:=\s\"'])(?<=[:=]\s{{0,3}}[\"']?)(?i)(?<=(?:{KEYWORDS})(?:[_-][a-z]{{1,10}})?[\"']?\s{{0,3}}[:=]\s{{0,3}}[\"']?)(?-i)[^\s\"'<>]{{8,}}"
)
#: Candidates are 8 characters long at least, so that many of them lie within REACH characters at most.
REACH = 40
NEAR = REACH // 8 + 1
#: Candidates whose lengths are summed one by one; more are summed by block.
BLOCK = 256
FEATURES = ("length", "transitions", "digits", "uppers", "alphabet", "dictionary", "hex", "prefix", "path", "near_key", "near_negative", "assigned", "repeats")


def features(value: Column, left: Column, right: Column, source: Column) -> dict[str, Column]:
    """Numbers of one candidate: its length and make-up, dictionary coverage, path and neighbouring words."""
    n = F.greatest(F.length(value), F.lit(1))
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[^A-Za-z0-9]", "-"), "[0-9]", "0"), "[A-Z]", "A"), "[a-z]", "a")
    flag = lambda c: c.cast("double")
    return {
        "length": F.length(value).cast("double"),
        "transitions": F.regexp_count(kinds, F.lit("(?<=a)[^a]|(?<=A)[^A]|(?<=0)[^0]|(?<=-)[^-]")) / n,
        "digits": F.regexp_count(value, F.lit("[0-9]")) / n,
        "uppers": F.regexp_count(value, F.lit("[A-Z]")) / n,
        "alphabet": F.size(F.array_distinct(F.split(value, ""))) / F.least(n, F.lit(40)),
        "dictionary": 1 - F.length(F.regexp_replace(F.lower(value), DICTIONARY, "")) / n,
        "hex": flag(value.rlike("^[0-9a-f]+$|^[0-9A-F]+$")),
        "prefix": flag(value.rlike("^(AKIA|ASIA|gh[pousr]_|github_pat_|sk[-_]|pk_live_|xox[abprs]-|AIza|eyJ|glpat-|-----BEGIN)")),
        "path": flag(value.rlike("/[a-z]{2,}.*/") | source.rlike("(?i)test|spec|example|fixture|docs")),
        "near_key": flag(left.rlike(f"(?i)({KEYWORDS})")),
        "near_negative": flag(left.rlike(f"(?i)({NEGATIVE})") | right.rlike(f"(?i)^.?.?({NEGATIVE})")),
        "assigned": flag(left.rlike("[:=]\\s{0,3}[\"']?$")),
        "repeats": F.regexp_count(value, F.lit(r"(.)\1\1")) / n,
    }


def labelled_findings(n: int = 3000, seed: int = 5) -> list[tuple[int, str, str, str, str]]:
    """(label, value, left, right, source): invented findings of known kind, `n` of them, the same in every call."""
    r = random.Random(seed)
    hexes, b64 = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    letters = "abcdefghijklmnopqrstuvwxyz"
    some = lambda chars, k: "".join(r.choice(chars) for _ in range(k))
    text = lambda: " ".join(some(letters, r.randint(2, 9)) for _ in range(4)) + " "
    key = lambda: r.choice(["token", "secret", "api_key", "password", "access_key", "auth", "API-KEY", "client_secret", "pwd", "DB_PASSWORD", "AUTH_TOKEN", "SECRET_KEY"]) + r.choice([" = ", "=", ": ", ":"]) + r.choice(['"', "'", ""])
    good = [
        lambda: (some(hexes, r.choice([32, 40, 64, 48, 36])), text() + key()),
        lambda: (some(hexes, r.randint(10, 30)), text() + key()),
        lambda: (some(r.choice([b64, b64[:62]]), r.randint(12, 60)), text() + key()),
        lambda: ("AKIA" + some("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16), text() + r.choice(["", key()])),
        lambda: (r.choice(["ghp_", "gho_", "ghs_", "sk-", "sk_", "glpat-"]) + some(b64[:62], r.randint(24, 40)), text() + r.choice(["", key(), "bearer "])),
        lambda: ("xoxb-" + some("0123456789", 11) + "-" + some(b64[:62], 24), text()),
        lambda: ("eyJ" + some(b64[:62], 30) + "_" + some(b64[:62], 40), text() + r.choice(["bearer ", "", key()])),
        lambda: ("-----BEGIN " + (kind := r.choice(["RSA ", "EC ", "OPENSSH ", ""])) + "PRIVATE KEY-----" + r.choice(["", "\n" + some(b64, r.randint(64, 800)) + "\n-----END " + kind + "PRIVATE KEY-----"]), text()),
        lambda: (some(letters, 4) + some("0123456789", 3) + some("!#%&*", 2) + some(letters.upper(), 3), text() + r.choice(["password = ", 'pwd: "', "passwd="])),
    ]
    bad = [
        lambda: (some(hexes, r.choice([40, 64, 32])), text() + r.choice(["commit ", "sha256: ", "md5 = ", "checksum ", "revision ", "digest:"])),
        lambda: ("-".join(some(hexes, k) for k in (8, 4, 4, 4, 12)), text() + r.choice(["uuid ", "id: ", ""])),
        lambda: (r.choice(["YOUR_API_KEY_HERE_123", "your-token-here-0000", "example_secret_value1", "changeme12345678", "insert-password-here1", "dummy_token_for_test_1"]), text() + r.choice([key(), ""])),
        lambda: (r.choice("x*0X1") * r.randint(16, 40) + r.choice(["", "1", "0"]), text() + r.choice([key(), ""])),
        lambda: ("usr/local/lib/python3/" + some(letters, 8) + "/" + some(letters, 6), text()),
        lambda: ("get" + some(letters, 6).title() + "Factory" + some("0123456789", 1) + some(letters, 7).title(), text()),
        lambda: (some(letters, r.randint(14, 28)) + some("0123456789", r.randint(1, 2)), text()),
        lambda: (some("0123456789", r.randint(16, 24)), text() + r.choice(["isbn ", "number ", ""])),
        lambda: ("20" + some("0123456789", 2) + "-01-02T10-" + some("0123456789", 6), text() + r.choice(["build ", "date: "])),
        lambda: (some(b64, r.randint(24, 60)), text() + r.choice(["integrity sha512-", "etag: ", "image data ", ""])),
        lambda: (some(hexes, r.choice([16, 20, 24, 40])), text() + r.choice(["", "see ", "object "])),
        lambda: ("_".join(some(letters, 5) for _ in range(4)) + "_v2", text() + r.choice(["", "auth: "])),
    ]
    out = []
    for i in range(n):
        label = i % 2
        value, left = r.choice(good if label else bad)()
        out.append((label, value, left[-40:], '" ' + text() if r.random() < 0.5 else " " + text(), r.choice(["src1", "web", "code/app", "mail"])))
    return out


def grow_forest(x: np.ndarray, y: np.ndarray, trees: int = 15, depth: int = 6, least: int = 5, seed: int = 3) -> list:
    """Trees as nested tuples (feature, threshold, low, high) or leaf probabilities, by Gini on bootstraps."""
    rng = np.random.default_rng(seed)

    def grow(idx: np.ndarray, level: int):
        p = y[idx].mean()
        if level == depth or len(idx) < 2 * least or p in (0.0, 1.0):
            return float(p)
        best = (1e-9, None)
        for f in rng.choice(x.shape[1], max(1, int(x.shape[1] ** 0.5) + 1), replace=False):
            order = idx[np.argsort(x[idx, f], kind="stable")]
            v, s, n = x[order, f], np.cumsum(y[order]), np.arange(1, len(order) + 1)
            a, b = s[:-1] / n[:-1], (s[-1] - s[:-1]) / (len(v) - n[:-1])
            gain = p * (1 - p) - (n[:-1] * a * (1 - a) + (len(v) - n[:-1]) * b * (1 - b)) / len(v)
            gain = np.where((v[1:] > v[:-1]) & (n[:-1] >= least) & (len(v) - n[:-1] >= least), gain, -1)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], (int(f), float((v[k] + v[k + 1]) / 2)))
        if best[1] is None:
            return float(p)
        f, c = best[1]
        low = x[idx, f] <= c
        return (f, c, grow(idx[low], level + 1), grow(idx[~low], level + 1))

    return [grow(rng.integers(0, len(y), len(y)), 0) for _ in range(trees)]


def vote(forest: list, of: dict[str, Column]) -> Column:
    """The mean of the trees' leaves as one column expression."""

    def tree(node) -> Column:
        if isinstance(node, float):
            return F.lit(node)
        f, c, low, high = node
        return F.when(of[FEATURES[f]] <= c, tree(low)).otherwise(tree(high))

    total = tree(forest[0])
    for t in forest[1:]:
        total = total + tree(t)
    return total / len(forest)


@lru_cache(maxsize=1)
def _forest_of(rows: tuple) -> list:
    data = np.array(rows, float)
    return grow_forest(data[:, 1:], data[:, 0])


def train(spark: SparkSession, findings: list | None = None) -> list:
    """A forest from labelled findings (label, value, left, right, source); the features come from the same column
    expressions that score texts. The list is bounded by its maker: 3,000 invented findings by default."""
    rows = findings or labelled_findings()
    df = spark.createDataFrame(rows, "label int, value string, left string, right string, source string")
    of = features(F.col("value"), F.col("left"), F.col("right"), F.col("source"))
    got = df.coalesce(1).select(F.col("label").cast("double"), *[of[k].alias(k) for k in FEATURES]).collect()
    return _forest_of(tuple(sorted(tuple(r) for r in got)))


def starts(parts: Column, own: Column) -> Column:
    """Where each candidate starts: running sums of the lengths of what lies between (parts) and of candidates (own). Sums
    within blocks and sums of whole blocks, so the cost is in proportion to the number of candidates."""
    total = lambda x: F.aggregate(x, F.lit(0), lambda a, v: a + v)
    every = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    lengths = F.transform(own, lambda v, i: F.length(v) + F.length(F.get(parts, i)))

    def of(x: Column) -> Column:
        sums = F.transform(every(F.ceil(F.size(x) / BLOCK).cast("int")), lambda b: total(F.slice(x, b * BLOCK + 1, BLOCK)))
        before = let(sums, lambda s: F.transform(s, lambda _, b: total(F.slice(s, 1, b))))
        return let(before, lambda c: F.transform(x, lambda _, i: F.get(c, F.floor(i / BLOCK).cast("int")) + total(F.slice(x, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK)) + F.length(F.get(parts, i))))

    return let(lengths, of)


def findings_column(text: Column, source: Column, forest: list) -> Column:
    """Array of candidates in text order: (start, value, score), start in code points from 0. A candidate's neighbours are
    put together from the pieces next to it, never cut out of the whole text."""

    def of(t: Column) -> Column:
        between = F.split(t, CANDIDATE)
        found = F.regexp_extract_all(t, F.lit(CANDIDATE), F.lit(0))

        def placed(parts: Column, own: Column) -> Column:
            tails = F.transform(own, lambda v, i: F.struct(F.right(F.get(parts, i), F.lit(REACH)).alias("p"), F.right(v, F.lit(REACH)).alias("v")))
            heads = F.transform(own, lambda v, i: F.struct(F.left(v, F.lit(REACH)).alias("v"), F.left(F.get(parts, i + 1), F.lit(REACH)).alias("p")))
            text_of = lambda x, *names: F.array_join(F.transform(x, lambda e: F.concat(*[e[n] for n in names])), "")
            left = lambda a, i: F.concat(text_of(F.slice(a, F.greatest(i - NEAR + 1, F.lit(1)), F.least(i, F.lit(NEAR))), "p", "v"), F.get(a, i)["p"])
            right = lambda b, i: F.concat(F.get(b, i)["p"], text_of(F.slice(b, i + 2, NEAR), "v", "p"))
            return let(starts(parts, own), lambda at: let(tails, lambda a: let(heads, lambda b: F.transform(own, lambda v, i: F.struct(
                F.get(at, i).alias("start"), v.alias("value"), F.right(left(a, i), F.lit(REACH)).alias("left"), F.left(right(b, i), F.lit(REACH)).alias("right"),
            )))))

        return let(between, lambda parts: let(found, lambda own: placed(parts, own)))

    numbers = F.transform(of(text), lambda m: F.struct(m["start"].alias("start"), m["value"].alias("value"), *[v.cast("double").alias(k) for k, v in features(m["value"], m["left"], m["right"], source).items()]))
    return F.transform(numbers, lambda m: F.struct(m["start"].alias("start"), m["value"].alias("value"), vote(forest, {k: m[k] for k in FEATURES}).alias("score")))


def scan(docs: DataFrame, forest: list, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text", source_col: str | None = "source") -> DataFrame:
    """One row per candidate: id, start, length, value, score, is_secret (score >= threshold).

    Row-wise, without a shuffle. Null and empty texts have no candidates and give no rows; a null source counts as
    empty; repeated rows repeat their findings; other columns are ignored.
    """
    source = F.coalesce(F.col(source_col), F.lit("")) if source_col and source_col in docs.columns else F.lit("")
    one = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"), source.alias("s"))
    rows = one.where(F.col("t").rlike(CANDIDATE)).select("id", F.explode(findings_column(F.col("t"), F.col("s"), forest)).alias("m"))
    return rows.select(
        F.col("id").alias(id_col), F.col("m.start").cast("long").alias("start"), F.length("m.value").cast("long").alias("length"),
        F.col("m.value").alias("value"), F.round("m.score", 6).alias("score"), (F.col("m.score") >= threshold).alias("is_secret"),
    )


def redact(docs: DataFrame, forest: list, threshold: float = 0.5, mask: str = "[SECRET]", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """docs with each secret replaced by mask; everything else, null texts too, stays as it is."""
    source = F.coalesce(F.col(source_col), F.lit("")) if source_col in docs.columns else F.lit("")
    text = F.col(text_col)
    between = F.split(text, CANDIDATE)
    shown = F.transform(findings_column(text, source, forest), lambda m: F.when(m["score"] >= threshold, F.lit(mask)).otherwise(m["value"]))
    joined = let(shown, lambda s: let(between, lambda p: F.array_join(F.transform(p, lambda x, i: F.concat(x, F.coalesce(F.get(s, i), F.lit("")))), "")))
    return docs.withColumn(text_col, F.when(text.rlike(CANDIDATE), joined).otherwise(text)).select(docs.columns)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"), train(spark))
    return found.withColumn("value_sha256", F.sha2("value", 256)).drop("value")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: secrets become a mask; no document goes. Null and empty texts, texts without candidates, null ids
    and repeated rows stay as they are; without a source column the source counts as empty."""
    return redact(docs, train(spark))
