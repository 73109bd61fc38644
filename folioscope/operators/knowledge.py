"""Items of yearly and merged frameworks: kinds of input, relations, consolidation, governance, audits, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Vocabularies and limits that must be these for equal results.
RELATIONS = ["duplicate", "refinement", "extension", "application", "example", "evidence", "exception", "contradiction", "supersession", "parallel", "new"]
VERDICTS = [(20, "merge"), (16, "merge_with_note"), (12, "make_sub_item"), (8, "link"), (4, "keep_both"), (0, "unrelated")]
IMPORTANCE = ["high", "medium", "low"]
TIME_HORIZONS = ["short", "medium", "long", "permanent"]


def input_type(json: Column) -> Column:
    """master where the text has categories, yearly where it has a letter's data, else unknown; not_json where it is none."""
    v = F.try_parse_json(json)
    has = lambda k: F.try_variant_get(v, f"$.{k}", "variant").isNotNull()
    return F.when(v.isNull(), "not_json").when(has("categories"), "master").when(has("letter_metadata") | has("year"), "yearly").otherwise("unknown")


def long_form(rows: DataFrame, key: str, json: str, arrays: list[str]) -> DataFrame:
    """(key, list, pos, id, text) of the items of several arrays of JSON texts. Items are texts, or objects whose text has
    one of three names."""
    v = F.try_parse_json(json)
    structs = []
    for a in arrays:
        items = F.coalesce(F.try_variant_get(v, f"$.{a}", "array<variant>"), F.array().cast("array<variant>"))
        structs.append(F.transform(items, lambda x, i: _item(x, i)(a)))  # noqa: B023  used at once
    return rows.select(key, F.explode(F.concat(*structs)).alias("x")).select(key, "x.*")


def _item(x: Column, i: Column):
    text = F.coalesce(*[F.try_variant_get(x, f"$.{k}", "string") for k in ("principle", "flag", "model")], F.try_variant_get(x, "$", "string"))
    return lambda name: F.struct(F.lit(name).alias("list"), i.alias("pos"), F.try_variant_get(x, "$.id", "string").alias("id"), text.alias("text"))


def first_relation(relations: Column) -> Column:
    """Of several relations of a pair the one that comes first in the order of priority."""
    order = F.array(*map(F.lit, RELATIONS))
    return F.get(F.array_intersect(order, relations), F.lit(0))


def similarity_bucket(a: Column, b: Column) -> Column:
    """0 to 3 by the Jaccard similarity of two sets; two empty sets are 0."""
    j = F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b)))
    return F.when(j >= 0.75, 3).when(j >= 0.5, 2).when(j >= 0.25, 1).otherwise(0)


def tribunal(score: Column) -> Column:
    """The verdict on a pair by the sum of its eight dimensions."""
    out = F.lit(VERDICTS[-1][1])
    for least, name in reversed(VERDICTS[:-1]):
        out = F.when(score >= least, name).otherwise(out)
    return out


def must_merge(items: DataFrame, question: str, id_: str) -> DataFrame:
    """Questions that several items have as their first, with the smallest id, into which the others go."""
    return items.groupBy(question).agg(F.count(F.lit(1)).alias("n_items"), F.min(id_).alias("into")).where("n_items > 1")


def governance(items: DataFrame, category: str, allowed: list[str], before: DataFrame | None = None) -> DataFrame:
    """(category, n_items, finding) per category: unknown ones, and those of a single item; new ones beyond one more than
    before are too many."""
    n = items.groupBy(category).agg(F.count(F.lit(1)).alias("n_items"))
    out = n.withColumn("finding", F.when(~F.col(category).isin(allowed), "unknown").when(F.col("n_items") == 1, "single_item").otherwise(""))
    if before is None:
        return out
    old = before.select(category).distinct().withColumn("_old", F.lit(True))
    new = out.join(old, category, "left")
    extra = F.count_if(F.col("_old").isNull()).over(Window.partitionBy(F.lit(0))) > 1  # one row per category
    return new.withColumn("finding", F.when(extra & F.col("_old").isNull() & (F.col("finding") == ""), "growth").otherwise(F.col("finding"))).drop("_old")


def metric_conflicts(items: DataFrame, metric: str, definition: str) -> DataFrame:
    """Metrics that have several definitions."""
    return items.groupBy(metric).agg(F.count_distinct(definition).alias("n_definitions")).where("n_definitions > 1")


def registry(concepts: DataFrame, index: DataFrame, concept: str, least: int = 3) -> DataFrame:
    """concepts with status: PASS with `least` items or more, PARTIAL with fewer, FAIL where it was due and has none,
    NOT_YET where it isn't due. concepts: (concept, due)."""
    n = index.groupBy(concept).agg(F.count(F.lit(1)).alias("n_items"))
    both = concepts.join(n, concept, "left").withColumn("n_items", F.coalesce("n_items", F.lit(0).cast("long")))
    return both.withColumn("status", F.when(F.col("n_items") >= least, "PASS").when(F.col("n_items") > 0, "PARTIAL").when(F.col("due"), "FAIL").otherwise("NOT_YET"))


def renamed(rows: DataFrame, label: str, old: dict[str, str]) -> DataFrame:
    """rows with the old vocabulary's labels in the new one's words; labels of neither stay."""
    return rows.replace(old, subset=[label])


def markdown_items(rows: DataFrame, key: str, wanted: list[str]) -> DataFrame:
    """rows (key, idx, line) of markdown: (key, idx, heading, part, item) of bullets below the parts wanted; heading is the
    last one above, and a part is a bold line or a heading of a lower level."""
    w = Window.partitionBy(key).orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    head = F.regexp_extract("line", r"^#{1,2}\s+(.*\S)", 1)
    part = F.coalesce(F.nullif(F.regexp_extract("line", r"^#{3,6}\s+(.*\S)", 1), F.lit("")), F.nullif(F.regexp_extract("line", r"^\*\*(.*?):?\*\*", 1), F.lit("")))
    marked = rows.select(key, "idx", "line", F.nullif(head, F.lit("")).alias("_h"), part.alias("_p"))
    marked = marked.withColumn("heading", F.last("_h", ignorenulls=True).over(w)).withColumn("part", F.last(F.when(F.col("_h").isNotNull(), F.lit("")).otherwise(F.col("_p")), ignorenulls=True).over(w))
    item = F.regexp_extract("line", r"^\s*[-*]\s+(.*\S)", 1)
    return marked.where(F.lower("part").isin([x.lower() for x in wanted]) & (item != "")).select(key, "idx", "heading", "part", item.alias("item"))


def era(year: Column, bounds: dict[str, int]) -> Column:
    """The last era whose first year is not after the year."""
    out = F.lit(None).cast("string")
    for name, first in sorted(bounds.items(), key=lambda x: x[1]):
        out = F.when(year >= first, name).otherwise(out)
    return out


def update_summary(log: DataFrame, decision: str, incoming: int | Column) -> DataFrame:
    """One row: how many items each decision took, and whether they sum to what came in."""
    names = ("merged", "added", "linked", "rejected")
    sums = log.agg(*[F.count_if(F.col(decision) == n).alias(n) for n in names], F.count(F.lit(1)).alias("n_rows"))
    total = sum((F.col(n) for n in names), F.lit(0))
    return sums.withColumn("balanced", (total == F.col("n_rows")) & (F.col("n_rows") == incoming))


def review(scores: DataFrame, id_: str, dimensions: list[str], hard: list[str]) -> DataFrame:
    """Sum of the dimensions out of 100 and the verdict; a hard fail overrides any sum."""
    total = sum((F.col(c) for c in dimensions), F.lit(0))
    failed = F.lit(False)
    for c in hard:
        failed = failed | F.coalesce(F.col(c), F.lit(True))
    return scores.select(id_, total.alias("score"), F.when(failed, "FAIL").when(total >= 85, "PASS").when(total >= 70, "REVISE").otherwise("FAIL").alias("verdict"))


def traceability(items: DataFrame, group: str, excerpt: str, chunk: str) -> DataFrame:
    """Per group how many items have an excerpt, a chunk, both or neither."""
    e, c = F.col(excerpt).isNotNull(), F.col(chunk).isNotNull()
    return items.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.count_if(e).alias("with_excerpt"), F.count_if(c).alias("with_chunk"), F.count_if(e & c).alias("traced"), F.count_if(~e & ~c).alias("untraced"))


def growth_alarm(before: Column, after: Column, share: float = 0.15, most: int = 5) -> Column:
    """Whether a list grew by more than 15 % of what it had, or by more than five if that is less."""
    return (after - before) > F.least(before * share, F.lit(float(most)))


def vocabulary_findings(id_: Column, importance: Column, horizon: Column, tags: Column) -> Column:
    """Names of the rules that an item breaks: words outside the vocabulary, the form of its id, the number of its tags."""
    rules = [("id", ~id_.rlike(r"^\d{4}_\d{3}$")), ("importance", ~importance.isin(IMPORTANCE)), ("time_horizon", ~horizon.isin(TIME_HORIZONS)), ("tags", ~F.size(tags).between(3, 10))]
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True)), F.lit(k)) for k, c in rules]))


def resolve_tags(reports: DataFrame, key: str, text: str, known: DataFrame) -> DataFrame:
    """(key, kind, id, resolved) of the tags [DATA:id|...] and [WB:...|id] of reports; known: (kind, id)."""
    data = F.transform(F.regexp_extract_all(text, F.lit(r"\[DATA:([^|\]]+)"), F.lit(1)), lambda x: F.struct(F.lit("DATA").alias("kind"), x.alias("id")))
    cited = F.transform(F.regexp_extract_all(text, F.lit(r"\[WB:[^\]]*\|([^|\]]+)\]"), F.lit(1)), lambda x: F.struct(F.lit("WB").alias("kind"), x.alias("id")))
    tags = reports.select(key, F.explode(F.concat(data, cited)).alias("t")).select(key, "t.*")
    return tags.join(known.select("kind", "id", F.lit(True).alias("_k")), ["kind", "id"], "left").select(key, "kind", "id", F.coalesce("_k", F.lit(False)).alias("resolved"))


def daily_item(items: DataFrame, id_: str, day: Column) -> DataFrame:
    """The item of the day: the one with the smallest hash of id and day, so it is the same in every run."""
    return items.withColumn("_h", F.xxhash64(F.col(id_), day)).orderBy("_h", id_).limit(1).drop("_h")
