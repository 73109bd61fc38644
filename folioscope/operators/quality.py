"""Record validation over raw JSON: each rule is a finding; one scan, no crash on any shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ARRAY, OBJECT, STRING, BOOLEAN, INTEGER = "array", "object", "string", "boolean", "integer"
#: The 28 keys of a record's metadata with their type; a trailing ? allows null. The key of concepts can be renamed.
METADATA = {
    "letter_year": INTEGER, "letter_date": STRING, "source_file": STRING, "section_title": STRING, "section_hierarchy": ARRAY,
    "chunk_tier": INTEGER, "parent_chunk_id": "string?", "child_chunk_ids": ARRAY, "content_type": STRING, "contextual_summary": STRING,
    "has_table": BOOLEAN, "table_data": ARRAY, "has_financial_data": BOOLEAN, "entities": OBJECT, "themes": ARRAY, "concepts": ARRAY,
    "principles": ARRAY, "temporal_references": OBJECT, "cross_references": OBJECT, "retrieval_priority": STRING, "abstraction_level": STRING,
    "token_count": INTEGER, "char_count": INTEGER, "source_span": OBJECT, "standalone_exception": BOOLEAN, "exception_reason": "string?",
    "boundary_note": "string?", "merged_from": ARRAY,
}
LEVELS = ["low", "medium", "high"]
CONTENT_TYPES = ["philosophy", "narrative", "financial_table", "performance_summary"]


def kind(json: Column, path: str) -> Column:
    """array, object, string, boolean, integer, double or null of the value at a path; SQL null where it is missing."""
    return kind_of(F.try_variant_get(json, path, "variant"))


def kind_of(value: Column) -> Column:
    """kind of a variant. Its schema is told once: as an argument, since a chain of conditions tells it in each."""
    named = lambda s: (
        F.when(s.isNull(), F.lit(None).cast("string"))
        .when(s.startswith("ARRAY"), ARRAY).when(s.startswith("OBJECT"), OBJECT).when(s == "STRING", STRING).when(s == "BOOLEAN", BOOLEAN)
        .when(s == "BIGINT", INTEGER).when(s == "VOID", "null").otherwise("double")
    )
    return F.get(F.transform(F.array(F.schema_of_variant(value)), named), F.lit(0))


def validate(records: DataFrame, metadata: dict[str, str] = METADATA, content_types: list[str] = CONTENT_TYPES) -> DataFrame:
    """(file, pos, chunk_id, level, rule) from (file, pos, json string). A text that is not JSON or not an object is one
    finding. All rules of a record come from one array, so the table is scanned once; a record is parsed once, and the kinds
    of its metadata are told once, whatever the number of rules."""
    v = records.withColumn("v", F.try_parse_json("json"))
    v = v.withColumn("m", F.try_variant_get("v", "$.metadata", "map<string,variant>"))
    v = v.withColumn("kinds", F.transform_values("m", lambda _, x: kind_of(x))).withColumn("id_kind", kind(F.col("v"), "$.chunk_id")).withColumn("text_kind", kind(F.col("v"), "$.content"))
    text = lambda p: F.try_variant_get("v", p, "string")
    number = lambda p: F.try_variant_get("v", p, "bigint")
    boolean = lambda p: F.try_variant_get("v", p, "boolean")
    finding = lambda level, rule, cond: F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(level).alias("level"), F.lit(rule).alias("rule")))
    error, warn = (lambda r, c: finding("ERROR", r, c)), (lambda r, c: finding("WARN", r, c))
    there = lambda p: F.try_variant_get("v", p, "variant").isNotNull()
    at = lambda name: F.try_element_at("kinds", F.lit(name))
    is_object = F.col("m").isNotNull()
    rules = [
        error("missing_key:" + p, ~there("$." + p)) for p in ("chunk_id", "content", "metadata")
    ] + [
        error("wrong_type:chunk_id", F.col("id_kind") != STRING), error("wrong_type:content", F.col("text_kind") != STRING), error("metadata_not_object", there("$.metadata") & ~is_object),
        warn("chunk_id_format", (F.col("id_kind") == STRING) & ~text("$.chunk_id").rlike(r"^\d{4}-S\d{2}-T[12]-\d{3}$")),
        warn("content_short", (F.col("text_kind") == STRING) & (F.length(F.trim(text("$.content"))) < 80)),
        warn("content_long", (F.col("text_kind") == STRING) & (F.length(text("$.content")) > 25000)),
        error("unexpected_keys", is_object & (F.size(F.array_except(F.map_keys("m"), F.array(*map(F.lit, metadata)))) > 0)),
        error("tier", is_object & ~number("$.metadata.chunk_tier").isin(1, 2)),
        error("content_type", (at("content_type") == STRING) & ~text("$.metadata.content_type").isin(content_types)),
        error("retrieval_priority", (at("retrieval_priority") == STRING) & ~text("$.metadata.retrieval_priority").isin(LEVELS)),
        error("abstraction_level", (at("abstraction_level") == STRING) & ~text("$.metadata.abstraction_level").isin(LEVELS)),
        error("table_flag", boolean("$.metadata.has_table") != there("$.metadata.table_data[0]")),
        error("table_type", (text("$.metadata.content_type") == "financial_table") & ~boolean("$.metadata.has_table")),
        error("tier_of_id", number("$.metadata.chunk_tier") != F.regexp_extract(text("$.chunk_id"), r"-T(\d)-", 1).try_cast("bigint")),
        error("span", ~((number("$.metadata.source_span.start_char") < number("$.metadata.source_span.end_char_exclusive")) | ((number("$.metadata.source_span.start_char") == 0) & (number("$.metadata.source_span.end_char_exclusive") == 0)))),
        error("letter_date", (at("letter_date") == STRING) & ~text("$.metadata.letter_date").rlike(r"^\d{4}-\d{2}-\d{2}$")),
        warn("tier1_parent", (number("$.metadata.chunk_tier") == 1) & text("$.metadata.parent_chunk_id").isNotNull()),
        error("tier2_orphan", (number("$.metadata.chunk_tier") == 2) & text("$.metadata.parent_chunk_id").isNull()),
    ]
    items = F.from_json(F.get_json_object("json", "$.metadata.principles"), "array<variant>")
    rules.append(error("principles", F.exists(items, lambda x: F.schema_of_variant(x) != "OBJECT<category: STRING, statement: STRING>")))
    for e in ("companies", "people", "metrics"):
        rules.append(error("entities:" + e, (at("entities") == OBJECT) & (F.coalesce(kind(F.col("v"), "$.metadata.entities." + e), F.lit("")) != ARRAY)))
    for name, want in metadata.items():
        plain = want.rstrip("?")
        rules.append(error("missing_metadata:" + name, is_object & at(name).isNull()))
        allowed = [plain] + ["null"] * want.endswith("?") + [BOOLEAN] * (plain == INTEGER)  # a boolean passes as an integer
        rules.append(error("metadata_type:" + name, is_object & ~at(name).isin(allowed)))
    whole = F.when(F.col("v").isNull(), F.array(F.struct(F.lit("ERROR").alias("level"), F.lit("not_json").alias("rule")))).when(
        F.try_variant_get("v", "$", "map<string,variant>").isNull(), F.array(F.struct(F.lit("ERROR").alias("level"), F.lit("not_object").alias("rule")))
    )
    found = F.coalesce(whole, F.array_compact(F.array(*rules)))
    return v.select("file", "pos", text("$.chunk_id").alias("chunk_id"), F.explode(found).alias("f")).select("file", "pos", "chunk_id", "f.level", "f.rule")


def rollup_findings(findings: DataFrame) -> DataFrame:
    """Errors, warnings and exit code per file; exit code 2 with errors, 1 with warnings, 0 without."""
    of = lambda level: F.count_if(F.col("level") == level)
    sums = findings.groupBy("file").agg(of("ERROR").alias("errors"), of("WARN").alias("warnings"))
    return sums.withColumn("exit_code", F.when(F.col("errors") > 0, 2).when(F.col("warnings") > 0, 1).otherwise(0))


def duplicates(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """Every repeat after the first of a key, with the first's order value."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("n", F.row_number().over(w)).withColumn("first_in", F.first(order[0]).over(w)).where("n > 1").drop("n")


def signatures(rows: DataFrame, group: str, key: str, kind_: str) -> DataFrame:
    """Sorted distinct key:type pairs per group as one string."""
    return rows.groupBy(group).agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws(":", key, kind_))), ",").alias("signature"))


def mode_signature(signed: DataFrame, group: str) -> DataFrame:
    """The commonest signature; of equally common ones the one that the smallest group has."""
    return signed.groupBy("signature").agg(F.count(F.lit(1)).alias("n"), F.min(group).alias("first_group")).orderBy(F.desc("n"), "first_group").limit(1)


def path_diff(base: DataFrame, other: DataFrame) -> DataFrame:
    """(path, status, base_types, other_types) of (path, type) rows: missing, extra, mismatch or same. Int and float
    are compatible; an empty type set is not compatible with a filled one."""
    sets = lambda d, name: d.groupBy("path").agg(F.array_join(F.array_sort(F.collect_set("type")), "|").alias(name))
    both = sets(base, "base_types").join(sets(other, "other_types"), "path", "full_outer")
    numeric = lambda c: F.col(c).isin("int", "float", "float|int")
    status = (
        F.when(F.col("other_types").isNull(), "missing").when(F.col("base_types").isNull(), "extra")
        .when((F.col("base_types") == F.col("other_types")) | (numeric("base_types") & numeric("other_types")), "same").otherwise("mismatch")
    )
    return both.select("path", status.alias("status"), "base_types", "other_types")


def duplicate_ids(rows: DataFrame, file: str, id_: str, pos: str) -> DataFrame:
    """Ids that a file has more than once: (file, id, copies, last), where the record at `last` is the one that counts."""
    return rows.groupBy(file, id_).agg(F.count(F.lit(1)).alias("copies"), F.max(pos).alias("last")).where("copies > 1")


def link_findings(rows: DataFrame, id_: str = "id", tier: str = "tier", parent: str = "parent", children: str = "children") -> DataFrame:
    """(id, level, rule, other) of links that lead nowhere or one way only: parents that don't exist or are no first tier,
    children that don't exist or name another parent."""
    all_ = rows.select(F.col(id_).alias("other"), F.col(tier).alias("_t"), F.col(parent).alias("_p"))
    up = rows.where(F.col(parent).isNotNull()).select(F.col(id_).alias("id"), F.col(parent).alias("other")).join(all_, "other", "left")
    down = rows.select(F.col(id_).alias("id"), F.explode(children).alias("other")).join(all_, "other", "left")
    finding = lambda level, rule: F.struct(F.lit(level).alias("level"), F.lit(rule).alias("rule"))
    up = up.withColumn("f", F.when(F.col("_t").isNull(), finding("ERROR", "parent_not_found")).when(F.col("_t") != 1, finding("ERROR", "parent_not_tier1")))
    down = down.withColumn("f", F.when(F.col("_t").isNull(), finding("ERROR", "child_not_found")).when(~F.col("_p").eqNullSafe(F.col("id")), finding("WARN", "child_points_elsewhere")))
    return up.unionByName(down).where("f is not null").select("id", "f.level", "f.rule", "other")


def signature_drift(pairs: DataFrame, group: str, pair: str) -> DataFrame:
    """(group, extra, missing) of groups whose set of key:type pairs is not the commonest one (of equally common ones that of
    the smallest group). One row per group is what is compared; the commonest is one row, so it is broadcast."""
    own = pairs.groupBy(group).agg(F.array_sort(F.collect_set(pair)).alias("own"))
    mode = own.groupBy("own").agg(F.count(F.lit(1)).alias("n"), F.min(group).alias("first")).orderBy(F.desc("n"), "first").limit(1).select(F.col("own").alias("mode"))
    both = own.crossJoin(F.broadcast(mode))
    diff = lambda a, b: F.array_join(F.array_sort(F.array_except(a, b)), ",")
    return both.select(group, diff("own", "mode").alias("extra"), diff("mode", "own").alias("missing")).where("extra <> '' or missing <> ''")


def flatten_paths(rows: DataFrame, key: str, json: str) -> DataFrame:
    """(key, path, type) of every value of JSON texts, each once: p, p.k of objects, p[] of elements; an empty array gives
    p[] with a null type. Recursion over any depth has no column form, so it runs on Arrow batches, row by row apart."""
    import json as J
    from collections.abc import Iterator

    import pandas as pd

    kind = lambda x: "bool" if isinstance(x, bool) else {int: "int", float: "float", str: "str", dict: "dict", list: "list"}.get(type(x), "null")

    def paths(text: str) -> list:
        try:
            todo = [("", J.loads(text))]
        except (TypeError, ValueError):
            return []
        found = {}
        while todo:
            path, x = todo.pop()
            if path:
                found[path, kind(x)] = None
            if isinstance(x, dict):
                todo += [(f"{path}.{k}" if path else k, v) for k, v in x.items()]
            elif isinstance(x, list):
                todo += [(path + "[]", v) for v in x]
                if not x:
                    found[path + "[]", None] = None
        return list(found)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(k, p, t) for k, text in zip(b[key], b[json], strict=True) for p, t in paths(text)], columns=[key, "path", "type"])

    return rows.select(key, json).mapInPandas(run, f"{key} {rows.schema[key].dataType.simpleString()}, path string, type string")


#: What repair() puts where a field is missing or wrong.
DEFAULTS = {"retrieval_priority": "medium", "abstraction_level": "medium", "content_type": "narrative", "letter_date": "0000-00-00"}


def repair(records: DataFrame) -> DataFrame:
    """records (file, pos, json) with chunk_tier, token_count and the fields of DEFAULTS made valid, and the codes of what was
    done: E001 not JSON, E002 a field is missing, E003 a type is coerced, W001 a value is replaced by the nearest valid one."""
    v = records.withColumn("v", F.try_parse_json("json"))
    text = lambda k: F.try_variant_get("v", f"$.metadata.{k}", "string")
    allowed = {"retrieval_priority": LEVELS, "abstraction_level": LEVELS, "content_type": CONTENT_TYPES}
    out, codes = [], [F.when(F.col("v").isNull(), "E001")]
    for k, default in DEFAULTS.items():
        good = text(k).isin(allowed[k]) if k in allowed else text(k).rlike(r"^\d{4}-\d{2}-\d{2}$")
        out.append(F.when(good, text(k)).otherwise(default).alias(k))
        codes.append(F.when(F.col("v").isNotNull(), F.when(text(k).isNull(), F.lit("E002:" + k)).when(~good, F.lit("W001:" + k))))
    for k, low, high, default in (("chunk_tier", 1, 2, 1), ("token_count", 0, None, 0)):
        n = text(k).try_cast("bigint")
        near = F.greatest(n, F.lit(low)) if high is None else F.least(F.greatest(n, F.lit(low)), F.lit(high))
        out.append(F.coalesce(near, F.lit(default)).cast("bigint").alias(k))
        coerced = kind(F.col("v"), f"$.metadata.{k}") != INTEGER
        codes.append(F.when(F.col("v").isNotNull(), F.when(text(k).isNull(), F.lit("E002:" + k)).when(coerced, F.lit("E003:" + k)).when(near != n, F.lit("W001:" + k))))
    return v.select("file", "pos", *out, F.array_join(F.array_compact(F.array(*codes)), ",").alias("codes"))
