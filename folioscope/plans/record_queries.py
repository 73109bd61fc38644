"""Queries of record validation, links and drift: each rule meets a defect that was planted for it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as K
from ..operators import relate as R
from .catalogue import EVENT_KEYS, query, read

#: Literals of a record's keys where nothing is wrong; {k} is the number of the planted defect.
VALID = {
    "letter_year": "2016", "letter_date": '"2016-01-02"', "source_file": '"a.txt"', "section_title": '"T"', "section_hierarchy": "[]", "chunk_tier": "1", "parent_chunk_id": "null", "child_chunk_ids": "[]",
    "content_type": '"narrative"', "contextual_summary": '"S"', "has_table": "false", "table_data": "[]", "has_financial_data": "false", "entities": '{"companies": [], "people": [], "metrics": []}', "themes": "[]", "concepts": "[]",
    "principles": '[{"statement": "s", "category": "c"}]', "temporal_references": "{}", "cross_references": "{}", "retrieval_priority": '"low"', "abstraction_level": '"high"', "token_count": "450", "char_count": "9",
    "source_span": '{"start_char": 0, "end_char_exclusive": 9}', "standalone_exception": "false", "exception_reason": "null", "boundary_note": "null", "merged_from": "[]",
}
#: (what is changed, findings) of each defect; content and id are the record's own keys, None leaves a key out.
DEFECTS = [
    ({}, []), ({"content": "repeat('x', 10)"}, ["WARN content_short"]), ({"content": "repeat('x', 25001)"}, ["WARN content_long"]), ({"extra": "1"}, ["ERROR unexpected_keys"]), ({"token_count": '"450"'}, ["ERROR metadata_type:token_count"]),
    ({"letter_year": "true"}, []), ({"chunk_tier": "3"}, ["ERROR tier", "ERROR tier_of_id"]), ({"content_type": '"x"'}, ["ERROR content_type"]), ({"retrieval_priority": '"x"'}, ["ERROR retrieval_priority"]), ({"abstraction_level": '"x"'}, ["ERROR abstraction_level"]),
    ({"has_table": "true"}, ["ERROR table_flag"]), ({"content_type": '"financial_table"'}, ["ERROR table_type"]), ({"id": "2016-S03-T2-001"}, ["ERROR tier_of_id"]), ({"source_span": '{"start_char": 5, "end_char_exclusive": 5}'}, ["ERROR span"]),
    ({"entities": '{"companies": [], "metrics": []}'}, ["ERROR entities:people"]), ({"principles": '[{"statement": "s", "category": "c", "x": 1}]'}, ["ERROR principles"]), ({"letter_date": '"March 14, 1978"'}, ["ERROR letter_date"]), ({"letter_date": '"0000-00-00"'}, []),
    ({"chunk_tier": "2", "id": "2016-S03-T2-001"}, ["ERROR tier2_orphan"]), ({"parent_chunk_id": '"2016-S03-T1-001"'}, ["WARN tier1_parent"]), ({"principles": '["s"]'}, ["ERROR principles"]), ({"themes": None}, ["ERROR missing_metadata:themes"]),
    ({"source_span": '{"start_char": 0, "end_char_exclusive": 0}'}, []), ({"child_chunk_ids": "{}"}, ["ERROR metadata_type:child_chunk_ids"]), ({"id": "2016-S3-T1-2"}, ["WARN chunk_id_format"]), ({"merged_from": "null"}, ["ERROR metadata_type:merged_from"]),
]


def _record(changes: dict, s: str) -> str:
    keys = {**VALID, **{k: v for k, v in changes.items() if k not in ("content", "id")}}
    body = ", ".join(f'"{k}": {v}' for k, v in keys.items() if v is not None)
    head = '{"chunk_id": "' + changes.get("id", "2016-S03-T1-001") + '", "content": "'
    return f"concat('{head}', {changes.get('content', chr(39) + 'x' * 100 + chr(39))}, '\", \"metadata\": {{{body}}}}}')"


def planted(s: str) -> str:
    return f"case doc_id % {len(DEFECTS)} " + " ".join(f"when {k} then {_record(c, s)}" for k, (c, _) in enumerate(DEFECTS)) + " end"


@query(
    f"""with f as (select source file, doc_id pos, case doc_id % {len(DEFECTS)} when 12 then '2016-S03-T2-001' when 18 then '2016-S03-T2-001' when 24 then '2016-S3-T1-2' else '2016-S03-T1-001' end chunk_id, unnest(case doc_id % {len(DEFECTS)} {" ".join(f"when {k} then {f}::varchar[]" for k, (_, f) in enumerate(DEFECTS))} end) f from documents)
    select file, pos, chunk_id, string_split(f, ' ')[1] as level, string_split(f, ' ')[2] as rule from f"""
)
def planted_defects(spark, d):
    """Whole records with one defect each, or none."""
    return K.validate(read(spark, d, "documents").select(F.col("source").alias("file"), F.col("doc_id").alias("pos"), F.expr(planted("string")).alias("json")))


NODES = "select p_partkey id, case when p_partkey % 3 = 0 then 1 else 2 end tier, case when p_partkey % 3 = 0 then null when p_partkey % 7 = 0 then -p_partkey when p_partkey % 11 = 0 then p_partkey + (4 - p_partkey % 3) % 3 else p_partkey - p_partkey % 3 end parent from part"
CHILDREN = "case when id % 3 <> 0 then {none} when id % 5 = 0 then {odd} else {both} end"


@query(
    f"""with n as ({NODES}), r as (select *, {CHILDREN.format(none='[]::bigint[]', odd='[id + 1, id + 4, -1]', both='[id + 1, id + 2]')} kids from n),
    u as (select r.id, p.tier, r.parent other from r left join r p on r.parent = p.id where r.parent is not null), k as (select id, unnest(kids) other from r), d as (select k.id, c.id found, c.parent, k.other from k left join r c on k.other = c.id)
    select id, 'ERROR' as level, case when tier is null then 'parent_not_found' else 'parent_not_tier1' end as rule, other from u where tier is null or tier <> 1
    union all select id, case when found is null then 'ERROR' else 'WARN' end, case when found is null then 'child_not_found' else 'child_points_elsewhere' end, other from d where found is null or parent is distinct from id"""
)
def link_findings(spark, d):
    """Parents and children that don't exist, are of the wrong tier, or don't point back."""
    read(spark, d, "part").createOrReplaceTempView("folioscope_parts")
    n = spark.sql(NODES.replace("from part", "from folioscope_parts"))
    kids = CHILDREN.format(none="cast(array() as array<bigint>)", odd="array(id + 1, id + 4, cast(-1 as bigint))", both="array(id + 1, id + 2)")
    return K.link_findings(n.withColumn("children", F.expr(kids)))


@query("select source file, doc_id % 40 id, count(*) copies, max(doc_id) as last from documents group by 1, 2 having count(*) > 1")
def duplicate_ids(spark, d):
    rows = read(spark, d, "documents").select(F.col("source").alias("file"), (F.col("doc_id") % 40).alias("id"), F.col("doc_id").alias("pos"))
    return K.duplicate_ids(rows, "file", "id", "pos")


@query(
    f"""with e as ({EVENT_KEYS}), t as (select event_type || '-' || (event_id % 5)::varchar g, props from events where props is not null),
    k as (select g, unnest(json_keys(cast(props as json))) k from t), o as (select g, list_sort(list(distinct case when g like '%-4' and k = (select min(k) from e) then 'other' else k end)) own from k group by 1),
    m as (select own mode from o group by own order by count(*) desc, min(g) limit 1), d as (select g, array_to_string(list_sort(list_filter(own, lambda v: not list_contains(mode, v))), ',') extra, array_to_string(list_sort(list_filter(mode, lambda v: not list_contains(own, v))), ',') missing from o, m)
    select * from d where extra <> '' or missing <> ''"""
)
def signature_drift(spark, d):
    """Groups whose keys are not those of most groups; one group in five has a key by another name."""
    e = read(spark, d, "events").where("props is not null").select(F.concat("event_type", F.lit("-"), (F.col("event_id") % 5).cast("string")).alias("g"), F.explode(F.json_object_keys("props")).alias("k"))
    least = e.agg(F.min("k").alias("least"))  # one row
    pairs = e.crossJoin(F.broadcast(least)).select("g", F.when(F.col("g").endswith("-4") & (F.col("k") == F.col("least")), "other").otherwise(F.col("k")).alias("k"))
    return K.signature_drift(pairs, "g", "k")


TREE = """concat('{{"id": ', cast(doc_id as {s}), ', "tags": ', case when doc_id % 2 = 0 then '[]' else '["a", 1, null]' end, ', "meta": {{"a": [{{"b": 1.5}}, {{"c": true}}], "d": {{}}}}}}')"""


@query(
    """select doc_id, unnest(['id', 'tags', 'tags[]', 'meta', 'meta.a', 'meta.a[]', 'meta.a[].b', 'meta.a[].c', 'meta.d'] || case when doc_id % 2 = 0 then [] else ['tags[]', 'tags[]'] end) path,
    unnest(['int', 'list', case when doc_id % 2 = 0 then null else 'str' end, 'dict', 'list', 'dict', 'float', 'bool', 'dict'] || case when doc_id % 2 = 0 then [] else ['int', 'null'] end) as type from documents"""
)
def flatten_paths(spark, d):
    return K.flatten_paths(read(spark, d, "documents").select("doc_id", F.expr(TREE.format(s="string")).alias("json")), "doc_id", "json")


@query(
    """select source file, doc_id pos, case doc_id % 4 when 0 then 'high' else 'medium' end retrieval_priority, 'medium' abstraction_level, case doc_id % 4 when 0 then 'philosophy' else 'narrative' end content_type, '0000-00-00' letter_date,
    case doc_id % 4 when 0 then 2 when 1 then 2 else 1 end chunk_tier, case doc_id % 4 when 1 then 450 else 0 end token_count,
    ['E002:abstraction_level,E002:letter_date,E002:token_count', 'E002:abstraction_level,E002:letter_date,E003:chunk_tier,E003:token_count,W001:content_type,W001:retrieval_priority', 'E001', 'E002:abstraction_level,E002:chunk_tier,E002:content_type,E002:letter_date,E002:retrieval_priority,W001:token_count'][1 + doc_id % 4] codes from documents"""
)
def repair_records(spark, d):
    """Fields filled in, coerced or set to the nearest valid value; codes sorted."""
    json = F.expr("""element_at(array('{"metadata": {"retrieval_priority": "high", "content_type": "philosophy", "chunk_tier": 2}}', '{"metadata": {"retrieval_priority": "urgent", "content_type": "x", "chunk_tier": "2", "token_count": "450"}}', 'no json', '{"metadata": {"token_count": -3}}'), cast(1 + doc_id % 4 as int))""")
    out = K.repair(read(spark, d, "documents").select(F.col("source").alias("file"), F.col("doc_id").alias("pos"), json.alias("json")))
    order = F.array_join(F.array_sort(F.split("codes", ",")), ",")
    return out.withColumn("codes", order)


@query("select conv_id, turn, coalesce(nullif(lag(s) over w, ''), lag(role) over w) previous_summary, coalesce(nullif(lead(s) over w, ''), lead(role) over w) next_summary from (select *, case when turn % 2 = 0 then text else '' end s from conversations) window w as (partition by conv_id order by turn)")
def summary_fallback(spark, d):
    """Neighbours' summaries; an empty one gives way to the second kind."""
    rows = read(spark, d, "conversations").select("conv_id", "turn", F.coalesce(F.nullif(F.when(F.col("turn") % 2 == 0, F.col("text")).otherwise(""), F.lit("")), "role").alias("s"))
    return R.neighbours(rows, "conv_id", "turn", F.col("s")).drop("s")


@query("with r as (select *, turn - min(turn) over (partition by conv_id) + 1 + case when turn % 7 = 6 then 1 else 0 end seq from conversations) select conv_id, turn, seq - row_number() over (partition by conv_id order by turn) = 0 contiguous from r")
def id_contiguity(spark, d):
    from pyspark.sql import Window

    c = read(spark, d, "conversations").select("conv_id", "turn")
    seq = F.col("turn") - F.min("turn").over(Window.partitionBy("conv_id")) + 1 + F.when(F.col("turn") % 7 == 6, 1).otherwise(0)
    return c.select("conv_id", "turn", (seq - F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) == 0).alias("contiguous"))


@query("select level, rule, n from (select *, row_number() over (order by n desc, rule) r from (select string_split(f, ' ')[1] as level, string_split(f, ' ')[2] as rule, count(*) n from (select unnest(case doc_id % " + str(len(DEFECTS)) + " " + " ".join(f"when {k} then {f}::varchar[]" for k, (_, f) in enumerate(DEFECTS)) + " end) f from documents) group by 1, 2)) where r <= 10")
def first_diagnostics(spark, d):
    """The ten commonest findings."""
    return planted_defects(spark, d).groupBy("level", "rule").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "rule").limit(10)

