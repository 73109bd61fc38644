"""Registered queries and the SQL that they are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import fundamentals as N
from ..operators import quality as K
from ..operators import relate as R
from ..operators import retrieval as O
from ..operators import segment as S

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def documents(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").withColumn("text", F.coalesce("text", F.lit("")))


STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"

# -- documents: profile, lines, packing -------------------------------------------------------------------------------


@query(
    r"""select doc_id, length(t) n_characters, len(list_filter(regexp_split_to_array(t, '\s+'), lambda w: w <> '')) n_words,
    len(list_filter(regexp_split_to_array(t, '\n\s*\n'), lambda p: trim(p) <> '')) n_paragraphs, string_split(t, chr(10))[1] opening_line
    from (select doc_id, coalesce(text, '') t from documents)"""
)
def doc_profile(spark, d):
    t = F.col("text")
    return documents(spark, d).select("doc_id", F.length(t).cast("long").alias("n_characters"), T.word_count(t).alias("n_words"), T.paragraph_count(t).alias("n_paragraphs"), F.element_at(F.split(t, "\n"), 1).alias("opening_line"))


@query(
    rf"""select doc_id, i - 1 idx, length({STRIP.format('l')}) n_trimmed, l line from (select doc_id, unnest(s) l, generate_subscripts(s, 1) i
    from (select doc_id, string_split(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), chr(10)) s from documents))"""
)
def line_explode_clean(spark, d):
    return S.exploded(documents(spark, d), T.lines(F.col("text")), "doc_id").select("doc_id", F.col("idx").cast("long").alias("idx"), F.length(T.strip(F.col("line"))).cast("long").alias("n_trimmed"), "line")


def pack_sql(target: int, most: int, previous: str, body: str) -> str:
    return rf"""with recursive p as (select doc_id, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda l: {STRIP.format('l')}), lambda l: l <> '') ps from documents),
r(doc_id, i, tok, no, prev, shut) as (
  select doc_id, 0, 0::bigint, 0, '', false from p
  union all
  select doc_id, i + 1,
    case when keep then tok + n when tok > 0 and tok + n > {most} then n else tok + n end,
    case when keep then no when tok > 0 and tok + n > {most} then no + 1 when shut then no + 1 else no end,
    x, (case when keep then false else (case when tok > 0 and tok + n > {most} then n else tok + n end) >= {target} and not item end)
  from (select q.*, item and not shut and regexp_matches(prev, '{previous}') keep from (
    select r.doc_id, r.i, case when r.shut then 0 else r.tok end tok, r.no, r.prev, r.shut, p.ps[r.i + 1] x, length(p.ps[r.i + 1]) // 4 n, regexp_matches(p.ps[r.i + 1], '^[\[(]?\d+[\]).]') item
    from r join p using (doc_id) where r.i < len(p.ps)) q)),
c as (select doc_id, no, cast(sum(length(prev)) + 2 * (count(*) - 1) as bigint) n_chars from r where i > 0 group by doc_id, no)
{body}"""


def packed(spark, d, profile):
    chunks = documents(spark, d).select("doc_id", F.posexplode(S.pack_paragraphs(F.split("text", "\n"), profile)).alias("chunk_no", "content"))
    return chunks.select("doc_id", F.col("chunk_no").cast("long").alias("chunk_no"), F.length("content").cast("long").alias("n_chars"), T.tokens(F.col("content")).alias("n_tokens"))


CHUNKS = "select doc_id, no::bigint chunk_no, n_chars, n_chars // 4 n_tokens from c"


@query(pack_sql(400, 1500, r"^[\[(]?\d+[\]).]", CHUNKS))
def greedy_chunks(spark, d):
    """Non-blank lines as paragraphs, packed into chunks."""
    return packed(spark, d, T.V3)


@query(pack_sql(300, 450, r"[\[(]?\d+[\]).]", CHUNKS))
def greedy_chunks_v1(spark, d):
    return packed(spark, d, T.V1)


@query(
    pack_sql(400, 1500, r"^[\[(]?\d+[\]).]", """, w as (select doc_id, length(coalesce(text, '')) // 4 tok from documents)
    select w.doc_id, case when tok < 50 then 'none' when tok <= 600 then 'section' else 'paragraph' end strategy,
    cast(case when tok < 50 then 0 when tok <= 600 then 1 else (select count(*) from c where c.doc_id = w.doc_id and n_chars // 4 >= 50) end as bigint) n_chunks from w""")
)
def chunk_strategy(spark, d):
    p, tok = T.V3, T.tokens(F.col("text"))
    chunks = F.size(F.filter(S.pack_paragraphs(F.split("text", "\n"), p), lambda c: T.tokens(c) >= p.paragraph_min))
    kind = F.when(tok < p.section_min, "none").when(tok <= p.long, "section").otherwise("paragraph")
    return documents(spark, d).select("doc_id", kind.alias("strategy"), F.when(tok < p.section_min, 0).when(tok <= p.long, 1).otherwise(chunks).cast("long").alias("n_chunks"))


@query()
def sentence_safe_join(spark, d):
    return documents(spark, d).select("doc_id", F.posexplode(S.join_sentences(T.lines(F.col("text")))).alias("para_no", "paragraph"))


@query(
    rf"""with l as (select doc_id, i - 1 idx, l line from (select doc_id, unnest(s) l, generate_subscripts(s, 1) i from (select doc_id, string_split(coalesce(text, ''), chr(10)) s from documents))),
    m as (select *, regexp_matches(line, '^\s*\*[\s*]+\*\s*$') sep from l),
    s as (select *, sum(sep::int) over (partition by doc_id order by idx rows unbounded preceding) section_no from m)
    select doc_id, section_no::bigint section_no, count(*) n_lines, sum(length(line))::bigint n_chars from s where not sep group by all"""
)
def sections_by_separator(spark, d):
    rows = S.exploded(documents(spark, d), F.split("text", "\n"), "doc_id").withColumn("sep", T.is_asterisk_rule(F.col("line")))
    return S.sections(rows, "doc_id", "sep").groupBy("doc_id", "section_no").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("line")).cast("long").alias("n_chars"))


CARD = "concat(c_mktsegment, ' Segment\n\n', c_name, ' pays.\n', case when c_nationkey % 2 = 0 then 'Account Of ' else 'account of ' end, c_name, '\n', c_mktsegment)"


@query(
    rf"""with l as (select c_custkey, unnest(string_split({CARD.replace(chr(92) + 'n', "' || chr(10) || '")}, chr(10))) x from customer), s as (select c_custkey, {STRIP.format('x')} x from l),
    w as (select *, regexp_split_to_array(x, '\s+') ws from s where x <> '' and length(x) <= 80)
    select c_custkey, x line from w where len(ws) between 2 and 5 and not regexp_matches(x, '[.,;:?!]$') and len(list_filter(ws, lambda v: regexp_matches(v, '^\p{{Lu}}'))) >= 0.7 * len(ws)"""
)
def header_candidates(spark, d):
    rows = S.exploded(read(spark, d, "customer").withColumn("card", F.expr(CARD)), F.split("card", "\n"), "c_custkey")
    return rows.where(T.is_likely_header(F.col("line"))).select("c_custkey", T.strip(F.col("line")).alias("line"))


@query()
def section_headers(spark, d):
    rows = S.exploded(documents(spark, d), T.lines(F.col("text")), "doc_id")
    return S.section_headers(rows).where("is_header").select("doc_id", "idx", "line")


LINES = """select l_orderkey, l_linenumber, case when l_linenumber % 3 = 0 then 'Prose about the order.' else concat('$', cast(cast(floor(l_extendedprice) as bigint) as {s}), '   $', cast(cast(floor(l_quantity) as bigint) as {s})) end line from lineitem"""


def numeric_lines(spark, d):
    read(spark, d, "lineitem").createOrReplaceTempView("folioscope_lines")
    return spark.sql(LINES.format(s="string").replace("from lineitem", "from folioscope_lines"))


@query(
    r"with l as (" + LINES.format(s="varchar") + r"""), t as (select *, regexp_matches(line, '\$[\d,]+\s+\$[\d,]+') f from l)
    select l_orderkey, l_linenumber, f is_table, (sum(f::int) over (partition by l_orderkey order by l_linenumber rows between 3 preceding and 3 following) - f::int) >= 2 in_context from t"""
)
def table_context_flag(spark, d):
    rows = numeric_lines(spark, d).withColumn("is_table", T.is_table_line(F.col("line")))
    return S.table_context(rows, "l_orderkey", "l_linenumber", "is_table").drop("line")


@query(
    "with l as (" + LINES.format(s="varchar") + r"""), t as (select *, l_linenumber - row_number() over (partition by l_orderkey order by l_linenumber) g from l where starts_with(line, '$'))
    select l_orderkey, min(l_linenumber) first, max(l_linenumber) last, count(*) n_rows from t group by l_orderkey, g having count(*) >= 2"""
)
def table_islands(spark, d):
    rows = numeric_lines(spark, d).withColumn("is_table", T.is_table_line(F.col("line")))
    return S.islands(rows, "l_orderkey", "l_linenumber", "is_table", 2)


@query(
    "with l as (" + LINES.format(s="varchar") + """), r as (select *, row_number() over (partition by l_orderkey order by l_linenumber, line) - 1 i from l), t as (select *, i - row_number() over (partition by l_orderkey order by i) g from r where starts_with(line, '$'))
    select l_orderkey, min(i) first, max(i) last from t group by l_orderkey, g having count(*) >= 2"""
)
def table_blocks(spark, d):
    whole = numeric_lines(spark, d).groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "line"))), lambda x: x["line"]).alias("lines"))
    return whole.select("l_orderkey", F.explode(S.table_blocks(F.col("lines"), least=2)).alias("b")).select("l_orderkey", F.col("b.first").cast("long").alias("first"), F.col("b.last").cast("long").alias("last"))


@query()
def page_break_heal(spark, d):
    """A marker is put after every fifth line and healed where it splits a paragraph."""
    marked = F.flatten(F.transform(F.split("text", "\n"), lambda x, i: F.when(i % 5 == 4, F.array(x, F.lit(""), F.lit(S.BREAK))).otherwise(F.array(x))))
    healed = S.heal_page_breaks(F.col("lines"))
    return documents(spark, d).select("doc_id", marked.alias("lines")).select("doc_id", F.size("lines").alias("n_before"), F.size(healed).alias("n_after"), F.size(F.filter(healed, lambda x: x == S.BREAK)).alias("n_breaks"))


@query("select lang, source, count(*) n_docs, round(avg(length(coalesce(text, '')) // 4), 6) avg_tokens, min(length(coalesce(text, '')) // 4) min_tokens, max(length(coalesce(text, '')) // 4) max_tokens from documents group by all")
def token_estimate_hist(spark, d):
    t = T.tokens(F.col("text"))
    return documents(spark, d).groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n_docs"), F.round(F.avg(t), 6).alias("avg_tokens"), F.min(t).alias("min_tokens"), F.max(t).alias("max_tokens"))


# -- extraction over letters written from orders ----------------------------------------------------------------------

LETTER = """select o_orderkey, year(o_orderdate) y, concat('We believe our approach is sound. Net worth was $', cast(cast(floor(o_totalprice) as bigint) as {s}), case when o_orderkey % 3 = 0 then ' million' else '' end,
 ' in ', cast(year(o_orderdate) as {s}), ', up ', cast(o_custkey % 40 as {s}), '.5% compared to ', cast(year(o_orderdate) - 1 as {s}),
 case when o_orderkey % 5 = 0 then '. Book value rose; I made a mistake' when o_orderkey % 7 = 0 then '. We expect more at the annual meeting' else '' end, '. ', o_orderpriority, case when o_orderkey % 2 = 0 then ' March 14,' else ' 14 March ' end,
 case when o_orderkey % 2 = 0 then ' ' else '' end, cast(year(o_orderdate) as {s})) t from orders"""
WITH_LETTER = "with l as (" + LETTER.format(s="varchar") + ") "


def letters(spark, d):
    read(spark, d, "orders").createOrReplaceTempView("folioscope_orders")
    return spark.sql(LETTER.format(s="string").replace("from orders", "from folioscope_orders"))


@query(
    WITH_LETTER + r"""select o_orderkey, list_aggregate(list_sort(list_distinct(list_concat(regexp_extract_all(t, '\d+[.]?\d*%')[1:5],
    list_filter(list_transform(regexp_extract_all(t, '\$\d+(?:,\d{3})*(?:[.]\d+)?(?: ?(?:million|billion))?')[1:5], lambda m: m), lambda m: regexp_matches(m, 'illion|,|\d{5}'))))), 'string_agg', '|') metrics from l"""
)
def metric_extract(spark, d):
    return letters(spark, d).select("o_orderkey", F.array_join(F.array_sort(T.metrics(F.col("t"))), "|").alias("metrics"))


@query(WITH_LETTER + r"select o_orderkey, coalesce(list_aggregate(list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(t, '\b(?:19[6-9]\d|20[0-2]\d)\b'), lambda v: v::int), lambda v: v <> y)))[1:10], 'string_agg', ','), '') year_list from l")
def mentioned_years(spark, d):
    return letters(spark, d).select("o_orderkey", F.array_join(T.mentioned_years(F.col("t"), F.col("y")), ",").alias("year_list"))


@query(WITH_LETTER + r"select o_orderkey, regexp_matches(lower(t), 'compared to|versus|vs[.]?|year.ago|previous year') has_comparison, regexp_matches(lower(t), 'expect|anticipate|forecast|outlook|going forward') has_forecast, regexp_matches(t, '\$[\d,]+|\d+[.]?\d*%') has_financial from l")
def temporal_flags(spark, d):
    t = F.col("t")
    return letters(spark, d).select("o_orderkey", T.has_comparison(t).alias("has_comparison"), T.has_forecast(t).alias("has_forecast"), T.has_financial(t).alias("has_financial"))


CASCADE = r"""case when regexp_matches(lower(t), 'we believe')::int + regexp_matches(lower(t), 'our (?:view|approach|philosophy)')::int + regexp_matches(lower(t), 'principle')::int >= 2 then 'philosophy'
 when regexp_matches(lower(t), '\b(?:i|we|my|our)\b.{0,30}\b(?:mistake|error|wrong|foolish)\b') then 'mistake_confession'
 when regexp_matches(lower(t), 'net worth')::int + regexp_matches(lower(t), 'book value')::int + regexp_matches(lower(t), 'per.share')::int + regexp_matches(lower(t), 'operating earnings')::int >= 2 then 'performance_summary'
 when regexp_matches(lower(t), 'annual meeting|shareholder.+meeting') then 'annual_meeting' else 'narrative' end"""


@query(WITH_LETTER.replace("We believe our approach is sound. ", "Our view. ") + f"select o_orderkey, {CASCADE} content_type from l")
def content_type(spark, d):
    t = F.replace("t", F.lit("We believe our approach is sound. "), F.lit("Our view. "))
    return letters(spark, d).select("o_orderkey", T.content_type(t, F.lit(False)).alias("content_type"))


@query(WITH_LETTER + r"select o_orderkey, regexp_extract(t, '((?:March \d{1,2}, \d{4})|(?:\d{1,2} March \d{4}))', 1) letter_date from l")
def letter_date(spark, d):
    return letters(spark, d).select("o_orderkey", T.letter_date(F.col("t")).alias("letter_date"))


CONCEPTS = {"license": "licensed under|license", "function_words": r"\b(?:the|and)\b", "years": r"\b(?:19|20)\d\d\b", "table": r" \| ", "contact": "@"}
THEMES = {"symbols": "[#$%&]", "shouting": "!!", "questions": "[?]", "digits": "[0-9]", "dots": "[.]", "commas": ","}


@query(
    "select doc_id, coalesce(list_aggregate(list_filter([" + ", ".join(f"case when regexp_matches(lower(coalesce(text, '')), '{p}') then '{k}' end" for k, p in CONCEPTS.items()) + "], lambda v: v is not null), 'string_agg', ','), '') concepts,"
    " coalesce(list_aggregate(list_filter([" + ", ".join(f"case when regexp_matches(lower(coalesce(text, '')), '{p}') then '{k}' end" for k, p in THEMES.items()) + "], lambda v: v is not null)[1:5], 'string_agg', ','), '') themes from documents"
)
def concept_tags(spark, d):
    t = F.col("text")
    return documents(spark, d).select("doc_id", F.array_join(T.tagged(t, CONCEPTS), ",").alias("concepts"), F.array_join(T.tagged(t, THEMES, 5), ",").alias("themes"))


@query(
    """select s_suppkey, list_aggregate(list_filter((select list(n_name order by n_nationkey) from nation), lambda n: contains(lower(t), lower(n))), 'string_agg', ',') entities
    from (select s_suppkey, concat(s_name, ' ships from ', n_name, ' to ', r_name) t from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""
)
def entity_tags(spark, d):
    s, n, r = read(spark, d, "supplier"), read(spark, d, "nation"), read(spark, d, "region")
    names = n.agg(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: x["n_name"]).alias("names"))  # one row
    t = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select("s_suppkey", F.concat("s_name", F.lit(" ships from "), "n_name", F.lit(" to "), "r_name").alias("t"))
    found = F.filter("names", lambda v: F.contains(F.lower("t"), F.lower(v)))
    return t.crossJoin(F.broadcast(names)).select("s_suppkey", F.array_join(found, ",").alias("entities"))


@query(
    "with l as (" + LETTER.format(s="varchar") + r"""), s as (select o_orderkey, 25 + 20 * contains(t, 'expect')::int + 15 + 10 * contains(t, 'Book value')::int + 5 * (o_orderkey % 4) score, (o_orderkey % 7)::double a, (o_orderkey % 5)::double c from l)
    select o_orderkey, score::bigint score, case when score >= 40 then 'high' when score >= 20 then 'medium' else 'low' end priority,
    case when a + c = 0 then 'medium' when a / (a + c) >= 0.7 then 'high' when a / (a + c) <= 0.3 then 'low' else 'medium' end abstraction from s"""
)
def priority_score(spark, d):
    t, k = F.col("t"), F.col("o_orderkey")
    score = T.priority_score(F.lit(False), F.lit(True), F.contains(t, F.lit("expect")), F.lit(0), F.lit(True), F.contains(t, F.lit("Book value")), k % 4)
    one = letters(spark, d).select("o_orderkey", score.cast("long").alias("score"))
    return one.select("o_orderkey", "score", T.level(F.col("score")).alias("priority"), T.abstraction((k % 7).cast("double"), (k % 5).cast("double")).alias("abstraction"))


# -- neighbours, parents, duplicates ------------------------------------------------------------------------------------


@query("select conv_id, turn, role, lag(nullif(text, '')) over w previous_summary, lead(nullif(text, '')) over w next_summary from conversations window w as (partition by conv_id order by turn)")
def neighbor_summary(spark, d):
    return R.neighbours(read(spark, d, "conversations"), "conv_id", "turn", F.col("text")).drop("text")


@query(
    """select l_orderkey, l_linenumber, row_number() over (partition by l_orderkey order by l_linenumber) section_position, count(*) over (partition by l_orderkey) total_section_chunks,
    coalesce(list_aggregate(list_filter(list(l_linenumber) over (partition by l_orderkey order by l_linenumber rows between unbounded preceding and unbounded following), lambda v: v <> l_linenumber), 'string_agg', ','), '') siblings from lineitem"""
)
def siblings(spark, d):
    out = S.siblings(read(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey", "l_linenumber", "l_linenumber")
    return out.select("l_orderkey", "l_linenumber", F.array_join("sibling_ids", ",").alias("siblings"), F.col("section_position").cast("long").alias("section_position"), "total_section_chunks")


@query("select l_orderkey, string_agg(l_linenumber::varchar, ',' order by l_linenumber) children, count(*) n_children from lineitem group by 1")
def parent_child_links(spark, d):
    return R.child_lists(read(spark, d, "lineitem"), "l_orderkey", "l_linenumber")


@query("select doc_id from (select doc_id + 7 doc_id from documents) where doc_id not in (select doc_id from documents)")
def orphan_refs(spark, d):
    docs = read(spark, d, "documents").select("doc_id")
    return R.orphans(docs.select((F.col("doc_id") + 7).alias("doc_id")), docs, "doc_id", "doc_id")


@query("select o_orderkey, o_custkey from orders where o_custkey in (select c_custkey from customer where c_acctbal < 0)")
def bad_parent(spark, d):
    return R.bad_parents(read(spark, d, "orders").select("o_orderkey", "o_custkey"), read(spark, d, "customer"), "o_custkey", "c_custkey", F.col("c_acctbal") < 0).select("o_orderkey", "o_custkey")


@query("select doc_id, first_in from (select doc_id, row_number() over w n, first_value(doc_id) over w first_in from documents window w as (partition by md5(coalesce(text, '')) order by doc_id)) where n > 1")
def dup_ids_cross_source(spark, d):
    keyed = documents(spark, d).select("doc_id", F.md5("text").alias("h"))
    return K.duplicates(keyed, "h", "doc_id").select("doc_id", "first_in")


@query("select c.conv_id, c.turn, min(abs(c.turn - s.turn)) distance from conversations c join conversations s on c.conv_id = s.conv_id and abs(c.turn - s.turn) <= 1 where s.role = 'assistant' group by all")
def context_expand(spark, d):
    """Turns within one place of an answer."""
    turns = read(spark, d, "conversations").select("conv_id", "turn", "role")
    return R.expand_context(turns.where("role = 'assistant'").drop("role"), turns.drop("role"), "conv_id", "turn", 1)


@query("select p_brand, arg_min(p_partkey, (p_size, p_partkey)) first_item, min(p_size) first_seen, count(distinct p_partkey) n_items from part group by 1")
def earliest_exposition(spark, d):
    return R.earliest(read(spark, d, "part"), "p_brand", "p_size", "p_partkey")


# -- validation and drift -----------------------------------------------------------------------------------------------


RECORD = """concat('{{"chunk_id": "', case when doc_id % 11 = 0 then '2016-S3-T1-2' else concat('2016-S03-T', cast(1 + doc_id % 2 as {s}), '-', lpad(cast(doc_id % 1000 as {s}), 3, '0')) end,
 '", "content": ', case when doc_id % 13 = 0 then '5' else concat('"', repeat('x', cast(10 + doc_id % 200 as int)), '"') end,
 case when doc_id % 17 = 0 then '' else concat(', "metadata": ', case when doc_id % 19 = 0 then '[]' else concat('{{"chunk_tier": ', cast(1 + doc_id % 3 as {s}), ', "letter_date": "', case when doc_id % 23 = 0 then 'March 14' else '2016-01-02' end, '"}}') end) end, '}}')"""


def json_records(spark, d):
    return read(spark, d, "documents").select(F.col("source").alias("file"), F.col("doc_id").alias("pos"), F.expr(RECORD.format(s="string")).alias("json"))


OTHER_KEYS = [k for k in K.METADATA if k not in ("chunk_tier", "letter_date")]
FINDINGS = f"""with r as (select source file, doc_id pos, cast({RECORD.format(s='varchar')} as json) j from documents),
x as (select *, j->>'$.chunk_id' id, json_type(j->'$.content') ct, json_type(j->'$.metadata') mt, (j->>'$.metadata.chunk_tier')::bigint tier, j->>'$.metadata.letter_date' ld from r),
f as (select file, pos, id chunk_id, unnest(list_concat(case when mt = 'OBJECT' then {["ERROR missing_metadata:" + k for k in OTHER_KEYS]} else [] end, list_filter([
 case when mt is null then 'ERROR missing_key:metadata' end, case when ct <> 'VARCHAR' then 'ERROR wrong_type:content' end, case when mt <> 'OBJECT' then 'ERROR metadata_not_object' end,
 case when not regexp_matches(id, '^\\d{{4}}-S\\d{{2}}-T[12]-\\d{{3}}$') then 'WARN chunk_id_format' end, case when ct = 'VARCHAR' and length(trim(j->>'$.content')) < 80 then 'WARN content_short' end,
 case when mt = 'OBJECT' and tier not in (1, 2) then 'ERROR tier' end, case when tier <> try_cast(nullif(regexp_extract(id, '-T(\\d)-', 1), '') as bigint) then 'ERROR tier_of_id' end,
 case when not regexp_matches(ld, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') then 'ERROR letter_date' end, case when tier = 2 then 'ERROR tier2_orphan' end], lambda v: v is not null))) f from x)
"""


@query(FINDINGS + "select file, pos, chunk_id, string_split(f, ' ')[1] as level, string_split(f, ' ')[2] as rule from f")
def schema_findings(spark, d):
    return K.validate(json_records(spark, d))


@query(FINDINGS + "select file, count(*) filter (f like 'ERROR%') errors, count(*) filter (f like 'WARN%') warnings, case when count(*) filter (f like 'ERROR%') > 0 then 2 else 1 end exit_code from f group by 1")
def finding_rollup(spark, d):
    return K.rollup_findings(K.validate(json_records(spark, d)))


@query("select doc_id, case when doc_id % 17 = 0 then 'metadata' else '' end missing from documents")
def missing_keys(spark, d):
    keys = F.json_object_keys("json")
    need = F.array(*map(F.lit, ("chunk_id", "content", "metadata")))
    return json_records(spark, d).select(F.col("pos").alias("doc_id"), F.array_join(F.array_sort(F.array_except(need, keys)), ",").alias("missing"))


EVENT_KEYS = "select event_type, unnest(json_keys(cast(props as json))) k, props from events where props is not null"


@query(f"with e as ({EVENT_KEYS}), t as (select event_type, k, case json_type(cast(props as json), '$.' || k) when 'VARCHAR' then 'string' when 'OBJECT' then 'object' when 'ARRAY' then 'array' when 'BOOLEAN' then 'boolean' when 'NULL' then 'null' when 'DOUBLE' then 'double' else 'integer' end ty from e), s as (select event_type, string_agg(distinct k || ':' || ty, ',' order by k || ':' || ty) signature from t group by 1) select signature, count(*) n, min(event_type) first_group from s group by 1 order by n desc, first_group limit 1")
def schema_signature_mode(spark, d):
    e = read(spark, d, "events").where("props is not null").select("event_type", F.explode(F.json_object_keys("props")).alias("k"), "props")
    typed = e.select("event_type", "k", json_kind(F.col("props"), F.col("k")).alias("ty"))
    return K.mode_signature(K.signatures(typed, "event_type", "k", "ty"), "event_type")


def json_kind(props, key):
    """Type of a top-level value of a JSON text whose key is a column."""
    s = F.schema_of_variant(F.element_at(F.from_json(props, "map<string,variant>"), key))
    return F.when(s.startswith("ARRAY"), "array").when(s.startswith("OBJECT"), "object").when(s == "STRING", "string").when(s == "BOOLEAN", "boolean").when(s == "BIGINT", "integer").when(s == "VOID", "null").otherwise("double")


PATHS = "select case when l_linenumber <= 2 then 'base' else 'other' end batch, unnest(['l_quantity', 'l_returnflag', 'l_shipdate_' || l_linenumber, 'l_tax']) path, unnest([case when l_linenumber <= 2 then 'int' else 'float' end, 'str', 'str', case when l_linenumber <= 2 then 'str' else 'int' end]) ty from lineitem"


@query(f"""with p as ({PATHS}), a as (select path, string_agg(distinct ty, '|' order by ty) base_types from p where batch = 'base' group by 1), b as (select path, string_agg(distinct ty, '|' order by ty) other_types from p where batch = 'other' group by 1)
select path, case when other_types is null then 'missing' when base_types is null then 'extra' when base_types = other_types or (base_types in ('int', 'float') and other_types in ('int', 'float')) then 'same' else 'mismatch' end status, base_types, other_types from a full join b using (path)""")
def path_schema_diff(spark, d):
    low = F.col("l_linenumber") <= 2
    pairs = F.array(
        F.struct(F.lit("l_quantity").alias("path"), F.when(low, "int").otherwise("float").alias("type")), F.struct(F.lit("l_returnflag").alias("path"), F.lit("str").alias("type")),
        F.struct(F.concat(F.lit("l_shipdate_"), F.col("l_linenumber").cast("string")).alias("path"), F.lit("str").alias("type")), F.struct(F.lit("l_tax").alias("path"), F.when(low, "str").otherwise("int").alias("type")),
    )
    rows = read(spark, d, "lineitem").select(low.alias("low"), F.explode(pairs).alias("p")).select("low", "p.path", "p.type")
    return K.path_diff(rows.where("low"), rows.where("not low"))


@query("with k as (select doc_id, source, unnest(['id', 'text'] || case when doc_id % 4 = 0 then ['note'] else [] end || case when lang = 'en' then ['english'] else [] end) k from documents), n as (select source, count(*) n from documents group by 1) select source, k from k join n using (source) group by source, k, n having count(*) = n")
def required_keys_100pct(spark, d):
    docs = read(spark, d, "documents")
    keys = F.array_compact(F.array(F.lit("id"), F.lit("text"), F.when(F.col("doc_id") % 4 == 0, "note"), F.when(F.col("lang") == "en", "english")))
    n = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return docs.select("source", F.explode(keys).alias("k")).groupBy("source", "k").agg(F.count(F.lit(1)).alias("c")).join(n, "source").where("c = n").select("source", "k")


@query("select lang, count(*) n_docs, count(*) filter (length(coalesce(text, '')) // 4 > 600) n_long, count(*) filter (length(coalesce(text, '')) // 4 < 50) n_short, count(distinct source) n_sources from documents group by rollup (lang)")
def stats_rollup(spark, d):
    t = T.tokens(F.col("text"))
    return documents(spark, d).rollup("lang").agg(F.count(F.lit(1)).alias("n_docs"), F.count_if(t > 600).alias("n_long"), F.count_if(t < 50).alias("n_short"), F.count_distinct("source").alias("n_sources"))


@query("select lang, string_agg(distinct source, ',' order by source) sources from documents group by 1")
def titles_per_group(spark, d):
    return read(spark, d, "documents").groupBy("lang").agg(F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))


# -- statements ----------------------------------------------------------------------------------------------------------

YEARS = "select year(o_orderdate) y, sum(o_totalprice) revenue, count(*) n from orders group by 1"


def by_year(spark, d):
    return read(spark, d, "orders").groupBy(F.year("o_orderdate").alias("y")).agg(F.sum("o_totalprice").alias("revenue"), F.count(F.lit(1)).alias("n"))


@query(f"with s as ({YEARS}) select y, round(coalesce(revenue / lag(revenue) over w - 1, 0), 6) yoy, round(pow(revenue / lag(revenue, 3) over w, 1.0/3) - 1, 6) cagr_3, round(pow(revenue / lag(revenue, 5) over w, 1.0/5) - 1, 6) cagr_5 from s window w as (order by y)")
def yoy_cagr(spark, d):
    return N.growth(by_year(spark, d), "y", "revenue").select("y", "yoy", "cagr_3", "cagr_5")


@query(
    """with s as (select year(l_shipdate) y, l_returnflag f, sum(l_extendedprice) gross, sum(l_extendedprice * (1 - l_discount)) net, sum(case when l_tax > 0.07 then l_extendedprice end) taxed, sum(case when l_quantity < 0 then 1 else 0 end) none from lineitem group by 1, 2)
    select y, f, round(net / gross, 6) net_margin, case when gross = 0 then 'zero_divisor' end net_margin_missing, round(taxed / gross, 6) taxed_share, case when taxed is null then 'missing_input' end taxed_share_missing, cast(null as double) no_share, 'zero_divisor' no_share_missing from s"""
)
def margin_ratios(spark, d):
    price = F.col("l_extendedprice")
    s = read(spark, d, "lineitem").groupBy(F.year("l_shipdate").alias("y"), F.col("l_returnflag").alias("f")).agg(
        F.sum(price).alias("gross"), F.sum(price * (1 - F.col("l_discount"))).alias("net"), F.sum(F.when(F.col("l_tax") > 0.07, price)).alias("taxed"), F.sum(F.when(F.col("l_quantity") < 0, 1).otherwise(0)).alias("none")
    )
    return s.select("y", "f", *N.ratio(F.col("net"), F.col("gross"), "net_margin"), *N.ratio(F.col("taxed"), F.col("gross"), "taxed_share"), *N.ratio(F.col("gross"), F.col("none"), "no_share"))


@query(f"with s as ({YEARS}) select y, 'revenue' item, round(revenue, 2) \"value\" from s union all select y, 'n', n::double from s")
def statement_unpivot(spark, d):
    wide = by_year(spark, d).select("y", F.round("revenue", 2).alias("revenue"), F.col("n").cast("double").alias("n"))
    return N.long_facts(wide, ["y"], ["revenue", "n"])


@query("select o_orderkey, round(t - o_totalprice, 2) difference, abs(t - o_totalprice) <= 1000 ok from orders join (select l_orderkey, sum(l_extendedprice) t from lineitem group by 1) on l_orderkey = o_orderkey")
def identity_checks(spark, d):
    sums = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("t"))
    return N.identity(read(spark, d, "orders").select("o_orderkey", "o_totalprice").join(sums, "o_orderkey"), F.col("t"), F.col("o_totalprice"), 1000).select("o_orderkey", "difference", "ok")


@query("with s as (select o_custkey, year(o_orderdate) y, sum(o_totalprice) v from orders group by 1, 2) select o_custkey, y, round(v / max(v) over (partition by o_custkey order by y rows unbounded preceding) - 1, 6) drawdown from s")
def value_drawdown(spark, d):
    s = read(spark, d, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.sum("o_totalprice").alias("v"))
    return N.drawdown(s, "o_custkey", "y", "v").select("o_custkey", "y", "drawdown")


@query(
    f"""with s as (select year(o_orderdate) y, sum(o_totalprice) net_sales, sum(case when o_orderstatus = 'F' then o_totalprice end) gross_profit from orders group by 1)
    select y, 'gross_margin' metric_name, round(gross_profit / net_sales, 6) "value", case when gross_profit is null then 'null gross_profit' end missing_reason from s union all
    select y, m, null, r from s, (values {", ".join(f"('{k}', 'no field {next(f for f in v[1] if f not in ('net_sales', 'gross_profit'))}')" for k, v in N.METRICS.items() if k != "gross_margin")}) t(m, r)"""
)
def metric_records(spark, d):
    wide = read(spark, d, "orders").groupBy(F.year("o_orderdate").alias("y")).agg(F.sum("o_totalprice").alias("net_sales"), F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("gross_profit"))
    return N.metric_records(wide, ["y"]).drop("formula", "source_fields")


@query("select p_type item, min(y) first_seen_year, max(y) last_seen_year, count(distinct y) n_years, string_agg(distinct y::varchar, ',' order by y::varchar) year_list, count(distinct l_orderkey) n_sources from (select p_type, year(l_shipdate) y, l_orderkey from lineitem join part on p_partkey = l_partkey) group by 1")
def recurrence_backbone(spark, d):
    rows = read(spark, d, "lineitem").join(read(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_type").alias("item"), F.year("l_shipdate").alias("y"), "l_orderkey")
    return R.recurrence(rows, "item", "y", "l_orderkey")


@query(r"select lang, source, sum(len(regexp_extract_all(lower(coalesce(text, '')), '\bthe\b')))::bigint n_the, sum(len(regexp_extract_all(lower(coalesce(text, '')), 'licen[cs]e')))::bigint n_license from documents group by all")
def term_trend(spark, d):
    n = lambda p: F.sum(F.regexp_count(F.lower("text"), F.lit(p))).cast("long")
    return documents(spark, d).groupBy("lang", "source").agg(n(r"\bthe\b").alias("n_the"), n("licen[cs]e").alias("n_license"))


@query(
    """select doc_id, round(s, 6) score, case when s >= 4.2 and a >= 4 then 'ACCEPT' when s >= 3 then 'REVISE' else 'REJECT' end decision from (select doc_id, a, (a * 0.5 + b * 0.3 + c * 0.2) / 1.0 s from
    (select doc_id, 5.0 * quality a, 5.0 * (1 - toxic) b, (doc_id % 6)::double c from labels))"""
)
def weighted_scorecard(spark, d):
    s = read(spark, d, "labels").select("doc_id", (5.0 * F.col("quality")).alias("a"), (5.0 * (1 - F.col("toxic"))).alias("b"), (F.col("doc_id") % 6).cast("double").alias("c"))
    return R.scorecard(s, "doc_id", {"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 4})


# -- retrieval -----------------------------------------------------------------------------------------------------------

BM25 = r"""with t as (select doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+')) term from documents), c as (select doc_id, term, count(*) tf from t group by all),
l as (select doc_id, sum(tf) dl from c group by 1), a as (select (select count(*) from documents) n, (select sum(dl) from l) w), f as (select term, count(*) df from c group by 1),
q as (select distinct item_id, term from (select item_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+')) term from benchmark)),
s as (select item_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / (w / n)))), 6) score from q join c using (term) join f using (term) join l using (doc_id), a group by all)
"""


@query(BM25 + "select item_id, doc_id, score, rank from (select *, row_number() over (partition by item_id order by score desc, doc_id) rank from s) where rank <= 5")
def bm25_topk(spark, d):
    out = O.bm25(read(spark, d, "documents"), read(spark, d, "benchmark"), 5)
    return out.select("item_id", "doc_id", "score", F.col("rank").cast("long").alias("rank"))


VECTORS = "with q as (select vec_id query_id, embedding qe from embeddings where vec_id % 20 = 0), s as (select query_id, vec_id, round(list_cosine_similarity(embedding::double[], qe::double[]), 6) score from embeddings, q where vec_id <> query_id)"


def vector_ranks(spark, d, k):
    v = read(spark, d, "embeddings")
    return O.vector_top_k(v.select("vec_id", "embedding"), v.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_embedding")), k)


@query(VECTORS + " select query_id, vec_id, score, rank from (select *, row_number() over (partition by query_id order by score desc, vec_id) rank from s) where rank <= 5")
def vector_topk(spark, d):
    return vector_ranks(spark, d, 5).select("query_id", "vec_id", "score", F.col("rank").cast("long").alias("rank"))


@query(
    VECTORS + """, v as (select *, row_number() over (partition by query_id order by score desc, vec_id) rank from s), b as (select a.vec_id query_id, c.vec_id, row_number() over (partition by a.vec_id order by c.vec_id) rank from embeddings a join embeddings c on a.label = c.label and a.vec_id <> c.vec_id where a.vec_id % 20 = 0),
    f as (select query_id, vec_id, round(sum(1.0 / (60 + rank)), 6) score from (select query_id, vec_id, rank from v where rank <= 20 union all select query_id, vec_id, rank from b where rank <= 20) group by all)
    select query_id, vec_id, score, rank from (select *, row_number() over (partition by query_id order by score desc, vec_id) rank from f) where rank <= 10"""
)
def hybrid_rrf(spark, d):
    v = read(spark, d, "embeddings").select("vec_id", "label")
    first = O.top_k(v, "label", [F.col("vec_id")], 21).drop("rank")  # of a label's ids only these can be among the 20 of a query
    same = v.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "label").join(first, "label").where("vec_id <> query_id")
    other = O.top_k(same, "query_id", [F.col("vec_id")], 20)
    return O.reciprocal_rank_fusion([vector_ranks(spark, d, 20), other], "query_id", "vec_id", 10).select("query_id", "vec_id", "score", F.col("rank").cast("long").alias("rank"))


@query(
    r"""with a as (select distinct doc_id, unnest(regexp_extract_all(lower(text), '[a-z]{6,}')) t from documents), b as (select distinct item_id, unnest(regexp_extract_all(lower(text), '[a-z]{6,}')) t from benchmark),
    na as (select doc_id, count(*) n from a group by 1), nb as (select item_id, count(*) m from b group by 1)
    select doc_id, item_id, round(count(*) / (n + m - count(*)), 6) jaccard from a join b using (t) join na using (doc_id) join nb using (item_id) group by doc_id, item_id, n, m having round(count(*) / (n + m - count(*)), 6) >= 0.1"""
)
def similar_items(spark, d):
    long_words = lambda df, i: df.select(i, F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{6,}"), F.lit(0))).alias("t"))
    return O.overlap_pairs(long_words(read(spark, d, "documents"), "doc_id"), long_words(read(spark, d, "benchmark"), "item_id"), "doc_id", "item_id", "t", 0.1)


@query(r"select page_id, length(trim(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '<(script|style)[^>]*>[^<]*</(script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))) n_chars from pages")
def html_strip(spark, d):
    bare = F.regexp_replace(F.regexp_replace(F.coalesce("html", F.lit("")), "<(script|style)[^>]*>[^<]*</(script|style)>", " "), "<[^>]*>", " ")
    return read(spark, d, "pages").select("page_id", F.length(F.trim(F.regexp_replace(bare, r"\s+", " "))).cast("long").alias("n_chars"))


@query()
def kmeans_clusters(spark, d):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    v = read(spark, d, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    return KMeans(k=8, seed=1, maxIter=10).fit(v).transform(v).select("vec_id", F.col("prediction").alias("cluster"))


@query(pack_sql(400, 1500, r"^[\[(]?\d+[\]).]", "select doc_id, no::bigint chunk_no, n_chars from c"))
def stream_chunks(spark, d):
    """Documents as a stream of files, chunked once each and appended; the result is read back."""
    import tempfile
    import uuid

    from ..streaming.incremental import run_once
    from ..streaming.incremental import stream_chunks as chunks

    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir names no shared folder")
    base = f"{shared or tempfile.mkdtemp()}/stream-{uuid.uuid4().hex}"
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    run_once(chunks(spark, f"{d}/documents.parque[t]", schema), f"{base}/out", f"{base}/state")
    return spark.read.parquet(f"{base}/out").select("doc_id", F.col("chunk_no").cast("long").alias("chunk_no"), F.length("content").cast("long").alias("n_chars"))


@query("select o_orderkey, percent_rank() over (order by o_totalprice, o_orderkey) >= 0.9 top_decile from orders")
def range_position(spark, d):
    """Whether an order is in the top tenth, by a cut found with the quantile of all rows instead of one global sort."""
    o = read(spark, d, "orders").select("o_orderkey", "o_totalprice")
    n = o.agg(F.count(F.lit(1)).alias("n"))
    ranged = o.repartitionByRange("o_totalprice", "o_orderkey").select("*", F.spark_partition_id().alias("part"))
    sums = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("c"))
    before = sums.select("part", (F.sum("c").over(Window.orderBy("part")) - F.col("c")).alias("before"))
    local = F.row_number().over(Window.partitionBy("part").orderBy("o_totalprice", "o_orderkey"))
    ranked = ranged.withColumn("local", local).join(before, "part").crossJoin(F.broadcast(n))  # one row
    return ranked.select("o_orderkey", (((F.col("before") + F.col("local") - 1) / (F.col("n") - 1)) >= 0.9).alias("top_decile"))


from . import knowledge_queries, record_queries, review_queries, section_queries  # noqa: E402, F401  they register themselves
