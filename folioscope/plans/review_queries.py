"""Queries of extractors and checks over texts written from rows of the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import review as V
from ..operators import sectioning as C
from .catalogue import query, read
from .section_queries import _spark_list

NAMES = "['Acme Inc. paid', 'the Blue Chip Company and Acme Inc. again', 'Old Mills Corporation', 'A Co. and B Corp.', 'no company at all', 'See Candy Co. of See Candy Co.'][1 + c_custkey % 6]"
NUMBERS = "['grew 5.5% and 5.5% on $1,200 million', 'we cut 1,200 employees and $12', 'net worth and earnings grew by $3,000,000', 'our principle: we believe', 'my mistake was 40%', 'the mistake of others', 'annual meeting of 12,000 people'][1 + c_custkey // 6 % 7]"
TYPES = "['narrative', 'narrative', 'performance_summary', 'philosophy', 'mistake_confession', 'narrative', 'annual_meeting'][1 + c_custkey // 6 % 7]"
METRIC_LIST = "['1,200 (dollar_amount)|5.5% (percentage)', '1,200 (headcount)|12 (dollar_amount)', '3,000,000 (dollar_amount)', '', '40% (percentage)', '', '12,000 (headcount)'][1 + c_custkey // 6 % 7]"
NAME_LIST = "['Acme', 'Acme|Blue Chip', 'Old Mills', '', '', 'See Candy'][1 + c_custkey % 6]"


def customers(spark, d):
    return read(spark, d, "customer").select("c_custkey")


def pick(expr: str):
    return F.expr(_spark_list(expr))


@query(f"select c_custkey, {NAME_LIST} names, {METRIC_LIST} metrics, case when c_custkey % 5 = 0 then 'financial_data' else {TYPES} end content_type from customer")
def extract_v1(spark, d):
    """Names, metrics and types of the first profile."""
    t = pick(NUMBERS)
    return customers(spark, d).select(
        "c_custkey", F.array_join(F.array_sort(V.suffixed_names(pick(NAMES))), "|").alias("names"), F.array_join(V.metrics_v1(t), "|").alias("metrics"), V.content_type_v1(t, F.col("c_custkey") % 5 == 0).alias("content_type")
    )


DATES = "['1978-03-14', 'March 14, 1978', 'March 4,1978', '1978-13-40', 'soon', '0000-00-00', 'December 31 1999'][1 + c_custkey % 7]"
SAID = "['We believe in owners. Prices move.', 'One should never sell. The lesson is plain.', 'It rained.', 'We will expect more next year.', 'The key is to wait. We think so too.'][1 + c_custkey % 5]"


@query(
    f"""select c_custkey, ['1978-03-14', '1978-03-14', '1978-03-04', '0000-00-00', '0000-00-00', '0000-00-00', '1999-12-31'][1 + c_custkey % 7] iso_date,
    ['belief:We believe in owners.', 'rule:One should never sell.|lesson:The lesson is plain.', '', '', 'lesson:The key is to wait.|belief:We think so too.'][1 + c_custkey % 5] principles, c_custkey % 5 = 3 forward_looking,
    case when c_custkey % 3 = 0 then 'financial_table' when c_custkey % 5 not in (2, 3) then 'philosophy' when c_custkey % 4 = 0 then 'performance_summary' else 'narrative' end content_type from customer"""
)
def canonical_fields(spark, d):
    """Dates, principle sentences, forward-looking marks and the four types."""
    k, said = F.col("c_custkey"), V.principle_sentences(pick(SAID))
    return customers(spark, d).select(
        "c_custkey", V.iso_date(pick(DATES)).alias("iso_date"), F.array_join(F.transform(said, lambda x: F.concat_ws(":", x["category"], x["statement"])), "|").alias("principles"), V.forward_looking(pick(SAID)).alias("forward_looking"),
        V.canonical_type(k % 3 == 0, F.size(said) > 0, k % 4 == 0).alias("content_type"),
    )


SUMMARIES = "['Owners of the mill explain why they closed it and what it cost them all.', 'This section develops the main ideas.', 'Short.', 'It says more...', 'The mill lost money. We closed it in the end of all.', repeat('word ', 50), 'One. Two. Three. Four and a few more words.', ''][1 + c_custkey % 8]"
LINT = "['', 'section_reference|template|generic', 'too_short', 'ellipsis|too_short', 'verbatim', 'too_long', 'sentences', 'sentences|too_short'][1 + c_custkey % 8]"


@query(f"with s as (select c_custkey, {SUMMARIES} s from customer) select c_custkey, {LINT} findings, concat('Letter', chr(10), case when trim(s) = '' then '' else trim(s) || chr(10) end, 'The mill lost money.') context_text from s")
def summary_lint(spark, d):
    s, content = pick(SUMMARIES), F.lit("The mill lost money.")
    return customers(spark, d).select("c_custkey", F.array_join(V.summary_findings(s, content), "|").alias("findings"), V.context_text(F.lit("Letter"), F.lit(None).cast("string"), s, content).alias("context_text"))


METRIC = "['return_on_equity', 'Return on Equity', 'ROE', 'p/e ratio ', 'float'][1 + c_custkey % 5]"


@query(
    f"""select c_custkey, c_custkey % 5 in (0, 4) is_snake, ['return_on_equity', 'return_on_equity', 'roe', 'p_e_ratio', 'float'][1 + c_custkey % 5] snake, ['return_on_equity', 'return_on_equity', 'return_on_equity', 'price_to_earnings', 'float'][1 + c_custkey % 5] canonical,
    c_custkey % 2 = 0 named from customer"""
)
def metric_names(spark, d):
    """Names in snake case, their synonyms by join, and entries that begin with their metric."""
    known = spark.createDataFrame([("roe", "return_on_equity"), ("p_e_ratio", "price_to_earnings")], "snake string, canonical string")
    m = pick(METRIC)
    rows = customers(spark, d).select("c_custkey", V.is_snake_case(m).alias("is_snake"), V.snake_case(m).alias("snake"))
    entry = F.when(F.col("c_custkey") % 2 == 0, F.concat("snake", F.lit(": share of it"))).otherwise(F.concat(F.lit("about "), "snake"))
    return rows.join(known, "snake", "left").select("c_custkey", "is_snake", "snake", F.coalesce("canonical", "snake").alias("canonical"), V.entry_names_metric(entry, F.col("snake")).alias("named"))


ENDS = """['All is well.', 'We bought it and', 'He said "so', concat('1. one', chr(10), '2. two'), concat('1. one', chr(10), '3. three,'), 'lower case start.'][1 + c_custkey % 6]"""


@query("select c_custkey, ['', 'open_end', 'odd_quotes', '', 'open_end|list_gap', ''][1 + c_custkey % 6] boundary, c_custkey % 6 in (1, 2, 3, 4, 5) mid_sentence from customer")
def boundary_checks(spark, d):
    return customers(spark, d).select("c_custkey", F.array_join(V.boundary_findings(pick(ENDS)), "|").alias("boundary"), V.mid_sentence(pick(ENDS)).alias("mid_sentence"))


@query(
    """with t as (select l_orderkey, l_linenumber, l_partkey, 1 + l_linenumber % 2 tier, cast(l_quantity as bigint) * 30 n from lineitem)
    select l_orderkey, l_linenumber, l_partkey, concat_ws('|', case when tier = 1 and n < 250 and l_partkey % 4 <> 0 then 'tier1_small' end, case when tier = 1 and n > 1200 and l_partkey % 3 <> 0 then 'tier1_no_note' end,
    case when tier = 2 and n not between 120 and 400 then 'tier2_size' end, case when tier = 2 and l_partkey % 5 < 2 then 'tier2_leak' end) findings from t"""
)
def tier_checks(spark, d):
    p = F.col("l_partkey")
    content = F.when(p % 5 == 0, "It was so.").when(p % 5 == 1, "Prices, as noted above, rose.").otherwise("Prices rose.")
    found = V.tier_findings(1 + F.col("l_linenumber") % 2, F.col("l_quantity").cast("long") * 30, p % 4 == 0, F.when(p % 3 == 0, "note"), content)
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.array_join(found, "|").alias("findings"))


@query("select tier, count(*) n, round(avg(t), 6) avg_tokens, min(t) min_tokens, max(t) max_tokens, round(avg(e::int), 6) exception_rate, avg(e::int) <= 0.05 within_limit from (select 1 + l_linenumber % 2 tier, cast(l_quantity as bigint) * 30 t, l_partkey % 25 = 0 e from lineitem) group by 1")
def tier_statistics(spark, d):
    e, t = F.col("e").cast("int"), F.col("t")
    rows = read(spark, d, "lineitem").select((1 + F.col("l_linenumber") % 2).alias("tier"), (F.col("l_quantity").cast("long") * 30).alias("t"), (F.col("l_partkey") % 25 == 0).alias("e"))
    return rows.groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(t), 6).alias("avg_tokens"), F.min(t).alias("min_tokens"), F.max(t).alias("max_tokens"), F.round(F.avg(e), 6).alias("exception_rate"), (F.avg(e) <= 0.05).alias("within_limit"))


@query("select c_custkey, c_custkey % 3 > 0 has_context, c_custkey % 4 <> 1 stands_alone from customer")
def table_context_size(spark, d):
    k, table = F.col("c_custkey"), F.lit("1,000   2,000")
    near = F.when(k % 3 == 0, "few words").otherwise("these are more than fifty characters of text around it")
    content = F.when(k % 2 == 0, F.concat(near, F.lit("\n"), table)).otherwise(F.concat(table, F.lit("\n"), near))
    return customers(spark, d).select("c_custkey", V.table_has_context(content, table).alias("has_context"), C.stands_alone(F.when(k % 4 == 1, "They went.").otherwise("The mill went.")).alias("stands_alone"))


@query("select conv_id, turn, concat('[', role, '] ', coalesce(list_aggregate(list_filter(regexp_split_to_array(coalesce(text, ''), '\\n+'), lambda v: trim(v) <> '')[1:3], 'string_agg', ' / '), '')) excerpt from conversations")
def citation_pack(spark, d):
    """Records that cite a turn with its first pieces."""
    pieces = F.slice(F.filter(F.split(F.coalesce("text", F.lit("")), "\\n+"), lambda v: F.trim(v) != ""), 1, 3)
    return read(spark, d, "conversations").select("conv_id", "turn", F.concat(F.lit("["), "role", F.lit("] "), F.array_join(pieces, " / ")).alias("excerpt"))
