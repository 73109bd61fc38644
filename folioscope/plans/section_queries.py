"""Queries of sections, tables and sizes. Letters are written from rows of the tables, so what must be found is known; the
SQL states it from the same rows, or restates the rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import sectioning as C
from ..operators import segment as S
from .catalogue import documents, query, read

OPENING = "concat(repeat('We wrote to all of you again. ', 8), c_name)"
BODY = "repeat('Premiums were paid in full. ', cast(8 + c_custkey % 4 as int))"
CLOSING = "repeat('Thanks go to every holder. ', 9)"
ROWS = ["'1976 ..... $1,000   $2,000'", "concat('1977 ..... $', cast(c_custkey as {s}), '   $4')", "'1978 ..... $5   $6'", "'1979 ..... $7   $88'"]


def _glue(parts: list[str], s: str) -> str:
    return ("concat(" + ", chr(10), ".join(parts) + ")").replace("{s}", s)


def _letter(s: str) -> str:
    return _glue([OPENING, "''", "'Insurance Operations'", "''", BODY, *ROWS, "''", "'Then we rest.'", "''", "'Final Remarks'", "''", CLOSING], s)


def customers(spark, d):
    """Customers dealt by key over all tasks: a row of some bytes becomes a letter, so a file that is one split is much work;
    the number is stated, as small partitions would be put together again. Windows by key need no further exchange."""
    return read(spark, d, "customer").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "c_custkey")


def letters(spark, d):
    customers(spark, d).createOrReplaceTempView("folioscope_customers")
    return spark.sql(f"select c_custkey, cast(1970 + c_custkey % 50 as int) y, {_letter('string')} t from folioscope_customers")


@query(
    f"""with c as (select *, 1970 + c_custkey % 50 y, {OPENING} a, {BODY} b, {_glue(ROWS, 'varchar')} t, {CLOSING} z from customer),
    r as (select c_custkey, y, unnest([
      {{'n': 1, 'sec': '01', 'id': '-SEC', 'kind': 'section', 'title': 'Opening', 'content': a}}, {{'n': 2, 'sec': '02', 'id': '-TBL-001', 'kind': 'table', 'title': 'Insurance Operations', 'content': t}},
      {{'n': 3, 'sec': '02', 'id': '-SEC', 'kind': 'section', 'title': 'Insurance Operations', 'content': b || chr(10) || chr(10) || 'Then we rest.'}}, {{'n': 4, 'sec': '03', 'id': '-SEC', 'kind': 'section', 'title': 'Final Remarks', 'content': rtrim(z)}}]) x from c)
    select c_custkey, y || '-S' || x.sec || x.id chunk_id, x.kind kind, 'Letter Body|' || x.title hierarchy, y || '-S' || x.sec parent_section_id, x.content "content", length(x.content) // 4 token_count, length(x.content) char_count,
    x.kind = 'table' has_table, x.kind = 'table' has_financial_data, case when x.kind = 'table' then 'financial_table' else 'narrative' end content_type, x.n position_in_letter, 1 section_position, case when x.kind = 'table' then 0 else 1 end total_section_chunks from r"""
)
def chunk_records(spark, d):
    """Letters to chunk records: headers, sections, tables first, text without tables, ids and counts."""
    rows = S.exploded(letters(spark, d), T.lines(F.col("t")), "c_custkey", "y")
    marked = S.section_headers(rows, "c_custkey", table_words=["net", "gross", "total", "year"], known="insurance (?:operations|underwriting)")
    sections = C.split_sections(marked, "c_custkey", F.col("is_header"), T.strip(F.col("line")), F.contains("line", F.lit(S.BREAK)))
    out = C.chunk_records(sections, "c_custkey", (1970 + F.col("c_custkey") % 50).cast("int"))
    return out.drop("section_title").withColumn("hierarchy", F.array_join("section_hierarchy", "|")).drop("section_hierarchy")


LINE = "['Insurance Operations', 'the Annual Meeting', 'Total', 'What We Own Is Good', 'Net Worth,', 'Our Textile Mills', 'A', 'Gifts Of Many Holders To Their Own Schools', 'Book value', 'Utility 7 plants', 'Costs That We Had', 'Banking', 'Paid Up.'][1 + c_custkey % 13]"
BEFORE, AFTER = "['', 'words before', '* * *'][1 + c_custkey // 13 % 3]", "['', 'words after'][1 + c_custkey // 39 % 2]"


def _spark_list(expr: str) -> str:
    """The SQL's list by place as Spark's array by place."""
    items, at = expr.rsplit("][", 1)
    return f"element_at(array({items[1:]}), cast({at[:-1].replace('//', 'div')} as int))"


@query(
    rf"""with l as (select c_custkey, {LINE} x, {BEFORE} b, {AFTER} a from customer), w as (select *, string_split(x, ' ') ws, length(x) between 3 and 80 ok from l),
    s as (select *, len(list_filter(ws, lambda v: regexp_matches(v, '^[A-Z]') or v in ('and', 'of', 'the', 'for', '&'))) / len(ws) c1, len(list_filter(ws, lambda v: regexp_matches(v, '^[A-Z]') or lower(v) in ('and', 'of', 'the', 'for', '&', 'a', 'in'))) / len(ws) c2 from w)
    select c_custkey, ok and (b = '' or a = '') and regexp_matches(x, '^[A-Z][A-Za-z\s&,\-'']+$|^(?:Insurance|Textile|Banking|Manufacturing|Retail|Utility|Finance|Investment)[\w\s&,\-'']+$') and len(ws) <= 6 and c1 >= 0.7 v1,
    ok and not regexp_matches(x, ',$|^[a-z]') and lower(x) not in ('total', 'book value') and (lower(x) in ('banking', 'insurance operations') or ((b = '' or b = '* * *' or a = '') and len(ws) between 2 and 6 and c2 >= 0.8
    and len(list_filter(ws, lambda v: lower(v) in ('is', 'that', 'had'))) = 0 and (not ends_with(x, '.') or len(ws) <= 4))) v2 from s"""
)
def header_profiles(spark, d):
    """Header rules of the first two profiles on lines with each kind of neighbour."""
    one = read(spark, d, "customer").select("c_custkey", F.posexplode(F.array(F.expr(_spark_list(BEFORE)), F.expr(_spark_list(LINE)), F.expr(_spark_list(AFTER)))).alias("idx", "line"))
    n = C.neighbours(one, "c_custkey", T.V2).where("idx = 1")
    v2 = C.header_v2(F.col("x"), F.col("before"), F.col("after"), F.col("is_table"), F.col("in_context"), "banking|insurance operations", ["total", "book value"])
    return n.select("c_custkey", C.header_v1(F.col("x"), F.col("before"), F.col("after")).alias("v1"), v2.alias("v2"))


MARK = "['* * * * * * * * * * * *', '***', '* * *', '----------', '[[PAGE_BREAK]]', '=====', 'see [[PAGE_BREAK]] here', 'a * b'][1 + c_custkey % 8]"
START = "['Let''s move to insurance.', 'Now we''ll turn over', 'Our textile operations had a bad year', 'Our business', 'Finally, I thank you', 'One two three four five', 'let''s turn to the future of the company and its many owners of today..'][1 + c_custkey // 8 % 7]"


@query(
    rf"""with m as (select c_custkey, {MARK} m, {START} s from customer)
    select c_custkey, regexp_matches(m, '\*(?:\s*\*){{11}}|\[\[PAGE_BREAK\]\]|^[-=]{{10,}}$') v1, regexp_matches(m, '^\*[\s\*]+\*$|^-{{10,}}$|^\[\[PAGE_BREAK\]\]$') v2, regexp_matches(m, '^\*[\s\*]+\*$') v3,
    s next_line, regexp_matches(s, '^(?:[Ll]et''s (?:move|turn)|Now we|Finally, I|Our textile operations had)') implicit,
    case when s like 'Let%' then 'insurance' when s like 'let%' then 'the future of the company and its many owners of t' when s like 'Our textile%' then 'Textile Operations' when s = 'Our business' then 'Our business...' else array_to_string(string_split(s, ' ')[1:4], ' ') || '...' end title from m"""
)
def separator_titles(spark, d):
    """Separators of the three profiles, the next line that is not blank, and the title that it tells."""
    rows = read(spark, d, "customer").select("c_custkey", F.posexplode(F.array(F.expr(_spark_list(MARK)), F.lit("  "), F.expr(_spark_list(START)))).alias("idx", "line"))
    n = C.neighbours(rows, "c_custkey").withColumn("next_line", C.next_line("c_custkey")).where("idx = 0")
    return n.select("c_custkey", *[C.is_separator(F.col("line"), v).alias(f"v{v}") for v in (1, 2, 3)], "next_line", C.is_implicit_start(F.col("next_line")).alias("implicit"), C.infer_title(F.col("next_line")).alias("title"))


PARTED = ["'Words of a beginning here.'", "''", "'* * * * * * * * * * * *'", "''", "case when c_custkey % 2 = 0 then 'Let''s move to floats.' else 'More words of it.' end", "'and so on.'", "''", "'Textile Mills'", "''", "'The mills ran.'"]


@query(
    """with p as (select c_custkey, c_custkey % 2 = 0 even from customer)
    select c_custkey, 1 profile, unnest([1, 2]) section_no, unnest(['Letter Opening', 'Textile Mills']) section_title, unnest([7, 2]) n_lines from p
    union all select c_custkey, 2, unnest(case when even then [1, 2, 3] else [1, 2] end), unnest(case when even then ['Letter Opening', 'floats', 'Textile Mills'] else ['Letter Opening', 'Textile Mills'] end), unnest(case when even then [2, 4, 2] else [6, 2] end) from p"""
)
def section_profiles(spark, d):
    """Sections of the first profile, where separators are text, and of the second, where they may start a section."""
    read(spark, d, "customer").createOrReplaceTempView("folioscope_customers")
    whole = spark.sql(f"select c_custkey, {_glue(PARTED, 'string')} t from folioscope_customers")
    n = C.neighbours(S.exploded(whole, T.lines(F.col("t")), "c_custkey"), "c_custkey", T.V2).withColumn("next_line", C.next_line("c_custkey"))
    x, near = F.col("x"), (F.col("before"), F.col("after"))
    one = C.split_sections(n, "c_custkey", C.header_v1(x, *near), x, opening="Letter Opening")
    header, mark = C.header_v2(x, *near, F.col("is_table"), F.col("in_context")), C.is_separator(F.col("line"), 2)
    implicit = mark & C.is_implicit_start(F.col("next_line"))
    two = C.split_sections(n, "c_custkey", header | implicit, F.when(header, x).otherwise(C.infer_title(F.col("next_line"))), mark, "Letter Opening")
    every = one.withColumn("profile", F.lit(1)).unionByName(two.withColumn("profile", F.lit(2)))
    return every.select("c_custkey", "profile", "section_no", "section_title", F.size("lines").alias("n_lines"))


ITEMS = [f"concat('Item of the order  $', cast(c_custkey + {k} as {{s}}), '   $', '{k * 7}')" if k % 5 else "'Prose about the order.'" for k in range(1, 8)]


@query(
    f"""with o as (select c_custkey, c_custkey % 7 + 1 c, [{", ".join(ITEMS).replace("{s}", "varchar")}] ls from customer)
    select c_custkey, case when c <= 2 then c when c <= 4 then 0 else c - 4 end n_left, case when c >= 4 then 1 else 0 end n_tables, coalesce(case when c >= 4 then array_to_string(ls[1:4], chr(10)) end, '') first_table,
    case when c >= 4 then 0 end region_first, case when c >= 4 then 3 end region_last,
    case when c = 1 then 'raw_line' else array_to_string(regexp_split_to_array(ls[1], ' {{2,}}'), '|') end header, case when c = 1 then 1 else least(c, 4) - 1 end n_rows from o"""
)
def table_extraction(spark, d):
    """Text without tables, texts of tables, regions of the first profile, and cells, of one to seven lines."""
    customers(spark, d).createOrReplaceTempView("folioscope_customers")
    whole = spark.sql(f"select c_custkey, slice(array({', '.join(ITEMS).replace('{s}', 'string')}), 1, cast(c_custkey % 7 + 1 as int)) lines from folioscope_customers")
    one = whole.withColumn("t", C.table_texts(F.col("lines"))).withColumn("v1", C.tables_v1(F.col("lines")))
    data = C.table_data(F.array_join(F.slice("lines", 1, 4), "\n"))
    return one.withColumn("data", data).select(
        "c_custkey", F.size(C.without_tables(F.col("lines"))).alias("n_left"), F.size("t").alias("n_tables"), F.coalesce(F.get("t", F.lit(0)), F.lit("")).alias("first_table"),
        F.get("v1", F.lit(0))["first"].alias("region_first"), F.get("v1", F.lit(0))["last"].alias("region_last"), F.array_join("data.columns", "|").alias("header"), F.col("data.row_count").alias("n_rows"),
    )


PLACED = "(select *, row_number() over (partition by l_orderkey order by l_linenumber, l_extendedprice, l_partkey, l_suppkey) n from lineitem)"
SIZED = f"select l_orderkey, n as l_linenumber, cast(l_quantity as bigint) * 10 tokens, n = max(n) over (partition by l_orderkey) section_final, l_returnflag = 'A' header, n % 3 paragraphs, l_linestatus = 'F' after_table from {PLACED}"


def sized(spark, d):
    read(spark, d, "lineitem").createOrReplaceTempView("folioscope_lines")
    return spark.sql(SIZED.replace("from lineitem", "from folioscope_lines"))


@query(
    f"""with s as ({SIZED}), m as (select *, case when tokens >= 250 then 'none' when section_final then 'back' when header and paragraphs < 2 then 'forward' when after_table then 'back' else 'forward' end direction from s),
    p as (select *, lag(direction) over (partition by l_orderkey order by l_linenumber) before from m)
    select l_orderkey, l_linenumber, direction, sum(case when before is null or (direction <> 'back' and before <> 'forward') then 1 else 0 end) over (partition by l_orderkey order by l_linenumber)::bigint merged_no from p"""
)
def minimum_size_merge(spark, d):
    c = F.col
    rows = sized(spark, d).withColumn("direction", C.merge_direction(c("tokens"), c("section_final"), c("header"), c("paragraphs"), c("after_table")))
    return C.merge_runs(rows, "l_orderkey", "l_linenumber", "direction").select("l_orderkey", "l_linenumber", "direction", "merged_no")


@query(
    f"""with s as ({SIZED}), g as (select l_orderkey, list(tokens order by l_linenumber) ts from s group by 1)
    select l_orderkey, case when list_sum(ts) > 800 and len(ts) > 1 then (select k from (select unnest(range(1, len(ts))) k) order by abs(list_sum(ts[1:k]) - 500), k limit 1) end split_after from g"""
)
def long_section_split(spark, d):
    g = sized(spark, d).groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "tokens"))), lambda x: x["tokens"]).alias("ts"))
    return g.select("l_orderkey", C.split_point(F.col("ts")).cast("long").alias("split_after"))


NEAR = f"select l_orderkey, n * 4 + n // 3 a, n * 4 + n // 3 + cast(l_quantity as bigint) % 3 b, cast(l_quantity as bigint) * 10 n from {PLACED}"


@query(
    f"""with t as ({NEAR}), r as (select *, case when a - lag(b) over w - 1 < 3 then 0 else 1 end apart from t window w as (partition by l_orderkey order by a)), g as (select *, sum(apart) over (partition by l_orderkey order by a) g from r),
    o as (select *, case when sum(n) over (partition by l_orderkey, g) <= 1000 then 0 else row_number() over (partition by l_orderkey order by a) end own from g)
    select l_orderkey, a "first", dense_rank() over (partition by l_orderkey order by g, own) table_group from o"""
)
def near_tables(spark, d):
    read(spark, d, "lineitem").createOrReplaceTempView("folioscope_lines")
    rows = spark.sql(NEAR.replace("from lineitem", "from folioscope_lines").replace("n // 3", "(n div 3)"))
    return C.near_tables(rows, "l_orderkey", "a", "b", "n").select("l_orderkey", F.col("a").alias("first"), F.col("table_group").cast("long").alias("table_group"))


LEAD = "['What does it mean?', 'Our rules are:', 'Therefore we paid.', 'Consider the float', 'We paid them as follows and left', 'These are large.', 'A plain line', 'So it went'][1 + l_linenumber % 8]"


@query(
    rf"""with t as (select l_orderkey, l_linenumber, cast(l_quantity as bigint) * 10 tokens, 800 parent_tokens, {LEAD} x from lineitem)
    select l_orderkey, l_linenumber, case when regexp_matches(x, '[?:]$') or x like 'Consider%' or x like '%as follows%' then 'forward' when regexp_matches(x, '^(?:Therefore|These|So)\b') then 'back' else 'none' end direction,
    not regexp_matches(x, '^These') stands_alone, coalesce(l_linenumber = min(case when tokens between 120 and 400 and not regexp_matches(x, '^These') then l_linenumber end) over (partition by l_orderkey), false) second_tier,
    concat('lead in', chr(10), chr(10), x, case when l_linenumber % 2 = 0 then chr(10) || chr(10) || 'after' else '' end) chunk from t"""
)
def tier_rules(spark, d):
    """Directions of short paragraphs, self-containment, the one child that a parent gets, and tables with what is around."""
    n = F.col("l_linenumber")
    rows = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity").cast("long") * 10).alias("tokens"), F.lit(800).alias("parent_tokens"), F.expr(_spark_list(LEAD)).alias("content"))
    child = C.second_tier(rows, "l_orderkey", "l_linenumber").select("l_orderkey", "l_linenumber", F.lit(True).alias("second_tier"))
    return rows.join(child, ["l_orderkey", "l_linenumber"], "left").select(
        "l_orderkey", "l_linenumber", C.lead_direction(F.col("content")).alias("direction"), C.stands_alone(F.col("content")).alias("stands_alone"), F.coalesce("second_tier", F.lit(False)).alias("second_tier"),
        C.table_chunk(F.lit("lead in"), F.col("content"), F.when(n % 2 == 0, "after").otherwise("")).alias("chunk"),
    )


@query(
    r"""with w as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda v: v <> '') ws from documents)
    select doc_id, k window_no, array_to_string(ws[k * 150 + 1 : k * 150 + 150], ' ') as "content" from (select doc_id, ws, unnest(range(0, (len(ws) + 149) // 150)) k from w)"""
)
def word_windows(spark, d):
    return documents(spark, d).select("doc_id", F.posexplode(C.word_windows(F.col("text"))).alias("window_no", "content")).withColumn("window_no", F.col("window_no").cast("long"))


@query("select conv_id, turn, coalesce(string_split(lag(text) over (partition by conv_id order by turn), chr(10) || chr(10))[-1], '') overlap from conversations")
def chunk_overlap(spark, d):
    return C.overlapped(read(spark, d, "conversations"), "conv_id", "turn", "text").select("conv_id", "turn", "overlap")


LEADING = ["'Year ..... 1,000   2,000'", "'1976 ..... 12   13'", "case when c_custkey % 3 = 0 then 'Only text here.' else 'Shares  4  5' end", "''", "'We begin.'", "'a  1  2'", "'b  3  4'", "'c . . . . 5'", "'The end.'"]


@query(
    """select c_custkey, case when c_custkey % 3 = 0 then '00000' else '11100' end || '1110' flags, case when c_custkey % 3 = 0 then 9 else 5 end n_left from customer"""
)
def leading_tables(spark, d):
    """Lines of tables by the rules of the tiers, and letters without the table that they begin with."""
    read(spark, d, "customer").createOrReplaceTempView("folioscope_customers")
    one = spark.sql(f"select c_custkey, array({', '.join(LEADING)}) lines from folioscope_customers")
    flags = F.array_join(F.transform(C.table_block_lines(F.col("lines")), lambda v: v.cast("int").cast("string")), "")
    return one.select("c_custkey", flags.alias("flags"), F.size(C.without_leading_table(F.col("lines"))).alias("n_left"))
