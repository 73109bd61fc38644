"""Queries of framework items, audits, reports and statements' metrics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import fundamentals as N
from ..operators import knowledge as G
from ..operators import relate as R
from ..operators import retrieval as O
from .catalogue import query, read
from .section_queries import _spark_list

FILES = """['{"categories": []}', '{"year": 1977, "criteria": [{"id": "a", "principle": "p1"}, {"id": "b", "principle": "p2"}], "flags": [{"id": "f", "flag": "x"}], "models": ["m1", "m2"]}', '{"letter_metadata": {}, "flags": []}', '[]', '{broken'][1 + c_custkey % 5]"""


def picked(spark, d, expr: str, name: str = "x"):
    return read(spark, d, "customer").select("c_custkey", F.expr(_spark_list(expr)).alias(name))


@query("select c_custkey, ['master', 'yearly', 'yearly', 'unknown', 'not_json'][1 + c_custkey % 5] input_type from customer")
def input_types(spark, d):
    return picked(spark, d, FILES).select("c_custkey", G.input_type(F.col("x")).alias("input_type"))


@query("select c_custkey, unnest(['criteria', 'criteria', 'flags', 'models', 'models']) list, unnest([0, 1, 0, 0, 1]) pos, unnest(['a', 'b', 'f', null, null]) id, unnest(['p1', 'p2', 'x', 'm1', 'm2']) text from customer where c_custkey % 5 = 1")
def long_form_items(spark, d):
    return G.long_form(picked(spark, d, FILES), "c_custkey", "x", ["criteria", "flags", "models"])


@query("select p_partkey, case when p_size % 4 = 0 then 'duplicate' when p_size % 3 = 0 then 'exception' when p_size % 2 = 0 then 'parallel' else 'new' end relation from part")
def first_relations(spark, d):
    s = F.col("p_size")
    got = F.array_compact(F.array(F.lit("new"), F.when(s % 2 == 0, "parallel"), F.when(s % 3 == 0, "exception"), F.when(s % 4 == 0, "duplicate")))
    return read(spark, d, "part").select("p_partkey", G.first_relation(got).alias("relation"))


@query(
    r"""with p as (select p_partkey, list_distinct(string_split(p_name, ' ')) a, list_distinct(string_split(p_type, ' ')) b, list_distinct(string_split(p_name || ' ' || p_type, ' ')) c from part),
    j as (select p_partkey, len(list_intersect(a, c)) / len(c) ja, len(list_intersect(b, c)) / len(c) jb from p), s as (select p_partkey, 4 * (case when ja >= 0.75 then 3 when ja >= 0.5 then 2 when ja >= 0.25 then 1 else 0 end) + 4 * (case when jb >= 0.75 then 3 when jb >= 0.5 then 2 when jb >= 0.25 then 1 else 0 end) score from j)
    select p_partkey, score, case when score >= 20 then 'merge' when score >= 16 then 'merge_with_note' when score >= 12 then 'make_sub_item' when score >= 8 then 'link' when score >= 4 then 'keep_both' else 'unrelated' end verdict from s"""
)
def redundancy_tribunal(spark, d):
    """Eight dimensions of a pair, each 0 to 3 by the overlap of words."""
    a, b, c = F.split("p_name", " "), F.split("p_type", " "), F.split(F.concat("p_name", F.lit(" "), "p_type"), " ")
    score = sum((G.similarity_bucket(x, c) for x in (a, b) * 4), F.lit(0))
    return read(spark, d, "part").select("p_partkey", score.alias("score")).withColumn("verdict", G.tribunal(F.col("score")))


@query("select p_type, count(*) n_items, min(p_partkey) as into_item from part group by 1 having count(*) > 1")
def mandatory_consolidation(spark, d):
    return G.must_merge(read(spark, d, "part"), "p_type", "p_partkey").withColumnRenamed("into", "into_item")


@query(
    """with n as (select p_brand, count(*) n_items from part group by 1), o as (select distinct p_brand from part where p_partkey % 2 = 0), b as (select n.*, o.p_brand is not null old, count(*) filter (o.p_brand is null) over () extra from n left join o using (p_brand))
    select p_brand, n_items, case when p_brand not like '%1%' then 'unknown' when n_items = 1 then 'single_item' when extra > 1 and not old then 'growth' else '' end finding from b"""
)
def category_governance(spark, d):
    p = read(spark, d, "part")
    return G.governance(p, "p_brand", [f"Brand#{n}" for n in range(1, 100) if "1" in str(n)], p.where("p_partkey % 2 = 0"))


@query("select p_brand, count(distinct p_size) n_definitions from part group by 1 having count(distinct p_size) > 1")
def metric_conflicts(spark, d):
    return G.metric_conflicts(read(spark, d, "part"), "p_brand", "p_size")


@query("with c as (select n_name concept, n_nationkey % 2 = 0 due from nation), s as (select n_name concept, count(*) n_items from supplier join nation on s_nationkey = n_nationkey group by 1) select concept, due, coalesce(n_items, 0) n_items, case when n_items >= 3 then 'PASS' when n_items > 0 then 'PARTIAL' when due then 'FAIL' else 'NOT_YET' end status from c left join s using (concept)")
def regression_registry(spark, d):
    n, s = read(spark, d, "nation"), read(spark, d, "supplier")
    index = s.join(n, s.s_nationkey == n.n_nationkey).select(F.col("n_name").alias("concept"))
    return G.registry(n.select(F.col("n_name").alias("concept"), (F.col("n_nationkey") % 2 == 0).alias("due")), index, "concept")


@query("select o_orderkey, case o_orderpriority when '1-URGENT' then 'high' when '2-HIGH' then 'high' else o_orderpriority end importance, case when year(o_orderdate) >= 1996 then 'late' when year(o_orderdate) >= 1994 then 'middle' end era from orders")
def vocabulary_and_era(spark, d):
    """Labels of an older vocabulary in the words of the new one, and the era of a year."""
    o = read(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("importance"), G.era(F.year("o_orderdate"), {"late": 1996, "middle": 1994}).alias("era"))
    return G.renamed(o, "importance", {"1-URGENT": "high", "2-HIGH": "high"})


MD = ["'# Year'", "concat('## Theme ', c_name)", "'**Reusable principle:**'", "'- hold'", "concat('* buy ', c_mktsegment)", "'### Other'", "'- nothing'", "'### Evaluation questions'", "'text'", "'- why?'", "'## Next'", "'- loose'"]


@query(
    """select c_custkey, unnest([3, 4, 9]) idx, 'Theme ' || c_name heading, unnest(['Reusable principle', 'Reusable principle', 'Evaluation questions']) part, unnest(['hold', 'buy ' || c_mktsegment, 'why?']) item from customer"""
)
def markdown_items(spark, d):
    read(spark, d, "customer").createOrReplaceTempView("folioscope_customers")
    rows = spark.sql(f"select c_custkey, posexplode(array({', '.join(MD)})) as (idx, line) from folioscope_customers")
    return G.markdown_items(rows, "c_custkey", ["Reusable principle", "Evaluation questions"])


@query("select count(*) filter (k % 4 = 0) merged, count(*) filter (k % 4 = 1) added, count(*) filter (k % 4 = 2) linked, count(*) filter (k % 4 = 3) rejected, count(*) n_rows, true balanced from (select c_custkey k from customer)")
def update_summary(spark, d):
    log = read(spark, d, "customer").select(F.element_at(F.array(*map(F.lit, ("merged", "added", "linked", "rejected"))), (F.col("c_custkey") % 4 + 1).cast("int")).alias("decision"))
    return G.update_summary(log, "decision", F.col("n_rows"))


@query(
    """select c_custkey, s score, case when c_custkey % 17 = 0 then 'FAIL' when s >= 85 then 'PASS' when s >= 70 then 'REVISE' else 'FAIL' end verdict from (select c_custkey, cast(c_custkey % 51 + 30 + c_custkey % 21 as bigint) s from customer)"""
)
def review_score(spark, d):
    k = F.col("c_custkey")
    s = read(spark, d, "customer").select("c_custkey", (k % 51).alias("a"), F.lit(30).alias("b"), (k % 21).alias("c"), (k % 17 == 0).alias("broken"))
    return G.review(s, "c_custkey", ["a", "b", "c"], ["broken"])


@query("select lang, count(*) n, count(*) filter (e) with_excerpt, count(*) filter (c) with_chunk, count(*) filter (e and c) traced, count(*) filter (not e and not c) untraced from (select lang, doc_id % 3 <> 0 e, doc_id % 4 <> 0 c from documents) group by 1")
def traceability_audit(spark, d):
    k = F.col("doc_id")
    rows = read(spark, d, "documents").select("lang", F.when(k % 3 != 0, "x").alias("e"), F.when(k % 4 != 0, k).alias("c"))
    return G.traceability(rows, "lang", "e", "c")


@query("select p_brand, count(*) filter (p_partkey % 5 < 4) before, count(*) after, (count(*) - count(*) filter (p_partkey % 5 < 4)) > least(0.15 * count(*) filter (p_partkey % 5 < 4), 5.0) alarm from part group by 1")
def growth_alarm(spark, d):
    n = read(spark, d, "part").groupBy("p_brand").agg(F.count_if(F.col("p_partkey") % 5 < 4).alias("before"), F.count(F.lit(1)).alias("after"))
    return n.withColumn("alarm", G.growth_alarm(F.col("before"), F.col("after")))


@query("select p_brand, count(*) filter (p_size % 3 = 0) explicit, count(*) filter (p_size % 3 = 1) implicit, count(*) filter (p_size % 3 = 2) none from part group by 1")
def item_counts(spark, d):
    kind = F.element_at(F.array(F.lit("explicit"), F.lit("implicit"), F.lit("none")), (F.col("p_size") % 3 + 1).cast("int"))
    return read(spark, d, "part").select("p_brand", kind.alias("kind")).groupBy("p_brand").pivot("kind", ["explicit", "implicit", "none"]).count().fillna(0)


@query("select p_partkey, concat_ws('|', case when p_partkey % 5 = 0 then 'id' end, case when p_partkey % 4 = 3 then 'importance' end, case when p_partkey % 6 = 5 then 'time_horizon' end, case when p_partkey % 7 not between 3 and 10 then 'tags' end) findings from part")
def item_vocabulary(spark, d):
    k = F.col("p_partkey")
    at = lambda n, *xs: F.element_at(F.array(*map(F.lit, xs)), (k % n + 1).cast("int"))
    found = G.vocabulary_findings(F.when(k % 5 == 0, "77_1").otherwise("1977_001"), at(4, "high", "medium", "low", "huge"), at(6, "short", "medium", "long", "permanent", "long", "brief"), F.slice(F.sequence(F.lit(1), F.lit(9)), F.lit(1), (k % 7).cast("int")))
    return read(spark, d, "part").select("p_partkey", F.array_join(found, "|").alias("findings"))


@query("select c_custkey, unnest(['DATA', 'DATA', 'WB']) kind, unnest(['revenue', 'm' || c_custkey % 3, 'c' || c_custkey % 4]) id, unnest([true, c_custkey % 3 = 1, c_custkey % 4 = 2]) resolved from customer")
def evidence_tags(spark, d):
    """Tags of a report and whether what they name is there."""
    known = spark.createDataFrame([("DATA", "revenue"), ("DATA", "m1"), ("WB", "c2")], "kind string, id string")
    k = F.col("c_custkey").cast("bigint")
    text = F.concat(F.lit("Up [DATA:revenue|2024] and [DATA:m"), (k % 3).cast("string"), F.lit("|2023] as said [WB:1977|S1|c"), (k % 4).cast("string"), F.lit("]."))
    return G.resolve_tags(read(spark, d, "customer").select("c_custkey", text.alias("t")), "c_custkey", "t", known)


@query("select o_custkey, o_orderpriority section, o_orderkey, rank from (select *, row_number() over (partition by o_custkey, o_orderpriority order by o_totalprice desc, o_orderkey) rank from orders) where rank <= 2")
def report_sections(spark, d):
    """The two best items of each section of each report."""
    o = read(spark, d, "orders").select("o_custkey", F.col("o_orderpriority").alias("section"), "o_orderkey", "o_totalprice", F.concat_ws("|", "o_custkey", "o_orderpriority").alias("k"))
    top = O.top_k(o, "k", [F.desc("o_totalprice"), F.col("o_orderkey")], 2)
    return top.select("o_custkey", "section", "o_orderkey", F.col("rank").cast("long").alias("rank"))


@query("select doc_id, case when doc_id % 5 = 0 then 'missing' when doc_id % 3 = 0 then 'small' else '' end finding from documents where doc_id % 5 = 0 or doc_id % 3 = 0")
def tier2_parents(spark, d):
    """Second-tier records whose parent is no first-tier record or too small."""
    docs = read(spark, d, "documents").select("doc_id")
    parents = docs.where("doc_id % 5 <> 0").select(F.col("doc_id").alias("p"), F.when(F.col("doc_id") % 3 == 0, 200).otherwise(300).alias("tokens"))
    lost = R.orphans(docs, parents, "doc_id", "p").select("doc_id", F.lit("missing").alias("finding"))
    return lost.unionByName(R.bad_parents(docs, parents, "doc_id", "p", F.col("tokens") < 250).select("doc_id", F.lit("small").alias("finding")))


@query("select item, n_years, rank from (select *, row_number() over (order by n_years desc, n desc, item) rank from (select p_brand item, count(distinct year(l_shipdate)) n_years, count(*) n from lineitem join part on p_partkey = l_partkey group by 1)) where rank <= 10")
def ranked_backbone(spark, d):
    """The ten items that recur most."""
    rows = read(spark, d, "lineitem").join(read(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("p_brand").alias("item")).agg(F.count_distinct(F.year("l_shipdate")).alias("n_years"), F.count(F.lit(1)).alias("n"))
    top = rows.orderBy(F.desc("n_years"), F.desc("n"), "item").limit(10)  # ten rows are ranked
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n_years"), F.desc("n"), "item")).cast("long")).select("item", "n_years", "rank")


@query()
def daily_item(spark, d):
    return G.daily_item(read(spark, d, "part").select("p_partkey", "p_name"), "p_partkey", F.lit("2024-05-04"))


@query("select p_partkey from part where p_size between 10 and 20 and list_contains(string_split(p_type, ' '), 'PROMO') and p_partkey % 2 = 1")
def filtered_mapping(spark, d):
    """A query that maps to filters over a range, a list and a tier."""
    return read(spark, d, "part").where(F.col("p_size").between(10, 20) & F.array_contains(F.split("p_type", " "), "PROMO") & (F.col("p_partkey") % 2 == 1)).select("p_partkey")


@query("select conv_id, turn, coalesce(lag(text, 2) over w, '') before_2, coalesce(lag(text) over w, '') before_1, coalesce(lead(text) over w, '') after_1, coalesce(lead(text, 2) over w, '') after_2 from conversations window w as (partition by conv_id order by turn)")
def context_two(spark, d):
    """Two turns on either side."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    at = lambda n, name: F.coalesce(F.lag("text", n).over(w) if n > 0 else F.lead("text", -n).over(w), F.lit("")).alias(name)
    return read(spark, d, "conversations").select("conv_id", "turn", at(2, "before_2"), at(1, "before_1"), at(-1, "after_1"), at(-2, "after_2"))


# -- statements --------------------------------------------------------------------------------------------------------

ITEMS = {
    "net_sales": "sum(o_totalprice)", "gross_profit": "sum(o_totalprice) * 0.4", "operating_profit": "sum(case when o_orderstatus = 'F' then o_totalprice * 0.5 end)", "net_profit": "sum(case when o_orderstatus = 'F' then o_totalprice * 0.3 end)",
    "short_borrowings": "count(*) * 1000.0", "long_borrowings": "count(*) * 2000.0", "equity": "sum(o_totalprice) * 0.2", "interest": "-1.0 * count(*)", "current_assets": "sum(o_totalprice) * 0.3", "current_liabilities": "case when year(o_orderdate) = 1995 then 0.0 else count(*) * 5.0 end",
    "operating_cash": "sum(o_totalprice) * 0.25", "capex": "sum(o_totalprice) * -0.1", "dividends": "count(*) * -3.0", "cash": "count(*) * 7.0", "depreciation": "count(*) * 11.0", "earnings_per_share": "sum(o_totalprice) / 1000",
}
WIDE = "select year(o_orderdate) y, " + ", ".join(f"{v} {k}" for k, v in ITEMS.items()) + " from orders group by year(o_orderdate)"


def _metric_sql(name: str, formula: str, fields: list[str]) -> str:
    absent = [f for f in fields if f not in ITEMS]
    if absent:
        return f"select y, '{name}' metric_name, null::double \"value\", 'no field {absent[0]}' missing_reason from w"
    top, slash, bottom = formula.partition(" / ")
    value = f"({top}) / nullif({bottom}, 0)" if slash else formula
    null = " ".join(f"when {f} is null then 'null {f}'" for f in fields)
    return f"select y, '{name}', round(case when {' or '.join(f + ' is null' for f in fields)} then null else {value} end, 6), case {null} {f'when ({bottom}) = 0 then ' + chr(39) + 'zero divisor' + chr(39) if slash else ''} end from w"


@query(f"with w as ({WIDE}) select * from (" + " union all ".join(_metric_sql(k, f, n) for k, (f, n) in N.METRICS.items()) + ") t(y, metric_name, \"value\", missing_reason)")
def statement_metrics(spark, d):
    """All metrics over a statement that has their fields; one has a zero divisor in a year, one lacks a field."""
    read(spark, d, "orders").createOrReplaceTempView("folioscope_orders")
    return N.metric_records(spark.sql(WIDE.replace("from orders", "from folioscope_orders")), ["y"]).drop("formula", "source_fields")


@query(
    """with i as (select o_custkey t, year(o_orderdate) y, sum(o_totalprice) v from orders where o_orderstatus = 'F' group by 1, 2), b as (select o_custkey t, year(o_orderdate) y, sum(o_totalprice) v from orders where o_orderstatus = 'O' group by 1, 2), c as (select o_custkey t, year(o_orderdate) y, count(*) v from orders group by 1, 2)
    select t, y, round(i.v / b.v, 6) ratio, c.v n from i join b using (t, y) join c using (t, y)"""
)
def three_statements(spark, d):
    """Three statements joined by company and year."""
    o = read(spark, d, "orders").select(F.col("o_custkey").alias("t"), F.year("o_orderdate").alias("y"), "o_totalprice", "o_orderstatus")
    of = lambda s, name: o.where(F.col("o_orderstatus") == s).groupBy("t", "y").agg(F.sum("o_totalprice").alias(name))
    return of("F", "i").join(of("O", "b"), ["t", "y"]).join(o.groupBy("t", "y").agg(F.count(F.lit(1)).alias("n")), ["t", "y"]).select("t", "y", F.round(F.col("i") / F.col("b"), 6).alias("ratio"), "n")


@query("with s as (select o_custkey, year(o_orderdate) y, sum(o_totalprice) v from orders group by 1, 2), g as (select *, v / lag(v) over (partition by o_custkey order by y) - 1 g from s) select o_custkey, case when count(*) > 1 then round(regr_slope(v, y), 4) end slope, round(stddev_samp(g), 6) volatility from g group by 1")
def trend_and_volatility(spark, d):
    s = read(spark, d, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.sum("o_totalprice").alias("v"))
    g = s.withColumn("g", F.col("v") / F.lag("v").over(Window.partitionBy("o_custkey").orderBy("y")) - 1)
    return g.groupBy("o_custkey").agg(F.round(F.regr_slope("v", "y"), 4).alias("slope"), F.round(F.stddev_samp("g"), 6).alias("volatility"))


@query(
    """with o as (select o_orderkey, concat(o_custkey, o_orderpriority) topic, year(o_orderdate) y from orders)
    select a.o_orderkey seed, b.o_orderkey, abs(a.y - b.y) distance from o a join o b on a.topic = b.topic and abs(a.y - b.y) <= 1 and a.o_orderkey <> b.o_orderkey where a.o_orderkey % 20 = 0"""
)
def same_topic(spark, d):
    """Items of a seed's topic in its own and the neighbouring years; seeds are a stated set."""
    o = read(spark, d, "orders").select("o_orderkey", F.concat("o_custkey", "o_orderpriority").alias("topic"), F.year("o_orderdate").alias("y"))
    return R.same_topic(o.where("o_orderkey % 20 = 0"), o, "o_orderkey", "topic", "y")


UNIT = "['Net sales (Bn. VND)', 'Net sales (million)', 'Units', 'Cost (bn)'][1 + c_custkey % 4]"


@query("select c_custkey, [2e9, 2e6, 2.0, 3e10][1 + c_custkey % 4] \"value\", ['scaled', 'scaled', 'plain', 'kept'][1 + c_custkey % 4] unit from customer")
def unit_normalisation(spark, d):
    k = F.col("c_custkey")
    return picked(spark, d, UNIT).select("c_custkey", *N.unit_normalised(F.when(k % 4 == 3, 3e10).otherwise(2.0), F.col("x")))
