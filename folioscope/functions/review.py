"""Extractors and checks of the other profiles and of the written rules: names, metrics, summaries, sentences, boundaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as T

# Patterns, names and limits that must be these for equal results.
COMPANY_SUFFIX = r"\b([A-Z][A-Za-z]+(?:\s+[A-Z][A-Za-z]+)*)\s+(?:Inc\.|Corp\.|Corporation|Company|Co\.)"
METRICS_V1 = [
    (r"(\d+(?:\.\d+)?%)", "percentage"), (r"\$(\d+(?:,\d{3})*(?:\.\d+)?)\s*(?:million|billion|M|B)?", "dollar_amount"), (r"(\d+(?:,\d{3})+)\s*(?:employees|people|shareholders)", "headcount"),
]
PHILOSOPHY_V1 = [r"we believe", r"our (?:view|approach|philosophy|policy)", r"the (?:key|important|crucial) (?:thing|point|lesson)", r"rules? (?:we|i) follow", r"principle"]
MISTAKE_V1 = "mistake|error|wrong|foolish|confession|failed"
PERFORMANCE_V1 = ["earnings", "net worth", "book value", "return on", "grew", "increased"]
GENERIC_SUMMARY = "develops the main ideas|supports quantitative analysis|provides tabular financial data"
TEMPLATE_OPENERS = r"^(?:this (?:section|chunk|passage|part)|the (?:section|chunk|passage|author|letter)|in this)\b"
PRINCIPLES = {"belief": r"\b(?:we|i) (?:believe|think|feel)\b", "rule": r"\b(?:should|must|never|always)\b", "lesson": r"\b(?:lesson|principle|rule|key)\b"}
NO_DATE = "0000-00-00"


def suffixed_names(text: Column) -> Column:
    """Capitalised names before a company's suffix, each once, in order."""
    return F.filter(F.array_distinct(F.regexp_extract_all(text, F.lit(COMPANY_SUFFIX), F.lit(1))), lambda n: F.length(n) > 2)


def metrics_v1(text: Column, most: int = 5) -> Column:
    """The first five of each of three kinds with the kind behind them, each once, sorted."""
    named = lambda k: lambda m: F.concat(m, F.lit(f" ({k})"))
    found = [F.transform(F.slice(F.regexp_extract_all(text, F.lit(p), F.lit(1)), 1, most), named(k)) for p, k in METRICS_V1]
    return F.array_sort(F.array_distinct(F.concat(*found)))


def content_type_v1(text: Column, table: Column) -> Column:
    low = F.lower(text)
    return (
        F.when(table, "financial_data").when(T.hits(text, PHILOSOPHY_V1) >= 2, "philosophy").when(low.rlike(MISTAKE_V1) & low.rlike(r"\b(?:i|we|my|our)\b"), "mistake_confession")
        .when(T.hits(text, PERFORMANCE_V1) >= 3, "performance_summary").when(low.rlike("annual meeting|shareholder.+meeting"), "annual_meeting").otherwise("narrative")
    )


def iso_date(text: Column) -> Column:
    """The date as yyyy-MM-dd, from that form or from "Month d, yyyy"; NO_DATE where it is none."""
    long = F.try_to_timestamp(F.regexp_replace(T.strip(text), r",?\s+|,", " "), F.lit("MMMM d yyyy"))
    return F.coalesce(F.date_format(F.try_to_date(text, "yyyy-MM-dd"), "yyyy-MM-dd"), F.date_format(long, "yyyy-MM-dd"), F.lit(NO_DATE))


def canonical_type(table: Column, principle: Column, performance: Column) -> Column:
    return F.when(table, "financial_table").when(principle, "philosophy").when(performance, "performance_summary").otherwise("narrative")


def sentences(text: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"(?<=[.!?])\s+"), T.strip), lambda s: s != "")


def principle_sentences(text: Column, patterns: dict[str, str] = PRINCIPLES) -> Column:
    """array<struct<statement,category>> of sentences that state a belief, a rule or a lesson; the first kind counts."""
    kind = F.lit(None).cast("string")
    found = F.transform(sentences(text), lambda s: F.struct(s.alias("statement"), _first(s, patterns, kind).alias("category")))
    return F.filter(found, lambda x: x["category"].isNotNull())


def _first(s: Column, patterns: dict[str, str], none: Column) -> Column:
    low, out = F.lower(s), none
    for name, p in reversed(patterns.items()):
        out = F.when(low.rlike(p), name).otherwise(out)
    return out


def forward_looking(text: Column) -> Column:
    return F.lower(text).rlike(r"\b(?:will|expect|anticipate|forecast|going forward|next year|in the future)\b")


def summary_findings(summary: Column, content: Column, most_words: int = 45, most_sentences: int = 3, least: int = 30, optional: bool = True) -> Column:
    """Names of the rules that a contextual summary breaks; the optional ones are warnings that the validator has but
    leaves off."""
    s, low = F.coalesce(summary, F.lit("")), F.lower(F.coalesce(summary, F.lit("")))
    n = F.size(sentences(summary))
    rules = [
        ("too_long", T.word_count(s) > most_words), ("sentences", ~n.between(1, most_sentences)), ("ellipsis", s.rlike(r"\.\.\.|…")), ("section_reference", low.rlike(r"\bsection\b|\bpart \w+ of \w+")),
        ("template", low.rlike(TEMPLATE_OPENERS)), ("verbatim", F.exists(sentences(summary), lambda x: F.contains(content, x))),
    ]
    if optional:
        rules += [("generic", low.rlike(GENERIC_SUMMARY)), ("too_short", F.length(T.strip(s)) < least)]
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in rules]))


def context_text(header: Column, section: Column, summary: Column, original: Column) -> Column:
    """What is embedded: header line, section, summary and the text itself; missing parts leave no blank line."""
    return F.concat_ws("\n", *[F.nullif(T.strip(F.coalesce(x, F.lit(""))), F.lit("")) for x in (header, section, summary)], original)


def is_snake_case(name: Column) -> Column:
    return F.coalesce(name, F.lit("")).rlike("^[a-z0-9_]+$")


def snake_case(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(T.strip(name)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def entry_names_metric(entry: Column, metric: Column) -> Column:
    """Whether a metric's entry begins with the metric's name."""
    return F.coalesce(F.startswith(entry, F.concat(metric, F.lit(":"))) | (entry == metric), F.lit(False))


def boundary_findings(content: Column) -> Column:
    """Names of the rules that a chunk's ends break: an open end, list numbers with a gap, an odd number of quotes."""
    numbers = F.transform(F.regexp_extract_all(content, F.lit(r"(?m)^\s*[\[(]?(\d+)[\]).]"), F.lit(1)), lambda v: v.cast("int"))
    gap = F.exists(F.transform(numbers, lambda v, i: v - F.coalesce(F.get(numbers, i - 1), v - 1)), lambda step: step != 1)
    rules = [("open_end", F.lower(T.strip(content)).rlike(r"(?:,|;|\band|\bor)$")), ("list_gap", gap), ("odd_quotes", F.regexp_count(content, F.lit('"')) % 2 == 1)]
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in rules]))


def tier_findings(tier: Column, tokens: Column, exception: Column, note: Column, content: Column) -> Column:
    """Names of the rules of size and leakage that a chunk of the first or second tier breaks."""
    leak = content.rlike(r"^\s*(?:This|That|These|Those|It|They|He|She)\b") | F.lower(content).rlike(r"\b(?:as (?:mentioned|noted|discussed) (?:above|earlier|before)|the (?:former|latter))\b")
    rules = [
        ("tier1_small", (tier == 1) & (tokens < 250) & ~F.coalesce(exception, F.lit(False))), ("tier1_no_note", (tier == 1) & (tokens > 1200) & (F.coalesce(note, F.lit("")) == "")),
        ("tier2_size", (tier == 2) & ~tokens.between(120, 400)), ("tier2_leak", (tier == 2) & leak),
    ]
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in rules]))


def table_has_context(content: Column, table: Column, least: int = 50) -> Column:
    """Whether a table's chunk has enough text before or after the table."""
    at = F.position(table, content)
    before, after = F.substring(content, F.lit(1), at - 1), F.substring(content, at + F.length(table), F.length(content))
    return (at > 0) & ((F.length(T.strip(before)) >= least) | (F.length(T.strip(after)) >= least))


def mid_sentence(content: Column) -> Column:
    """Whether a chunk begins in lower case or ends without a closing mark."""
    x = T.strip(F.coalesce(content, F.lit("")))
    return x.rlike(r"^\p{Ll}") | ~x.rlike(r"[.?!:\"')]$")
