"""Text predicates, extractors and scores as Column functions; lexicons and thresholds are parameters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


# The patterns, months and word lists in this module must be these for equal results; lexicons are parameters.


@dataclass(frozen=True)
class Profile:
    """Sizes in tokens of four characters, and which marks a table line has."""

    section_min: int = 50
    paragraph_min: int = 50
    target: int = 400
    long: int = 600
    most: int = 1500
    list_rule: str = "both"  # v1 asks the previous paragraph to contain a marker: "contains"
    table_lines: str = (
        r"(?U)(?d)^\s*\$[\d,]+|^\s*[\d,]+\s*$|^\s*\d+[.]\d+%?\s*$|[.]{4,}|^\s*[(]\d+[)]\s*$|^\s*[-–—]+\s*$"
        r"|\$[\d,]+\s+\$[\d,]+|[\d,]+\s{3,}[\d,]+|^\s*\d{4}\s*[.]{2,}"
    )


V3 = Profile()
V2 = Profile(table_lines=V3.table_lines.replace("[.]{4,}", "[.]{3,}") + r"|\S\s{2,}\S|^\s*[*]\s*$")
V1 = Profile(paragraph_min=30, target=300, most=450, list_rule="contains")
LIST_ITEM = r"^[\[(]?\d+[\]).]"
LIST_ANYWHERE = r"[\[(]?\d+[\]).]"
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"


def strip(x: Column) -> Column:
    """Trim every kind of white space, not blanks alone."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def tokens(x: Column) -> Column:
    return F.floor(F.length(x) / 4).cast("long")


def lines(text: Column) -> Column:
    return F.split(F.regexp_replace(text, "\r\n?", "\n"), "\n")


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")).cast("long")


def paragraph_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"\n\s*\n"), lambda p: strip(p) != "")).cast("long")


def is_table_line(line: Column, profile: Profile = V3) -> Column:
    return line.rlike(profile.table_lines)


def capital_share(words: Column) -> Column:
    return F.size(F.filter(words, lambda w: F.substring(w, 1, 1).rlike(r"^\p{Lu}"))) / F.greatest(F.size(words), F.lit(1))


def is_likely_header(line: Column, known: str = "(?!)") -> Column:
    """At most 80 characters; a known pattern, or 2 to 5 words, mostly capitalised, without closing punctuation."""
    x = strip(line)
    words = F.split(x, r"(?U)\s+")
    generic = F.size(words).between(2, 5) & ~x.rlike(r"[.,;:?!]$") & (capital_share(words) >= 0.7)
    return (x != "") & (F.length(x) <= 80) & (x.rlike(f"(?i)^(?:{known})") | generic)


def table_word_share(line: Column, vocabulary: list[str], phrases: str = "(?!)", least: float = 0.4) -> Column:
    found = F.regexp_extract_all(F.lower(line), F.lit(r"(?U)\b\w+\b"), F.lit(0))
    share = F.size(F.filter(found, lambda w: w.isin(vocabulary))) / F.greatest(F.size(found), F.lit(1))
    return (share >= least) & (F.size(found) > 0) | F.lower(line).rlike(phrases)


def is_signature(line: Column, people: str = "(?!)") -> Column:
    return F.lower(strip(line)).rlike(rf"^(?:{people}|chairman|vice\s+chairman|\w+\s+\d{{1,2}},?\s*\d{{4}}$|(?:{MONTHS.lower()})\s+\d)")


def is_sentence_start(line: Column) -> Column:
    link = "finally|additionally|moreover|furthermore|however|therefore|thus"
    lead = "we|i|our|the|this|that|these|those|it|there|here|as|if|when|while|although|because|since|unless"
    return F.lower(line).rlike(rf"^(?:(?:{link}),?\s|(?:{lead})\s|(?:in|on|at|by|for|with|from|to|of)\s+(?:the|our|this|that|an?)\s)")


def is_asterisk_rule(line: Column) -> Column:
    return line.rlike(r"^\s*\*[\s*]+\*\s*$")


def has_table(text: Column, least: int = 4) -> Column:
    """At least four lines with two dollar amounts, a dot leader, a dotted year, or three spaced numbers."""
    row = lambda x: (F.regexp_count(x, F.lit(r"\$[\d,]+")) >= 2) | x.rlike(r"[.]{5,}|^\s*\d{4}\s*[.]|\d+[.]?\d*\s{3,}\d+[.]?\d*\s{3,}\d+")
    return F.size(F.filter(F.split(text, "\n"), row)) >= least


def has_financial(text: Column) -> Column:
    return text.rlike(r"\$[\d,]+|\d+[.]?\d*%")


def contained(text: Column, names: list[str]) -> Column:
    """Names found anywhere in the text, whatever their case, in the order of the list."""
    low = F.lower(text)
    return F.array_compact(F.array(*[F.when(F.contains(low, F.lit(n.lower())), F.lit(n)) for n in names]))


def tagged(text: Column, lexicon: dict[str, str], most: int | None = None) -> Column:
    """Labels whose pattern the lower-cased text matches, in the order of the lexicon. Patterns are matched as they
    are, so capitals in them never match."""
    low = F.lower(text)
    found = F.array_compact(F.array(*[F.when(low.rlike(p), F.lit(k)) for k, p in lexicon.items()]))
    return F.slice(found, 1, most) if most else found


def metrics(text: Column, most: int = 5) -> Column:
    """The first five percentages, then of the first five dollar amounts those with a unit, a comma or over four
    digits; each once."""
    percents = F.slice(F.regexp_extract_all(text, F.lit(r"(\d+[.]?\d*%)"), F.lit(1)), 1, most)
    money = r"(?i)\$(\d+(?:,\d{3})*(?:[.]\d+)?)\s*(million|billion)?"
    amounts = F.slice(F.arrays_zip(F.regexp_extract_all(text, F.lit(money), F.lit(1)).alias("a"), F.regexp_extract_all(text, F.lit(money), F.lit(2)).alias("u")), 1, most)
    kept = F.filter(amounts, lambda m: (m["u"] != "") | F.contains(m["a"], F.lit(",")) | (F.length(F.replace(m["a"], F.lit(","), F.lit(""))) > 4))
    shown = F.transform(kept, lambda m: F.when(m["u"] != "", F.concat(F.lit("$"), m["a"], F.lit(" "), m["u"])).otherwise(F.concat(F.lit("$"), m["a"])))
    return F.array_distinct(F.concat(percents, shown))


def mentioned_years(text: Column, primary: Column, most: int = 10) -> Column:
    years = F.transform(F.regexp_extract_all(text, F.lit(r"\b(19[6-9]\d|20[0-2]\d)\b"), F.lit(1)), lambda y: y.cast("int"))
    return F.slice(F.array_sort(F.array_distinct(F.filter(years, lambda y: y != primary))), 1, most)


def has_comparison(text: Column) -> Column:
    return F.lower(text).rlike(r"compared to|versus|vs[.]?|year.ago|previous year")


def has_forecast(text: Column) -> Column:
    return F.lower(text).rlike("expect|anticipate|forecast|outlook|going forward")


def hits(text: Column, patterns: list[str]) -> Column:
    low = F.lower(text)
    return sum((low.rlike(p).cast("int") for p in patterns), F.lit(0))


def content_type(text: Column, table: Column) -> Column:
    low = F.lower(text)
    return (
        F.when(table, "financial_table")
        .when(hits(text, ["we believe", "our (?:view|approach|philosophy)", "principle"]) >= 2, "philosophy")
        .when(low.rlike(r"\b(?:i|we|my|our)\b.{0,30}\b(?:mistake|error|wrong|foolish)\b"), "mistake_confession")
        .when(hits(text, ["net worth", "book value", "per.share", "operating earnings"]) >= 2, "performance_summary")
        .when(low.rlike("annual meeting|shareholder.+meeting"), "annual_meeting")
        .otherwise("narrative")
    )


def letter_date(text: Column) -> Column:
    """The last "Month d, yyyy" in the last 2,000 characters, else the last "d Month yyyy"."""
    tail = F.right(text, F.lit(2000))
    last = lambda p: F.try_element_at(F.regexp_extract_all(tail, F.lit(p), F.lit(1)), F.lit(-1))
    return F.coalesce(last(rf"((?:{MONTHS})\s+\d{{1,2}},?\s*\d{{4}})"), last(rf"(\d{{1,2}}\s+(?:{MONTHS})\s+\d{{4}})"))


def chunk_id(year: Column, section: Column, kind: Column, number: Column | None = None) -> Column:
    code = F.when(kind == "table", "TBL").when(kind == "paragraph", "PAR").otherwise("SEC")
    base = F.concat(year.cast("string"), F.lit("-S"), F.lpad(section.cast("string"), 2, "0"), F.lit("-"), code)
    return base if number is None else F.concat(base, F.lit("-"), F.lpad(number.cast("string"), 3, "0"))


def year_of_name(name: Column) -> Column:
    return F.regexp_extract(name, r"(\d{4})", 1).try_cast("int")


def priority_score(high: Column, philosophy: Column, forward: Column, concepts: Column, financial: Column, table: Column, themes: Column) -> Column:
    n = lambda c: c.cast("int")
    return 30 * n(high) + 25 * n(philosophy) + 20 * n(forward) + 10 * concepts + 15 * n(financial) + 10 * n(table) + 5 * themes


def level(score: Column) -> Column:
    return F.when(score >= 40, "high").when(score >= 20, "medium").otherwise("low")


def abstraction(abstract: Column, concrete: Column) -> Column:
    ratio = F.try_divide(abstract, abstract + concrete)
    return F.when(ratio >= 0.7, "high").when(ratio <= 0.3, "low").otherwise("medium")
