"""Sections and chunk records: header and separator rules of three profiles, titles, assembly, sizes.

Rules look at a line and its two neighbours, so they are columns over (key, idx, line) rows with one window by document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from . import segment as S

# Words and patterns that must be these for equal results.
SMALL_V1 = ["and", "of", "the", "for", "&"]
SMALL_V2 = ["and", "of", "the", "for", "&", "a", "in"]
SENTENCE_WORDS_V2 = ["is", "are", "was", "were", "have", "has", "had", "will", "would", "can", "could", "should", "may", "that", "which", "who", "when", "where", "because"]
HEADER_V1 = r"^[A-Z][A-Za-z\s&,\-']+$|^(?:Insurance|Textile|Banking|Manufacturing|Retail|Utility|Finance|Investment)[\w\s&,\-']+$"
SEPARATOR_V1 = r"\*(?:\s*\*){11}|\[\[PAGE_BREAK\]\]|^[-=]{10,}$"
SEPARATOR_V2 = r"^\*[\s\*]+\*$|^[-=]{10,}$|^\[\[PAGE_BREAK\]\]$"
IMPLICIT_START = r"(?i)^(?:Let'?s (?:move|turn|now look) to|Now (?:let'?s|I'?ll|we'?ll)|Finally,? (?:we|I|let me)|Our \w+ operations? (?:continued|had|produced|generated)|\*(?: \*){11})"
TABLE_TITLE = r"(?:Earnings|Revenue|Float|Premium|Cost|Market|Shares|Company)\s*(?:\(|$)"


def _words(x: Column) -> Column:
    return F.split(x, r"(?U)\s+")


def _share(words: Column, small: list[str], lower: bool) -> Column:
    named = lambda w: (F.lower(w) if lower else w).isin(small)
    return F.size(F.filter(words, lambda w: w.rlike(r"^\p{Lu}") | named(w))) / F.greatest(F.size(words), F.lit(1))


def header_v1(x: Column, before: Column, after: Column) -> Column:
    """A stripped line of 3 to 80 characters and at most six words, most of them capitalised, that a blank line touches."""
    apart = (F.coalesce(before, F.lit("")) == "") | (F.coalesce(after, F.lit("")) == "")
    words = _words(x)
    return F.length(x).between(3, 80) & apart & x.rlike(HEADER_V1) & (F.size(words) <= 6) & (_share(words, SMALL_V1, False) >= 0.7)


def header_v2(x: Column, before: Column, after: Column, is_table: Column, in_context: Column, known: str = "(?!)", never: list[str] | None = None) -> Column:
    """v1 with more rejects: terms of tables, table lines and their surroundings, unfinished lines; known headers need no
    blank line; generic ones have two to six words and none that tells a sentence."""
    words = _words(x)
    reject = ~F.length(x).between(3, 80) | is_table | in_context | x.rlike(r",$|^\p{Ll}")
    if never:
        reject = reject | F.lower(x).isin(never)
    apart = F.coalesce(before, F.lit("")).rlike(r"^$|^\*") | (F.coalesce(after, F.lit("")) == "")
    title = F.size(words).between(2, 6) & (_share(words, SMALL_V2, True) >= 0.8) & ~F.exists(words, lambda w: F.lower(w).isin(SENTENCE_WORDS_V2)) & (~x.rlike(r"[.]$") | (F.size(words) <= 4))
    return ~reject & (x.rlike(f"(?i)^(?:{known})$") | (apart & title))


def is_separator(line: Column, version: int = 3) -> Column:
    if version == 3:
        return T.is_asterisk_rule(line)
    return T.strip(line).rlike(SEPARATOR_V1 if version == 1 else SEPARATOR_V2)


def is_implicit_start(line: Column) -> Column:
    return T.strip(line).rlike(IMPLICIT_START)


def infer_title(line: Column) -> Column:
    """Title of a section that only its first line tells."""
    x = T.strip(line)
    moved, ours = r"(?i)^Let'?s (?:move|turn) to (.+)", r"(?i)^Our (\w+(?:\s+\w+)?)\s+(?:operation|business)"
    named = F.initcap(F.regexp_extract(x, r"(?i)^Our (\w+(?:\s+\w+)?)", 1))
    return (
        F.when(x.rlike(moved), F.left(F.regexp_replace(F.regexp_extract(x, moved, 1), r"[.]+$", ""), F.lit(50)))
        .when(x.rlike(ours), named)
        .otherwise(F.concat(F.left(F.array_join(F.slice(_words(x), 1, 4), " "), F.lit(40)), F.lit("...")))
    )


def neighbours(rows: DataFrame, key: str, profile: T.Profile = T.V3) -> DataFrame:
    """rows with x (stripped), before, after, is_table and in_context."""
    w = Window.partitionBy(key).orderBy("idx")
    x = rows.withColumn("x", T.strip(F.col("line"))).withColumn("is_table", T.is_table_line(F.col("x"), profile))
    return S.table_context(x, key, "idx", "is_table").withColumn("before", F.lag("x").over(w)).withColumn("after", F.lead("x").over(w))


def next_line(key: str, line: str = "x") -> Column:
    """The next line that is not blank."""
    w = Window.partitionBy(key).orderBy("idx").rowsBetween(1, Window.unboundedFollowing)
    return F.first(F.when(F.col(line) != "", F.col(line)), ignorenulls=True).over(w)


def split_sections(rows: DataFrame, key: str, start: Column, title: Column, drop: Column | None = None, opening: str = "Opening") -> DataFrame:
    """(key, section_no, section_title, lines): a line where start holds begins a section with the title and is no part of
    it; lines where drop holds go too. What comes first is the opening. Sections without a line left have no number."""
    w = Window.partitionBy(key).orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    marked = rows.select(key, "idx", "line", start.alias("_s"), F.when(start, title).alias("_t"), (start | (drop if drop is not None else F.lit(False))).alias("_d"))
    marked = marked.select(key, "idx", "line", "_d", F.sum(F.col("_s").cast("int")).over(w).alias("_n"), F.coalesce(F.last("_t", ignorenulls=True).over(w), F.lit(opening)).alias("section_title"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("idx", "line"))), lambda r: r["line"])
    kept = marked.where("not _d").groupBy(key, "_n").agg(F.min("section_title").alias("section_title"), lines.alias("lines"))
    return kept.withColumn("section_no", F.row_number().over(Window.partitionBy(key).orderBy("_n"))).drop("_n")


def without_tables(lines: Column, profile: T.Profile = T.V3, blocks: Column | None = None) -> Column:
    """Lines outside table blocks of three lines or more, whether the section counts as having a table or not; the blocks
    can be given."""
    blocks = S.table_blocks(lines, profile) if blocks is None else blocks
    return F.element_at(F.transform(F.array(blocks), lambda b: F.filter(lines, lambda _, i: ~F.exists(b, lambda x: i.between(x["first"], x["last"])))), 1)


def table_texts(lines: Column, profile: T.Profile = T.V3, least: int = 50, blocks: Column | None = None) -> Column:
    """Texts of table blocks of over `least` characters, if the section has a table at all; the blocks can be given."""
    blocks = S.table_blocks(lines, profile) if blocks is None else blocks
    text = lambda b: F.array_join(F.slice(lines, b["first"] + 1, b["last"] - b["first"] + 1), "\n")
    found = F.filter(F.transform(blocks, text), lambda t: F.length(t) > least)
    return F.when(T.has_table(F.array_join(lines, "\n")), found).otherwise(F.array().cast("array<string>"))


def chunk_records(sections: DataFrame, key: str, year: Column, profile: T.Profile = T.V3, root: str = "Letter Body") -> DataFrame:
    """One row per chunk of sections (key, section_no, section_title, lines): a section's tables come first, then its text
    as one chunk or, beyond the long size, packed paragraphs. Text below the smallest size is none."""
    lines = F.col("lines")
    text = T.strip(F.array_join(F.col("plain"), "\n"))
    size = T.tokens(text)
    packed = F.filter(S.pack_paragraphs(S.join_sentences(F.col("plain")), profile), lambda c: T.tokens(c) >= profile.paragraph_min)
    body = F.when(size < profile.section_min, F.array().cast("array<string>")).when(size <= profile.long, F.array(text)).otherwise(packed)
    kind = F.when(size <= profile.long, "section").otherwise("paragraph")
    cut = sections.withColumn("blocks", S.table_blocks(lines, profile))
    cut = cut.withColumn("plain", without_tables(lines, profile, F.col("blocks"))).withColumn("tables", table_texts(lines, profile, blocks=F.col("blocks")))
    cut = cut.withColumn("body", body).withColumn("body_kind", kind)
    number = lambda k: lambda c, i: F.struct(k.alias("kind"), (i + 1).alias("sub"), c.alias("content"))
    rows = cut.select(key, "section_no", "section_title", F.size("body").alias("n_text"), F.explode(F.concat(F.transform("tables", number(F.lit("table"))), F.transform("body", number(F.col("body_kind"))))).alias("c"))
    rows = rows.select(key, "section_no", "section_title", "n_text", "c.*")
    sub = F.when(F.col("kind") != "section", F.col("sub"))
    of = lambda c: T.chunk_id(year, F.col("section_no"), F.col("kind"), c)
    is_table = (F.col("kind") == "table") | T.has_table(F.col("content"))
    in_letter = Window.partitionBy(key).orderBy("section_no", (F.col("kind") != "table").cast("int"), "sub")
    return rows.select(
        key, F.when(F.col("kind") == "section", T.chunk_id(year, F.col("section_no"), F.col("kind"))).otherwise(of(sub)).alias("chunk_id"), "kind", "section_title",
        F.array(F.lit(root), "section_title").alias("section_hierarchy"), F.concat(year.cast("string"), F.lit("-S"), F.lpad(F.col("section_no").cast("string"), 2, "0")).alias("parent_section_id"),
        "content", T.tokens(F.col("content")).alias("token_count"), F.length("content").cast("long").alias("char_count"), is_table.alias("has_table"),
        (is_table | T.has_financial(F.col("content"))).alias("has_financial_data"), T.content_type(F.col("content"), is_table).alias("content_type"),
        F.row_number().over(in_letter).alias("position_in_letter"), F.col("sub").alias("section_position"), F.when(F.col("kind") == "table", 0).otherwise(F.col("n_text")).alias("total_section_chunks"),
    )


# -- tables of the first profile ------------------------------------------------------------------------------------------

NUMBERS = r"\$[\d,]+|\d+\.\d+%?|\d{1,3}(?:,\d{3})+"


def table_region_v1(lines: Column, start: Column, reach: int = 50) -> Column:
    """Last index of the table region that begins at start, or start where there is none: at least three lines with
    numbers, wide gaps or dot leaders; one blank line may lie before a line of numbers."""
    state = "struct<n:int,last:int,on:boolean>"
    make = lambda n, last, on: F.struct(n.alias("n"), last.alias("last"), on.alias("on")).cast(state)

    def step(s: Column, i: Column) -> Column:
        line, after = F.get(lines, i), F.coalesce(F.get(lines, i + 1), F.lit(""))
        plain = line.rlike(NUMBERS) | line.rlike(r"\s{3,}")
        mark = plain | line.rlike(r"\.{3,}")
        blank = (s["n"] > 0) & (T.strip(line) == "")
        ends = F.when(blank, ~after.rlike(r"\$[\d,]+|\d+\.\d+")).otherwise(s["n"] > 2)
        return F.when(~s["on"], s).when(mark, make(s["n"] + 1, i, F.lit(True))).otherwise(make(s["n"], s["last"], ~ends))

    end = F.least(start + reach, F.size(lines)) - 1
    begin = F.struct(F.lit(0).alias("n"), start.alias("last"), F.lit(True).alias("on")).cast(state)
    return F.aggregate(F.sequence(start, end), begin, step, lambda s: F.when(s["n"] >= 3, s["last"]).otherwise(start))


def tables_v1(lines: Column) -> Column:
    """array<struct<first,last>> of regions of four lines or more that a title of a table or a row of numbers begins; of
    the second kind the look begins two lines earlier, and a text found before is not taken again."""
    item = "array<struct<first:int,last:int>>"
    state = f"struct<out:{item},skip:int>"
    text = lambda a, b: F.array_join(F.slice(lines, a + 1, b - a + 1), "\n")

    def step(s: Column, i: Column) -> Column:
        line = F.get(lines, i)
        early = F.greatest(i - 2, F.lit(0))
        whole = lambda x: x.cast("int")
        numeric = line.rlike(r"^\s*\d{4}\s*\.{3,}|\$[\d,]+\s+\$[\d,]+")
        one = F.when(line.rlike(TABLE_TITLE), table_region_v1(lines, i))
        two = F.when(numeric, table_region_v1(lines, early))
        add = lambda a, b: F.concat(s["out"], F.array(F.struct(a.cast("int").alias("first"), b.cast("int").alias("last"))))
        make = lambda out, skip: F.struct(out.alias("out"), skip.cast("int").alias("skip")).cast(state)

        def take(r: Column) -> Column:
            one, two = r["one"], r["two"]
            seen = F.exists(s["out"], lambda t: text(t["first"], t["last"]) == text(early, two))
            return F.when(F.coalesce(one > i + 2, F.lit(False)), make(add(i, one), one + 1)).when(F.coalesce(two > early + 2, F.lit(False)), make(F.when(seen, s["out"]).otherwise(add(early, two)), two + 1)).otherwise(s)

        return F.when(i < s["skip"], s).otherwise(S.once(F.struct(whole(one).alias("one"), whole(two).alias("two")), take))

    start = F.struct(F.array().cast(item).alias("out"), F.lit(0).alias("skip")).cast(state)
    return F.aggregate(F.sequence(F.lit(0), F.size(lines) - 1), start, step, lambda s: s["out"])


def table_data(block: Column) -> Column:
    """struct<columns, rows, row_count>: cells lie two or more blanks apart; the first row names the columns where all have
    as many cells, else the rows are one column raw_line."""

    def told(lines: Column, cells: Column) -> Column:
        even = (F.size(cells) > 1) & (F.size(F.array_distinct(F.transform(cells, lambda c: F.size(c)))) == 1) & (F.size(F.get(cells, 0)) > 1)
        rows = F.when(even, F.slice(cells, 2, F.greatest(F.size(cells) - 1, F.lit(0)))).otherwise(F.transform(lines, lambda x: F.array(x)))
        return F.struct(F.when(even, F.get(cells, 0)).otherwise(F.array(F.lit("raw_line"))).alias("columns"), rows.alias("rows"), F.size(rows).alias("row_count"))

    solid = F.filter(F.split(block, "\n"), lambda x: T.strip(x) != "")
    return S.once(solid, lambda lines: S.once(F.transform(lines, lambda x: F.split(T.strip(x), r" {2,}")), lambda cells: told(lines, cells)))


# -- sizes, merges and directions of the specified tiers ------------------------------------------------------------------


def split_point(sizes: Column, most: int = 800, aim: int = 500) -> Column:
    """Of paragraphs' sizes in tokens the number of those before the split: the boundary nearest `aim`, the first of equal
    ones; null where the whole is not over `most`."""
    total = F.aggregate(sizes, F.lit(0).cast("long"), lambda a, v: a + v)
    after = F.transform(F.sequence(F.lit(1), F.size(sizes) - 1), lambda k: F.struct(F.abs(F.aggregate(F.slice(sizes, 1, k), F.lit(0).cast("long"), lambda a, v: a + v) - aim).alias("d"), k.alias("k")))
    return F.when((total > most) & (F.size(sizes) > 1), F.array_min(after)["k"])


def merge_direction(tokens: Column, section_final: Column, header: Column, paragraphs: Column, after_table: Column, least: int = 250) -> Column:
    """Where a chunk below `least` tokens goes: the last of a section and what follows a table back, all else forward."""
    return F.when(tokens >= least, "none").when(section_final, "back").when(header & (paragraphs < 2), "forward").when(after_table, "back").otherwise("forward")


def merge_runs(rows: DataFrame, key: str, order: str, direction: str) -> DataFrame:
    """rows with merged_no: a chunk that goes back joins the one before, one that goes forward the one after, and chains of
    them are one run."""
    w = Window.partitionBy(key).orderBy(order)
    starts = (F.lag(direction).over(w).isNull()) | ((F.col(direction) != "back") & (F.lag(direction).over(w) != "forward"))
    return rows.withColumn("_new", starts.cast("int")).withColumn("merged_no", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def lead_direction(paragraph: Column) -> Column:
    """Whether a short paragraph belongs to what follows (a question, a colon, an announcement) or to what came before (a
    conclusion or a reference back)."""
    low = F.lower(T.strip(paragraph))
    return (
        F.when(low.rlike(r"[?:]$"), "forward").when(low.rlike(r"^(?:consider|here (?:is|are)|the following|let's|let us|below)\b|\bas follows\b"), "forward")
        .when(low.rlike(r"^(?:therefore|thus|in (?:summary|conclusion|short)|as a result|so|these|this|that|those|such)\b"), "back").otherwise("none")
    )


def near_tables(tables: DataFrame, key: str, first: str, last: str, tokens: str, gap: int = 3, most: int = 1000) -> DataFrame:
    """tables with table_group: those fewer than `gap` paragraphs apart are one group, if it has at most `most` tokens."""
    w = Window.partitionBy(key).orderBy(first)
    apart = F.coalesce(F.col(first) - F.lag(last).over(w) - 1 >= gap, F.lit(True))
    run = tables.withColumn("_a", apart.cast("int")).withColumn("_g", F.sum("_a").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    small = F.sum(tokens).over(Window.partitionBy(key, "_g")) <= most
    return run.withColumn("_own", F.when(small, F.lit(0)).otherwise(F.row_number().over(w))).withColumn("table_group", F.dense_rank().over(Window.partitionBy(key).orderBy("_g", "_own"))).drop("_a", "_g", "_own")


def table_chunk(lead_in: Column, table: Column, following: Column) -> Column:
    """A table with the paragraphs around it."""
    return F.concat_ws("\n\n", F.nullif(lead_in, F.lit("")), table, F.nullif(following, F.lit("")))


def second_tier(children: DataFrame, parent: str, order: str, least: int = 120, most: int = 400, parent_least: int = 250) -> DataFrame:
    """At most one child per parent of children (parent, order, tokens, parent_tokens, content): of the right size, able to
    stand alone, and leaving the parent large enough."""
    fit = F.col("tokens").between(least, most) & (F.col("parent_tokens") - F.col("tokens") >= parent_least) & stands_alone(F.col("content"))
    return children.where(fit).withColumn("_n", F.row_number().over(Window.partitionBy(parent).orderBy(order))).where("_n = 1").drop("_n")


def stands_alone(content: Column) -> Column:
    """Whether the first sentence names its subject: it does not begin with a pronoun."""
    return ~F.coalesce(content, F.lit("")).rlike(r"^\s*(?:This|That|These|Those|It|They|He|She)\b")


def overlapped(rows: DataFrame, key: str, order: str, content: str) -> DataFrame:
    """rows with overlap: the last paragraph of the chunk before."""
    w = Window.partitionBy(key).orderBy(order)
    return rows.withColumn("overlap", F.coalesce(F.try_element_at(F.split(F.lag(content).over(w), "\n\n"), F.lit(-1)), F.lit("")))


def word_windows(text: Column, size: int = 150) -> Column:
    """Chunks of `size` words; the last one has what is left."""
    words = F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")
    return F.element_at(F.transform(F.array(words), lambda w: F.when(F.size(w) == 0, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(0), F.floor((F.size(w) - 1) / size).cast("int")), lambda k: F.array_join(F.slice(w, k * size + 1, size), " ")))), 1)


def is_block_line(line: Column) -> Column:
    """Whether a line belongs to a table by either rule of the tiers: a dot leader, or aligned columns with at least two
    numbers."""
    return line.rlike(r"[.]{3,}|(?:[.] ){3,}") | (T.strip(line).rlike(r"\S {2,}\S") & (F.regexp_count(line, F.lit(r"\$?\d[\d,.]*%?")) >= 2))


def table_block_lines(lines: Column, least: int = 3) -> Column:
    """For each line whether it is in a run of at least `least` table lines; a line that is none, blank ones too, ends it."""
    marks = F.transform(lines, lambda x: (T.strip(x) != "") & is_block_line(x))
    around = lambda m, i: F.exists(F.sequence(i - (least - 1), i), lambda a: (a >= 0) & (a + least <= F.size(m)) & F.forall(F.slice(m, F.greatest(a, F.lit(0)) + 1, least), lambda v: v))
    return F.element_at(F.transform(F.array(marks), lambda m: F.transform(m, lambda v, i: v & around(m, i))), 1)


def without_leading_table(lines: Column) -> Column:
    """Lines without the table that a letter begins with: what comes before its first prose line, if that has a table."""
    flags = table_block_lines(lines)

    def cut(f: Column) -> Column:
        prose = F.array_position(F.transform(lines, lambda x, i: (T.strip(x) != "") & ~F.get(f, i)), True)
        first = F.array_position(F.transform(lines, lambda x: T.strip(x) != ""), True)
        leads = F.coalesce(F.get(f, (first - 1).cast("int")), F.lit(False))
        return F.when(leads, F.when(prose > 0, F.slice(lines, prose.cast("int"), F.size(lines))).otherwise(F.array().cast("array<string>"))).otherwise(lines)

    return F.element_at(F.transform(F.array(flags), cut), 1)
