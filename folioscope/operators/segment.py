"""Segmentation: page-break healing, sections, table blocks, sentence joining and greedy packing.

Order-dependent rules are folds over a document's array of lines, so a document is one row and nothing shuffles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

# The marker and the words that must be these for equal results.
BREAK = "[[PAGE_BREAK]]"
STRINGS = "array<string>"
CONTINUES = "contracts people shares and or the a an to of in that which who with for from value at by as on this these those it".split()
JOINS = [*CONTINUES, *"its their our but so yet nor if when while each".split()]
CLOSED = r"[.?!:\"')]$"


def once(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x) with x worked out once, however often f names it."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def last(x: Column) -> Column:
    return F.try_element_at(x, F.lit(-1))


def heal_page_breaks(lines: Column, known_headers: str = "(?!)") -> Column:
    """Lines without the page-break markers that split a paragraph, nor the blank lines just before those."""
    index = F.sequence(F.lit(1), F.size(lines))
    is_break = lambda x: F.contains(x, F.lit(BREAK))

    def step(out: Column, i: Column) -> Column:
        line = F.element_at(lines, i)
        solid = F.filter(out, lambda x: T.strip(x) != "")
        before = F.coalesce(T.strip(last(solid)), F.lit(""))
        after = F.coalesce(T.strip(F.get(F.filter(F.slice(lines, i + 1, F.greatest(F.size(lines) - i, F.lit(0))), lambda x: (T.strip(x) != "") & ~is_break(x)), F.lit(0))), F.lit(""))
        first = F.lower(F.element_at(F.split(after, r"(?U)\s+"), 1))
        middle = (~before.rlike(CLOSED) | after.rlike(r"^\p{Ll}") | first.isin(CONTINUES)) & ~T.is_likely_header(after, known_headers)
        blanks = F.size(out) - F.coalesce(F.array_max(F.transform(out, lambda x, k: F.when(T.strip(x) != "", k + 1))), F.lit(0))
        return F.when(is_break(line) & middle, F.slice(out, 1, F.size(out) - blanks)).otherwise(F.concat(out, F.array(line)))

    return F.when(F.array_contains(F.transform(lines, is_break), True), F.aggregate(index, F.array().cast(STRINGS), step)).otherwise(lines)


def join_sentences(lines: Column) -> Column:
    """Paragraphs of stripped lines: a line whose paragraph's last piece is not closed is glued to it, and so is the
    first line after blank ones if it goes on in lower case or with a joining word."""
    state = "struct<done:array<string>,cur:array<string>,gap:boolean>"

    def step(s: Column, line: Column) -> Column:
        x, tail = T.strip(line), last(s["cur"])
        first = F.lower(F.element_at(F.split(x, r"(?U)\s+"), 1))
        open_ = tail.isNotNull() & ~tail.rlike(CLOSED)
        goes_on = first.isin(JOINS) | x.rlike(r"^\p{Ll}")
        glued = F.concat(F.slice(s["cur"], 1, F.size(s["cur"]) - 1), F.array(F.concat(tail, F.lit(" "), x)))
        closed = F.concat(s["done"], F.array(F.array_join(s["cur"], " ")))
        make = lambda done, cur, gap: F.struct(done.alias("done"), cur.alias("cur"), gap.alias("gap")).cast(state)
        no, yes, only = F.lit(False), F.lit(True), F.array(x)
        return (
            F.when((x == "") & (F.size(s["cur"]) == 0), s)
            .when(x == "", F.when(open_, make(s["done"], s["cur"], yes)).otherwise(make(closed, F.array().cast(STRINGS), no)))
            .when(F.size(s["cur"]) == 0, make(s["done"], only, no))
            .when(s["gap"] & ~goes_on, make(closed, only, no))
            .when(open_, make(s["done"], glued, no))
            .otherwise(make(s["done"], F.concat(s["cur"], only), no))
        )

    start = F.struct(F.array().cast(STRINGS).alias("done"), F.array().cast(STRINGS).alias("cur"), F.lit(False).alias("gap")).cast(state)
    return F.aggregate(lines, start, step, lambda s: F.when(F.size(s["cur"]) > 0, F.concat(s["done"], F.array(F.array_join(s["cur"], " ")))).otherwise(s["done"]))


def pack_paragraphs(paragraphs: Column, profile: T.Profile = T.V3) -> Column:
    """Chunks of paragraphs joined by a blank line: flushed before they would pass `most` tokens and after they reach
    `target`; items of a numbered list stay together. The fold carries numbers alone, and texts are sliced once after it."""
    state = "struct<cuts:array<int>,tok:bigint,open:boolean,marked:boolean>"
    marker = T.LIST_ITEM if profile.list_rule == "both" else T.LIST_ANYWHERE
    make = lambda cuts, tok, open_, marked: F.struct(cuts.alias("cuts"), tok.alias("tok"), open_.alias("open"), marked.alias("marked")).cast(state)

    def step(s: Column, p: Column) -> Column:
        keep = p["item"] & s["open"] & s["marked"]
        flush = (s["tok"] > 0) & (s["tok"] + p["n"] > profile.most) & ~keep
        tok = F.when(flush, p["n"]).otherwise(s["tok"] + p["n"])
        full = (tok >= profile.target) & ~p["item"]
        return make(F.when(flush | ~s["open"], F.concat(s["cuts"], F.array(p["at"]))).otherwise(s["cuts"]), F.when(full, F.lit(0).cast("bigint")).otherwise(tok), ~full, p["marked"])

    def packed(xs: Column) -> Column:
        told = F.transform(xs, lambda x, i: F.struct(i.alias("at"), T.tokens(x).alias("n"), x.rlike(T.LIST_ITEM).alias("item"), x.rlike(marker).alias("marked")))
        cuts = F.aggregate(told, make(F.array().cast("array<int>"), F.lit(0).cast("bigint"), F.lit(False), F.lit(False)), step, lambda s: s["cuts"])
        return F.element_at(F.transform(F.array(cuts), lambda c: F.transform(c, lambda a, k: F.array_join(F.slice(xs, a + 1, F.coalesce(F.get(c, k + 1), F.size(xs)) - a), "\n\n"))), 1)

    solid = F.filter(F.transform(paragraphs, T.strip), lambda x: x != "")
    return F.element_at(F.transform(F.array(solid), packed), 1)


def exploded(docs: DataFrame, lines: Column, *keep: str) -> DataFrame:
    """(keep..., idx, line) with idx from 0."""
    return docs.select(*keep, F.posexplode(lines).alias("idx", "line"))


def table_context(rows: DataFrame, key: str, order: str, flag: str, reach: int = 3) -> DataFrame:
    """in_context: at least two other lines within `reach` look like a table."""
    near = Window.partitionBy(key).orderBy(order).rowsBetween(-reach, reach)
    n = F.col(flag).cast("int")
    return rows.withColumn("in_context", (F.sum(n).over(near) - n) >= 2)


def islands(rows: DataFrame, key: str, order: str, flag: str, least: int = 3) -> DataFrame:
    """Runs of neighbouring rows whose flag is true: (key, first, last, n_rows) of at least `least` rows."""
    place = F.col(order) - F.row_number().over(Window.partitionBy(key).orderBy(order))
    runs = rows.where(flag).withColumn("run", place).groupBy(key, "run")
    return runs.agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") >= least).drop("run")


def table_blocks(lines: Column, profile: T.Profile = T.V3, longest: int = 50, least: int = 3) -> Column:
    """array<struct<first,last>> of table blocks, one fold: a block starts on a table line, goes on over table lines,
    lines with a wide gap and blanks before a table line, and has 3 to 50 lines. Each line is held against the rules of a
    table once; lines without a table line are not folded."""
    state = "struct<out:array<struct<first:int,last:int>>,start:int,n:int>"
    table = lambda x: F.coalesce(T.is_table_line(x, profile), F.lit(False))
    empty = F.array().cast("array<struct<first:int,last:int>>")
    make = lambda out, start, n: F.struct(out.alias("out"), start.alias("start"), n.alias("n")).cast(state)
    close = lambda s, end: F.when(s["n"] >= least, F.concat(s["out"], F.array(F.struct(s["start"].alias("first"), end.alias("last")))))

    def fold(flags: Column) -> Column:
        def step(s: Column, i: Column) -> Column:
            line, own = F.get(lines, i), F.get(flags, i)
            inside = (s["n"] > 0) & (s["n"] < longest) & (own | line.rlike(r"\s{3,}\S") | (T.strip(line) == "") & F.coalesce(F.get(flags, i + 1), F.lit(False)))
            shut = F.coalesce(close(s, i - 1), s["out"])
            return F.when(inside, make(s["out"], s["start"], s["n"] + 1)).when(own, make(shut, i, F.lit(1))).otherwise(make(shut, F.lit(0), F.lit(0)))

        start = F.struct(empty.alias("out"), F.lit(0).alias("start"), F.lit(0).alias("n")).cast(state)
        return F.aggregate(F.sequence(F.lit(0), F.size(lines) - 1), start, step, lambda s: F.coalesce(close(s, F.size(lines) - 1), s["out"]))

    return once(F.transform(lines, table), lambda flags: F.when(flags.isNull() | F.exists(flags, lambda x: x), fold(flags)).otherwise(empty))


def section_headers(rows: DataFrame, key: str = "doc_id", table_words: list[str] | None = None, known: str = "(?!)", profile: T.Profile = T.V3) -> DataFrame:
    """rows (key, idx, line) with is_header: the ordered rejects, known patterns, and the title-case rule."""
    w = Window.partitionBy(key).orderBy("idx")
    x = T.strip(F.col("line"))
    small = ["and", "of", "the", "for", "a", "an", "in", "on", "at", "to", "or", "-", "–", "&"]
    verbs = "is are was were have has had will would can could should may might do does did being been be get got make made".split()
    marked = table_context(rows.withColumn("x", x).withColumn("is_table", T.is_table_line(x, profile)), key, "idx", "is_table")
    marked = marked.withColumn("prev", F.lag("x").over(w)).withColumn("next", F.lead("x").over(w))
    words = F.split("x", r"(?U)\s+")
    caps = F.size(F.filter(words, lambda v: v.rlike(r"^\p{Lu}") | F.lower(v).isin(small))) / F.greatest(F.size(words), F.lit(1))
    blank = F.coalesce(F.col("prev") == "", F.lit(True)) | F.contains(F.col("prev"), F.lit(BREAK)) | F.coalesce(F.col("next") == "", F.lit(True))
    apart = F.coalesce(blank, F.lit(False)) | F.coalesce(F.col("prev").rlike(r"[.:]$"), F.lit(False))
    reject = (~F.length("x").between(3, 80)) | F.col("x").rlike(r"^\p{Ll}|,$") | T.is_signature(F.col("x")) | T.is_sentence_start(F.col("x")) | F.col("is_table") | F.col("in_context")
    if table_words:
        reject = reject | T.table_word_share(F.col("x"), table_words)
    title = F.size(words).between(2, 7) & (caps >= 0.7) & ~F.exists(words, lambda v: F.lower(v).isin(verbs)) & (~F.col("x").rlike(r"[.]$") | (F.size(words) <= 3))
    return marked.withColumn("is_header", ~reject & (F.col("x").rlike(f"(?i)^(?:{known})") | (apart & title))).drop("x", "prev", "next")


def sections(rows: DataFrame, key: str, flag: str) -> DataFrame:
    """rows with section_no: how many lines marked by the flag came before or on the line; marked lines leave."""
    w = Window.partitionBy(key).orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("section_no", F.sum(F.col(flag).cast("int")).over(w)).where(~F.col(flag))


def siblings(chunks: DataFrame, parent: str, child: str, order: str) -> DataFrame:
    """chunks with sibling_ids, section_position and total_section_chunks."""
    every = Window.partitionBy(parent).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return chunks.withColumn("sibling_ids", F.array_remove(F.collect_list(child).over(every), F.col(child))).withColumn("section_position", F.row_number().over(Window.partitionBy(parent).orderBy(order))).withColumn("total_section_chunks", F.count(F.lit(1)).over(Window.partitionBy(parent)))
