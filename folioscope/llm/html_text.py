"""HTML extraction: a host suffix array over the token streams of its pages, with the pages' structure as one input."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table
from .shingles import ODD, mix, word_hashes

#: Tokens that a repeated substring has at least; a shorter block counts as repeated when all of it is.
LEAST = 8
#: Pages of a host that a substring is on before it is boilerplate; their share of the host's pages is SHARE at least.
#: Fewer pages, or a smaller share, are copies of an article, a quotation or a shared passage, which stay.
PAGES = 3
SHARE = 0.25
#: The same for a whole block inside a marked article, or one that is shorter than LEAST anywhere.
BLOCK_PAGES = 4
BLOCK_SHARE = 0.5
#: Keys of all hosts' boilerplate that are broadcast at most; more are joined by host.
BROADCAST_KEYS = 1 << 20

#: Possessive throughout, so that no page makes it go back.
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>",
    re.S,
)
OPENS = re.compile(r"<[a-zA-Z/!?]")
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "xmp", "noembed", "noframes"}
DROP = {"nav", "aside", "form", "svg", "template", "button", "select", "dialog", "menu", "object", "audio", "video", "canvas", "footer", "head", "header", "datalist", "fieldset"}
BLOCK = set("address article aside blockquote body center dd details dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption title".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CHROME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|sidebars?|side|widgets?|nav\w*|menus?|breadcrumbs?|comments?|commentlist|replies|reply|respond|disqus|cookies?|consent|gdpr|notices?|alert|newsletter|subscribe|signup|"
    r"popup|modal|overlay|share|sharing|social|related|recommend\w*|footer|header|masthead|toolbar|pagination|pager|skip|login|copyright|legal)(?:$|[\s_-])",
    re.I,
)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "form", "toolbar"}
SPACE = re.compile(r"\s+")


def hash_of(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _chrome(name: str, raw: str, inside: bool) -> bool:
    """Whether an element is a menu, header, footer, sidebar, notice, advert, form or comment. A header inside the
    article holds its title, so it stays."""
    if name in DROP and not (name == "header" and inside):
        return True
    if "=" not in raw and "hidden" not in raw.lower():
        return False
    for key, value in ATTRIBUTE.findall(raw):
        key, value = key.lower(), value.strip("\"'").strip()
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "role" and value.lower() in ROLES:
            return True
        if key in ("class", "id") and name not in ("body", "html", "main") and CHROME.search(value) and not (name == "article" and not re.search(r"comment|repl|related|promo|ad\b", value, re.I)):
            return True
    return False


def blocks(page: str) -> tuple[list[str], bool, list[str]]:
    """The text blocks of a page in order, whether an article or main element marks them as its content, and the blocks
    that stand in chrome or outside that element.

    Everything of chrome elements goes. If the page has an article (or else a main) element outside chrome, only its
    text stays. Unclosed elements end with their parent; an unclosed chrome element ends where an article begins.
    """
    out: dict[str, list[str]] = {"article": [], "main": [], "open": []}
    seen: set[str] = set()
    piece: list[str] = []
    aside: list[str] = []
    rest: list[str] = []
    stack: list[tuple[str, bool]] = []
    open_: dict[str, int] = {}
    outside: list[bool] = []
    dropped, zones, at = 0, {"article": 0, "main": 0}, 0
    unclosed = OPENS.search(page, page.rfind(">") + 1)  # a tag that the page's end cuts off
    page = page[: unclosed.start()] if unclosed else page

    def flush() -> None:
        if piece:
            text = SPACE.sub(" ", entities.unescape("".join(piece))).strip()
            piece.clear()
            if text:
                out["open"].append(text)
                for z in ("article", "main"):
                    if zones[z]:
                        out[z].append(text)
                outside.append(not (zones["article"] or zones["main"]))
        if aside:
            text = SPACE.sub(" ", entities.unescape("".join(aside))).strip()
            aside.clear()
            if text:
                rest.append(text)

    def pop() -> None:
        nonlocal dropped
        name, gone = stack.pop()
        open_[name] -= 1
        dropped -= gone
        if name in zones and not gone and zones[name]:
            zones[name] -= 1

    while True:
        m = TAG.search(page, at)
        if text := page[at : m.start() if m else len(page)]:
            (aside if dropped else piece).append(text)
        if m is None:
            break
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name, closing, raw = name.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if name in BLOCK:
            flush()
        elif name == "br" and not dropped:
            piece.append(" ")
        if closing:
            if open_.get(name):
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        if name in VOID or raw.endswith("/") and name not in BLOCK and name not in RAW:
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name == "p" and stack and stack[-1][0] == "p":
            pop()
        if name == "li" and stack and stack[-1][0] == "li":
            pop()
        gone = _chrome(name, raw, zones["article"] > 0)
        if name in zones and not gone and dropped and not any(map(open_.get, (*zones, "aside", "footer"))):
            while dropped:  # chrome that was never closed
                pop()
        stack.append((name, gone))
        open_[name] = open_.get(name, 0) + 1
        dropped += gone
        if name in zones and not dropped:
            zones[name] += 1
            seen.add(name)
    flush()
    for z in ("article", "main"):
        if z in seen:
            return out[z], True, rest + [x for x, o in zip(out["open"], outside, strict=True) if o]
    return out["open"], False, rest


def _tokens(found: list[str], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a page's blocks: for each token the hash of the window that starts there and its block's number, 0 where no
    window does; and its width. A block below `least` tokens is one window."""
    keys, owner, width = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i, block in enumerate(found):
        h = word_hashes(block.lower().split())
        keys.append(h)
        owner.append(np.full(len(h), i))
        width.append(np.minimum(least, np.full(len(h), len(h))))
    return np.concatenate(keys), np.concatenate(owner), np.concatenate(width)


def suffix_ranks(tokens: np.ndarray, owner: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of concatenated streams, sorted on the first `least` tokens of each suffix, and for each entry
    the number of its class of suffixes that agree there. Prefix doubling; streams and blocks end with their owner."""
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    k = 1
    while k < least:
        step = min(k, least - k)
        after = np.zeros(n, np.int64)
        if n > step:
            same = owner[step:] == owner[:-step]
            after[:-step] = np.where(same, rank[step:], 0)
        rank = np.unique(rank * (n + 2) + after, return_inverse=True)[1].astype(np.int64) + 1
        k += step
    order = np.argsort(rank, kind="stable")
    return order, rank[order]


def window_keys(tokens: np.ndarray, owner: np.ndarray, least: int) -> np.ndarray:
    """A hash of the first `least` tokens of every suffix, which ends with its owner."""
    out = np.full(len(tokens), least, np.uint64)
    for k in range(min(least, len(tokens))):
        same = np.zeros(len(tokens), bool)
        same[: len(tokens) - k] = owner[k:] == owner[: len(tokens) - k]
        part = np.zeros(len(tokens), np.uint64)
        part[: len(tokens) - k] = tokens[k:]
        out = np.where(same, mix(out + part * ODD[k % 5]), out)
    return out


def block_keys(found: list[str]) -> np.ndarray:
    """A hash of all tokens of each block; no window has it but by chance."""
    out = np.zeros(len(found), np.uint64)
    for i, block in enumerate(found):
        h = word_hashes(block.lower().split())
        out[i] = mix(mix(h + np.arange(len(h), dtype=np.uint64) * ODD[2]).sum() + np.uint64(len(h)))
    return out.view(np.int64)


def repeated(pages: DataFrame, least: int) -> DataFrame:
    """(host, keys): of pages (host, html) the keys of each host's boilerplate.

    Each batch of a host's pages builds the suffix array of their concatenated token streams, which is bounded by the
    batch: all blocks of pages that mark no article, what stands outside the article of those that do, and the blocks
    inside it as wholes. Neighbours in it that agree are one row. Batches meet in an aggregation by host and key, so a host
    may have any share of the pages. Pages of the same content are one page as far as distinct pages are asked for, so
    mirrors of an article aren't boilerplate. A key is on SHARE of its host's pages at least, so a host has no more of them
    than a few times the tokens of a page.
    """
    far = np.iinfo(np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for host, g in b.groupby("host", sort=False):
                tokens, owner, page, content, base, whole = [], [], [], [], 0, []
                for number, html in enumerate(g["html"]):
                    found, sure, rest = blocks(html)
                    own = rest if sure else found + rest
                    t, o, _ = _tokens(own, least)
                    tokens.append(t)
                    owner.append(o + base)
                    page.append(np.full(len(t), number))
                    base += len(own)
                    keys = np.unique(block_keys([x for x in found if sure or len(x.split()) < least]))
                    whole.append((keys, np.full(len(keys), number)))
                    content.append(hash_of("\n".join(found)))
                t, o, p, content = np.concatenate(tokens), np.concatenate(owner), np.concatenate(page), np.array(content, np.int64)
                order, cls = suffix_ranks(t, o, least) if len(t) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
                # A page once for each class of equal windows; what is left of a block after its last window is none.
                full = (np.searchsorted(o, o, side="right") - np.arange(len(o)) >= least)[order]
                order, cls = order[full], cls[full]
                at = np.lexsort((p[order], cls))
                order, cls = order[at], cls[at]
                once = np.concatenate([[True], (cls[1:] != cls[:-1]) | (p[order][1:] != p[order][:-1])]) if len(order) else np.zeros(0, bool)
                keys = window_keys(t, o, least).view(np.int64)[order[once]]
                keys = np.concatenate([keys, *[k for k, _ in whole]])
                p = np.concatenate([p[order[once]], *[n for _, n in whole]]).astype(np.int64)
                by = np.argsort(keys, kind="stable")
                keys, p = keys[by], p[by]
                first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
                size = np.diff(np.append(first, len(keys)))
                low = np.minimum.reduceat(content[p], first) if len(first) else np.zeros(0, np.int64)
                high = np.maximum.reduceat(content[p], first) if len(first) else np.zeros(0, np.int64)
                strict = np.isin(keys[first], np.concatenate([np.zeros(0, np.int64), *[k for k, _ in whole]]))
                yield pd.DataFrame({
                    "host": host, "key": np.append(keys[first], 0), "strict": np.append(strict, False), "low": np.append(low, far.min), "high": np.append(high, far.max), "n": np.append(size, len(g)),
                })

    seen = pages.mapInPandas(run, "host string, key long, strict boolean, low long, high long, n long")
    seen = seen.groupBy("host", "key").agg(F.max("strict").alias("strict"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
    seen = cut(seen.where(f"key = 0 or low <> high and n >= {PAGES}").drop("low", "high"))
    every = seen.where("key = 0").select("host", F.col("n").alias("pages"))
    often = F.when(F.col("strict"), (F.col("n") >= BLOCK_PAGES) & (F.col("n") > BLOCK_SHARE * F.col("pages"))).otherwise(F.col("n") >= SHARE * F.col("pages"))
    return seen.where("key <> 0").join(every, "host").where(often).groupBy("host").agg(F.collect_list("key").alias("keys"))


def unique_runs(found: list[str], sure: bool, hit: np.ndarray, least: int) -> list[str]:
    """The blocks without what is boilerplate: of a marked article whole blocks, else tokens that a repeated window or a
    repeated short block covers. If fewer tokens than a window would stay of a page that marks no article, the page is a
    copy rather than a frame, and all stays."""
    whole = np.isin(block_keys(found), hit)
    if sure:
        return [x for x, gone in zip(found, whole, strict=True) if not gone]
    t, o, width = _tokens(found, least)
    covered = whole[o] & (width < least)
    last = np.searchsorted(o, o, side="right")
    for i in np.flatnonzero(np.isin(window_keys(t, o, least).view(np.int64), hit) & (width == least)):
        if last[i] - i >= least:  # a window ends inside its block
            covered[i : i + least] = True
    if not covered.any() or (~covered).sum() < least:
        return found
    out, bounds = [], np.searchsorted(o, np.arange(len(found) + 1))
    for i, block in enumerate(found):
        own = covered[bounds[i] : bounds[i + 1]]
        text = block if not own.any() else " ".join(w for w, c in zip(block.split(), own, strict=True) if not c)
        if text:
            out.append(text)
    return out


def extract(pages: DataFrame, least: int = LEAST, join: str = "\n\n") -> DataFrame:
    """(page_id, url, text, n_chars) of pages (page_id, url, html).

    All pages go through their host's suffix array (repeated()). Structure says which blocks are candidates: those inside
    an article (or else main) element where the page has one, else all outside chrome. Substrings of `least` tokens or more
    on at least PAGES pages of unlike content and a quarter of the host's are boilerplate, and so are whole blocks of an
    article, and short blocks, on more than half of them; these are removed and the unique runs stay. Null html counts as
    empty and gives an empty text; null urls are one host; rows with one id are rows; other columns are ignored; an empty
    table gives no rows. The keys of all hosts are broadcast up to BROADCAST_KEYS, beyond that joined by host.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    one = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][\w+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), F.lit("")).alias("host"))
    shared = cut(repeated(one.select("host", "html"), least))
    small = (shared.agg(F.sum(F.size("keys"))).first()[0] or 0) <= BROADCAST_KEYS

    def text(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for html, keys in zip(b["html"], b["keys"], strict=True):
                found, sure, _ = blocks(html)
                out.append(join.join(found if keys is None or not found else unique_runs(found, sure, np.asarray(keys, np.int64), least)))
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": out, "n_chars": [len(t) for t in out]})

    joined = one.join(F.broadcast(shared) if small else shared, "host", "left").select("page_id", "url", "html", "keys")
    return joined.mapInPandas(text, f"page_id {kind}, url string, text string, n_chars long")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
