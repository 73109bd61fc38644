"""HTML extraction on pages made by hand and on the table."""

from __future__ import annotations

import random

import numpy as np

from folioscope.llm import html_text as H
from folioscope.llm.shingles import word_hashes

SCHEMA = "page_id long, url string, html string"


def texts(spark, rows):
    return {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_article_stays_and_chrome_goes(spark):
    page = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var a = "<p>no</p>";</script></head><body>
    <header><h1>Site</h1></header><nav><ul><li>Home</li></ul></nav><div class="cookie-banner">We use cookies</div>
    <article><header><h1>The  title</h1></header><p>One &amp; two<br>three&nbsp;four</p><!-- <p>hidden</p> --><ul><li>a<li>b</ul>
    <aside>Related</aside><div class="ad">Buy</div><form><input value=x>Search</form><p>x <b>bold</b>ly &#8364;5 &lt;tag&gt;</p>
    <section id="comments"><p>First!</p></section></article><footer>(c)</footer></body></html>"""
    got = texts(spark, [(1, "http://a.b/c", page)])
    assert got[1] == "The title\n\nOne & two three four\n\na\n\nb\n\nx boldly €5 <tag>"


def test_host_boilerplate_goes_and_unique_runs_stay(spark):
    menu = "Welcome to the very long shared banner of this site today"
    rows = [(i, f"https://h.example/{i}", f"<body><div>{menu}</div><div>Own story number {i} with words that no other page has {i * 7}</div></body>") for i in range(5)]
    rows += [(9, "https://other.example/", f"<body><div>{menu}</div></body>")]
    got = texts(spark, rows)
    for i in range(5):
        assert menu not in got[i] and f"number {i} with" in got[i]
    assert got[9] == menu


def host(n, page):
    return [(i, f"https://h.example/{i}", page(i)) for i in range(n)]


def test_copies_of_an_article_stay(spark):
    """Mirrors, copies on few pages of a host, and pages of which hardly anything would stay, keep their text."""
    story = " ".join(f"word{i}" for i in range(40))
    for n, page in (
        (2, lambda i: f"<div>{story}</div>"),
        (6, lambda i: f"<div>{story}</div>"),
        (2, lambda i: f"<div>{story}</div><div>own ending number {i} of this page and no other one at all</div>"),
        (5, lambda i: f"<div>{story}</div><p>page {i}</p>"),
    ):
        got = texts(spark, host(n, page))
        assert all(story in t for t in got.values()), n
    rows = host(8, lambda i: f"<div>{story if i < 2 else ' '.join(f'x{i}y{k}' for k in range(40))}</div>" + f"<h2>Introduction {'x' * i}</h2>")
    assert all(story in texts(spark, rows)[i] for i in range(2))
    assert all("Introduction" in t for t in texts(spark, host(2, lambda i: f"<h2>Introduction</h2><div>the story number {i} of many words that is told on this page {i}</div>")).values())


def test_notice_inside_articles_goes(spark):
    """A block that stands in the articles of most pages of a host is boilerplate though structure does not tell."""
    notice = "Read our other stories, they are all free of charge"
    got = texts(spark, host(6, lambda i: f"<article><p>story {i} has its words {i}</p><div>{notice}</div><p>and an end of its own {i}</p></article>"))
    assert got == {i: f"story {i} has its words {i}\n\nand an end of its own {i}" for i in range(6)}
    lone = texts(spark, host(6, lambda i: f"<article><p>story {i} has its words {i}</p><div>{notice if i < 3 else i}</div></article>"))
    assert all(notice in lone[i] for i in range(3))


def test_chrome_of_marked_pages_is_known_on_others(spark):
    """What stands outside the articles of a host's pages is boilerplate on its page that marks none; a comment or script
    that names an element marks nothing."""
    frame = "Subscribe to the weekly letter of this site and never miss a story again"
    rows = host(5, lambda i: f"<footer>{frame}</footer><article><p>story {i} with words</p></article>")
    rows += [(9, "https://h.example/9", f"<!-- <main> --><script>'<article>'</script><div>{frame}</div><div>the only page here that has no element around its text</div>")]
    got = texts(spark, rows)
    assert got[9] == "the only page here that has no element around its text" and got[0] == "story 0 with words"


def test_windows_of_a_host_against_all_windows(spark):
    """The boilerplate keys of a host are those of the windows that brute force finds, for pages dealt over partitions."""
    r = random.Random(3)
    menu = [[f"m{k}w{i}" for i in range(12)] for k in range(4)]
    pages = []
    for i in range(40):
        own = [f"p{i}x{r.randrange(999)}" for _ in range(30)]
        for k in range(4):
            if i % (k + 2) == 0:
                own[r.randrange(30):0] = menu[k]
        pages.append(own)
    rows = spark.createDataFrame([("h", f"<div>{' '.join(p)}</div>") for p in pages], "host string, html string").repartition(5)
    got = {k for row in H.repeated(rows, 8).collect() for k in row["keys"]}
    seen = {}
    for i, p in enumerate(pages):
        for k in range(len(p) - 7):
            seen.setdefault(tuple(p[k : k + 8]), set()).add(i)
    often = [w for w, on in seen.items() if len(on) >= 10]
    want = {int(H.window_keys(word_hashes(list(w)), np.zeros(8, np.int64), 8).view(np.int64)[0]) for w in often}
    assert often and got == want


def test_beyond_the_broadcast_bound(spark, monkeypatch):
    rows = host(5, lambda i: f"<div>{'menu of this host is always the very same thing'}</div><div>story {i} " + " ".join(f"s{i}x{k}" for k in range(20)) + "</div>")
    few = texts(spark, rows)
    monkeypatch.setattr(H, "BROADCAST_KEYS", 0)
    assert texts(spark, rows) == few and "menu" not in few[0]


def test_odd_rows(spark):
    long = "<article>" + "<p>word word &amp; more</p>" * 60_000 + "</article>"
    rows = [(1, None, None), (2, "", ""), (3, "x", "plain text only"), (4, "http://h/", "<p>unclosed <b>tags"), (5, None, "<<<>>> & &bogus; <"), (6, "u", long), (7, "u", "<div" * 3000), (7, "u", "<div" * 3000)]
    df = spark.createDataFrame([(*r, "k") for r in rows], SCHEMA + ", host string")
    got = H.extract(df).collect()
    assert len(got) == len(rows) and {r["page_id"]: r["text"] for r in got if r["page_id"] in (1, 2, 3)} == {1: "", 2: "", 3: "plain text only"}
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert H.extract(df.limit(0)).count() == 0


def test_whole_table(spark, sf_dir):
    pages = {r[0]: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = H.op8_html_text(spark, sf_dir).collect()
    assert {r["page_id"] for r in got} == set(pages) and len(got) == len(pages)
    for r in got:
        assert r["url"] == pages[r["page_id"]]["url"] and r["n_chars"] == len(r["text"])
        assert all(b == " ".join(b.split()) and b for b in r["text"].split("\n\n")) or not r["text"]


def test_suffix_classes_are_windows():
    r = np.random.default_rng(1)
    tokens, owner = r.integers(0, 3, 400).astype(np.uint64), np.sort(r.integers(0, 20, 400))
    order, cls = H.suffix_ranks(tokens, owner, 4)
    own = [tuple(tokens[i : i + 4][owner[i : i + 4] == owner[i]]) for i in range(400)]
    assert [own[i] for i in order] == sorted(own)
    for a, b, x, y in zip(order, order[1:], cls, cls[1:], strict=False):
        assert (own[a] == own[b]) == (x == y)
