"""Archives: exact round trips, segments, chunks, and what broken archives do."""

from __future__ import annotations

import base64
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from compare import duck_rows, spark_rows
from folioscope.llm import warc as W
from folioscope.llm.common import scratch

SCHEMA = "page_id long, url string, html string"


def test_query_equals_sql(spark, sf_dir):
    assert spark_rows(W.op6_warc(spark, sf_dir)) == duck_rows(W.OP6_SQL, sf_dir)


def test_round_trip_of_odd_pages(spark):
    pages = [(1, "http://a", "x" * 400_000), (2, None, None), (3, "http://b\r\nX: y", ""), (4, "u", "a\r\n0\r\n\r\nWARC/1.1\r\n\r\n"), (5, "u", "é🙂" * 50_000), (6, "u", "\n"), (7, "u", "é🙂" * 50_000), (8, "ü", "a\x00b\x85 ")]
    df = spark.createDataFrame([(*p, "z") for p in pages], SCHEMA + ", refers_to string")
    path = scratch(spark, "warc-test")
    W.write_warc(df, path, segment=4096, chunk=100)
    got = {int(r["page"]): r for r in W.read_warc(spark, path).collect()}
    last = {p[2] or "": p[0] for p in pages}
    for i, url, html in pages:
        raw, lead = (html or "").encode(), last[html or ""]
        assert got[i]["digest"] == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        assert (got[i]["kind"], got[i]["refers"]) == (("response", None) if i == lead else ("revisit", str(lead)))
        assert i != lead or bytes(got[i]["payload"]) == raw
        assert got[i]["url"] == (url or "").replace("\r", "").replace("\n", "")
    kinds = W.read_segments(spark, path).groupBy("kind").count().collect()
    assert {r[0] for r in kinds} == {"response", "revisit", "continuation"}


def test_pages_of_the_table_are_segmented(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = scratch(spark, "warc-test")
    W.write_warc(pages, path)
    kinds = dict(W.read_segments(spark, path).groupBy("kind").count().collect())
    assert kinds["continuation"] > 0 and kinds["response"] + kinds.get("revisit", 0) == pages.count()


def test_empty_table_and_threshold(spark):
    path = scratch(spark, "warc-test")
    W.write_warc(spark.createDataFrame([], SCHEMA), path)
    assert W.read_warc(spark, path).count() == 0
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], SCHEMA)
    assert {r["page_id"]: r["refers_to"] for r in W.marked(pages, 3).collect()} == {1: None, 2: None, 3: 4, 4: None}


LONG, OTHER = "long page " * 20_000, "other page " * 20_000


@pytest.mark.parametrize(
    "pages",
    [
        [(1, "u", "a"), (1, "u", "a"), (None, "u", "a")],
        [(1, "u", LONG), (1, "u", OTHER)],
        [(None, "u", LONG), (None, "u", OTHER), (None, "u", LONG)],
        [(1, "u", LONG), (1, "u", LONG), (2, "u", "x"), (2, "u", "x")],
        [(1, "u", "x"), (1, "u", "y"), (2, "u", "x")],
        [(3, "u", LONG), (4, "v", LONG), (4, "w", LONG), (None, None, None), (9, None, "")],
    ],
)
def test_ids_repeated_and_null(spark, pages):
    """One row for each row of the table, whatever its id."""
    got = W.archived(spark, spark.createDataFrame(pages, SCHEMA).repartition(3), scratch(spark, "warc-test")).collect()
    lead, want = {}, []
    for page, _, html in pages:
        lead[html or ""] = max((x for x in (lead.get(html or ""), page) if x is not None), default=None)
    for page, _, html in pages:
        raw, to = (html or "").encode(), lead[html or ""]
        again = to is not None and page != to
        want.append((str(page), len(raw), W.base32_sha1(raw), "revisit" if again else "response", str(to if again else None)))
    assert sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], str(r["refers_to"])) for r in got) == sorted(want)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=300), st.integers(1, 40), st.integers(1, 60))
def test_frames_and_segments(text, chunk, segment):
    raw = text.encode("utf-8")
    got = list(W.parse(b"".join(W.records(7, 5, "u", raw, W.base32_sha1(raw), None, None, segment, chunk))))
    parts = [(int(h.get("WARC-Segment-Number", 1)), b) for h, b in got]
    total = [int(h["WARC-Segment-Total-Length"]) for h, _ in got if "WARC-Segment-Total-Length" in h]
    assert W.payload_of(W.assemble(parts[::-1], total[0] if total else None)) == raw
    assert all(h.get("WARC-Segment-Origin-ID", got[0][0]["WARC-Record-ID"]) == got[0][0]["WARC-Record-ID"] for h, _ in got)


def test_broken_archives_are_errors():
    with pytest.raises(ValueError):
        W.assemble([(1, b"a"), (3, b"b")], 2)
    with pytest.raises(ValueError):
        W.assemble([(1, b"a"), (2, b"b")], 3)
    with pytest.raises(ValueError):
        W.unchunk(b"5\r\nab")
    assert W.unchunk(b"2;x=y\r\nab\r\n0\r\n\r\n") == b"ab"
