"""WARC writing and reading: chunked transfer framing, continuation segments, revisits."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, scratch, table

#: Bytes that a record's block has at most; longer blocks go on in continuation records.
SEGMENT = 1 << 13
#: Bytes of one chunk of the transfer framing.
CHUNK = 1 << 12
#: Rows in one archive file, so that a reader never holds more than this many records at once.
ROWS = 512
#: Bytes of blocks that a reader hands on at once.
HELD = 1 << 23


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def slices(data: bytes, size: int) -> Iterator[bytes]:
    """data in pieces of at most `size` bytes (a character more at most), cut between UTF-8 characters."""
    at = 0
    while at < len(data):
        end = min(len(data), at + size)
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        yield data[at:end]
        at = end


def record(kind: str, headers: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [("WARC-Type", kind), *headers, ("Content-Length", len(block))])
    return b"WARC/1.1\r\n" + head.encode("utf-8") + b"\r\n" + block + b"\r\n\r\n"


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '/'.join(map(str, parts)))}>"


def records(row: object, page: object, url: str, payload: bytes, digest: str, lead: object, refers: object, segment: int, chunk: int) -> Iterator[bytes]:
    """A revisit record if there is a leading row, or a response whose block is cut into an origin and its continuations.
    row and lead tell rows apart; page and refers are the pages' own ids, which may repeat or be missing."""
    own = [("WARC-Record-ID", record_id("row", row)), ("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Target-URI", url), ("WARC-Page-ID", "" if page is None else page), ("WARC-Payload-Digest", f"sha1:{digest}")]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if lead is not None:
        profile = [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id("row", lead)), ("WARC-Refers-To-Page-ID", refers)]
        yield record("revisit", [*own, *profile, ("Content-Type", "application/http; msgtype=response")], http + b"\r\n")
        return
    body = b"".join(b"%x\r\n%s\r\n" % (len(c), c) for c in slices(payload, chunk)) + b"0\r\n\r\n"
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + body
    parts = list(slices(block, segment))
    first = [*own, ("Content-Type", "application/http; msgtype=response")]
    if len(parts) > 1:
        first.append(("WARC-Segment-Number", 1))
    yield record("response", first, parts[0])
    for k, part in enumerate(parts[1:], 2):
        more = [("WARC-Record-ID", record_id("row", row, k)), ("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Target-URI", url), ("WARC-Segment-Origin-ID", own[0][1]), ("WARC-Segment-Number", k)]
        if k == len(parts):
            more.append(("WARC-Segment-Total-Length", len(block)))
        yield record("continuation", more, part)


def marked(pages: DataFrame, least: int = 0) -> DataFrame:
    """(row, page_id, url, html, lead, refers_to): of equal payloads of at least `least` bytes the largest page_id is the
    response. lead is that response's row and refers_to its page_id, for rows of other pages. row is a number of the row
    itself, by its place in the input, as page_ids may repeat or be missing; rows of the largest page_id are all responses."""
    one = pages.select(F.monotonically_increasing_id().alias("row"), "page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    keyed = one.select("row", "page_id", F.sha2("html", 256).alias("sha"), F.octet_length("html").alias("n")).where(F.col("n") >= least)
    lead = keyed.groupBy("sha", "n").agg(F.max(F.struct("page_id", "row")).alias("x"), F.count(F.lit(1)).alias("copies")).where("copies > 1 and x.page_id is not null").select("sha", "n", F.col("x.row").alias("lead"), F.col("x.page_id").alias("refers_to"))
    others = keyed.join(lead, ["sha", "n"]).where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("row", "lead", "refers_to")
    return one.join(others, "row", "left")


def write_warc(pages: DataFrame, path: str, least: int = 0, segment: int = SEGMENT, chunk: int = CHUNK) -> None:
    """Gzipped archives under path, written by Spark's own writer, so to any file system that it knows. UTF-8 payloads and
    ASCII headers are text; a record's last line feed is the writer's line separator."""
    whole = lambda v: None if pd.isna(v) else int(v) if isinstance(v, float) else v

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for row, page, url, html, lead, refers in b.itertuples(index=False):
                payload = html.encode("utf-8")
                clean = "".join(c for c in url if c not in "\r\n")
                got = b"".join(records(row, whole(page), clean, payload, base32_sha1(payload), whole(lead), whole(refers), segment, chunk))
                out.append(got.decode("utf-8")[:-1])
            yield pd.DataFrame({"value": out})

    # Ids as text: a column of numbers with gaps would become one of floats on the way.
    rows = marked(pages, least).select("row", F.col("page_id").cast("string"), "url", "html", F.col("lead").cast("string"), F.col("refers_to").cast("string"))
    rows.mapInPandas(run, "value string").write.options(maxRecordsPerFile=ROWS, lineSep="\n", compression="gzip", **{"zlib.compress.level": "BEST_SPEED"}).text(path)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record, by Content-Length; stray line ends between records are skipped."""
    at = 0
    while (at := data.find(b"WARC/1.", at)) >= 0:
        end = data.index(b"\r\n\r\n", at)
        head = dict(line.split(": ", 1) for line in data[at:end].decode("utf-8").split("\r\n")[1:])
        at = end + 4 + int(head["Content-Length"])
        yield head, data[end + 4 : at]


def unchunk(body: bytes) -> bytes:
    """The entity of a chunked body; trailers and chunk extensions are ignored, a cut-off body is an error."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        if len(out[-1]) != size:
            raise ValueError("chunk is cut off")
        at = end + 4 + size


def assemble(parts: list[tuple[int, bytes]], total: int | None) -> bytes:
    """Blocks in order of segment number; numbers must run from 1 without a gap and lengths sum to the total."""
    parts = sorted(parts)
    if [n for n, _ in parts] != list(range(1, len(parts) + 1)):
        raise ValueError("segments are missing")
    block = b"".join(p for _, p in parts)
    if total is not None and len(block) != total:
        raise ValueError(f"segments sum to {len(block)}, not {total}")
    return block


def payload_of(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    return unchunk(body) if b"transfer-encoding: chunked" in head.lower() else body


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Every record: (origin, number, total, kind, page, url, digest, refers, refers_id, split, block); refers_id and, of what
    is no continuation, origin are record identifiers."""
    columns = ["origin", "number", "total", "kind", "page", "url", "digest", "refers", "refers_id", "split", "block"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for data in b["content"]:
                rows, held = [], 0
                for h, block in parse(gzip.decompress(data)):
                    total = h.get("WARC-Segment-Total-Length")
                    rows.append((h.get("WARC-Segment-Origin-ID") or h["WARC-Record-ID"], int(h.get("WARC-Segment-Number") or 1), total and int(total), h["WARC-Type"], h.get("WARC-Page-ID"), h.get("WARC-Target-URI"), (h.get("WARC-Payload-Digest") or "sha1:")[5:] or None, h.get("WARC-Refers-To-Page-ID"), h.get("WARC-Refers-To"), "WARC-Segment-Number" in h, block))
                    held += len(block)
                    if held >= HELD:
                        yield pd.DataFrame(rows, columns=columns).astype({"total": "Int64"})
                        rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=columns).astype({"total": "Int64"})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").load(path).select("content")
    return files.mapInPandas(run, "origin string, number int, total long, kind string, page string, url string, digest string, refers string, refers_id string, split boolean, block binary")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(id, page, url, kind, digest, refers, refers_id, payload) per logical record; page and refers as text, id and refers_id
    record identifiers.

    Records that stand alone are decoded where they are read. Only segmented ones are dealt and sorted by their origin's
    identifier and their number; what is held at once is one row's payload. Missing segments, a wrong total, a cut-off chunk or a wrong digest
    raise an error.
    """
    got = read_segments(spark, path)
    columns = ["id", "page", "url", "kind", "digest", "refers", "refers_id"]

    def check(payload: bytes, digest: str) -> bytes:
        if base32_sha1(payload) != digest:
            raise ValueError("payload digest does not match")
        return payload

    def alone(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = b.rename(columns={"origin": "id"})[columns].copy()
            out["payload"] = [check(payload_of(x), d) if k == "response" else None for x, k, d in zip(b["block"], b["kind"], b["digest"], strict=True)]
            yield out

    def whole(rows: list[tuple]) -> tuple:
        """The record of an origin's segments, which come in the order of their numbers."""
        first, totals = rows[0], [int(r[1]) for r in rows if not pd.isna(r[1])]
        if first[0] != 1:
            raise ValueError("segments are missing")
        block = assemble([(int(r[0]), bytes(r[2])) for r in rows], totals[0] if totals else None)
        return (*first[3:], check(payload_of(block), first[7]))

    def together(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        origin, held = None, []
        for b in batches:
            out = []
            for row in b[["number", "total", "block", "origin", *columns[1:]]].itertuples(index=False, name=None):
                if row[3] != origin and held:
                    out.append(whole(held))
                    held = []
                origin = row[3]
                held.append(row)
            yield pd.DataFrame(out, columns=[*columns, "payload"])
        if held:
            yield pd.DataFrame([whole(held)], columns=[*columns, "payload"])

    schema = "id string, page string, url string, kind string, digest string, refers string, refers_id string, payload binary"
    split = got.where("split").drop("split").repartition("origin").sortWithinPartitions("origin", "number")
    return got.where("not split").mapInPandas(alone, schema).unionByName(split.mapInPandas(together, schema))


def archived(spark: SparkSession, pages: DataFrame, path: str, least: int = 0, segment: int = SEGMENT, chunk: int = CHUNK) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of pages written to path and read back.

    One row for each row of pages, also for repeated rows, ids with several payloads and null ids. Null urls and htmls
    count as empty. Of equal payloads rows of other pages, null ids too, revisit the largest page_id; where all ids are
    null, all are responses. Other columns are ignored; an empty table gives no rows.
    """
    write_warc(pages, path, least, segment, chunk)
    kind = pages.schema["page_id"].dataType.simpleString()
    got = cut(read_warc(spark, path).select(
        "id", F.when(F.col("page") != "", F.col("page")).try_cast(kind).alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), F.col("refers").try_cast(kind).alias("refers_to"), "refers_id"
    ))
    out = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    lead = got.where("record_type = 'response'").select(F.col("id").alias("refers_id"), F.col("payload_bytes").alias("n"))
    again = got.where("record_type = 'revisit'").join(lead, "refers_id", "left").withColumn("payload_bytes", F.col("n"))
    return got.where("record_type = 'response'").select(out).unionByName(again.select(out))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC archives to the shared folder and read back; see archived()."""
    return archived(spark, table(spark, sf_dir, "pages"), scratch(spark, "warc"))


OP6_SQL = """
with p as (select page_id, coalesce(html, '') h from pages),
g as (select h, max(page_id) lead from p group by h)
select page_id, cast(octet_length(encode(h)) as bigint) payload_bytes,
  (select string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast((('0x' || substr(s, 1 + 5 * (i // 4), 5))::bigint >> (15 - 5 * (i % 4))) & 31 as int), 1), '' order by i)
   from (select sha1(h) s), range(32) t(i)) payload_digest,
  case when page_id = lead then 'response' else 'revisit' end record_type,
  case when page_id = lead then null else lead end refers_to
from p join g using (h)
"""
