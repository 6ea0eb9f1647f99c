"""WARC: archives written and read by Spark, with segmented records put together again.

Writing: pages with equal payloads of at least MIN_REVISIT bytes keep one response (the
smallest page_id); the others become revisit records without payload. Which is which is
decided on digests alone; the payloads of revisits do not travel. A response's block
is an HTTP message in chunked transfer framing; blocks above segment_bytes are cut into
a first segment and continuation records that name its record as origin. Record ids are
UUIDs from a number of the write itself and the record's place in it, so that archives of
several writes can be read together, and a task that runs again writes the same ids.
Spark's text writer stores the records (its line separator is the blank line that ends a
record), so that its commit protocol covers lost tasks; it starts a new archive after
ARCHIVE_RECORDS records. An archive is one gzip stream, not a member for each record:
the text writer has no other form.

Reading: each archive is parsed as a stream. Segments are grouped by origin identifier,
ordered by number, checked against the total length and only then freed of the chunked
framing; the payload's length and digest are computed anew from what was decoded.

Defined results: a null html is an empty payload; a null url writes no target uri;
records carry a row number of their own, so repeated rows and null page_ids stay apart;
of rows without page_id with a repeated payload all are revisits if one with an id has it,
else all are responses; a record whose segments or framing are incomplete has complete =
false and a null digest; segments whose first is missing give a row of kind "continuation"
without page_id, complete = false; an archive that is damaged (no gzip, cut short, no
record where one should begin) counts up to the damage, which gives a row of kind
"damaged", complete = false; an empty table gives an empty table.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep, scratch_path

MIN_REVISIT = 100
#: Largest block of one record, and of one transfer chunk, in bytes.
SEGMENT_BYTES = 8192
CHUNK_BYTES = 2048
BATCH_BYTES = 4 << 20
#: Records of one archive, each of at most SEGMENT_BYTES and its header.
ARCHIVE_RECORDS = 20_000
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def chunked(payload: bytes, size: int) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(payload[i : i + size]), payload[i : i + size]) for i in range(0, len(payload), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """The payload of a chunked body; None if its framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            n = int(body[at:end].split(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            n = -1
        if n < 0:
            return None
        if n == 0:
            return b"".join(out)
        at = end + 2 + n + 2
        if body[at - 2 : at] != b"\r\n":
            return None
        out.append(body[end + 2 : at - 2])


def decoded(block: bytes) -> bytes | None:
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        return None
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def _record(fields: dict[str, object], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block


def _one_line(text: str | None) -> str | None:
    return None if text is None else "".join(c if c.isprintable() else "%" + c.encode().hex() for c in text)


def _records(own: str, page: int | None, url: str | None, digest: str, length: int, payload: bytes | None, refers_to: int | None, segment: int, chunk: int) -> Iterator[bytes]:
    fields: dict[str, object] = {"WARC-Record-ID": f"<{own}>", "WARC-Date": "2020-01-01T00:00:00Z", "WARC-Page-ID": page, "WARC-Target-URI": _one_line(url)}
    fields |= {"WARC-Payload-Digest": "sha256:" + digest, "WARC-Payload-Length": length, "Content-Type": "application/http; msgtype=response"}
    if payload is None:
        yield _record({"WARC-Type": "revisit", "WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To-Page-ID": refers_to} | fields, HTTP_HEAD)
        return
    block = HTTP_HEAD + chunked(payload, chunk)
    if len(block) <= segment:
        yield _record({"WARC-Type": "response"} | fields, block)
        return
    starts = range(0, len(block), segment)
    yield _record({"WARC-Type": "response", "WARC-Segment-Number": 1} | fields, block[:segment])
    for k, at in enumerate(starts[1:], 2):
        more = {"WARC-Type": "continuation", "WARC-Record-ID": f"<{uuid.uuid5(uuid.UUID(own), str(k)).urn}>", "WARC-Date": fields["WARC-Date"], "WARC-Segment-Origin-ID": fields["WARC-Record-ID"], "WARC-Segment-Number": k}
        if k == len(starts):
            more["WARC-Segment-Total-Length"] = len(block)
        yield _record(more, block[at : at + segment])


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES, archive_records: int = ARCHIVE_RECORDS) -> None:
    """Writes gzipped archives below path, one or more per task."""
    html = F.coalesce(F.col("html"), F.lit(""))
    p = pages.select("page_id", "url", html.alias("html"), F.octet_length(html).alias("n"), F.sha2(html.cast("binary"), 256).alias("digest"))
    large = p.filter(F.col("n") >= MIN_REVISIT)
    same = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
    same = keep(same.filter("copies > 1 AND first IS NOT NULL").select("digest", "first"), "warc-copies")
    again = large.select("page_id", "url", "n", "digest").join(same, "digest").filter(F.col("first") != F.coalesce(F.col("page_id"), F.col("first") - 1))
    again = keep(again.select("page_id", "url", "n", "digest", "first"), "warc-revisits")
    # payloads leave by page and digest, not by digest alone, so that a popular page's rows spread
    gone = again.select(F.col("page_id").alias("gone_page"), F.col("digest").alias("gone_digest")).distinct()
    first = p.join(gone, F.col("page_id").eqNullSafe(F.col("gone_page")) & (F.col("digest") == F.col("gone_digest")), "left_anti")
    rows = first.withColumn("first", F.lit(None).cast("long")).unionByName(again.withColumn("html", F.lit(None).cast("string")))
    write = uuid.uuid4()

    def records(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, n = TaskContext.get().partitionId(), 0
        as_id = lambda x: None if pd.isna(x) else int(x)
        for pdf in parts:
            out, size = [], 0
            for page, url, page_html, length, digest, refers_to in zip(*(pdf[c] for c in ("page_id", "url", "html", "n", "digest", "first"))):
                n += 1
                own = uuid.uuid5(write, f"{task}-{n}").urn
                for r in _records(own, as_id(page), url, digest, length, None if page_html is None else page_html.encode(), as_id(refers_to), segment_bytes, chunk_bytes):
                    out.append(r)
                    size += len(r)
                if size > BATCH_BYTES:
                    yield pd.DataFrame({"record": out})
                    out, size = [], 0
            yield pd.DataFrame({"record": out})

    text = rows.select("page_id", "url", "html", "n", "digest", "first").mapInPandas(records, "record binary").select(F.col("record").cast("string").alias("value"))
    text.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", archive_records).text(path)


PARSED = "origin string, segment int, total long, page_id long, kind string, refers_to long, length long, digest string, block binary, complete boolean"


class Damaged(ValueError):
    """Bytes that are no record where one should begin."""


def _parse(stream: io.BufferedIOBase) -> Iterator[dict]:
    while line := stream.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise Damaged(f"no WARC record where one should begin: {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            k, _, v = line.decode(errors="replace").rstrip("\r\n").partition(":")
            fields[k.strip().lower()] = v.strip()
        number = lambda k: int(fields[k]) if fields.get(k, "").isdecimal() else None
        length = number("content-length")
        if length is None or "warc-record-id" not in fields:
            raise Damaged("a record without its length or id")
        block = stream.read(length)
        row = {
            "origin": fields.get("warc-segment-origin-id", fields["warc-record-id"]), "segment": number("warc-segment-number"), "total": number("warc-segment-total-length"), "page_id": _signed(fields.get("warc-page-id")),
            "kind": fields.get("warc-type"), "refers_to": _signed(fields.get("warc-refers-to-page-id")), "length": number("warc-payload-length"), "digest": fields.get("warc-payload-digest", "").rpartition(":")[2] or None, "block": None, "complete": len(block) == length,
        }
        if row["segment"] is not None:
            row["block"] = block
        elif row["kind"] == "response":
            row |= measured(decoded(block) if row["complete"] else None)
        yield row


def _signed(text: str | None) -> int | None:
    return int(text) if text and text.removeprefix("-").isdecimal() else None


def _archive(content: bytes, path: str) -> Iterator[dict]:
    """An archive's records; damage ends it and gives a last row that tells."""
    try:
        with gzip.GzipFile(fileobj=io.BytesIO(content)) as stream:
            yield from _parse(io.BufferedReader(stream))
    except (Damaged, EOFError, gzip.BadGzipFile, zlib.error):
        yield {"origin": f"damaged:{path}", "segment": None, "total": None, "page_id": None, "kind": "damaged", "refers_to": None, "length": None, "digest": None, "block": None, "complete": False}


def measured(payload: bytes | None) -> dict:
    if payload is None:
        return {"length": None, "digest": None, "complete": False}
    return {"length": len(payload), "digest": hashlib.sha256(payload).hexdigest(), "complete": True}


def _frame(rows: list[dict], columns: list[str]) -> pd.DataFrame:
    return pd.DataFrame({c: pd.array([r[c] for r in rows], dtype="Int64") if c in ("segment", "total", "page_id", "refers_to", "length") else pd.Series([r[c] for r in rows], dtype=object) for c in columns})


def read_archives(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per response or revisit of all archives below path: page_id, length and digest of the full payload, kind, refers_to, complete."""
    names = [x.split()[0] for x in PARSED.split(", ")]

    def parse(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for path, content in zip(pdf["path"], pdf["content"]):
                rows, size = [], 0
                for row in _archive(content, path):
                    rows.append(row)
                    size += 200 + len(row["block"] or b"")
                    if size > BATCH_BYTES:
                        yield _frame(rows, names)
                        rows, size = [], 0
                yield _frame(rows, names)

    def assemble(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = []
            for r in pdf.to_dict("records"):
                found = [x for x in r["segments"] if x["segment"] is not None]
                if found:
                    block = b"".join(x["block"] for x in found)
                    whole = r["kind"] is not None and [x["segment"] for x in found] == list(range(1, len(found) + 1)) and r["total"] == len(block)
                    r |= measured(decoded(block) if whole else None) | {"kind": r["kind"] or "continuation"}
                rows.append(r)
            yield _frame(rows, out)

    out = ["page_id", "length", "digest", "kind", "refers_to", "complete"]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    parsed = files.mapInPandas(parse, PARSED)
    head = lambda c: F.max(F.when(F.col("kind") != "continuation", F.col(c))).alias(c)
    by_origin = parsed.groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("segments"), F.max("total").alias("total"), *[head(c) for c in out]
    )
    return by_origin.drop("origin").mapInPandas(assemble, "page_id long, length long, digest string, kind string, refers_to long, complete boolean")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Writes pages to archives in the shared folder and reads those back."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path)


def oracle() -> str:
    """DuckDB SQL for the digest of a round trip."""
    return f"""
    SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN first IS NULL THEN 'response' ELSE 'revisit' END AS record_type, first AS refers_to, true AS complete FROM (
      SELECT page_id, n, digest, CASE WHEN n >= {MIN_REVISIT} AND page_id <> min(page_id) OVER (PARTITION BY digest) THEN min(page_id) OVER (PARTITION BY digest) END AS first
      FROM (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha256(coalesce(html, '')) AS digest FROM pages))"""
