"""Operator 10: web archives, written and read back.

Each page becomes an HTTP response with a chunked body inside a WARC record;
a page whose payload repeats an earlier one becomes a revisit record without
a payload. A response block longer than ``segment_bytes`` is cut into a first
record and continuation records.

Records end with two line breaks, so Spark's text writer with that line
separator makes archive files, compressed by its codec and committed by its
protocol on any file system. Reading loads the archive files (bounded by
records per file times segment size), follows each record's Content-Length,
then reassembles segments: continuations are grouped by origin identifier,
ordered by segment number, checked against the total length, and the chunked
transfer framing is decoded.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recprep.llm.common import append_columns, slices
from recprep.session import ship_package

#: Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_END = b"\r\n\r\n"

SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
RECORDS_PER_FILE = 1024
#: payloads shorter than this are never revisited
REVISIT_BYTES = 100


def record_id(row_id, digest: str, segment: int = 1) -> str:
    """The same for the same row, so that revisits can name their origin."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{row_id}/{digest}/{segment}')}>"


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return VERSION + b"\r\n" + lines.encode("utf-8") + b"Content-Length: %d\r\n\r\n" % len(block) + block


def chunked(body: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing of ``body``."""
    parts = []
    for i in range(0, len(body), size):
        c = body[i:i + size]
        parts.append(b"%x\r\n%s\r\n" % (len(c), c))
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(framed: bytes) -> bytes:
    """The body inside chunked framing; ValueError if the framing is broken."""
    parts, at = [], 0
    while True:
        end = framed.find(b"\r\n", at)
        if end < 0:
            raise ValueError("a chunk size is missing")
        size = int(framed[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if framed[at + size:at + size + 2] != b"\r\n":
            raise ValueError("a chunk is cut short")
        parts.append(framed[at:at + size])
        at += size + 2


def page_records(row_id, url, payload: bytes, digest: str, origin, date: str,
                 segment_bytes: int) -> list[bytes]:
    """The records of one page; ``origin``: the row id it revisits, or None."""
    own = record_id(row_id, digest)
    common = [("WARC-Date", date), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if url is not None:
        common.append(("WARC-Target-URI", "".join(url.split("\r")).replace("\n", "")))
    if row_id is not None:
        common.append(("X-Row-Id", str(row_id)))
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    content = ("Content-Type", "application/http; msgtype=response")
    if origin is not None:
        head = [("WARC-Type", "revisit"), ("WARC-Record-ID", own), ("WARC-Profile", REVISIT_PROFILE),
                ("WARC-Refers-To", record_id(origin, digest)), ("X-Refers-To-Row", str(origin)), content]
        return [_record(head + common, (http + "\r\n").encode())]
    block = (http + "Transfer-Encoding: chunked\r\n\r\n").encode() + chunked(payload)
    head = [("WARC-Type", "response"), ("WARC-Record-ID", own), content]
    if len(block) <= segment_bytes:
        return [_record(head + common, block)]
    out = [_record(head + common + [("WARC-Segment-Number", "1")], block[:segment_bytes])]
    starts = range(segment_bytes, len(block), segment_bytes)
    for k, i in enumerate(starts, 2):
        head = [("WARC-Type", "continuation"), ("WARC-Record-ID", record_id(row_id, digest, k)),
                ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", str(k))]
        if k == len(starts) + 1:
            head.append(("WARC-Segment-Total-Length", str(len(block))))
        out.append(_record(head + common, block[i:i + segment_bytes]))
    return out


def write_archives(df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", date: str = "2000-01-01T00:00:00Z",
                   segment_bytes: int = SEGMENT_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write a record per row (more for segmented ones) as gzip archives.

    Payload: the text in UTF-8, null as empty. Among rows with equal payloads
    of at least REVISIT_BYTES the smallest id is the response and the others
    revisit it; a row repeated with that id is a response as well, and where
    all ids are null all rows are responses. Null urls leave the header out.
    Other columns are ignored; an empty table writes no record.
    """
    spark = df.sparkSession
    ship_package(spark)
    payload = F.coalesce(F.col(f"`{payload_col}`"), F.lit("")).cast("binary")
    src = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"),
                    payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    firsts = (src.where(F.octet_length("payload") >= REVISIT_BYTES).groupBy(F.col("digest").alias("same"))
                 .agg(F.min("id").alias("first"), F.count("*").alias("n"))
                 .where("n > 1 and first is not null").select("same", "first"))
    rows = src.join(firsts, src["digest"] == firsts["same"], "left").select(
        "id", "url", "payload", "digest",
        F.when(~F.col("first").eqNullSafe(F.col("id")), F.col("first")).alias("origin"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, ["payload"]):
                out = []
                for r in zip(*[c.to_pylist() for c in b.columns]):
                    out.extend(page_records(*r, date, segment_bytes))
                yield pa.RecordBatch.from_arrays([pa.array(out, type=pa.binary())], names=["record"])

    records = rows.mapInArrow(run, "record binary")
    (records.select(F.col("record").cast("string").alias("value"))
            .write.option("lineSep", RECORD_END.decode()).option("compression", "gzip")
            .option("maxRecordsPerFile", records_per_file).text(path))


_FIELDS = T.StructType([T.StructField(n, t) for n, t in (
    ("record", T.StringType()), ("type", T.StringType()), ("row_id", T.StringType()),
    ("url", T.StringType()), ("digest", T.StringType()), ("refers_to", T.StringType()),
    ("refers_to_row", T.StringType()), ("origin", T.StringType()), ("segment", T.IntegerType()),
    ("total", T.LongType()), ("block", T.BinaryType()))])
_HEADER = {"record": "warc-record-id", "type": "warc-type", "row_id": "x-row-id", "url": "warc-target-uri",
           "digest": "warc-payload-digest", "refers_to": "warc-refers-to",
           "refers_to_row": "x-refers-to-row", "origin": "warc-segment-origin-id",
           "segment": "warc-segment-number", "total": "warc-segment-total-length"}


def parse_records(data: bytes) -> Iterator[dict]:
    """The records of one archive file, by Content-Length; ValueError where no
    record can be found."""
    at = 0
    while at < len(data):
        if data[at] in b"\r\n":                      # between records
            at += 1
            continue
        if not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            raise ValueError("a record header is cut short")
        h = {}
        for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
            k, _, v = line.partition(":")
            h[k.strip().lower()] = v.strip()
        size, at = int(h["content-length"]), end + 4
        if at + size > len(data):
            raise ValueError("a record is cut short")
        row = {k: h.get(name) for k, name in _HEADER.items()}
        row["segment"] = int(row["segment"]) if row["segment"] else None
        row["total"] = int(row["total"]) if row["total"] else None
        row["block"] = data[at:at + size]
        at += size
        yield row


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives under ``path`` (plain or gzip), one row
    each, segments apart."""
    ship_package(spark)
    kinds = pa.schema([(f.name, {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(),
                                 "binary": pa.binary()}[f.dataType.simpleString()]) for f in _FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                data = content.as_buffer().to_pybytes()
                if data[:2] == b"\x1f\x8b":
                    data = gzip.decompress(data)
                rows = list(parse_records(data))
                for k in range(0, len(rows), 256):
                    yield pa.RecordBatch.from_pylist(rows[k:k + 256], schema=kinds)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, _FIELDS)


def _payload(first: bytes, rest: list | None, segmented: int | None, total: int | None):
    """(payload, error) of a response from its first block and the others."""
    block = first
    if segmented is not None:
        rest = rest or []
        numbers = [r["segment"] for r in rest]
        if numbers != list(range(2, len(rest) + 2)):
            return None, "a segment is missing"
        block = first + b"".join(r["block"] for r in rest)
        if total is None or total != len(block):
            return None, "the segments don't have the total length"
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        return None, "no HTTP header"
    fields = head.lower().split(b"\r\n")[1:]
    if any(f.split(b":")[0].strip() == b"transfer-encoding" and b"chunked" in f for f in fields):
        try:
            body = unchunked(body)
        except ValueError as e:
            return None, str(e)
    return body, None


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit record: ``record``, ``type``, ``row_id``,
    ``url``, ``digest`` (as written), ``refers_to`` (a record), ``refers_to_row``,
    ``payload`` (null for revisits), ``error`` (null, or why no payload could be
    put together)."""
    records = read_records(spark, path)
    kinds = ["record", "type", "row_id", "url", "digest", "refers_to", "refers_to_row", "segment", "block"]
    whole = records.where(F.col("type").isin("response", "revisit")).select(*kinds)
    rest = (records.where(F.col("type") == "continuation").groupBy(F.col("origin").alias("of"))
                   .agg(F.sort_array(F.collect_set(F.struct("segment", "block"))).alias("rest"),
                        F.max("total").alias("whole_length")))
    # only cut records meet their continuations; whole ones stay where they are read
    cut = whole.where("segment is not null")
    cut = cut.join(rest, cut["record"] == rest["of"], "left").drop("of")
    parts = dict(rest.dtypes)
    plain = whole.where("segment is null").select(
        "*", *[F.lit(None).cast(parts[c]).alias(c) for c in ("rest", "whole_length")])
    rows = plain.unionByName(cut)

    def make():
        def decode(kinds, blocks, rests, segments, totals, digests):
            payloads, errors = [], []
            for kind, b, r, s, t, d in zip(kinds, blocks, rests, segments, totals, digests):
                body, error = (None, None) if kind == "revisit" else _payload(b, r, s, t)
                if body is not None and d and d != f"sha256:{hashlib.sha256(body).hexdigest()}":
                    body, error = None, "the payload doesn't have its digest"
                payloads.append(body)
                errors.append(error)
            return [payloads, errors]
        return decode

    out = append_columns(rows, ["type", "block", "rest", "segment", "whole_length", "digest"],
                         [T.StructField("payload", T.BinaryType()), T.StructField("error", T.StringType())],
                         make)
    return out.select("record", "type", "row_id", "url", "digest", "refers_to", "refers_to_row",
                      "payload", "error")
