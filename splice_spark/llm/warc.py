"""WARC archives with revisit records for repeated payloads.

``write_archives`` hashes every payload, shuffles the headers only by digest to
find the original of each group of equal payloads, and writes WARC/1.1 files in
which the original is a response record and the others are revisit records that
refer to it, all with fresh ids, lengths and digests.  ``read_archives`` parses
such files, and ``resolve_revisits`` joins revisit records to the responses they
refer to.  Records are written by Spark's text sink, whose line separator is the
blank line between records, so any file system that Spark knows will do; files
are gzip streams of about ``file_bytes`` of payload each.

Payloads are equal if their lengths, SHA-1 and SHA-256 are.  The original is the
row of the largest page_id, a null one being the smallest; of several rows with
that page_id one is the original and the others revisit it.  A null html is an
empty payload, a null url is stood for by ``urn:page:`` and the page_id, and
control characters of urls are percent-encoded.  Long pages are records like
others; a record and the file it stands in must fit a Spark row (2 GB).  Columns
other than the three named ones are ignored; an empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from splice_spark.functions.lineage import shared_folder

from .common import ROW, cut, join_counted, numbered, small_batches, trimmed

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BREAK = "\r\n"
#: Payload bytes of an archive, before compression.
FILE_BYTES = 32 << 20


def base32_of_hex(digest: Column) -> Column:
    """Base32 of a SHA-1 in hexadecimal: four characters for each five digits."""
    parts = []
    for i in range(8):
        v = F.conv(F.substr(digest, F.lit(5 * i + 1), F.lit(5)), 16, 10).cast("int")
        parts += [F.substr(F.lit(ALPHABET), F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*parts)


def page_rows(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", row: Column | None = None) -> DataFrame:
    """``row string, page_id, url, html`` of all pages.

    ``row`` names a row alike in every scan; without it rows are numbered and the pages written first.
    """
    columns = [F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html")]
    if row is not None:
        return pages.select(row.cast("string").alias("row"), *columns)
    return cut(numbered(pages.select(*columns)).withColumn("row", F.col(ROW).cast("string")).drop(ROW))


def resolve_headers(heads: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``heads`` with ``original`` (null for responses): ``struct<page_id, row, url>`` of the record that a revisit refers to.

    Only headers are shuffled, by payload; digests that a large share of them have are joined where they are.
    """
    large = heads.filter(F.col("n_bytes") >= min_bytes)
    one = F.struct("page_id", "row", "url")
    originals = large.groupBy("key").agg(F.max(one).alias("original"), F.count("*").alias("n"))
    met = join_counted(large, originals, "key").withColumn("original", F.when(F.col("original.row") != F.col("row"), F.col("original")))
    return met.unionByName(heads.filter(F.col("n_bytes") < min_bytes).withColumn("original", F.lit(None).cast(met.schema["original"].dataType)))


def _record_id(row: Column) -> Column:
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(F.md5(row), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _uri(url: Column, page_id: Column) -> Column:
    safe = F.regexp_replace(F.regexp_replace(url, "\r", "%0D"), "\n", "%0A")
    safe = F.regexp_replace(safe, r"[\x00-\x20\x7F]", "%20")
    return F.when(F.length(url) > 0, safe).otherwise(F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit(""))))


def record_text(date: str = DATE) -> Column:
    """The record of a page (columns of ``page_rows``, and ``digest, n_bytes, original``) without its closing blank line."""
    revisit = F.col("original").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n_bytes").cast("string"), F.lit(_BREAK * 2))
    body = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    original = F.col("original")
    refers = F.concat(
        F.lit("WARC-Refers-To: "), _record_id(original["row"]), F.lit(f"{_BREAK}WARC-Refers-To-Target-URI: "), _uri(original["url"], original["page_id"]),
        F.lit(f"{_BREAK}WARC-Refers-To-Date: {date}{_BREAK}WARC-Profile: {PROFILE}{_BREAK}"),
    )
    return F.concat(
        F.lit(f"WARC/1.1{_BREAK}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{_BREAK}WARC-Record-ID: "), _record_id(F.col("row")), F.lit(f"{_BREAK}WARC-Date: {date}{_BREAK}WARC-Target-URI: "), _uri(F.col("url"), F.col("page_id")),
        F.lit(f"{_BREAK}WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit(_BREAK), F.when(revisit, refers).otherwise(""),
        F.lit("X-Page-ID: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(f"{_BREAK}Content-Type: application/http;msgtype=response{_BREAK}Content-Length: "), (F.octet_length(http) + F.octet_length(body)).cast("string"), F.lit(_BREAK * 2), http, body,
    )


def write_archives(rows: DataFrame, path: str, min_bytes: int = 0, file_bytes: int = FILE_BYTES, date: str = DATE) -> None:
    """Archives of ``rows`` (``page_rows``) under ``path``: a record for each row, revisit records for repeated payloads of ``min_bytes`` or more."""
    sha1 = F.sha1(F.col("html").cast("binary"))
    heads = cut(rows.select("row", "page_id", "url", base32_of_hex(sha1).alias("digest"), F.octet_length("html").cast("long").alias("n_bytes"), F.concat(sha1, F.sha2(F.col("html").cast("binary"), 256)).alias("key")))
    total = heads.agg(F.sum("n_bytes")).first()[0] or 0
    files = max(1, math.ceil(total / file_bytes))
    decided = resolve_headers(heads, min_bytes).select("row", "digest", "n_bytes", "original").repartition(files, "row")
    whole = rows.repartition(files, "row").join(decided, "row")
    whole.select(record_text(date).alias("value")).write.option("lineSep", _BREAK * 2).option("compression", "gzip").text(path)


def inflate(data: bytes) -> bytes:
    """A gzip stream of one member or several; other data as it is."""
    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data:
        member = zlib.decompressobj(31)
        out += [member.decompress(data), member.flush()]
        if not member.eof:
            raise ValueError("a gzip member is cut short")
        data = member.unused_data
    return b"".join(out)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], memoryview]]:
    """Headers (names in lower case) and block of each record of an archive."""
    at, view = 0, memoryview(data)
    while at < len(data):
        end = data.find(_BREAK.encode() * 2, at)
        lines = data[at:end].decode("utf-8", "replace").split(_BREAK)
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        start, length = end + 4, int(headers["content-length"])
        if start + length > len(data):
            raise ValueError(f"the record at byte {at} is cut short")
        yield headers, view[start : start + length]
        at = start + length + 4


_RECORD = "record_id string, record_type string, page_id long, target_uri string, refers_to string, declared_digest string, payload_digest string, payload_bytes long, payload binary"


def _parse(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.binary()]
        names = [c.split()[0] for c in _RECORD.split(", ")]
        for batch in batches:
            for k in range(batch.num_rows):
                rows, held = [], 0
                for h, block in parse_records(inflate(batch.column(0)[k].as_py())):
                    response = h["warc-type"] == "response"
                    payload = bytes(block).partition(_BREAK.encode() * 2)[2] if response else None
                    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode() if response else None
                    page = h.get("x-page-id")
                    rows.append((h["warc-record-id"], h["warc-type"], int(page) if page else None, h.get("warc-target-uri"), h.get("warc-refers-to"), h.get("warc-payload-digest", "").removeprefix("sha1:") or None, digest, len(payload) if response else None, payload if payloads else None))
                    held += len(payload or b"") * payloads
                    if held > 8 << 20 or len(rows) >= 4096:
                        yield _batch(rows, kinds, names)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, kinds, names)

    return run


def _batch(rows: list[tuple], kinds: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row for each record of the archives under ``path``; digest and length are those of the payload found, null for revisit records, and ``payload`` is null if not asked for."""
    small_batches(spark)
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(trimmed(_parse(payloads)), _RECORD)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records`` with the payload's digest, length and bytes of the response that a revisit record refers to, and its page_id (``original_page_id``); nulls where it isn't there."""
    kept = ["page_id", "payload_digest", "payload_bytes", "payload"]
    revisits = records.filter("record_type = 'revisit'")
    responses = records.filter("record_type <> 'revisit'")
    asked = revisits.groupBy("refers_to").agg(F.count("*").alias("n"))
    found = asked.join(responses.select(F.col("record_id").alias("refers_to"), F.struct(*kept).alias("found__")), "refers_to", "left")
    met = join_counted(revisits, found, "refers_to")
    met = met.withColumns({c: F.col(f"found__.{c}") for c in kept[1:]} | {"original_page_id": F.col("found__.page_id")}).drop("found__")
    return responses.withColumn("original_page_id", F.lit(None).cast("long")).unionByName(met)


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(page_rows(pages, row=F.concat_ws("#", "_metadata.file_path", "_metadata.row_index")), path)
    records = cut(read_archives(spark, path, payloads=False))
    return resolve_revisits(records).select("page_id", "payload_bytes", "payload_digest", "record_type", F.col("original_page_id").alias("refers_to"))


OP12_SQL = f"""
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), o AS (
    SELECT *, max(page_id) OVER (PARTITION BY html) AS first_id, octet_length(encode(html)) AS n FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       list_aggregate([substr('{ALPHABET}', 1 + ((CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS INTEGER) >> (15 - 5 * (i % 4))) & 31), 1) FOR i IN range(32)], 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM o
"""
