"""WARC archives with revisit records for repeated payloads.

Headers (identifier, digest, length) are shuffled by payload digest, the newest page of a digest
becomes the original, and the other pages are joined to it as revisits. The archives are then
written anew with fresh headers: originals with their payload, revisits without one. Spark's
text writer writes them, with the record's closing line ends as its separator, so they can go
to any file system Spark knows; they are read back as binary files, record by record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.work import whole_text, work_dir

#: Records in a file, so that a file fits a reader's memory.
RECORDS_PER_FILE = 2000
#: Ends of lines and records, the base-32 digits of both kinds, HTTP header.
LINE, RECORD_END = "\r\n", "\r\n\r\n"
PLAIN_DIGITS, BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = (
    "record_id string, record_type string, page_id long, url string, payload_bytes long, "
    "payload_digest string, refers_to long"
)


def base32_sha1(text: Column) -> Column:
    """Upper-case base32 of the SHA-1 of the text's UTF-8 bytes."""
    digits = F.sha1(text)
    groups = [F.lpad(F.conv(F.substring(digits, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*groups), PLAIN_DIGITS, BASE32_DIGITS)


def _record_uuid(page_id: Column, identity: Column) -> Column:
    digits = F.md5(F.concat_ws("/", F.coalesce(page_id.cast("string"), F.lit("-")), F.hex(identity)))
    cuts = [F.substring(digits, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def resolve_revisits(headers: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, identity, refers_to`` of the pages whose payload a later page has too.

    ``headers`` has ``page_id, identity, payload_bytes``. Originals are aggregated before the
    shuffle; the join is on the digest, which Spark splits if one is hot. Null ids come first,
    so they revisit any page with an id; payloads of null ids only have no revisits.
    """
    large = headers.where(F.col("payload_bytes") >= least_bytes)
    originals = large.groupBy("identity").agg(
        F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("pages")
    )
    originals = originals.where((F.col("pages") > 1) & F.col("refers_to").isNotNull())
    seen = large.select("page_id", "identity").distinct()
    found = seen.join(originals, "identity")
    earlier = F.col("page_id").isNull() | (F.col("page_id") < F.col("refers_to"))
    return found.where(earlier).select("page_id", "identity", "refers_to")


def write_archives(
    pages: DataFrame,
    path: str,
    least_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> None:
    """A record per row of ``pages`` below ``path``, in compressed files.

    Of equal payloads of at least ``least_bytes`` bytes that of the largest page id is a
    response and the others revisit it; smaller ones are all responses. A null payload is
    empty, a null url has no target header, line ends in a url are percent-encoded. Rows that
    agree in id and payload give records of the same kind. ``date`` is the records' date.
    """
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        whole_text(html_col).alias("html"),
    )
    rows = rows.select(
        "*", F.octet_length("html").cast("long").alias("payload_bytes"), F.unhex(F.sha2("html", 256)).alias("identity")
    )
    revisits = resolve_revisits(rows.select("page_id", "identity", "payload_bytes"), least_bytes)
    revisits = revisits.toDF("_page_id", "_identity", "refers_to")
    same = rows["page_id"].eqNullSafe(revisits["_page_id"]) & (rows["identity"] == revisits["_identity"])
    joined = rows.join(revisits, same, "left")
    records = joined.select(_record(date).alias("value"))
    (
        records.write.option("lineSep", RECORD_END).option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)
    )


def _record(date: str) -> Column:
    """The record's text without its closing line ends."""

    def header(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(LINE)), F.lit(""))

    revisit = F.col("refers_to").isNotNull()
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit(HTTP), F.lit("Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(RECORD_END))
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("html")))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        header("WARC-Record-ID", _record_uuid(F.col("page_id"), F.col("identity"))),
        header("WARC-Date", F.lit(date)),
        header("WARC-Target-URI", url),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("html")))),
        header("WARC-Refers-To", F.when(revisit, _record_uuid(F.col("refers_to"), F.col("identity")))),
        header("WARC-Profile", F.when(revisit, PROFILE)),
        header("X-Page-Id", F.col("page_id").cast("string")),
        header("X-Refers-To-Page-Id", F.col("refers_to").cast("string")),
        F.lit("Content-Type: application/http;msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(RECORD_END),
        block,
    )


def records_of(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an uncompressed archive."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        headers: dict[str, str] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.lower()] = value.strip(" \r\n")
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("an archive ends inside a record")
        yield headers, block


def _row(headers: dict[str, str], block: bytes) -> tuple:
    http, _, payload = block.partition(RECORD_END.encode())
    length = next(int(x[15:]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    if headers["warc-type"] == "response":
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest or len(payload) != length:
            raise ValueError(f"payload of {headers['warc-record-id']} does not fit its digest")

    def number(name: str) -> int | None:
        return int(headers[name]) if name in headers else None

    return (
        headers["warc-record-id"], headers["warc-type"], number("x-page-id"), headers.get("warc-target-uri"),
        length, digest, number("x-refers-to-page-id"),
    )


def _record_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = [part.split()[0] for part in RECORDS.split(", ")]
    for batch in batches:
        for content in batch.column("content"):
            with gzip.open(pa.BufferReader(content.as_buffer())) as stream:
                rows = [_row(headers, block) for headers, block in records_of(io.BufferedReader(stream))]
            arrays = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records below ``path``. Payload length and digest of responses are checked against
    the payload; a record that does not fit its headers raises."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(_record_batches, RECORDS)


def archived_pages(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` and more of every
    page, from archives written to the shared folder and read again. Empty input gives no rows;
    other columns are not read."""
    spark = pages.sparkSession
    path = work_dir(spark, "warc")
    write_archives(pages, path, least_bytes)
    return read_archives(spark, path)
