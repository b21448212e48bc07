"""WARC archives in which equal payloads are stored once.

Headers - page, address, digest and size of the payload - are shuffled by digest. Of the pages
with one payload the one with the largest id becomes the response record; all others become
revisit records that name the response they refer to. Responses and revisits are written with
fresh headers as WARC 1.1 files by Spark's text writer, whose line separator is the two line
ends between records. Only the responses' payloads are moved, and of equal payloads every input
task sends one.

Reading takes whole archive files (bounded by ``RECORDS_PER_FILE``), walks their records by
``Content-Length`` and checks every payload against its digest; revisits are then resolved by a
join with the responses on the digest.

Payloads are equal if SHA-256 and size are; the records carry the SHA-1 digest that the format
asks for. Payloads below ``least_bytes`` are never shared.

Defined cases: a missing payload is empty, and empty payloads are equal; a missing id loses to
any other and has no page header; a missing address is left out; control characters in an
address are percent-encoded; of rows that agree in id, address and payload one is the response
and the others revisit it; an empty table gives an archive without records; further columns play
no part.
"""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.common import cut, packed

RECORDS_PER_FILE = 10_000
SEPARATOR = "\r\n\r\n"
# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def base32_of_hex(digest: Column) -> Column:
    """Upper-case base32 of 40 hexadecimal digits: four base32 digits per five of them."""
    groups = [
        F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(
        F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


def _pages(pages: DataFrame, key: str, address: str, payload: str) -> DataFrame:
    html = F.coalesce(F.col(f"row.`{payload}`"), F.lit(""))
    return packed(pages).select(
        F.col(f"row.`{key}`").alias("page"),
        F.col(f"row.`{address}`").alias("url"),
        html.alias("html"),
        F.octet_length(html).cast("long").alias("bytes"),
        F.sha2(html, 256).alias("content_key"),
        F.sha1(html).alias("sha1"),
    )


def _record_id(page: Column, url: Column, digest: Column, copy: Column) -> Column:
    named = F.md5(F.concat_ws("\n", page.cast("string"), url, digest, copy.cast("string")))
    parts = [F.substring(named, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _lines(*lines: tuple[str, Column]) -> Column:
    """Header lines; a line whose value is null is left out."""
    return F.concat(
        *[
            F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))
            for name, value in lines
        ]
    )


def _safe(url: Column) -> Column:
    for code in (*range(32), 127):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(url != "", url)


def _keyed(df: DataFrame, least_bytes: int) -> DataFrame:
    """The key that equal payloads share; small payloads get one of their own per page."""
    alone = F.when(
        F.col("bytes") < least_bytes,
        F.to_json(F.struct("page", "url"), {"ignoreNullFields": "false"}),
    )
    return df.withColumn("share", F.concat_ws(":", "content_key", "bytes", alone))


def records(
    pages: DataFrame,
    key: str = "page_id",
    address: str = "url",
    payload: str = "html",
    least_bytes: int = 0,
    written: datetime | None = None,
) -> DataFrame:
    """``record``: the text of every WARC record, without the separator behind it."""
    date = (written or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = _keyed(_pages(pages, key, address, payload), least_bytes)
    order = F.struct("page", "url")
    small = F.col("bytes") < least_bytes
    # Below the limit every row is a response, rows that agree in everything too.
    originals = (
        rows.groupBy("share")
        .agg(
            F.max_by(F.struct("page", "url", "html", "bytes", "sha1"), order).alias("o"),
            F.count_if(small).alias("own"),
        )
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.greatest("own", F.lit(1)))))
    )
    heads = rows.where(~small).select("share", "page", "url", "sha1")
    same = heads.groupBy("share", "page", "url").agg(
        F.count(F.lit(1)).alias("n"), F.first("sha1").alias("sha1")
    )
    best = heads.groupBy("share").agg(F.max(order).alias("o"))
    revisits = (
        same.join(best, "share")
        .withColumn(
            "own",
            (F.col("page").eqNullSafe(F.col("o.page")) & F.col("url").eqNullSafe(F.col("o.url")))
            .cast("long"),
        )
        .where("n > own")
        .withColumn("copy", F.explode(F.sequence(F.col("own") + 1, F.col("n"))))
    )
    block = F.concat(F.lit(HTTP_HEAD), F.col("o.html"))
    response = F.concat(
        F.lit("WARC/1.1\r\n"),
        _lines(
            ("WARC-Type", F.lit("response")),
            ("WARC-Record-ID", _record_id(
                F.col("o.page"), F.col("o.url"), F.col("o.sha1"), F.col("copy"))),
            ("WARC-Date", F.lit(date)),
            ("WARC-Target-URI", _safe(F.col("o.url"))),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_of_hex(F.col("o.sha1")))),
            ("X-Page-ID", F.col("o.page")),
            ("X-Share", F.sha1("share")),
            ("Content-Type", F.lit("application/http;msgtype=response")),
            ("Content-Length", F.octet_length(block)),
        ),
        F.lit("\r\n"),
        block,
    )
    revisit = F.concat(
        F.lit("WARC/1.1\r\n"),
        _lines(
            ("WARC-Type", F.lit("revisit")),
            ("WARC-Record-ID", _record_id(
                F.col("page"), F.col("url"), F.col("sha1"), F.col("copy"))),
            ("WARC-Date", F.lit(date)),
            ("WARC-Target-URI", _safe(F.col("url"))),
            ("WARC-Profile", F.lit(PROFILE)),
            ("WARC-Refers-To", _record_id(
                F.col("o.page"), F.col("o.url"), F.col("sha1"), F.lit(1))),
            ("WARC-Refers-To-Target-URI", _safe(F.col("o.url"))),
            ("WARC-Refers-To-Date", F.lit(date)),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_of_hex(F.col("sha1")))),
            ("X-Page-ID", F.col("page")),
            ("X-Share", F.sha1("share")),
            ("Content-Length", F.lit(0)),
        ),
        F.lit("\r\n"),
    )
    return originals.select(response.alias("record")).unionByName(
        revisits.select(revisit.alias("record"))
    )


def write_archives(pages: DataFrame, folder: str, **options) -> None:
    """Deduplicated archives, one gzip file per task and ``RECORDS_PER_FILE`` records."""
    (
        records(pages, **options)
        .write.option("lineSep", SEPARATOR)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(folder)
    )


def parse_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of a binary stream."""
    while True:
        first = stream.readline()
        if not first:
            return
        if first.strip() != b"WARC/1.1":
            raise ValueError(f"no record starts here: {first[:40]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(": ")
            headers[name] = value
        block = stream.read(int(headers["Content-Length"]))
        if stream.read(4) != SEPARATOR.encode():
            raise ValueError(f"no record ends at {headers.get('WARC-Record-ID')}")
        yield headers, block


class _Inflated(io.RawIOBase):
    """Decompresses a gzip buffer piece by piece, one member after the other."""

    def __init__(self, data: bytes) -> None:
        self.data, self.at, self.left = memoryview(data), 0, b""
        self.engine = zlib.decompressobj(31)

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        while not self.left and self.at < len(self.data):
            if self.engine.eof:
                self.engine = zlib.decompressobj(31)
            piece = self.data[self.at : self.at + 65536]
            self.left = self.engine.decompress(piece)
            self.at += len(piece) - len(self.engine.unused_data)
        part = self.left[: len(target)]
        target[: len(part)] = part
        self.left = self.left[len(part) :]
        return len(part)


_HEADER_SCHEMA = (
    "record_id string, record_type string, page string, url string, share string, digest string, "
    "refers string, payload_bytes long"
)


def read_headers(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record with what its headers say; every payload is checked."""

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in _HEADER_SCHEMA.split(", ")]
        for batch in stream:
            for i in range(batch.num_rows):
                rows = []
                opened = io.BufferedReader(_Inflated(batch.column("content")[i].as_py()))
                for headers, block in parse_records(opened):
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = None
                    if headers["WARC-Type"] == "response":
                        payload = block[len(HTTP_HEAD) :]
                        size = len(payload)
                        own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if own != digest:
                            raise ValueError(f"payload differs: {headers['WARC-Record-ID']}")
                    rows.append(
                        (
                            headers["WARC-Record-ID"],
                            headers["WARC-Type"],
                            headers.get("X-Page-ID"),
                            headers.get("WARC-Target-URI"),
                            headers["X-Share"],
                            digest,
                            headers.get("WARC-Refers-To"),
                            size,
                        )
                    )
                columns = list(zip(*rows)) if rows else [()] * len(names)
                kinds = [pa.string()] * (len(names) - 1) + [pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return files.select("content").mapInArrow(batches, _HEADER_SCHEMA)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Every page of the archives, revisits resolved to their originals by payload digest."""
    heads = cut(read_headers(spark, folder))
    originals = heads.where("record_type = 'response'").select(
        "share",
        F.col("record_id").alias("original"),
        F.col("page").alias("original_page"),
        F.col("payload_bytes").alias("size"),
    )
    found = heads.where("record_type = 'revisit'").join(originals, "share", "left")
    lost = F.when(
        ~F.col("refers").eqNullSafe(F.col("original")),
        F.raise_error(F.concat(F.lit("revisit without its original: "), "record_id")),
    )
    revisits = found.select(
        "page",
        F.coalesce(lost.cast("long"), F.col("size")).alias("payload_bytes"),
        "digest",
        "record_type",
        "original_page",
    )
    responses = heads.where("record_type = 'response'").select(
        "page", "payload_bytes", "digest", "record_type", F.lit(None).cast("string").alias("original_page")
    )
    return responses.unionByName(revisits).select(
        F.col("page").cast("long").alias("page_id"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        F.col("original_page").cast("long").alias("refers_to"),
    )
