"""WARC archives without repeated payloads.

Page headers (no payload) are folded by payload digest to find the payloads that occur
more than once and, of each, the page with the largest id; joined back by digest, every
other page with that payload becomes a ``revisit`` record without a body. Archives are
written as gzipped text parts whose separator is the two line ends that close a WARC
record, so that Spark's own sink writes valid archives to any file system.

Reading back streams every archive through a parser that goes by ``Content-Length``, so
a payload may hold any bytes, separators included, and memory is bounded by the largest
record. Revisits are then joined to the responses they refer to by digest.

NULL or empty html is an empty payload; NULL urls and ids leave out their header; a page
repeated under the winning id stays a response each time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import land

# shortest payload worth a revisit record
MIN_BYTES = 1000
END = "\r\n"
BREAK = b"\r\n\r\n"
# fixed values of the WARC 1.1 format
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

PARSED = (
    "page_id long, record_type string, url string, payload_digest string, "
    "payload_bytes long, refers_to long, refers_digest string"
)


def _record_id(page: Column, digest: Column) -> Column:
    """A UUID of the page's id and payload, the same on every run."""
    h = F.md5(F.concat_ws(":", page.cast("string"), digest).cast("binary"))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(
        F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">")
    )


def _header(name: str, value: Column) -> Column:
    """A header line; nothing where the value is NULL."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit(""))


def _one_line(value: Column) -> Column:
    """Control characters and spaces cannot stand in a header's URI."""
    return F.regexp_replace(value, r"[\x00-\x20\x7F]", "%20")


def resolve_revisits(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """page_id, url, html, payload_digest, payload_bytes, record_type, refers_to."""
    html = F.coalesce(F.col("html"), F.lit(""))
    base = pages.select(
        "page_id",
        "url",
        html.alias("html"),
        F.sha1(html.cast("binary")).alias("payload_digest"),
        F.octet_length(html).cast("long").alias("payload_bytes"),
    )
    repeated = (
        base.filter(F.col("payload_bytes") >= min_bytes)
        .groupBy(F.col("payload_digest").alias("_digest"))
        .agg(F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .drop("_n")
    )
    joined = base.join(
        repeated,
        (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_bytes") >= min_bytes),
        "left",
    )
    again = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return joined.withColumns(
        {
            "record_type": F.when(again, "revisit").otherwise("response"),
            "refers_to": F.when(again, F.col("_first")),
        }
    ).drop("_digest", "_first")


def record_text(date: str) -> Column:
    """The record of a resolved page, without the separator that closes it."""
    digest, page = F.col("payload_digest"), F.col("page_id")
    revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(END + END),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    return F.concat(
        F.lit(f"{VERSION}{END}"),
        _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", _record_id(page, digest)),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", _one_line(F.col("url"))),
        _header("WARC-Page-ID", page.cast("string")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        _header("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _header("WARC-Refers-To", F.when(revisit, _record_id(F.col("refers_to"), digest))),
        _header("WARC-Refers-To-Page-ID", F.when(revisit, F.col("refers_to").cast("string"))),
        F.lit(f"Content-Type: application/http; msgtype=response{END}"),
        _header("Content-Length", F.octet_length(block).cast("string")),
        F.lit(END),
        block,
    )


def write_archives(
    pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, date: str = "1970-01-01T00:00:00Z"
) -> None:
    """Write one record a page to gzipped archives in ``path``, a new folder."""
    resolved = resolve_revisits(pages, min_bytes)
    resolved.select(record_text(date).alias("value")).write.options(
        lineSep=END + END, compression="gzip"
    ).text(path)


def parse_records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a byte stream of whole archives.

    Line ends before a record are passed over. Spark's reader leaves them: where the last
    payload of a part ends in a line end, it finds the separator one line end early and
    gives the rest as a line of its own.
    """
    buffer, at = bytearray(), 0
    chunks = iter(chunks)

    def need(end: int) -> bool:
        """Read until ``end`` bytes are there."""
        nonlocal at
        while len(buffer) < end:
            got = next(chunks, None)
            if got is None:
                return False
            buffer.extend(got)
        return True

    while True:
        while need(at + len(END)) and buffer.startswith(END.encode(), at):
            at += len(END)
        while (cut := buffer.find(BREAK, at)) < 0:
            got = next(chunks, None)
            if got is None:
                if bytes(buffer[at:]).strip():
                    raise ValueError("an archive ends inside a header")
                return
            buffer.extend(got)
        lines = buffer[at:cut].decode("utf-8").split(END)
        if lines[0] != VERSION:
            raise ValueError(f"not a WARC record: {lines[0][:80]!r}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        start = cut + len(BREAK)
        end = start + int(headers["Content-Length"])
        if not need(end):
            raise ValueError("an archive ends inside a record")
        block = bytes(buffer[start:end])
        if not need(end + len(BREAK)) or buffer[end : end + len(BREAK)] != BREAK:
            raise ValueError("a record is not closed")
        at = end + len(BREAK)
        if at > 1 << 20:  # let go of what has been read
            del buffer[:at]
            at = 0
        yield headers, block


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("record_type", pa.string()),
            ("url", pa.string()),
            ("payload_digest", pa.string()),
            ("payload_bytes", pa.int64()),
            ("refers_to", pa.int64()),
            ("refers_digest", pa.string()),
        ]
    )

    def chunks():
        for batch in batches:
            for piece in batch.column(0):
                yield piece.as_py() + BREAK

    rows = []
    for headers, block in parse_records(chunks()):
        page, refers = headers.get("WARC-Page-ID"), headers.get("WARC-Refers-To-Page-ID")
        stated = headers["WARC-Payload-Digest"].removeprefix("sha1:")
        row = [page and int(page), headers["WARC-Type"], headers.get("WARC-Target-URI")]
        if headers["WARC-Type"] == "revisit":
            row += [None, None, int(refers), stated]
        else:
            payload = block[block.index(BREAK) + len(BREAK) :]
            digest = hashlib.sha1(payload).hexdigest()
            if digest != stated:
                raise ValueError(f"payload of page {page} does not match its digest")
            row += [digest, len(payload), None, None]
        rows.append(row)
        if len(rows) == 1000:
            yield _batch(rows, schema)
            rows = []
    if rows:
        yield _batch(rows, schema)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
    )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row a record; payload columns are computed from the stored payload.

    Gzip parts are never split, so a task sees whole archives in order.
    """
    lines = spark.read.option("lineSep", END + END).text(path)
    return lines.select(F.col("value").cast("binary").alias("value")).mapInArrow(_read, PARSED)


def resolve_archives(records: DataFrame) -> DataFrame:
    """Revisits with the payload columns of the response they refer to.

    Archives are parsed once: the records, without payloads, are landed. Only revisits are
    joined; a response knows its own payload.
    """
    found = land(records, "warc-records")
    responses = found.filter("record_type = 'response'")
    originals = responses.groupBy(
        F.col("payload_digest").alias("_d"), F.col("page_id").alias("_p")
    ).agg(F.max("payload_bytes").alias("_bytes"))
    resolved = (
        found.filter("record_type = 'revisit'")
        .join(
            originals,
            (F.col("refers_digest") == F.col("_d")) & (F.col("refers_to") == F.col("_p")),
            "left",
        )
        .withColumns({"payload_bytes": F.col("_bytes"), "payload_digest": F.col("_d")})
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    return responses.select(*columns).unionByName(resolved.select(*columns))
