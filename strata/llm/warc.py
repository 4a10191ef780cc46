"""WARC archives: writing, reading headers, and resolving repeated payloads to revisit records.

Archives are gzip files with one member per record, written by tasks as streams. Deduplication works on headers alone:
they are grouped by payload digest, each record is joined to the response it repeats, and the archives are written anew
with fresh headers; payloads are read again only for the records that stay responses.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import Store, arrow_map, stored

MIN_BYTES = 1000
LEVEL = 3
# Bytes of one archive, and records that a reader hands on at a time.
ARCHIVE_BYTES, BATCH_RECORDS = 1 << 30, 1024
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILES = "file string"
HEADERS = (
    "file string, offset bigint, length bigint, record_id string, record_type string, uri string, date string, page_id bigint, "
    "payload_digest string, payload_bytes bigint, refers_to_id string, refers_to bigint"
)


def _value(text: str) -> str:
    """A header value: control characters and spaces would end it or hide its end."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def _member(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """One record as a gzip member of its own. Headers without a value are left out."""
    lines = [f"{name}: {value}" for name, value in [*headers, ("Content-Length", len(block))] if value is not None]
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    head = "\r\n".join(["WARC/1.1", *lines, "", ""]).encode()
    return pack.compress(head + block + b"\r\n\r\n") + pack.flush()


def _digest(hexadecimal: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def _response(record_id: str, page_id: int | None, uri: str | None, date: str, digest: str, payload: bytes) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [
        ("WARC-Type", "response"), ("WARC-Record-ID", record_id), ("WARC-Date", date), ("WARC-Target-URI", uri and _value(uri)),
        ("WARC-Payload-Digest", _digest(digest)), ("Page-Id", page_id), ("Payload-Length", len(payload)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return _member(headers, http + payload)


def _revisit(row: dict) -> bytes:
    headers = [
        ("WARC-Type", "revisit"), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", row["date"]), ("WARC-Target-URI", row["uri"] and _value(row["uri"])),
        ("WARC-Payload-Digest", _digest(row["payload_digest"])), ("WARC-Profile", PROFILE), ("WARC-Refers-To", row["refers_to_id"]),
        ("WARC-Refers-To-Target-URI", row["original_uri"] and _value(row["original_uri"])), ("WARC-Refers-To-Date", row["original_date"]),
        ("Page-Id", row["page_id"]), ("Refers-To-Page-Id", row["refers_to"]), ("Payload-Length", row["payload_bytes"]),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return _member(headers, b"")


def records(data: memoryview) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Offset, length, headers (lower-case names) and block of every record of an archive."""
    at, end = 0, len(data)
    while at < end:
        start, unpack, content = at, zlib.decompressobj(31), []
        while not unpack.eof:
            chunk = data[at : at + (1 << 16)]
            if not chunk:
                raise ValueError("an archive ends inside a record")
            content.append(unpack.decompress(chunk))
            at += len(chunk) - len(unpack.unused_data)
        head, _, rest = b"".join(content).partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at {start}")
        headers = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines[1:])}
        yield start, at - start, headers, rest[: int(headers["content-length"])]


def payload_of(block: bytes) -> bytes:
    """What follows the HTTP headers of a response block."""
    return block.partition(b"\r\n\r\n")[2]


def write_archives(pages: DataFrame, path: str, date: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A response record per row; returns the archives' names. NULL html is an empty payload, NULL id or url no header."""
    store = Store(path)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = name = None
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            if file is None:
                file, name = store.create(f"part-{part:06d}.warc.gz")
            for page_id, uri, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                payload = (html or "").encode()
                record_id = f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{path}#{part}#{row}').urn}>"
                file.write(_response(record_id, page_id, uri, date, hashlib.sha1(payload).hexdigest(), payload))
                row += 1
        if file is not None:
            file.close()
            yield pa.RecordBatch.from_arrays([pa.array([name])], ["file"])

    plain = pages.select(F.col(id_col).cast("bigint"), F.col(url_col).cast("string"), F.col(html_col).cast("string"))
    return stored(arrow_map(plain, write, FILES), "archives")


def read_headers(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    """One row per record of the archives; a response whose payload is not what its digest says is an error."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    store, schema = Store(path), to_arrow_schema(T._parse_datatype_string(HEADERS))

    def number(value: str | None) -> int | None:
        return None if value is None else int(value)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows = []
                for offset, length, h, block in records(memoryview(store.read(file))):
                    digest = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
                    n_bytes = number(h.get("payload-length"))
                    if h["warc-type"] == "response":
                        payload = payload_of(block)
                        n_bytes = len(payload)
                        if hashlib.sha1(payload).hexdigest() != digest:
                            raise ValueError(f"{file}: the payload at {offset} is damaged")
                    rows.append((file, offset, length, h["warc-record-id"], h["warc-type"], h.get("warc-target-uri"), h["warc-date"], number(h.get("page-id")), digest, n_bytes, h.get("warc-refers-to"), number(h.get("refers-to-page-id"))))
                    if len(rows) == BATCH_RECORDS:
                        yield made(rows)
                        rows = []
                if rows:
                    yield made(rows)

    # An archive is read by a task of its own; the rows dealt out here are file names.
    dealt = files.select("file").repartitionByRange(max(1, files.count()), "file")
    return arrow_map(dealt, read, HEADERS)


def resolve(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """New type and reference of every record, from headers alone.

    Of records with equal payloads (digest and length) of at least ``min_bytes``, the response with the largest page id
    (NULL last, then by place) stays a response and all others refer to it. Smaller payloads stay responses. Revisits
    that came in are joined to a response of their payload; one without any keeps the reference it had. ``headers`` is read
    twice, so it should be stored.
    """
    same = ["payload_digest", "payload_bytes"]
    # Reduced before the shuffle, and stored, so that the join below can be split where one payload has very many records.
    original = F.struct("page_id", "file", "offset", "record_id", "uri", "date")
    originals = headers.where((F.col("record_type") == "response") & (F.col("payload_bytes") >= min_bytes)).groupBy(*same).agg(F.max(original).alias("original"))
    joined = headers.join(stored(originals, "originals"), same, "left")
    itself = (F.col("original.file") == F.col("file")) & (F.col("original.offset") == F.col("offset"))
    again = F.col("original").isNotNull() & ~itself
    return joined.select(
        "file", "offset", "length", "record_id", "uri", "date", "page_id", *same,
        F.when(again, "revisit").otherwise(F.col("record_type")).alias("record_type"),
        F.when(again, F.col("original.record_id")).otherwise(F.col("refers_to_id")).alias("refers_to_id"),
        F.when(again, F.col("original.page_id")).otherwise(F.col("refers_to")).alias("refers_to"),
        F.when(again, F.col("original.uri")).alias("original_uri"),
        F.when(again, F.col("original.date")).alias("original_date"),
    )


def write_deduplicated(resolved: DataFrame, source: str, path: str, archives: int = 0) -> DataFrame:
    """The archives anew, with fresh headers; returns their names. Payloads are copied for responses only.

    There are as many archives as Spark has shuffle partitions, or ``archives`` where that is more.
    """
    old, store = Store(source), Store(path)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = name = opened = None
        data = memoryview(b"")
        for batch in batches:
            if file is None:
                file, name = store.create(f"part-{TaskContext.get().partitionId():06d}.warc.gz")
            for row in batch.to_pylist():
                if row["record_type"] == "revisit":
                    file.write(_revisit(row))
                    continue
                if opened != row["file"]:
                    opened, data = row["file"], memoryview(old.read(row["file"]))
                _, _, _, block = next(records(data[row["offset"] : row["offset"] + row["length"]]))
                file.write(_response(row["record_id"], row["page_id"], row["uri"], row["date"], row["payload_digest"], payload_of(block)))
        if file is not None:
            file.close()
            yield pa.RecordBatch.from_arrays([pa.array([name])], ["file"])

    # In the order of the old archives, so that a task reads few of them and each from front to back.
    usual = int(resolved.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = [F.col("file"), F.col("offset")]
    placed = resolved.repartitionByRange(archives, *place) if archives > usual else resolved.repartitionByRange(*place)
    placed = placed.sortWithinPartitions("file", "offset")
    return stored(arrow_map(placed, write, FILES), "archives")


def deduplicate(
    pages: DataFrame, path: str, date: str = "2000-01-01T00:00:00Z", min_bytes: int = MIN_BYTES, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to``, read back from archives without repeats.

    ``pages`` has ``page_id, url, html``, one record each; repeated rows are records of their own. Archives as first
    written are in ``path``/first, a file per input split, those without repeats in ``path``/unique, of about ``archive_bytes`` at most. An empty table gives no archive and no row.
    """
    spark = pages.sparkSession
    first, unique = f"{path}/first", f"{path}/unique"
    headers = stored(read_headers(spark, first, write_archives(pages, first, date)), "headers")
    archives = -(-(headers.agg(F.sum("length")).first()[0] or 0) // archive_bytes)
    files = write_deduplicated(resolve(headers, min_bytes), first, unique, archives)
    return read_headers(spark, unique, files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
