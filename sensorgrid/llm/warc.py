"""Web archives: records written as one gzip member each, and read back in sequence.

``write_archives`` turns pages into archives, rows that hold the bytes of a whole
file; ``read_archives`` reads such rows, or real files through Spark's
``binaryFile`` source (``read_files``), so every store that Spark reaches will do.

The reader never inflates more than one record: it feeds a decompressor block by
block, frames the record by its Content-Length, and checks the payload's digest. A
revisit has no payload; ``verified`` compares what it says with the record it refers to,
as that was read.

Cases: null html is an empty payload; a null page_id is kept as null; rows that
repeat a page_id each get a record; of equal payloads of at least
``revisit_bytes`` those with the largest page_id are responses (all of them, if
rows repeat it, and all rows if no page_id is known) and the others revisit it;
an empty table gives no archives; other columns of the input are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorgrid.llm.common import arrow_map, saved

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 8 << 20
READ_BLOCK = 1 << 16
GZIP = 16 + zlib.MAX_WBITS

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD_TYPE = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary, digest_ok boolean, date string"
)


def with_record_types(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Pages with digest, size, record type and the page that a revisit refers to.

    Digests are aggregated before anything is moved. The table of digests that
    occur more than once is written, so its size is known: it is broadcast if it
    is small, and joined by a sort-merge join that splits hot digests if not.
    """
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    page = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        body.alias("payload"),
        F.octet_length(body).cast("long").alias("payload_bytes"),
        F.sha1(body).alias("payload_digest"),
    )
    repeated = saved(
        page.where(F.col("payload_bytes") >= revisit_bytes)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("response_id"), F.count("*").alias("copies"))
        .where("copies > 1")
        .drop("copies"),
        "warc-repeated",
    )
    revisits = F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    return page.join(repeated, ["payload_digest", "payload_bytes"], "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("response_id")).alias("refers_to"),
    )


def _block(page: dict, date: str) -> tuple[list[tuple[str, str]], bytes]:
    """Headers and content of one record."""
    digest = base64.b32encode(bytes.fromhex(page["payload_digest"])).decode()
    head = [
        ("WARC-Type", page["record_type"]),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Payload-Length", str(page["payload_bytes"])),
    ]
    if page["page_id"] is not None:
        head.append(("WARC-Record-ID", f"<urn:page:{page['page_id']}>"))
    if page["url"] is not None:
        uri = page["url"].replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
        head.append(("WARC-Target-URI", uri))
    if page["record_type"] == "revisit":
        head.append(("WARC-Refers-To", f"<urn:page:{page['refers_to']}>"))
        head.append(("WARC-Profile", REVISIT_PROFILE))
        return head, b"HTTP/1.1 200 OK\r\n\r\n"
    head.append(("Content-Type", "application/http; msgtype=response"))
    return head, b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n\r\n" + page["payload"]


def record_member(page: dict, date: str) -> bytes:
    """One record as one gzip member."""
    head, content = _block(page, date)
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*head, ("Content-Length", str(len(content)))])
    packer = zlib.compressobj(6, zlib.DEFLATED, GZIP)
    record = b"".join((VERSION, b"\r\n", lines.encode(), b"\r\n", content, b"\r\n\r\n"))
    return packer.compress(record) + packer.flush()


def write_archives(records: DataFrame, archive_bytes: int = ARCHIVE_BYTES, date: str | None = None) -> DataFrame:
    """One row per archive: its bytes. A record is never split.

    ``date`` is the records' time in the format's form; without it the time of this call.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                member = record_member({c: batch.column(c)[i].as_py() for c in batch.schema.names}, date)
                if held and size + len(member) > archive_bytes:
                    yield pa.RecordBatch.from_pydict({"content": [b"".join(held)]})
                    held, size = [], 0
                held.append(member)
                size += len(member)
        if held:
            yield pa.RecordBatch.from_pydict({"content": [b"".join(held)]})

    return arrow_map(records, task, "content binary")


def _inflated(archive: bytes) -> Iterator[tuple[int, bytes]]:
    """(number of the member, its next bytes), read block by block."""
    at, member, size = 0, 0, len(archive)
    unpacker = zlib.decompressobj(GZIP)
    view = memoryview(archive)
    while at < size:
        block = view[at : at + READ_BLOCK]
        at += len(block)
        while block:
            out = unpacker.decompress(block)
            if out:
                yield member, out
            if not unpacker.eof:
                break
            block = unpacker.unused_data
            unpacker = zlib.decompressobj(GZIP)
            member += 1


def sequential_records(archive: bytes) -> Iterator[dict]:
    """The records of an archive in order; framing errors raise ``ValueError``."""
    buffer, current = bytearray(), 0
    for member, part in _inflated(archive):
        if member != current:
            yield from _framed(buffer)
            buffer, current = bytearray(), member
        buffer += part
    yield from _framed(buffer)


def _framed(buffer: bytearray) -> Iterator[dict]:
    while buffer:
        end = buffer.find(b"\r\n\r\n")
        lines = bytes(buffer[:end]).split(b"\r\n")
        if end < 0 or not lines[0].startswith(b"WARC/"):
            raise ValueError("a record must start with its version and headers")
        head = {}
        for line in lines[1:]:
            name, _, value = line.partition(b":")
            head[name.strip().lower().decode()] = value.strip().decode()
        length = int(head["content-length"])
        body = bytes(buffer[end + 4 : end + 4 + length])
        if len(body) != length or bytes(buffer[end + 4 + length : end + 8 + length]) != b"\r\n\r\n":
            raise ValueError("a record's content must be as long as it says")
        del buffer[: end + 8 + length]
        yield _parsed(head, body)


def _page_number(urn: str | None) -> int | None:
    return int(urn.strip("<>").rpartition(":")[2]) if urn else None


def _parsed(head: dict[str, str], body: bytes) -> dict:
    payload = body.partition(b"\r\n\r\n")[2]
    kind = head.get("warc-type")
    label = head.get("warc-payload-digest", "")
    digest = base64.b32decode(label.rpartition(":")[2]).hex() if label else None
    uri = head.get("warc-target-uri")
    return {
        "page_id": _page_number(head.get("warc-record-id")),
        "url": uri and uri.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
        "payload_bytes": int(head["warc-payload-length"]) if kind == "revisit" else len(payload),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _page_number(head.get("warc-refers-to")),
        "payload": None if kind == "revisit" else payload,
        # A revisit has no payload of its own; ``verified`` looks at the one it refers to.
        "digest_ok": None if kind == "revisit" else hashlib.sha1(payload).hexdigest() == digest,
        "date": head.get("warc-date"),
    }


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the rows in ``content``; ``digest_ok`` is null for revisits (see ``verified``)."""
    schema = RECORD_TYPE if with_payload else RECORD_TYPE.replace("payload binary, ", "")
    names = [c.strip().split()[0] for c in schema.split(",")]
    types = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(),
             "payload": pa.binary(), "digest_ok": pa.bool_()}
    fields = pa.schema([(n, types.get(n, pa.string())) for n in names])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.column("content"):
                rows, size = [], 0
                for record in sequential_records(cell.as_py()):
                    rows.append({n: record[n] for n in names})
                    size += len(record["payload"] or b"") if with_payload else 0
                    if len(rows) >= 2000 or size > ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, fields)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, fields)

    return arrow_map(archives.select("content"), task, schema)


def verified(records: DataFrame) -> DataFrame:
    """The records with ``digest_ok`` of revisits too.

    A revisit is right if a response with the page_id it refers to was read whose payload
    has the digest and the length that the revisit says. Records are read from a table
    that is written, without payloads. Rows that repeat a page_id count as one response
    if any of them fits.
    """
    narrow = saved(records.drop("payload"), "warc-records")
    response = narrow.where("record_type <> 'revisit' and digest_ok").select(
        F.col("page_id").alias("at"), F.col("payload_digest").alias("held"), F.col("payload_bytes").alias("size")
    ).distinct()
    revisit = narrow.where("record_type = 'revisit'")
    fits = (F.col("refers_to") == F.col("at")) & (F.col("payload_digest") == F.col("held")) & (F.col("payload_bytes") == F.col("size"))
    checked = revisit.join(response, fits, "left").withColumn("digest_ok", F.col("at").isNotNull()).select(*narrow.columns)
    return narrow.where("record_type is null or record_type <> 'revisit'").unionByName(checked)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archive files below a path; a file is one cell, so of less than 2 GB and a task's memory."""
    return read_archives(spark.read.format("binaryFile").load(path))


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Every page's record as it comes back from written archives."""
    archives = saved(write_archives(with_record_types(pages)), "warc")
    return verified(read_archives(archives, with_payload=False))
