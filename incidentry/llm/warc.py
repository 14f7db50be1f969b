"""WARC archives written and read through an index.

The writer stores each record as a gzip member of its task's archive and
returns the index: archive, offset, length, URL and digest of every record.
The reader takes selected index rows, sorts them by place, coalesces nearby
byte ranges and parses the records from them. Equal payloads are stored once;
the others are revisit records that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_SHARED_BYTES = 1000
GAP_BYTES = 64 << 10
RANGE_BYTES = 8 << 20
_DATE = "2000-01-01T00:00:00Z"  # fixed, so that archives are the same on every run
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = (
    "id {kind}, archive string, offset bigint, length bigint, url string, "
    "payload_digest string, record_type string, refers_to {kind}"
)
RECORDS = "id {kind}, url string, record_type string, refers_to {kind}, payload_bytes bigint, payload_digest string, payload binary"


def _header_text(value: str) -> str:
    """One header line cannot hold line breaks; they are percent-encoded, as is the sign itself."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _header_value(text: str) -> str:
    return text.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def write_record(key, url: str | None, payload: bytes, refers_to=None, digest: str = "") -> bytes:
    """One record, a gzip member. ``refers_to`` makes it a revisit, without the payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    sha1 = base64.b32encode(bytes.fromhex(digest)).decode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if key is None else key}>",
        f"WARC-Date: {_DATE}",
        *([] if url is None else [f"WARC-Target-URI: {_header_text(url)}"]),
        f"WARC-Payload-Digest: sha1:{sha1}",
        *([f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    data = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def read_record(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of a gzip member."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = _headers(head)
    block = rest[: int(headers["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return headers, _headers(http), payload


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}


def plan_records(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """Pages with the digest of the payload and, for revisits, the page that holds it."""
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    digested = rows.withColumn("payload_digest", F.sha1("payload"))
    holders = (
        digested.where(F.length("payload") >= MIN_SHARED_BYTES)
        .groupBy(F.col("payload_digest").alias("shared"))
        .agg(F.max("id").alias("holder"), F.count(F.lit(1)).alias("holders"))
        .where("holders > 1")
        .select("shared", "holder")
    )
    return digested.join(holders, F.col("payload_digest") == F.col("shared"), "left").select(
        "id", "url", "payload", "payload_digest",
        F.when(~F.col("id").eqNullSafe(F.col("holder")), F.col("holder")).alias("refers_to"),
    )


def write_warc(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html"
) -> DataFrame:
    """Write every row as a record below ``folder`` and return the index, one row per record.

    Of equal payloads of at least ``MIN_SHARED_BYTES``, the record with the
    largest id is the response and the others revisit it; rows that share that
    id are all responses, and so are all where every id is null. A null payload
    is empty, a null URL has no header. Each attempt of a task writes an archive
    of its own name, so the archives of lost attempts are in no index.
    ``folder`` is a URI that every executor can write. The frame writes when it
    is evaluated: store it before reading it twice. A payload of any length is one
    record; without rows there are no archives, and the index is empty.
    """
    rows = plan_records(pages, id_col, url_col, payload_col)
    kind = rows.schema["id"].dataType.simpleString()
    run_id = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_folder(folder)
        context = TaskContext.get()
        name = f"{run_id}-{context.partitionId():06d}-{context.taskAttemptId()}.warc.gz"
        store.create_dir(root, recursive=True)
        out, at = None, 0
        try:
            for batch in batches:
                index = []
                for row in batch.to_pylist():
                    if out is None:
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    data = write_record(
                        row["id"], row["url"], row["payload"], row["refers_to"], row["payload_digest"]
                    )
                    out.write(data)
                    what = "response" if row["refers_to"] is None else "revisit"
                    index.append((at, len(data), what))
                    at += len(data)
                offsets, lengths, kinds = zip(*index, strict=True) if index else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"), pa.array([name] * batch.num_rows, pa.string()),
                        pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()), batch.column("url"),
                        batch.column("payload_digest"), pa.array(kinds, pa.string()), batch.column("refers_to"),
                    ],
                    ["id", "archive", "offset", "length", "url", "payload_digest", "record_type", "refers_to"],
                )
        finally:
            if out is not None:
                out.close()

    return rows.mapInArrow(run, INDEX.format(kind=kind))


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI such as file:, hdfs: or s3:, or of a plain path."""
    if "://" in folder:
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder.removeprefix("file:")


def coalesce_ranges(places: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """Sorted (offset, length) places as reads (start, end, members) over small gaps, of bounded size."""
    members: list[tuple[int, int]] = []
    start = end = 0
    for offset, length in places:
        if members and (offset - end > GAP_BYTES or offset + length - start > RANGE_BYTES):
            yield start, end, members
            members = []
        if not members:
            start = end = offset
        members.append((offset, length))
        end = max(end, offset + length)
    if members:
        yield start, end, members


def read_warc(index: DataFrame, folder: str, keep_payload: bool = True) -> DataFrame:
    """The records of the given index rows, parsed from the archives.

    payload_bytes is the full payload's length as the HTTP header has it and
    payload_digest its SHA-1: computed from the payload of a response (which must
    equal the header, else ValueError), from the header of a revisit. Rows of one archive are dealt
    out by blocks of ``RANGE_BYTES``, so one large archive is read by many tasks. An
    empty index gives no rows.
    """
    kind = index.schema["id"].dataType.simpleString()
    block = F.floor(F.col("offset") / F.lit(RANGE_BYTES))
    dealt = (
        index.select("id", "archive", "offset", "length", "url", "refers_to")
        .repartition("archive", block)
        .sortWithinPartitions("archive", "offset")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_folder(folder)
        names = ["id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
        for batch in batches:
            rows = batch.to_pylist()
            start = 0
            while start < len(rows):
                end = start
                while end < len(rows) and rows[end]["archive"] == rows[start]["archive"]:
                    end += 1
                group = {r["offset"]: r for r in rows[start:end]}
                with store.open_input_file(f"{root}/{rows[start]['archive']}") as file:
                    places = [(r["offset"], r["length"]) for r in rows[start:end]]
                    for low, high, members in coalesce_ranges(places):
                        data = file.read_at(high - low, low)
                        out = [_parsed(data[a - low : a - low + n], group[a], keep_payload) for a, n in members]
                        columns = list(zip(*out, strict=True))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(columns[0], batch.schema.field("id").type),
                                pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string()),
                                pa.array(columns[3], batch.schema.field("refers_to").type),
                                pa.array(columns[4], pa.int64()), pa.array(columns[5], pa.string()),
                                pa.array(columns[6], pa.binary()),
                            ],
                            names,
                        )
                start = end

    return dealt.mapInArrow(run, RECORDS.format(kind=kind))


def _parsed(member: bytes, row: dict, keep_payload: bool) -> tuple:
    headers, http, payload = read_record(member)
    digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
    size = int(http["content-length"])
    what = headers["warc-type"]
    if what == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError(f"damaged record of {row['id']} in {row['archive']} at {row['offset']}")
    url = headers.get("warc-target-uri")
    refers = headers.get("warc-refers-to", "").removeprefix("<urn:page:").removesuffix(">")
    if str("" if row["refers_to"] is None else row["refers_to"]) != refers:
        raise ValueError(f"index and record differ for {row['id']} in {row['archive']}")
    return (
        row["id"], None if url is None else _header_value(url), what, row["refers_to"], size, digest,
        payload if keep_payload and what == "response" else None,
    )
