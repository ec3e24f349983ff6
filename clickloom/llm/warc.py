"""WARC archives written and read through an index.

Writing gives one index row per record: archive, offset, length, URL and digest.
Reading starts from index rows, selected by any filter: those of a stretch of an
archive come sorted to one task, which joins neighbouring byte ranges into few
reads. Archives are gzip members, one per record, in the shared folder.
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

from clickloom.llm.common import map_batches
from clickloom.session import cut_lineage, scratch_path

ARCHIVE_BYTES = 64 << 20
STRETCH_BYTES = 16 << 20
GAP_BYTES = 64 << 10
READ_BYTES = 4 << 20
BROADCAST_GROUPS = 10_000
DATE = "2024-01-01T00:00:00Z"
INDEX = (
    "archive string, offset long, length long, url string, payload_digest string, "
    "page_id long, record_type string"
)
RECORD = (
    "page_id long, url string, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long, payload binary"
)
_PAGE = "<urn:x-page:%s>"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(value: str) -> str:
    """A header value on one line: blanks and controls as in URLs."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def _record(kind: str, page_id, url: str | None, extra: list[str], block: bytes) -> bytes:
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_PAGE % ('' if page_id is None else page_id)}",
        f"WARC-Date: {DATE}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    head += [*extra, f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def make_record(page_id, url: str | None, payload: bytes, digest: str, first) -> bytes:
    """A response with its payload, or, given the page it repeats, a revisit."""
    extra = [
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
    ]
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    if first is None:
        return _record("response", page_id, url, extra, http + payload)
    extra += [
        "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        f"WARC-Refers-To: {_PAGE % first}",
    ]
    return _record("revisit", page_id, url, extra, http)


def _page(value: str | None) -> int | None:
    number = value[len("<urn:x-page:") : -1] if value else ""
    return int(number) if number else None


def parse_record(raw: bytes) -> dict:
    """The fields of ``RECORD``; raises where a payload belies its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not the start of a record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = None
    if fields["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if digest_of(payload) != digest:
            raise ValueError(f"digest of {fields['WARC-Record-ID']} differs")
    return {
        "page_id": _page(fields["WARC-Record-ID"]),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": int(fields["WARC-Payload-Length"]),
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": _page(fields.get("WARC-Refers-To")),
        "payload": payload,
    }


def with_first(pages: DataFrame, at_least: int = 0) -> DataFrame:
    """(page_id, url, payload, first): ``first`` is the smallest page_id of equal
    payloads where it is another page, else null. Groups are found on digests,
    with a partial aggregate below the shuffle; only those of two or more are
    joined back, by broadcast if they are few."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    groups = (
        rows.filter(F.octet_length("payload") >= at_least)
        .groupBy("digest")
        .agg(F.min("page_id").alias("least"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("digest", "least")
    )
    groups = cut_lineage(groups)
    if groups.count() <= BROADCAST_GROUPS:
        groups = F.broadcast(groups)
    first = F.when(~F.col("page_id").eqNullSafe(F.col("least")), F.col("least"))
    first = F.when(F.octet_length("payload") >= at_least, first)
    return rows.join(groups, "digest", "left").select(
        "page_id", "url", "payload", first.alias("first")
    )


def write_archives(rows: DataFrame, folder: str, most: int = ARCHIVE_BYTES) -> DataFrame:
    """The index of the archives that hold ``rows``, as a stored table.

    Each attempt of a task writes archives under names of its own, so only what
    successful tasks wrote is in the index; what a failed attempt left is never
    read.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        part, out, at, name = TaskContext.get().partitionId(), None, 0, ""
        names = [c.split()[0] for c in INDEX.split(", ")]
        try:
            for batch in batches:
                index = []
                for page_id, url, payload, first in zip(*(c.to_pylist() for c in batch.columns)):
                    if out is None or at >= most:
                        if out is not None:
                            out.close()
                        name = f"part-{part:06d}-{uuid.uuid4().hex}.warc.gz"
                        out, at = store.open_output_stream(f"{root}/{name}", compression=None), 0
                    digest = digest_of(payload)
                    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                    record = make_record(page_id, url, payload, digest, first)
                    member = pack.compress(record) + pack.flush()
                    out.write(member)
                    kind = "response" if first is None else "revisit"
                    index.append((name, at, len(member), url, digest, page_id, kind))
                    at += len(member)
                columns = list(zip(*index)) or [()] * len(names)
                types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(columns, types)], names
                )
        finally:
            if out is not None:
                out.close()

    return cut_lineage(map_batches(rows, task, INDEX))


def joined_ranges(ranges: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(from, to, how many) reads for ascending (offset, length) ranges."""
    reads: list[list[int]] = []
    for offset, length in ranges:
        if (
            reads
            and offset - reads[-1][1] <= GAP_BYTES
            and offset + length - reads[-1][0] <= READ_BYTES
        ):
            reads[-1][1] = max(reads[-1][1], offset + length)
            reads[-1][2] += 1
        else:
            reads.append([offset, offset + length, 1])
    return [tuple(r) for r in reads]


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """``RECORD`` of every index row given, read by joined byte ranges."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        opened, source = None, None
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            at = 0
            while at < len(rows):
                name, end = rows[at][0], at
                while end < len(rows) and rows[end][0] == name:
                    end += 1
                if name != opened:
                    opened, source = name, store.open_input_file(f"{root}/{name}")
                ranges = [(r[1], r[2]) for r in rows[at:end]]
                done = 0
                for start, stop, count in joined_ranges(ranges):
                    source.seek(start)
                    data = source.read(stop - start)
                    found = []
                    for offset, length in ranges[done : done + count]:
                        member = data[offset - start : offset - start + length]
                        found.append(parse_record(zlib.decompress(member, 31)))
                    done += count
                    yield pa.RecordBatch.from_pylist(found, schema=_RECORD)
                at = end

    stretch = F.floor(F.col("offset") / STRETCH_BYTES)
    dealt = (
        index.select("archive", "offset", "length", stretch.alias("stretch"))
        .repartition("archive", "stretch")
        .sortWithinPartitions("archive", "offset")
    )
    return map_batches(dealt.drop("stretch"), task, RECORD)


_RECORD = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("record_type", pa.string()),
        ("refers_to", pa.int64()), ("payload", pa.binary()),
    ]
)


def archive_pages(pages: DataFrame, folder: str | None = None, at_least: int = 0) -> DataFrame:
    """Write every page, then read all records back.

    Null html is an empty payload. Of equal payloads the smallest page_id is the
    response (each of its rows, if repeated); pages without an id revisit it, or
    are responses where no page of the group has one. URLs may be null; blanks
    in them come back percent-encoded. An empty table gives no rows, other
    columns are ignored.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    index = write_archives(with_first(pages, at_least), folder)
    return read_records(index, folder)


def digests(pages: DataFrame) -> DataFrame:
    return archive_pages(pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
