"""WARC archives: writing them, and making monolithic gzip files readable record by record.

A file compressed as one stream can only be read from its start. The normaliser
inflates it once, rewrites every record as a gzip member of its own and writes
an index of the members' offsets beside it. Files are reached through
``pyarrow.fs``, so that any shared store it knows will do; each task works
through its files in pieces of bounded size.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import mapped, small, stored
from tributary.scratch import scratch_path

GZIP = 31  # zlib's window bits for a gzip wrapper
PIECE = 1 << 20
HEADER_LIMIT = 1 << 20
MOST_TASKS = 10_000
CONTROL = re.compile(r"[\x00-\x20\x7f]")


@dataclass(frozen=True)
class ArchiveSettings:
    """A task starts a new archive after ``archive_bytes`` of records."""

    archive_bytes: int = 64 << 20
    whole_level: int = 1
    member_level: int = 6
    date: str = "1970-01-01T00:00:00Z"


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """A response record with its payload, or a revisit record without."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {url}")
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:uuid:{name}>",
        "WARC-Date": date,
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
        "Content-Length": str(len(block)),
        "X-Payload-Length": str(len(payload)),
    }
    if url is not None:
        fields["WARC-Target-URI"] = CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url)
    if page_id is not None:
        fields["X-Page-ID"] = str(page_id)
    if revisit:
        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        fields["X-Refers-To-Page-ID"] = str(refers_to)
    head = "".join(f"{key}: {value}\r\n" for key, value in fields.items())
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def write_batches(batches: Iterator[pa.RecordBatch], folder: str, settings: ArchiveSettings) -> Iterator[pa.RecordBatch]:
    """page_id, url, payload, refers_to, revisit -> path and records of each archive, one gzip stream each.

    Names are new for every attempt; only those a finished task returns count.
    """
    store, root = _opened(folder)
    store.create_dir(root, recursive=True)
    stream = packer = path = None
    written = records = 0

    def close() -> pa.RecordBatch:
        stream.write(packer.flush())
        stream.close()
        columns = [pa.array([f"{folder}/{path}"]), pa.array([records], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["path", "records"])

    for batch in batches:
        for page_id, url, payload, refers_to, revisit in zip(*batch.columns, strict=True):
            if stream is None:
                path = f"whole-{uuid.uuid4().hex}.warc.gz"
                stream = store.open_output_stream(f"{root}/{path}", compression=None)
                packer = zlib.compressobj(settings.whole_level, zlib.DEFLATED, GZIP)
                written = records = 0
            data = record(page_id.as_py(), url.as_py(), payload.as_py() or b"", refers_to.as_py(), revisit.as_py(), settings.date)
            stream.write(packer.compress(data))
            written, records = written + len(data), records + 1
            if written >= settings.archive_bytes:
                yield close()
                stream = None
    if stream is not None:
        yield close()


class _Inflated:
    """The bytes of a gzip file of one or more members, inflated piece by piece."""

    def __init__(self, source):
        self.source, self.inflater = source, zlib.decompressobj(GZIP)
        self.ready, self.pending, self.ended = bytearray(), b"", False

    def fill(self, size: int) -> bool:
        """Have ``size`` bytes ready, or as many as there are; whether they are."""
        while len(self.ready) < size and not self.ended:
            if not self.pending:
                self.pending = self.source.read(PIECE)
                if not self.pending:
                    if not self.inflater.eof:
                        raise ValueError("the gzip stream is cut off")
                    self.ended = True
                    break
            if self.inflater.eof:
                self.inflater = zlib.decompressobj(GZIP)
            self.ready += self.inflater.decompress(self.pending, PIECE)
            self.pending = self.inflater.unconsumed_tail or self.inflater.unused_data
        return len(self.ready) >= size

    def take(self, size: int) -> bytes:
        self.fill(size)
        out = bytes(self.ready[:size])
        del self.ready[:size]
        return out

    def head(self) -> bytes | None:
        """The next record's header with its empty line, or None at the end."""
        size = 1024
        while True:
            more = self.fill(size)
            end = self.ready.find(b"\r\n\r\n")
            if end >= 0:
                return self.take(end + 4)
            if not more:
                if self.ready.strip():
                    raise ValueError("a record's header is cut off")
                return None
            if size > HEADER_LIMIT:
                raise ValueError("a record's header is too long")
            size *= 2


def fields_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {key.strip().lower(): value.strip() for key, _, value in (line.partition(":") for line in lines[1:] if line)}


def normalise(source, target, level: int) -> Iterator[dict]:
    """Rewrite every record of ``source`` as its own member of ``target``; yields their places."""
    inflated = _Inflated(source)
    while (head := inflated.head()) is not None:
        fields, start = fields_of(head), target.tell()
        packer = zlib.compressobj(level, zlib.DEFLATED, GZIP)
        target.write(packer.compress(head))
        left = int(fields["content-length"]) + 4
        while left:
            piece = inflated.take(min(left, PIECE))
            if not piece:
                raise ValueError("a record's block is cut off")
            left -= len(piece)
            target.write(packer.compress(piece))
        target.write(packer.flush())
        yield {
            "offset": start,
            "length": target.tell() - start,
            "type": fields.get("warc-type"),
            "id": fields.get("warc-record-id"),
            "uri": fields.get("warc-target-uri"),
            "digest": fields.get("warc-payload-digest"),
        }


def normalise_batches(batches: Iterator[pa.RecordBatch], folder: str, level: int) -> Iterator[pa.RecordBatch]:
    """path, records -> path and index of the rewritten archives."""
    store, root = _opened(folder)
    store.create_dir(root, recursive=True)
    for batch in batches:
        for path, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            name = f"members-{uuid.uuid4().hex}"
            whole, place = _opened(path)
            found = 0
            with (
                whole.open_input_stream(place, compression=None) as source,
                store.open_output_stream(f"{root}/{name}.warc.gz", compression=None) as target,
                store.open_output_stream(f"{root}/{name}.idx") as index,
            ):
                for entry in normalise(source, target, level):
                    index.write(json.dumps(entry).encode() + b"\n")
                    found += 1
            if records is not None and found != records:
                raise ValueError(f"{path}: {found} records instead of {records}")
            out = [pa.array([f"{folder}/{name}{end}"]) for end in (".warc.gz", ".idx")]
            yield pa.RecordBatch.from_arrays([*out, pa.array([found], pa.int64())], names=["path", "index", "records"])


def read_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """The fields and the block of a record from its member."""
    plain = zlib.decompress(data, GZIP)
    end = plain.index(b"\r\n\r\n") + 4
    fields = fields_of(plain[:end])
    return fields, plain[end : end + int(fields["content-length"])]


PAGES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """path, index, records -> what each record says of its page. Payloads are checked against their digests."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    for batch in batches:
        for path, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            store, place = _opened(path)
            _, index_place = _opened(index)
            with store.open_input_file(place) as archive, store.open_input_stream(index_place, compression=None) as source:
                rows = []
                for line in source.read().splitlines():
                    entry = json.loads(line)
                    archive.seek(entry["offset"])
                    fields, block = read_record(archive.read(entry["length"]))
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    if fields["warc-type"] == "response":
                        payload = block[block.index(b"\r\n\r\n") + 4 :]
                        if payload_digest(payload) != digest or len(payload) != int(fields["x-payload-length"]):
                            raise ValueError(f"{path}: the payload at {entry['offset']} is damaged")
                    rows.append(
                        (
                            int(fields["x-page-id"]) if "x-page-id" in fields else None,
                            int(fields["x-payload-length"]),
                            digest,
                            fields["warc-type"],
                            int(fields["x-refers-to-page-id"]) if "x-refers-to-page-id" in fields else None,
                            fields.get("warc-target-uri"),
                        )
                    )
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=[part.split()[0] for part in PAGES.split(", ")])


def planned_records(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """page_id, url, payload, refers_to and revisit of the record each page gets.

    Of equal payloads the page with the largest id is the response.
    """
    payload = F.coalesce(F.col(html_column).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    latest = rows.groupBy("digest").agg(F.max("page_id").alias("latest"), F.count(F.lit(1)).alias("n"))
    latest = small(stored(latest.where("n > 1").select("digest", "latest"), "latest"))
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("latest")) & F.col("latest").isNotNull(), F.lit(False))
    return (
        rows.join(latest, "digest", "left")
        .withColumn("revisit", revisit)
        .select("page_id", "url", "payload", F.when(F.col("revisit"), F.col("latest")).alias("refers_to"), "revisit")
    )


def write_archives(pages: DataFrame, settings: ArchiveSettings = ArchiveSettings(), **columns: str) -> DataFrame:
    """Write a record for each row of ``pages`` into archives compressed as one stream; returns path and records.

    A null payload is empty; of a null url no address is written. Rows of one id
    with the same payload are all responses if that id is the largest. A
    null id is smaller than any other. An empty table gives no archive.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    return stored(mapped(planned_records(pages, **columns), write_batches, "path string, records long", folder, settings), "archives")


def _dealt(archives: DataFrame) -> DataFrame:
    """The archives one to a task, as adaptive execution would put many short paths together; of very many, several to a task."""
    return archives.repartitionByRange(max(1, min(archives.count(), MOST_TASKS)), "path")


def normalise_archives(archives: DataFrame, settings: ArchiveSettings = ArchiveSettings()) -> DataFrame:
    """Rewrite each archive with a member for each record and an index beside it; returns path, index and records.

    ``records``, where not null, is how many an archive has to hold. A file of several members or
    of none at all is read, too; one that is cut off fails.
    """
    folder = scratch_path(archives.sparkSession, "warc")
    files = _dealt(archives.select("path", "records"))
    return stored(mapped(files, normalise_batches, "path string, index string, records long", folder, settings.member_level), "members")


def read_pages(members: DataFrame) -> DataFrame:
    """One row for each record of normalised archives, read by their indexes."""
    return mapped(_dealt(members.select("path", "index", "records")), read_batches, PAGES)
