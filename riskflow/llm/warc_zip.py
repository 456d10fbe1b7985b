"""WARC records in ZIP packages: writer, and a reader that needs no extraction.

A package is a ZIP file of stored (uncompressed) members: ``archive/data.warc.gz``
holds one gzip member per record, ``indexes/index.cdxj`` one line per record with
its offset and length inside the archive member. The reader takes the end of a
package, parses the central directory (with its ZIP64 records and extra
fields), locates the stored members, range-reads the index and then only the
byte ranges of the records.

Packages are written by tasks to a folder that all executors share, under names
no other attempt uses; the rows that list them are committed by Spark, so
packages of lost or repeated attempts are never read.

Defined cases: a null or empty html is a record with an empty payload; rows with
the same page_id are records of their own, and all rows that have the smallest
page_id of their payload are responses; a null page_id counts as larger than
any other; a null url is left out of the record; an empty table gives an empty
result; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import io
import json
import struct
import urllib.parse
import uuid
import zipfile
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import ready_for_python
from riskflow.session import materialize, scratch_path

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PACKAGE_BYTES = 64 << 20  # a new package begins beyond this many archive bytes
BLOCK_BYTES = 4 << 20  # records that one range read takes together
MIN_REVISIT_BYTES = 100

# ---- ZIP reading -------------------------------------------------------------------------------

# Fixed values of the ZIP format: signatures and layouts.
_EOCD, _LOCATOR64, _EOCD64 = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06"
_CENTRAL, _LOCAL = b"PK\x01\x02", b"PK\x03\x04"


class ZipFormatError(ValueError):
    """The bytes are no ZIP package that this reader can use."""


def read_range(source, offset: int, length: int) -> bytes:
    source.seek(offset)
    data = source.read(length)
    if len(data) != length:
        raise ZipFormatError(f"{length} bytes asked at {offset}, {len(data)} there")
    return data


def _zip64_fields(extra: bytes, wanted: int) -> list[int]:
    """The 8-byte numbers of the ZIP64 extra field (header id 1)."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            return [struct.unpack_from("<Q", extra, at + 4 + 8 * i)[0] for i in range(min(wanted, size // 8))]
        at += 4 + size
    raise ZipFormatError("a ZIP64 entry without its extra field")


def directory(source, size: int) -> dict[str, tuple[int, int, int]]:
    """Members of a package: name -> (method, offset of the local header, stored size)."""
    tail_at = max(0, size - 65557)  # the end record and the longest comment
    tail = read_range(source, tail_at, size - tail_at)
    end = tail.rfind(_EOCD)
    while end >= 0 and (len(tail) - end < 22 or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(_EOCD, 0, end)
    if end < 0:
        raise ZipFormatError("no end of central directory")
    count, cd_size, cd_at = struct.unpack_from("<HII", tail, end + 10)
    locator = tail_at + end - 20
    if locator >= 0 and (found := read_range(source, locator, 20)).startswith(_LOCATOR64):
        record = read_range(source, struct.unpack_from("<Q", found, 8)[0], 56)
        if not record.startswith(_EOCD64):
            raise ZipFormatError("the ZIP64 locator points nowhere")
        count, cd_size, cd_at = struct.unpack_from("<QQQ", record, 32)
    cd, at, members = read_range(source, cd_at, cd_size), 0, {}
    for _ in range(count):
        if cd[at:at + 4] != _CENTRAL:
            raise ZipFormatError("broken central directory")
        method, = struct.unpack_from("<H", cd, at + 10)
        packed, full, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", cd, at + 20)
        header, = struct.unpack_from("<I", cd, at + 42)
        name = cd[at + 46:at + 46 + n_name].decode("utf-8")
        wide = [v == 0xFFFFFFFF for v in (full, packed, header)]
        if any(wide):
            extra = cd[at + 46 + n_name:at + 46 + n_name + n_extra]
            values = iter(_zip64_fields(extra, sum(wide)))
            full, packed, header = (next(values) if w else v for w, v in zip(wide, (full, packed, header), strict=True))
        members[name] = (method, header, packed)
        at += 46 + n_name + n_extra + n_comment
    return members


def stored_member(source, members: dict, name: str) -> tuple[int, int]:
    """Offset and length of a stored member's bytes inside the package."""
    if name not in members:
        raise ZipFormatError(f"no member {name}")
    method, header, size = members[name]
    if method != 0:
        raise ZipFormatError(f"{name} is compressed: it can't be range-read")
    local = read_range(source, header, 30)
    if not local.startswith(_LOCAL):
        raise ZipFormatError(f"no local header for {name}")
    n_name, n_extra = struct.unpack_from("<HH", local, 26)
    return header + 30 + n_name + n_extra, size


# ---- WARC records ------------------------------------------------------------------------------


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to, record_type: str) -> bytes:
    """One WARC/1.1 record; a revisit carries the response's header block without its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if record_type == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>"]
    if url is not None:
        head.append("WARC-Target-URI: " + urllib.parse.quote(url, safe="%/:=&?~#+!$,;'@()*[]"))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if record_type == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    pairs = (line.partition(": ") for line in head.decode("utf-8").split("\r\n")[1:])
    return {k: v for k, _, v in pairs}, rest


def _page(urn: str | None) -> int | None:
    value = (urn or "")[len("<urn:page:"):-1]
    return int(value) if value else None


def parse_record(data: bytes) -> dict:
    """Fields of a record; the payload digest of a response is computed from its bytes."""
    head, rest = _headers(data)
    block = rest[:int(head["Content-Length"])]
    http, payload = _headers(block)
    kind, said = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and hashlib.sha256(payload).hexdigest() != said:
        raise ZipFormatError(f"payload digest of {head['WARC-Record-ID']} differs")
    return {"page_id": _page(head["WARC-Record-ID"]), "payload_bytes": int(http["Content-Length"]),
            "payload_digest": said, "record_type": kind, "refers_to": _page(head.get("WARC-Refers-To")),
            "url": head.get("WARC-Target-URI"), "payload": payload if kind == "response" else None}


# ---- packages ----------------------------------------------------------------------------------


class PackageWriter:
    """Writes one package to a stream: records as they come, then the index, then the directory."""

    def __init__(self, sink):
        self._sink = sink
        self._zip = zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED)
        self._member = self._zip.open(ARCHIVE, "w", force_zip64=True)
        self._lines: list[str] = []
        self.size = 0

    def add(self, page_id, record: bytes) -> None:
        packer = zlib.compressobj(1, zlib.DEFLATED, 31)
        data = packer.compress(record) + packer.flush()
        self._member.write(data)
        self._lines.append(json.dumps({"page": page_id, "offset": self.size, "length": len(data)}))
        self.size += len(data)

    def close(self) -> int:
        self._member.close()
        self._zip.writestr(INDEX, "\n".join(self._lines))
        self._zip.close()
        records = len(self._lines)
        self._sink.close()
        return records


def open_folder(uri: str):
    """The file system of a URI (or plain path) and the path inside it."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _file_uri(root: str) -> str:
    return "file://" + root.removeprefix("file:") if root.startswith("file:/") and not root.startswith("file://") else root


def write_packages(records: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write (page_id, url, html, payload_digest, refers_to, record_type) rows; returns the committed package list."""
    ready_for_python(records.sparkSession)
    folder = _file_uri(folder)

    def run(batches):
        store, root = open_folder(folder)
        store.create_dir(root, recursive=True)
        writer, path = None, None
        for batch in batches:
            done = []
            for page_id, url, html, digest, refers_to, kind in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if writer is None:
                    path = f"{root}/{uuid.uuid4().hex}.wacz"
                    writer = PackageWriter(store.open_output_stream(path))
                writer.add(page_id, record_bytes(page_id, url, (html or "").encode(), digest, refers_to, kind))
                if writer.size >= package_bytes:
                    done.append((path, writer.close()))
                    writer = None
            if done:
                yield pa.RecordBatch.from_pylist([{"path": p, "records": n} for p, n in done])
        if writer is not None:
            yield pa.RecordBatch.from_pylist([{"path": path, "records": writer.close()}])

    return materialize(records.mapInArrow(run, "path string, records long"), "warc-packages")


def locate_records(packages: DataFrame, folder: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """path, start and lengths of runs of records, from the packages' directories and indexes."""
    folder = _file_uri(folder)

    def run(batches):
        store, _ = open_folder(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with store.open_input_file(path) as source:
                    members = directory(source, source.size())
                    base, _ = stored_member(source, members, ARCHIVE)
                    index_at, index_size = stored_member(source, members, INDEX)
                    index = read_range(source, index_at, index_size).decode()
                blocks, start, lengths = [], None, []
                for entry in map(json.loads, index.splitlines()):
                    at = base + entry["offset"]
                    if lengths and (at != start + sum(lengths) or sum(lengths) >= block_bytes):
                        blocks.append((start, lengths))
                        lengths = []
                    start = start if lengths else at
                    lengths.append(entry["length"])
                if lengths:
                    blocks.append((start, lengths))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(blocks)), pa.array([b[0] for b in blocks], pa.int64()),
                     pa.array([b[1] for b in blocks], pa.list_(pa.int64()))], names=["path", "start", "lengths"])

    return packages.select("path").mapInArrow(run, "path string, start long, lengths array<long>")


RECORD_SCHEMA = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
                 "refers_to long, url string")


def read_records(blocks: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """Range-read the located records; ``with_payload`` adds the payload bytes (null for revisits)."""
    folder = _file_uri(folder)
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())]
                       + [("payload", pa.binary())] * with_payload)

    def run(batches):
        store, _ = open_folder(folder)
        for batch in batches:
            for path, start, lengths in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with store.open_input_file(path) as source:
                    data = io.BytesIO(read_range(source, start, sum(lengths)))
                rows = [parse_record(zlib.decompress(data.read(n), 31)) for n in lengths]
                yield pa.RecordBatch.from_pylist([{k: r[k] for k in schema.names} for r in rows], schema=schema)

    return blocks.mapInArrow(run, RECORD_SCHEMA + ", payload binary" * with_payload)


def classify(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Record fields of every page: the smallest page_id of equal payloads is the response.

    The payload groups are pre-aggregated and written; the join back has plain
    scans on both sides, so Spark splits the rows of one very common payload.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"),
                        F.sha2(html.cast("binary"), 256).alias("payload_digest"))
    large = F.octet_length("html") >= min_bytes
    shared = materialize(rows.where(large).groupBy(F.col("payload_digest").alias("digest"))
                         .agg(F.min("page_id").alias("first_page"), F.count("*").alias("n")).where("n > 1")
                         .drop("n"), "warc-shared-payloads")
    first = F.col("first_page")
    revisit = F.col("digest").isNotNull() & ~F.col("page_id").eqNullSafe(first)
    return rows.join(shared, F.col("payload_digest") == F.col("digest"), "left").select(
        "page_id", "url", "html", "payload_digest", F.when(revisit, first).alias("refers_to"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"))


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write one record per page into packages and return what a reader finds in them."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    records = classify(pages)
    packages = write_packages(records, folder)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = locate_records(packages.repartition(parts), folder).repartition(parts)
    return read_records(blocks, folder)
