"""WARC records in ZIP-packaged archives: writer and range reader.

An archive is a ZIP file of stored members: ``archive/data.warc.gz`` with the records, each a
gzip member of its own, and ``indexes/index.cdxj`` with one JSON line a record (offset and
length within the WARC member). The reader parses the end of central directory record, its ZIP64 form
where the 32-bit fields are full, the central directory and the members' local headers,
reads the index and range-reads each record. Nothing is extracted.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.llm.common import staged
from obslake.session import scratch_path, ship_package

WARC_MEMBER = "archive/data.warc.gz"
INDEX_MEMBER = "indexes/index.cdxj"
FULL32, FULL16 = 0xFFFFFFFF, 0xFFFF
#: Payload bytes after which a task closes an archive and starts the next.
ARCHIVE_BYTES = 64 << 20
#: A gap between two wanted records up to which they are read in one request.
READ_AHEAD = 8 << 20


def open_store(uri: str):
    """(filesystem, path) of a folder or file URI, for use inside tasks (local, s3, hdfs, gs, abfs)."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def warc_record(page_id, url, payload: bytes | None, digest: str, length: int, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit carries the HTTP headers but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if payload is not None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>",
        f"WARC-Target-URI: {' '.join((url or '').split())}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if payload is None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{'null' if refers_to is None else refers_to}>",
        ]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers (lower-case names) of a record, with its HTTP ``length`` and ``payload``."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[: int(headers["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x[16:]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length: "))
    return headers | {"length": length, "payload": payload}


class ZipWriter:
    """Stored members written in order; sizes and checksum follow in the central directory and a
    data descriptor. ``zip64`` forces the 64-bit forms that large archives need."""

    def __init__(self, out, zip64: bool = False):
        self.out, self.zip64, self.at, self.members = out, zip64, 0, []

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def start(self, name: str) -> None:
        self.members.append({"name": name.encode(), "header": self.at, "crc": 0, "size": 0})
        # Flag 8: sizes follow the data. The ZIP64 field in front makes the descriptor's sizes 8 bytes.
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self._write(
            struct.pack("<IHHHHHIIIHH", 0x04034B50, 45, 8, 0, 0, 0x21, 0, FULL32, FULL32, len(name.encode()), len(extra))
            + name.encode()
            + extra
        )

    def write(self, data: bytes) -> None:
        member = self.members[-1]
        member["crc"] = zlib.crc32(data, member["crc"])
        member["size"] += len(data)
        self._write(data)

    def end(self) -> None:
        member = self.members[-1]
        self._write(struct.pack("<IIQQ", 0x08074B50, member["crc"], member["size"], member["size"]))

    def close(self) -> None:
        start = self.at
        for m in self.members:
            wide = self.zip64 or m["size"] >= FULL32 or m["header"] >= FULL32
            extra = struct.pack("<HHQQQ", 1, 24, m["size"], m["size"], m["header"]) if wide else b""
            size, header = (FULL32, FULL32) if wide else (m["size"], m["header"])
            self._write(
                struct.pack(
                    "<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45, 8, 0, 0, 0x21, m["crc"], size, size,
                    len(m["name"]), len(extra), 0, 0, 0, 0, header,
                )
                + m["name"]
                + extra
            )
        length, count = self.at - start, len(self.members)
        if self.zip64 or start >= FULL32 or length >= FULL32 or count >= FULL16:
            record = self.at
            self._write(struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, count, count, length, start))
            self._write(struct.pack("<IIQI", 0x07064B50, 0, record, 1))
            count, length, start = FULL16, FULL32, FULL32
        self._write(struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, count, count, length, start, 0))


def zip_members(source) -> dict[str, tuple[int, int]]:
    """Stored members of a ZIP file as name: (offset of the data, size), by its directories alone.

    ``source`` is seekable. Parses the end record (behind a comment of any length), its ZIP64
    form, and every central entry with its ZIP64 field. A compressed or encrypted member, or
    a damaged directory, is an error.
    """
    end = source.size()
    tail_at = max(0, end - 65557)
    source.seek(tail_at)
    tail = source.read(end - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack("<HII", tail[at + 10 : at + 20])
    locator = tail_at + at - 20
    if FULL16 == count or FULL32 in (length, start):
        source.seek(locator)
        signature, _, record, _ = struct.unpack("<IIQI", source.read(20))
        if signature != 0x07064B50:
            raise ValueError("no ZIP64 locator")
        source.seek(record)
        wide = struct.unpack("<IQHHIIQQQQ", source.read(56))
        if wide[0] != 0x06064B50:
            raise ValueError("no ZIP64 end record")
        count, length, start = wide[7:10]
    source.seek(start)
    directory, at, members = source.read(length), 0, {}
    for _ in range(count):
        fields = struct.unpack("<IHHHHHHIIIHHHHHII", directory[at : at + 46])
        if fields[0] != 0x02014B50:
            raise ValueError("damaged central directory")
        flags, method, packed, size = fields[3], fields[4], fields[8], fields[9]
        names, extras, notes, header = fields[10], fields[11], fields[12], fields[16]
        name = directory[at + 46 : at + 46 + names].decode()
        extra = directory[at + 46 + names : at + 46 + names + extras]
        while len(extra) >= 4:
            kind, n = struct.unpack("<HH", extra[:4])
            if kind == 1:  # the 64-bit values stand in order, only for the fields that are full
                wide = iter(struct.unpack(f"<{n // 8}Q", extra[4 : 4 + n // 8 * 8]))
                size = next(wide) if size == FULL32 else size
                packed = next(wide) if packed == FULL32 else packed
                header = next(wide) if header == FULL32 else header
            extra = extra[4 + n :]
        if method != 0 or flags & 1 or packed != size:
            raise ValueError(f"{name} is not stored")
        source.seek(header)
        local = struct.unpack("<IHHHHHIIIHH", source.read(30))
        if local[0] != 0x04034B50:
            raise ValueError(f"no local header of {name}")
        members[name] = (header + 30 + local[9] + local[10], size)
        at += 46 + names + extras + notes
    return members


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) with payload, payload_digest, payload_bytes, response_id.

    Rows of equal payload (by SHA-1) of at least ``least_bytes`` bytes share the largest
    page_id as response_id; smaller ones are each their own. The maximum is combined map-side
    and joined back on the digest, so a payload that a third of all pages share is no hot task.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    keyed = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"_sha": F.unhex(F.sha1("payload")), "payload_bytes": F.octet_length("payload").cast("long")}
    )
    latest = (
        keyed.where(F.col("payload_bytes") >= least_bytes).groupBy("_sha").agg(F.max("page_id").alias("response_id"))
    )
    return keyed.join(latest, "_sha", "left").withColumn(
        "is_response",
        (F.col("payload_bytes") < least_bytes) | F.col("page_id").eqNullSafe(F.col("response_id")),
    )


def write_archives(pages: DataFrame, folder: str, zip64: bool = False, least_bytes: int = 0) -> DataFrame:
    """Writes one record per row of ``pages`` below ``folder``; returns (path, records, bytes) of the archives.

    Each task writes its own rows, closing an archive at ``ARCHIVE_BYTES``. Archives have
    unique names and become part of the result only through the returned table, so what a
    failed or repeated task leaves is never read. Null html: an empty payload.
    """
    ship_package(pages.sparkSession)

    def write(batches: Iterator) -> Iterator:
        import pandas as pd

        fs, root = open_store(folder)
        out = writer = None
        index, done, total = [], [], 0

        def close() -> None:
            writer.end()
            writer.start(INDEX_MEMBER)
            writer.write("".join(index).encode())
            writer.end()
            writer.close()
            out.close()
            done.append((path, len(index), writer.at))

        for batch in batches:
            rows = batch.to_pydict()
            for page_id, url, payload, sha, length, first, response_id in zip(
                *(rows[c] for c in ("page_id", "url", "payload", "_sha", "payload_bytes", "is_response", "response_id")),
                strict=True,
            ):
                if out is None:
                    path = f"{root}/{uuid.uuid4().hex}.wacz"
                    out, index, total = fs.open_output_stream(path), [], 0
                    writer = ZipWriter(out, zip64)
                    writer.start(WARC_MEMBER)
                digest = base64.b32encode(sha).decode()
                record = gzip.compress(
                    warc_record(page_id, url, payload if first else None, digest, length, response_id), 3, mtime=0
                )
                index.append(json.dumps({"id": page_id, "offset": total, "length": len(record)}) + "\n")
                writer.write(record)
                total += len(record)
                if total >= ARCHIVE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        import pyarrow as pa

        yield pa.RecordBatch.from_pandas(
            pd.DataFrame(done, columns=["path", "records", "bytes"]).astype({"records": "int64", "bytes": "int64"}),
            schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]),
            preserve_index=False,
        )

    fs, root = open_store(folder)
    fs.create_dir(root, recursive=True)
    return staged(with_revisits(pages, least_bytes).mapInArrow(write, "path string, records long, bytes long"), "archives")


def read_records(archives: DataFrame, folder: str) -> DataFrame:
    """Every record of the listed archives: page_id, url, record_type, refers_to (of a revisit),
    payload (null for a revisit), payload_bytes and payload_digest. A response's digest is
    computed from the payload that was read and must equal the record's header.

    One task per archive; records are range-read by the index, neighbours in one request.
    """
    spark = archives.sparkSession
    ship_package(spark)

    def identity(value: str):
        value = value.removeprefix("<urn:page:").removesuffix(">")
        return None if value == "null" else int(value)

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        schema = pa.schema(
            [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
             ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
        )
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, _ = open_store(folder)
                with fs.open_input_file(path) as source:
                    members = zip_members(source)
                    at, size = members[INDEX_MEMBER]
                    source.seek(at)
                    index = [json.loads(x) for x in source.read(size).splitlines()]
                    data_at, _ = members[WARC_MEMBER]
                    for run in _runs(index):
                        source.seek(data_at + run[0]["offset"])
                        data = source.read(run[-1]["offset"] + run[-1]["length"] - run[0]["offset"])
                        rows = []
                        for entry in run:
                            start = entry["offset"] - run[0]["offset"]
                            record = parse_record(gzip.decompress(data[start : start + entry["length"]]))
                            digest = record["warc-payload-digest"].removeprefix("sha1:")
                            response = record["warc-type"] == "response"
                            if response and (payload_digest(record["payload"]), len(record["payload"])) != (digest, record["length"]):
                                raise ValueError(f"damaged record {entry} in {path}")
                            rows.append(
                                {
                                    "page_id": identity(record["warc-record-id"]),
                                    "url": record["warc-target-uri"],
                                    "record_type": record["warc-type"],
                                    "refers_to": None if response else identity(record["warc-refers-to"]),
                                    "payload": record["payload"] if response else None,
                                    "payload_bytes": record["length"],
                                    "payload_digest": digest,
                                }
                            )
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = (
        "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, "
        "payload_digest string"
    )
    # Dealt out by path: the archives are listed in few rows, but each is a task's worth of reading.
    spread = archives.repartition(max(1, spark.sparkContext.defaultParallelism * 4), "path")
    return spread.mapInArrow(read, schema)


def _runs(index: list[dict]) -> Iterator[list[dict]]:
    """Neighbouring index entries, up to READ_AHEAD bytes each time."""
    run, size = [], 0
    for entry in index:
        if run and (size + entry["length"] > READ_AHEAD or entry["offset"] != run[-1]["offset"] + run[-1]["length"]):
            yield run
            run, size = [], 0
        run.append(entry)
        size += entry["length"]
    if run:
        yield run


def archive_folder(spark: SparkSession) -> str:
    """A fresh folder for archives below the shared folder."""
    return scratch_path(spark, "llm-warc")
