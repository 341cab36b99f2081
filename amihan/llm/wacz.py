"""Web archives packed in ZIP files: written per page, read back without extraction.

A task writes its pages into ZIP files with stored (uncompressed) members: the
WARC file, each record a gzip member of its own, and an index of the records'
places.  Reading parses the end of central directory, the ZIP64 directory if
there is one and the central directory, locates the archive member and the
index in the file, and then reads single records by range.

Files get a new name for each attempt of a task; only those named in the
manifest, a written table, count, so lost executors and repeated tasks leave
nothing in the result.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any, BinaryIO

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amihan.llm.common import map_arrow, stored
from amihan.session import run_folder

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Payload bytes after which a task starts another file.
ROLL_BYTES = 256 << 20
#: Payloads below this are never referred to.
LEAST_REVISIT = 100
#: Records that one read task takes from a file at once.
READ_RECORDS = 2000
#: Signatures and sizes of the ZIP format.
END_SIZE, END_SIGNATURE = 22, b"PK\x05\x06"
LOCATOR_SIZE, LOCATOR_SIGNATURE, END64_SIGNATURE = 20, b"PK\x06\x07", b"PK\x06\x06"
ENTRY_SIZE, ENTRY_SIGNATURE = 46, b"PK\x01\x02"
LOCAL_SIZE, LOCAL_SIGNATURE = 30, b"PK\x03\x04"
MAX16, MAX32 = 0xFFFF, 0xFFFFFFFF


class Damaged(ValueError):
    """The bytes are no archive of this kind."""


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    begin: int
    size: int


def filesystem(folder: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a shared folder, and the path in it."""
    return pa.fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pa.fs.LocalFileSystem(), folder)


def read_at(source: BinaryIO, begin: int, size: int) -> bytes:
    source.seek(begin)
    data = source.read(size)
    if len(data) != size:
        raise Damaged(f"{size} bytes wanted at {begin}, {len(data)} there")
    return data


def members(source: BinaryIO, size: int) -> dict[str, Member]:
    """The members of a ZIP file by its central directory, each with the place of its bytes."""
    tail_size = min(size, END_SIZE + LOCATOR_SIZE + MAX16)
    tail = read_at(source, size - tail_size, tail_size)
    at = tail.rfind(END_SIGNATURE)
    while at >= 0 and (at + END_SIZE > len(tail) or at + END_SIZE + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(END_SIGNATURE, 0, at)
    if at < 0:
        raise Damaged("no end of central directory")
    count, length, begin = struct.unpack_from("<HII", tail, at + 10)
    located = at - LOCATOR_SIZE
    if located >= 0 and tail[located : located + 4] == LOCATOR_SIGNATURE and (MAX16 == count or MAX32 in (length, begin)):
        end64 = read_at(source, struct.unpack_from("<Q", tail, located + 8)[0], 56)
        if end64[:4] != END64_SIGNATURE:
            raise Damaged("no ZIP64 end of central directory")
        count, length, begin = struct.unpack_from("<QQQ", end64, 32)
    directory = read_at(source, begin, length)
    found: dict[str, Member] = {}
    at = 0
    for _ in range(count):
        if directory[at : at + 4] != ENTRY_SIGNATURE:
            raise Damaged("no entry of the central directory")
        method = struct.unpack_from("<H", directory, at + 10)[0]
        packed, plain, name_size, extra_size, comment_size = struct.unpack_from("<IIHHH", directory, at + 20)
        local = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + ENTRY_SIZE : at + ENTRY_SIZE + name_size].decode("utf-8", "replace")
        extra = directory[at + ENTRY_SIZE + name_size : at + ENTRY_SIZE + name_size + extra_size]
        packed, local = _wide(extra, plain, packed, local)
        head = read_at(source, local, LOCAL_SIZE)
        if head[:4] != LOCAL_SIGNATURE:
            raise Damaged("no local header")
        found[name] = Member(name, method, local + LOCAL_SIZE + sum(struct.unpack_from("<HH", head, 26)), packed)
        at += ENTRY_SIZE + name_size + extra_size + comment_size
    return found


def _wide(extra: bytes, plain: int, packed: int, local: int) -> tuple[int, int]:
    """Packed size and place; what the entry gives only as a mark stands in its ZIP64 field, in a fixed order."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            wide = iter(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
            try:
                if plain == MAX32:
                    next(wide)
                packed = next(wide) if packed == MAX32 else packed
                local = next(wide) if local == MAX32 else local
            except StopIteration:
                raise Damaged("short ZIP64 field") from None
        at += 4 + size
    return packed, local


def warc_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A response with its payload, or a revisit that names the record holding it; one gzip member."""
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {name(page_id)}",
        f"WARC-Target-URI: {(url or '').replace(chr(13), '%0D').replace(chr(10), '%0A')}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if revisit:
        lines += [f"WARC-Refers-To: {name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + packer.flush()


def parse_record(packed: bytes) -> dict[str, Any]:
    data = zlib.decompress(packed, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise Damaged("no WARC record")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
    number = lambda v: int(v) if (v := v.removeprefix("<urn:page:").removesuffix(">")) else None
    sizes = [int(line.split(b":")[1]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    revisit = fields["warc-type"] == "revisit"
    if not revisit and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != sizes[0]):
        raise Damaged(f"payload of {fields['warc-record-id']}")
    return {
        "page_id": number(fields["warc-record-id"]),
        "url": fields["warc-target-uri"],
        "payload": None if revisit else payload,
        "payload_bytes": sizes[0],
        "payload_digest": digest,
        "record_type": fields["warc-type"],
        "refers_to": number(fields["warc-refers-to"]) if revisit else None,
    }


class ArchiveWriter:
    """One ZIP file being written, front to back."""

    def __init__(self, store: pa.fs.FileSystem, path: str) -> None:
        self.path = path
        self.out = store.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(ARCHIVE, "w", force_zip64=True)
        self.at = self.payload = 0
        self.index: list[tuple[int, int, int | None]] = []

    def add(self, record: bytes, page_id: int | None, payload_size: int) -> None:
        self.member.write(record)
        self.index.append((self.at, len(record), page_id))
        self.at += len(record)
        self.payload += payload_size + 512

    def close(self) -> int:
        self.member.close()
        with self.zip.open(INDEX, "w", force_zip64=True) as index:
            for begin, size, page_id in self.index:
                index.write((json.dumps({"offset": begin, "length": size, "page_id": page_id}) + "\n").encode())
        self.zip.close()
        self.out.close()
        return len(self.index)


def mark_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Each page with its payload's digest, and whether it revisits the page of the smallest id with that payload."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        (F.col(url_col).cast("string") if url_col in pages.columns else F.lit(None).cast("string")).alias("url"),
        html.alias("html"),
        F.sha2(html.cast("binary"), 256).alias("digest"),
        (F.octet_length(html) >= LEAST_REVISIT).alias("large"),
    )
    shared = (
        rows.where("large").groupBy(F.col("digest").alias("of")).agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    )
    joined = rows.join(shared, rows["large"] & (rows["digest"] == shared["of"]), "left")
    revisit = F.col("first").isNotNull() & F.coalesce(F.col("page_id") != F.col("first"), F.lit(True))
    return joined.select("page_id", "url", "html", "digest", revisit.alias("revisit"), F.when(revisit, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write every page as a record; the manifest (path, size, records) of the files, as a stored table.

    A null html is an empty payload, a null id an empty name.  Pages that
    repeat the smallest id of a payload are all responses.  An empty table
    gives an empty manifest.  Other columns take no part.
    """
    schema = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        writer: ArchiveWriter | None = None
        done: list[tuple[str, int, int]] = []

        def finish(w: ArchiveWriter) -> None:
            records = w.close()
            done.append((w.path, store.get_file_info(w.path).size, records))

        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "html", "digest", "revisit", "refers_to"))):
                page_id, url, html, digest, revisit, refers_to = (x.as_py() for x in row)
                if writer is None:
                    store.create_dir(root)
                    writer = ArchiveWriter(store, f"{root}/{uuid.uuid4().hex}.wacz")
                payload = html.encode()
                writer.add(warc_record(page_id, url, payload, digest, refers_to, revisit), page_id, len(payload))
                if writer.payload >= ROLL_BYTES:
                    finish(writer)
                    writer = None
        if writer is not None:
            finish(writer)
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], f.type) for i, f in enumerate(schema)], schema=schema)

    marked = mark_revisits(pages, id_col, url_col, html_col)
    return stored(map_arrow(marked, run, "path string, bytes bigint, records bigint"), "wacz-manifest")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to) of every record in the files.

    Digests of responses are checked against their payloads.
    """
    places = pa.schema([("path", pa.string()), ("begins", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64()))])

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(folder)
        for batch in batches:
            for path, size in zip(batch.column("path").to_pylist(), batch.column("bytes").to_pylist()):
                with store.open_input_file(path) as source:
                    found = members(source, size)
                    archive, index = found[ARCHIVE], found[INDEX]
                    if archive.method or index.method:
                        raise Damaged(f"{path}: a member is compressed")
                    lines = [json.loads(x) for x in read_at(source, index.begin, index.size).splitlines()]
                for at in range(0, len(lines), READ_RECORDS):
                    some = lines[at : at + READ_RECORDS]
                    columns = [[path], [[archive.begin + x["offset"] for x in some]], [[x["length"] for x in some]]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, places)], schema=places)

    records = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(folder)
        for batch in batches:
            for path, begins, sizes in zip(*(batch.column(c).to_pylist() for c in places.names)):
                with store.open_input_file(path) as source:
                    rows, held = [], 0
                    for begin, size in zip(begins, sizes):
                        rows.append(parse_record(read_at(source, begin, size)))
                        held += rows[-1]["payload_bytes"]
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=records)
                            rows, held = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema=records)

    spark = manifest.sparkSession
    files = manifest.select("path", "bytes").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")
    located = map_arrow(files, locate, "path string, begins array<bigint>, sizes array<bigint>")
    dealt = located.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return map_arrow(
        dealt,
        read,
        "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    )


def archive_folder(df: DataFrame) -> str:
    """A new folder for archives below the shared folder."""
    return run_folder(df.sparkSession, "wacz")
