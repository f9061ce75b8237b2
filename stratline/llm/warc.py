"""WARC archives as a Spark data source, and deduplicating page archives.

`spark.dataSource.register(WarcSource)`, then `spark.read.format("warc").load(folder)` and
`df.write.format("warc").save(folder)`.

Writing: every task writes gzip archives of bounded size, one member for each record with
its compressed length in the member's header; the names are unique to the attempt, and the
job's list of archives is written when all tasks have ended, so files of lost attempts are
never read; a job in append mode adds its list to those that are there. Reading: archives are packed into partitions by size. Equality and list
filters on the record type and on header columns are pushed down: a record's headers are
inflated first, and a record that does not pass is skipped by its length without inflating
its payload. With option payload=false no payload is inflated at all.

Record columns: record_type, record_id, target_uri, page_id, refers_to, payload_digest,
payload_bytes (of the full payload, also where only a revisit was stored), payload (null
for revisits). Null page ids and URIs give records without that header. An empty folder
reads as no rows.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    Filter,
    In,
    InputPartition,
    WriterCommitMessage,
)

from pyarrow import fs

from stratline.llm import files
from stratline.sources import sinks

SCHEMA = (
    "record_type string, record_id string, target_uri string, page_id bigint, refers_to bigint, "
    "payload_digest string, payload_bytes bigint, payload binary"
)
HEADERS = {  # column: header, in the order they are written
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "page_id": "WARC-Page-ID",
    "refers_to": "WARC-Refers-To-Page-ID",
    "payload_digest": "WARC-Payload-Digest",
}
COLUMNS = [*HEADERS, "payload_bytes", "payload"]
NUMBERS = {"page_id", "refers_to", "payload_bytes"}
PUSHED = {*HEADERS} - {"payload_digest"}
LIST = "_archives"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MEMBER = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff"  # gzip with an extra field
EXTRA = struct.Struct("<H2sHII")  # its size, "sl", 8, length of the member, of its content


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(content: bytes, level: int) -> bytes:
    """A gzip member that tells its own length."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = packer.compress(content) + packer.flush()
    size = len(MEMBER) + EXTRA.size + len(body) + 8
    tail = struct.pack("<II", zlib.crc32(content), len(content) & 0xFFFFFFFF)
    return MEMBER + EXTRA.pack(EXTRA.size - 2, b"sl", 8, size, len(content) & 0xFFFFFFFF) + body + tail


def clean(value: object) -> str:
    """A header value holds no line break."""
    return " ".join(str(value).splitlines())


def record(row) -> bytes:
    """A response with its payload, or a revisit with the HTTP header of the payload only."""
    payload = bytes(row.payload) if row.payload is not None else b""
    size = len(payload) if row.payload_bytes is None else row.payload_bytes
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = row.record_type == "revisit"
    block = http if revisit else http + payload
    lines = ["WARC/1.1"]
    for name, header in HEADERS.items():
        value = row[name]
        if value is None and name == "record_id":
            value = f"<urn:uuid:{uuid.uuid4()}>"
        if value is not None:
            lines.append(f"{header}: {'sha1:' if name == 'payload_digest' else ''}{clean(value)}")
    lines.append("WARC-Date: 1970-01-01T00:00:00Z")
    lines.append("Content-Type: application/http; msgtype=response")
    if revisit:
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def fields(head: bytes) -> dict[str, str]:
    """Header lines as a dictionary with lower-case names."""
    out = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        out[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
    return out


@dataclass
class Archives(InputPartition):
    paths: list[str]


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.folder = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.partition_bytes = int(options.get("partitionBytes", 64 << 20))
        self.filters: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]):
        """Keep equality and list filters on headers; return the others to Spark."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and f.attribute[0] in PUSHED:
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                name = f.attribute[0]
                self.filters[name] = self.filters.get(name, wanted) & wanted
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        system, plain = files.opened(self.folder)
        listed = {f.base_name: f.size for f in system.get_file_info(fs.FileSelector(plain)) if f.is_file}
        lists = [n for n in listed if n.startswith(LIST)]  # one for each job that wrote here
        names = [n for x in lists for n in files.get(posixpath.join(self.folder, x)).decode().split()]
        if not lists:
            names = [n for n in listed if n.endswith((".warc", ".warc.gz"))]
        out, size = [Archives([])], 0
        for name in sorted(names):
            if size and size + listed[name] > self.partition_bytes:
                out.append(Archives([]))
                size = 0
            out[-1].paths.append(posixpath.join(self.folder, name))
            size += listed[name]
        return out

    def read(self, partition: Archives) -> Iterator[tuple]:
        for path in partition.paths:
            system, plain = files.opened(path)
            with system.open_input_file(plain) as file:
                packed = path.endswith(".gz")
                yield from (self.packed(file) if packed else self.plain(file))

    def wanted(self, head: dict[str, str]) -> tuple | None:
        """The header columns, or None if a pushed filter rules the record out."""
        values = []
        for name, header in HEADERS.items():
            value = head.get(header.lower())
            if value is not None and name in NUMBERS:
                value = int(value) if value.lstrip("-").isdigit() else None
            if name == "payload_digest" and value is not None:
                value = value.removeprefix("sha1:")
            if name in self.filters and value not in self.filters[name]:
                return None
            values.append(value)
        return tuple(values)

    def row(self, values: tuple, block: bytes, revisit: bool, length: int) -> tuple:
        """length is that of the whole block, of which only the start may be at hand."""
        http, _, payload = block.partition(b"\r\n\r\n")
        told, size = fields(http).get("content-length"), length - len(block) + len(payload)
        if not http.startswith(b"HTTP/"):
            told, payload, size = None, block, length
        size = int(told) if told and told.isdigit() else size
        return (*values, size, None if revisit or not self.payload else payload)

    def packed(self, file) -> Iterator[tuple]:
        """Records of an archive whose members tell their length, or of any gzip archive."""
        end, at = file.size(), 0
        while at < end:
            file.seek(at)
            start = file.read(len(MEMBER) + EXTRA.size)
            known = start[:4] == MEMBER[:4] and start[12:14] == b"sl"
            size = EXTRA.unpack(start[len(MEMBER) :])[3] if known else None
            machine = zlib.decompressobj(zlib.MAX_WBITS | 16)
            text, fed = machine.decompress(start, 4096), len(start)
            while b"\r\n\r\n" not in text and not machine.eof:
                more = machine.unconsumed_tail or file.read(min(4096, end - at - fed))
                if not machine.unconsumed_tail:
                    fed += len(more)
                if not more:
                    raise ValueError("an archive ends within a record")
                text += machine.decompress(more, 4096)
            head, _, block = text.partition(b"\r\n\r\n")
            head = fields(head)
            values = self.wanted(head)
            revisit = head.get("warc-type") == "revisit"
            # Enough of the block for its HTTP header is at hand without the payload.
            done = values is None or (not self.payload and (b"\r\n\r\n" in block or revisit))
            if not done or size is None:
                parts = [block]
                while not machine.eof:
                    more = machine.unconsumed_tail or file.read(1 << 16)
                    if not more:
                        raise ValueError("an archive ends within a record")
                    fed += 0 if machine.unconsumed_tail else len(more)
                    got = machine.decompress(more, 1 << 20)
                    if not done:
                        parts.append(got)
                block = b"".join(parts)
                size = size or fed - len(machine.unused_data)
            at += size
            if values is not None:
                length = int(head.get("content-length", len(block)))
                yield self.row(values, block[:length], revisit, length)

    def plain(self, file) -> Iterator[tuple]:
        """Records of an archive without compression; unwanted blocks are stepped over."""
        end, at = file.size(), 0
        while at < end:
            file.seek(at)
            text = file.read(4096)
            while b"\r\n\r\n" not in text:
                more = file.read(4096)
                if not more:
                    raise ValueError("an archive ends within a record")
                text += more
            head = text[: text.index(b"\r\n\r\n")]
            start = at + len(head) + 4
            head = fields(head)
            size = int(head["content-length"])
            values = self.wanted(head)
            if values is not None:
                file.seek(start)
                revisit = head.get("warc-type") == "revisit"
                block = file.read(size if self.payload else min(size, 4096))
                # A long HTTP header is read to its end also without the payload.
                while len(block) < size and block.startswith(b"HTTP/") and b"\r\n\r\n" not in block:
                    block += file.read(min(4096, size - len(block)))
                yield self.row(values, block, revisit, size)
            at = start + size + 4


class WarcWriter(DataSourceWriter):
    def __init__(self, options, overwrite: bool = False):
        self.folder, self.overwrite = options["path"], overwrite
        self.archive_bytes = int(options.get("archiveBytes", 64 << 20))
        self.level = int(options.get("level", 3))

    def write(self, rows: Iterator) -> WriterCommitMessage:
        names: list[str] = []
        parts: list[bytes] = []
        size = 0

        def close() -> None:
            names.append(f"{uuid.uuid4().hex}.warc.gz")
            files.put(posixpath.join(self.folder, names[-1]), b"".join(parts))

        for row in rows:
            packed = member(record(row), self.level)
            if parts and size + len(packed) > self.archive_bytes:
                close()
                parts, size = [], 0
            parts.append(packed)
            size += len(packed)
        if parts:
            close()
        return Written(names)

    def commit(self, messages) -> None:
        """The list of archives makes them part of the folder; without it nothing is. Every
        job writes a list of its own; overwriting takes the other lists away."""
        names = sorted(n for m in messages if m is not None for n in m.names)
        own = f"{LIST}-{uuid.uuid4().hex}"
        files.put(posixpath.join(self.folder, own), "\n".join(names).encode())
        if self.overwrite:
            system, plain = files.opened(self.folder)
            for f in system.get_file_info(fs.FileSelector(plain)):
                if f.is_file and f.base_name.startswith(LIST) and f.base_name != own:
                    system.delete_file(f.path)

    def abort(self, messages) -> None:
        """Archives that are not on the list are never read."""


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def records(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """A record for each page. Of equal payloads of at least min_revisit_bytes the one with
    the smallest page_id is the response and the others revisit it. Null html is an empty
    payload. Without any page_id all equal payloads are responses; repeated rows of the
    smallest page_id are each a response.

    Equality is that of length, SHA-1 and SHA-256; a third of all pages may be equal, so the
    smallest id is found by an aggregate and joined back on the payload's hash."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumn("sha", F.sha2("payload", 256)).withColumn("payload_bytes", F.octet_length("payload").cast("bigint"))
    shas = rows.select("sha", "page_id", "payload_bytes").where(F.col("payload_bytes") >= min_revisit_bytes)
    first = shas.groupBy("sha").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").select("sha", "first_id")
    both = rows.join(first, "sha", "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return both.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">")).alias("record_id"),
        "target_uri",
        "page_id",
        F.when(again, F.col("first_id")).alias("refers_to"),
        base32(F.sha1("payload")).alias("payload_digest"),
        "payload_bytes",
        F.when(~again, F.col("payload")).alias("payload"),
    )


def base32(hexadecimal):
    """Base 32 of a SHA-1 in hexadecimal: 32 letters of five bits."""
    digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    bits = F.concat(*(F.lpad(F.conv(F.substring(hexadecimal, 10 * k + 1, 10), 16, 32), 8, "0") for k in range(4)))
    return F.translate(F.upper(bits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", digits)


def archive(pages: DataFrame, folder: str | None = None, min_revisit_bytes: int = 0) -> DataFrame:
    """Write the pages as archives below a shared folder and read them back: without the
    payloads, but for a check of each stored one against its digest."""
    spark = pages.sparkSession
    register(spark)
    folder = folder or f"{sinks.table_folder(spark)}/warc"
    records(pages, min_revisit_bytes).write.format("warc").mode("append").save(folder)
    read = spark.read.format("warc").load(folder)
    stored = base32(F.sha1("payload"))
    wrong = F.col("payload").isNotNull() & ((stored != F.col("payload_digest")) | (F.octet_length("payload") != F.col("payload_bytes")))
    checked = F.when(wrong, F.raise_error(F.lit("a payload differs from its digest"))).otherwise(F.col("payload_digest"))
    return read.select("page_id", "payload_bytes", checked.alias("payload_digest"), "record_type", "refers_to", "target_uri")
