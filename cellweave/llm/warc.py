r"""WARC archives as a Spark data source.

Writing: each task writes gzip members, one per record, into files of bounded size below
``_temporary``; the commit moves the files of successful tasks into place, so that lost or repeated
attempts leave nothing behind. Every member carries its compressed size in the ``sl`` extra field.

Reading: files are planned into partitions by size. Of each record the header block is parsed first, against
the pushed predicates (record type, record id, target URI); the payload of an unwanted record, or of any record
where no payload column is read, is skipped by its size and never inflated whole. Members without the extra field,
and plain ``.warc`` files, are read as well. A damaged record raises.

Paths are URIs that pyarrow's file systems open (``file:``, ``s3:``, ``gs:``, ``hdfs:``) or local paths.
"""

from __future__ import annotations

import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, In, InputPartition, StringStartsWith, WriterCommitMessage)

from cellweave.llm.common import shared_folder, small_batches, table

SCHEMA = ("record_id string, record_type string, target_uri string, date string, payload_digest string, "
          "refers_to string, payload_bytes long, payload binary")
HEADERS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
           "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}
FILE_BYTES = 256 << 20
CHUNK = 16 << 10


def file_system(path: str):
    """(file system, path inside it)."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        if path.startswith("file:"):
            return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _line(text: str) -> str:
    """A header value: line ends and blanks can't stand in it."""
    return "".join(f"%{ord(c):02X}" if c in "\r\n \t" else c for c in text)


def record_bytes(row: dict) -> bytes:
    """One record: WARC header block, HTTP header block, payload."""
    payload = row["payload"] or b""
    size = row["payload_bytes"] if row["payload_bytes"] is not None else len(payload)
    revisit = row["record_type"] == "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = http if revisit else http + payload
    head = ["WARC/1.1"]
    for column, name in HEADERS.items():
        if row[column] is not None:
            head.append(f"{name}: {_line(row[column])}")
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    """A gzip member whose extra field ``sl`` holds its whole compressed size and its plain size."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    size = 10 + 2 + 12 + len(body) + 8
    if max(size, len(data)) >= 1 << 32:
        return b"\x1f\x8b\x08\x00" + bytes(4) + b"\x00\xff" + body + tail
    extra = struct.pack("<H2sHII", 12, b"sl", 8, size, len(data))
    return b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + extra + body + tail


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, file_bytes: int):
        self.path, self.file_bytes = path, file_bytes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, base = file_system(self.path)
        folder = posixpath.join(base, "_temporary")
        system.create_dir(folder, recursive=True)
        files, out, written = [], None, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None:
                        files.append(f"records-{uuid.uuid4().hex}.warc.gz")
                        out, written = system.open_output_stream(posixpath.join(folder, files[-1]), compression=None), 0
                    member = gzip_member(record_bytes(row))
                    out.write(member)
                    written += len(member)
                    if written >= self.file_bytes:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages: list) -> None:
        system, base = file_system(self.path)
        system.create_dir(base, recursive=True)
        for message in messages:
            for name in message.files if message else []:
                system.move(posixpath.join(base, "_temporary", name), posixpath.join(base, name))
        self._clear()

    def abort(self, messages: list) -> None:
        self._clear()

    def _clear(self) -> None:
        system, base = file_system(self.path)
        temporary = posixpath.join(base, "_temporary")
        if system.get_file_info(temporary).type.name != "NotFound":
            system.delete_dir(temporary)


@dataclass
class Files(InputPartition):
    names: list


def _parse(block: bytes) -> dict:
    """Header names in lower case and their values."""
    fields = {}
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            fields[name.strip().lower()] = value.strip()
    return fields


class _Inflate:
    """The plain bytes of one member or of a stretch of a plain file, read on demand."""

    def __init__(self, stream, at: int):
        self.stream, self.at, self.plain, self.done = stream, at, b"", False
        stream.seek(at)
        lead = stream.read(24)
        self.gzip, self.next = lead[:2] == b"\x1f\x8b", None
        if self.gzip and lead[3:4] == b"\x04" and lead[12:14] == b"sl":
            self.next = at + struct.unpack_from("<I", lead, 16)[0]
        stream.seek(at)
        self.packer = zlib.decompressobj(31) if self.gzip else None

    def more(self) -> bool:
        data = self.stream.read(CHUNK)
        if not data:
            return False
        if not self.gzip:
            self.plain += data
            return True
        self.plain += self.packer.decompress(data)
        if self.packer.eof:
            self.done = True
            self.next = self.stream.tell() - len(self.packer.unused_data)
        return True

    def until(self, mark: bytes) -> bytes:
        while (found := self.plain.find(mark)) < 0:
            if self.done or not self.more():
                raise ValueError(f"header without an end at byte {self.at}")
        return self.plain[: found + len(mark)]

    def take(self, start: int, size: int) -> bytes:
        pieces, have = [self.plain], len(self.plain)
        while have < start + size and not self.done:
            self.plain = b""
            if not self.more():
                break
            pieces.append(self.plain)
            have += len(self.plain)
        self.plain = b"".join(pieces)
        if len(self.plain) < start + size:
            raise ValueError(f"record at byte {self.at} ends early")
        return self.plain[start:start + size]


def read_records(stream, size: int, wanted, with_payload: bool) -> Iterator[dict]:
    """Records of an open file for whose header columns ``wanted`` holds."""
    at = 0
    while at < size:
        member = _Inflate(stream, at)
        head = member.until(b"\r\n\r\n")
        if not head.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = _parse(head)
        length = int(fields["content-length"])
        row = {column: fields.get(name.lower()) for column, name in HEADERS.items()}
        if wanted(row):
            http = len(head)
            if fields.get("content-type", "").startswith("application/http"):
                while (end := member.plain.find(b"\r\n\r\n", http)) < 0:
                    if member.done or not member.more():
                        raise ValueError(f"HTTP header without an end at byte {at}")
                inner = _parse(member.plain[http:end])
                start = end + 4
                row["payload_bytes"] = int(inner.get("content-length", len(head) + length - start))
            else:
                start, row["payload_bytes"] = http, length
            if with_payload:
                row["payload"] = None if row["record_type"] == "revisit" else member.take(start, len(head) + length - start)
            yield row
        if not member.gzip:
            at += len(head) + length + 4
            continue
        while member.next is None:
            member.plain = b""
            if not member.more():
                raise ValueError(f"member at byte {at} ends early")
        if member.next > size:
            raise ValueError(f"member at byte {at} ends early")
        at = member.next


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema, split_bytes: int):
        self.path, self.names, self.split_bytes, self.rules = path, [f.name for f in schema.fields], split_bytes, []
        self.types = [(f.name, f.dataType.simpleString()) for f in schema.fields]

    def pushFilters(self, filters):
        for one in filters:
            column = getattr(one, "attribute", (None,))[0]
            if column in HEADERS and isinstance(one, (EqualTo, EqualNullSafe, In, StringStartsWith)):
                self.rules.append((type(one).__name__, column, one.value))
            else:
                yield one

    def partitions(self):
        from pyarrow import fs

        system, base = file_system(self.path)
        infos = system.get_file_info(fs.FileSelector(base, recursive=True)) if system.get_file_info(base).type == fs.FileType.Directory else [system.get_file_info(base)]
        infos = sorted((i for i in infos if i.is_file and i.base_name.endswith((".warc", ".warc.gz")) and "/_temporary/" not in i.path), key=lambda i: i.path)
        parts, size = [], 0
        for info in infos:
            if not parts or size + info.size > self.split_bytes:
                parts.append(Files([]))
                size = 0
            parts[-1].names.append((info.path, info.size))
            size += info.size
        return parts or [Files([])]

    def _wanted(self, row: dict) -> bool:
        for kind, column, value in self.rules:
            own = row[column]
            if kind == "In" and own not in value or kind.startswith("Equal") and own != value:
                return False
            if kind == "StringStartsWith" and not (own or "").startswith(value):
                return False
        return True

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(self.path)
        arrow = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
        schema = pa.schema([(name, arrow[kind]) for name, kind in self.types])
        rows, held = [], 0
        for path, size in partition.names:
            with system.open_input_file(path) as stream:
                for row in read_records(stream, size, self._wanted, "payload" in self.names):
                    rows.append({name: row.get(name) for name in self.names})
                    held += len(row.get("payload") or b"") + 500
                    if held >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class WarcSource(DataSource):
    """``format("warc")``: option ``path``; ``fileBytes`` when writing, ``splitBytes`` when reading."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], schema, int(self.options.get("splitBytes", 64 << 20)))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], int(self.options.get("fileBytes", FILE_BYTES)))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def records(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """Archive records of pages (page_id, url, html): equal payloads become revisits of the largest page_id.

    Null html is an empty payload, and a null page_id counts below all others. Where rows repeat the largest page_id,
    all of them are responses. Without any page_id in a group of copies, all its rows are responses.
    """
    body = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", body.alias("payload")).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})
    # Small payloads are never revisits: their own key keeps them from meeting in one place.
    large = F.col("payload_bytes") >= least_bytes
    rows = rows.withColumn("key", F.when(large, F.sha2("payload", 256)).otherwise(F.concat(F.lit("#"), F.xxhash64("page_id", "url").cast("string"))))
    copies = rows.where(large).groupBy("key").agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).where("n > 1 and kept is not null")
    rows = rows.join(copies.select("key", "kept"), "key", "left")
    again = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    return rows.select(
        name("page_id").alias("record_id"), F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"), F.lit("2024-01-01T00:00:00Z").alias("date"),
        F.concat(F.lit("sha1:"), "digest").alias("payload_digest"), F.when(again, name("kept")).alias("refers_to"),
        "payload_bytes", F.when(~again, F.col("payload")).alias("payload"))


def write_archive(pages: DataFrame, path: str) -> None:
    register(pages.sparkSession)
    small_batches(pages.sparkSession, 200)
    records(pages).write.format("warc").option("path", path).mode("append").save()


def read_archive(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    register(spark)
    return spark.read.format("warc").schema(schema).option("path", path).load()


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "warc")
    write_archive(table(spark, folder, "pages"), path)
    number = lambda c: F.regexp_extract(c, "<urn:page:(.*)>", 1).try_cast("long")
    whole = read_archive(spark, path).where("record_type = 'response'").select(
        number("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    light = ", ".join(c for c in SCHEMA.split(", ") if not c.startswith("payload binary"))
    again = read_archive(spark, path, light).where("record_type = 'revisit'").select(
        number("record_id").alias("page_id"), "payload_bytes", F.substring("payload_digest", 6, 40).alias("payload_digest"),
        "record_type", number("refers_to").alias("refers_to"))
    return whole.unionByName(again)


OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, html, strlen(html) AS n, max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN n >= 1000 AND top IS NOT NULL AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND top IS NOT NULL AND page_id IS DISTINCT FROM top THEN top END AS refers_to FROM q"""
