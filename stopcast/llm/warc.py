"""WARC archives as a PySpark Python data source.

``warc`` writes WARC/1.1 files (one gzip member per record, whose gzip header
carries the member's length) and reads them, its own or others', plain or
gzipped.  The reader plans one partition per stretch of a file, takes
predicates on the record type and on header fields, and parses a record's
headers first: only a record that passes, and whose payload is asked for, has
its payload decoded; of any other, the rest is skipped by its length.

Writing is safe against lost executors: every attempt writes files of its own
name and the commit lists those that count in ``_manifest.json``; without a
manifest all ``*.warc`` and ``*.warc.gz`` files of the folder are read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import posixpath
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan,
                                    GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan,
                                    LessThanOrEqual, StringStartsWith, WriterCommitMessage)
from pyspark.sql.types import StructType

from stopcast.llm.common import shared_folder

READ_SCHEMA = ("page_id bigint, target_uri string, record_type string, payload_digest string, payload_bytes bigint, "
               "refers_to bigint, payload binary")
MANIFEST = "_manifest.json"
FILE_BYTES = 64 << 20       # a file is closed beyond this
SPLIT_BYTES = 8 << 20       # own files are read in stretches of about this
HEADER_FIELDS = ("page_id", "target_uri", "record_type", "payload_digest", "refers_to")
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, salt: str = "") -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{salt}')}>"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    """One gzip member whose 'sl' extra field holds its own length and that of
    ``data``, so that readers can skip it without inflating."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    size = 10 + 2 + 12 + len(body) + 8
    extra = b"" if max(size, len(data)) >> 32 else b"sl" + struct.pack("<HII", 8, size, len(data))
    head = b"\x1f\x8b\x08" + (b"\x04" if extra else b"\x00") + b"\x00\x00\x00\x00\x00\xff"
    if extra:
        head += struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def warc_record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A record of the given header fields; line breaks in values are escaped."""
    lines = ["WARC/1.1"] + [f"{k}: " + v.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
                            if k == "WARC-Target-URI" and re.search(r"[\r\n]|%0[AD]", v) else f"{k}: {v}"
                            for k, v in fields if v is not None]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, first: int | None, date: str) -> bytes:
    """A response, or a revisit of page ``first`` (whose payload is the same)."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    digest = digest32(payload)
    fields = [("WARC-Type", "response" if first is None else "revisit"),
              ("WARC-Record-ID", record_id(page_id, url or "" if page_id is None else "")),
              ("WARC-Date", date), ("WARC-Target-URI", url), ("WARC-Payload-Digest", "sha1:" + digest),
              ("WARC-Page-ID", None if page_id is None else str(page_id))]
    if first is not None:
        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(first)), ("WARC-Refers-To-Page-ID", str(first))]
        payload = b""
    return warc_record([*fields, ("Content-Type", "application/http; msgtype=response")], http + payload)


# ---------------------------------------------------------------- reading

class Member:
    """Forward reads of one record: a gzip member, or plain bytes."""

    def __init__(self, f: io.BufferedReader, start: int):
        self.f, self.start, self.buffer, self.length = f, start, b"", None
        f.seek(start)
        head = f.read(2)
        self.z = None
        if head != b"\x1f\x8b":
            self.buffer = head
        else:
            flags = f.read(8)[1]
            if flags & 4:
                extra = f.read(struct.unpack("<H", f.read(2))[0])
                while len(extra) >= 4:
                    n = struct.unpack("<H", extra[2:4])[0]
                    if extra[:2] == b"sl" and n == 8:
                        self.length = struct.unpack("<I", extra[4:8])[0]
                    extra = extra[4 + n:]
            for bit in (8, 16):
                if flags & bit:
                    while f.read(1) not in (b"\x00", b""):
                        pass
            if flags & 2:
                f.read(2)
            self.z = zlib.decompressobj(-15)

    def more(self, want: int = 1 << 16) -> bool:
        if self.z is None:
            got = self.f.read1(want)
        else:
            got = b""
            while not got and not self.z.eof:
                got = self.z.decompress(self.z.unconsumed_tail, want)   # what is still inside first
                if not got and not self.z.eof:
                    raw = self.f.read1(want)
                    if not raw:
                        raise EOFError("a gzip member ends early")
                    got = self.z.decompress(raw, want)
        self.buffer += got
        return bool(got)

    def until(self, mark: bytes) -> bytes | None:
        """Bytes before ``mark``, which is passed; None at the end."""
        looked = 0
        while (at := self.buffer.find(mark, max(0, looked - len(mark)))) < 0:
            looked = len(self.buffer)
            if not self.more(4096):
                return None
        out, self.buffer = self.buffer[:at], self.buffer[at + len(mark):]
        return out

    def take(self, n: int) -> bytes:
        parts, have = [self.buffer], len(self.buffer)
        self.buffer = b""
        while have < n:
            if not self.more(max(1 << 16, min(n - have, 1 << 22))):
                raise EOFError("a record ends early")
            parts.append(self.buffer)
            have += len(self.buffer)
            self.buffer = b""
        whole = b"".join(parts)
        self.buffer = whole[n:]
        return whole[:n]

    def end(self, content_left: int) -> int:
        """Offset after the record; ``content_left``: bytes of its block still unread."""
        if self.z is None:
            skip = content_left + 4 - len(self.buffer)
            return self.f.tell() + skip
        if self.length is not None:
            return self.start + self.length
        while self.more(1 << 20):
            self.buffer = b""
        return self.f.tell() - len(self.z.unused_data) + 8


def header_fields(block: bytes) -> dict[str, str]:
    out = {}
    for line in block.split(b"\r\n")[1:]:
        k, colon, v = line.partition(b":")
        if colon:
            out[k.strip().lower().decode("latin-1")] = v.strip().decode("utf-8", "replace")
    return out


def number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"-?\d+", text) else None


def record_row(h: dict[str, str]) -> dict:
    uri = h.get("warc-target-uri")
    if uri and re.search("%0[AD]", uri):
        uri = uri.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")
    return {"page_id": number(h.get("warc-page-id")), "target_uri": uri, "record_type": h.get("warc-type"),
            "payload_digest": (h.get("warc-payload-digest") or "").removeprefix("sha1:") or None,
            "refers_to": number(h.get("warc-refers-to-page-id"))}


def passes(row: dict, tests: list[tuple[str, str, object]]) -> bool:
    for kind, column, value in tests:
        x = row[column]
        if kind in ("null", "known"):
            if (x is None) != (kind == "null"):
                return False
        elif x is None or not {"=": lambda: x == value, "in": lambda: x in value, "<": lambda: x < value,
                               "<=": lambda: x <= value, ">": lambda: x > value, ">=": lambda: x >= value,
                               "starts": lambda: str(x).startswith(value)}[kind]():
            return False
    return True


def read_records(f: io.BufferedReader, start: int, end: int, tests: list[tuple[str, str, object]],
                 payload: bool, size: bool, verify: bool) -> Iterator[dict]:
    """Rows of the records from ``start`` to ``end`` that pass ``tests``."""
    while start < end:
        m = Member(f, start)
        head = m.until(b"\r\n\r\n")
        if head is None:
            if m.buffer.strip():
                raise EOFError("a record's header ends early")
            return
        h = header_fields(head)
        left = int(h.get("content-length", 0))
        row = record_row(h)
        if passes(row, tests):
            row |= {"payload": None, "payload_bytes": None}
            whole = payload or verify and row["record_type"] == "response"
            if (whole or size) and row["record_type"] in ("response", "revisit", "resource"):
                http = b""
                if h.get("content-type", "").startswith("application/http"):
                    before = m.until(b"\r\n\r\n")
                    http, left = before or b"", left - len(before or b"") - 4
                told = number(header_fields(http).get("content-length"))
                row["payload_bytes"] = left if row["record_type"] != "revisit" or told is None else told
                if whole:
                    row["payload"], left = m.take(left), 0
                    if verify and row["record_type"] == "response" and row["payload_digest"] not in (
                            None, digest32(row["payload"])):
                        raise ValueError(f"payload digest mismatch at {start}")
            yield row
        start = m.end(left)


@dataclass
class Stretch(InputPartition):
    path: str
    start: int
    end: int


def list_stretches(path: str) -> list[Stretch]:
    system, root = pafs.FileSystem.from_uri(path)
    manifest = posixpath.join(root, MANIFEST)
    if system.get_file_info(manifest).type == pafs.FileType.File:
        with system.open_input_stream(manifest) as f:
            files = json.loads(f.read())
        return [Stretch(posixpath.join(root, x["file"]), a, b) for x in files
                for a, b in zip(x["cuts"], x["cuts"][1:], strict=False)]
    info = system.get_file_info(root)
    found = [info] if info.type == pafs.FileType.File else system.get_file_info(pafs.FileSelector(root, recursive=True))
    return [Stretch(x.path, 0, x.size) for x in sorted(found, key=lambda x: x.path)
            if x.type == pafs.FileType.File and re.search(r"\.warc(\.gz)?$", x.path)]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.columns = options["path"], schema.names
        self.verify = options.get("verify", "false").lower() == "true"
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        kinds = {EqualTo: "=", In: "in", IsNull: "null", IsNotNull: "known", LessThan: "<", LessThanOrEqual: "<=",
                 GreaterThan: ">", GreaterThanOrEqual: ">=", StringStartsWith: "starts"}
        for x in filters:
            kind = kinds.get(type(x))
            if kind and len(x.attribute) == 1 and x.attribute[0] in HEADER_FIELDS:
                value = getattr(x, "value", None)
                self.tests.append((kind, x.attribute[0], set(value) if kind == "in" else value))
            else:
                yield x

    def partitions(self) -> list[InputPartition]:
        return list_stretches(self.path)

    def read(self, partition: Stretch | None) -> Iterator[tuple]:
        if partition is None:       # an archive without files
            return
        system, _ = pafs.FileSystem.from_uri(self.path)
        with system.open_input_file(partition.path) as raw, io.BufferedReader(raw, 1 << 20) as f:
            for row in read_records(f, partition.start, partition.end, self.tests, "payload" in self.columns,
                                    "payload_bytes" in self.columns, self.verify):
                yield tuple(row.get(c) for c in self.columns)


# ---------------------------------------------------------------- writing

@dataclass
class Written(WriterCommitMessage):
    files: list[dict]


class WarcWriter(DataSourceArrowWriter):
    """Rows (page_id, url, payload, refers_to) to archive files."""

    def __init__(self, options: dict):
        self.path, self.date = options["path"], options.get("date", "1970-01-01T00:00:00Z")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, root = pafs.FileSystem.from_uri(self.path)
        system.create_dir(root, recursive=True)
        files: list[dict] = []
        out = None
        for batch in iterator:
            for page_id, url, payload, first in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "refers_to")),
                                                    strict=True):
                if out is None:
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    out = system.open_output_stream(posixpath.join(root, name), compression=None)
                    out.write(gzip_member(warc_record([
                        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                        ("WARC-Date", self.date), ("Content-Type", "application/warc-fields")], b"format: WARC/1.1\r\n")))
                    files.append({"file": name, "cuts": [0]})
                out.write(gzip_member(page_record(page_id.as_py(), url.as_py(), payload.as_py() or b"", first.as_py(),
                                                  self.date)))
                at, cuts = out.tell(), files[-1]["cuts"]
                if at - cuts[-1] >= SPLIT_BYTES:
                    cuts.append(at)
                if at >= FILE_BYTES:
                    out = self._close(out, files)
        if out is not None:
            self._close(out, files)
        return Written(files)

    def _close(self, out: pa.NativeFile, files: list[dict]) -> None:
        if files[-1]["cuts"][-1] != out.tell():
            files[-1]["cuts"].append(out.tell())
        out.close()

    def commit(self, messages: list[Written | None]) -> None:
        system, root = pafs.FileSystem.from_uri(self.path)
        system.create_dir(root, recursive=True)
        with system.open_output_stream(posixpath.join(root, MANIFEST)) as f:
            f.write(json.dumps([x for m in messages if m for x in m.files]).encode())


class WarcDataSource(DataSource):
    """``spark.read.format("warc")``; a schema without ``payload`` (and
    ``payload_bytes``) never decodes one.  Option ``verify``: decode every
    response and fail when its payload and digest differ."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def with_revisits(pages: DataFrame, least: int = 0, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html") -> DataFrame:
    """(page_id, url, payload, refers_to): refers_to is the smallest page_id
    with an equal payload of at least ``least`` bytes, null for responses.

    The smallest ids are a map-side combined aggregate by SHA-1 and length;
    they are joined back on it, which Spark splits where a payload is hot.
    """
    rows = pages.select(pages[id_col].cast("bigint").alias("page_id"), pages[url_col].cast("string").alias("url"),
                        F.encode(F.coalesce(pages[payload_col].cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumns({"sha": F.unhex(F.sha1("payload")), "size": F.octet_length("payload")})
    firsts = rows.where(F.col("size") >= least).groupBy("sha", "size").agg(F.min("page_id").alias("first"))
    return rows.join(firsts, ["sha", "size"], "left").select(
        "page_id", "url", "payload", F.when(F.col("first") < F.col("page_id"), F.col("first"))
        .when(F.col("page_id").isNull(), F.col("first")).alias("refers_to"))


def write_warc(pages: DataFrame, path: str, least: int = 0, date: str = "1970-01-01T00:00:00Z", **columns: str) -> str:
    """Archive ``pages`` under ``path`` with duplicate payloads as revisits.

    Reads only the id, url and payload columns (names by ``columns``).  A null
    payload is empty, a null url has no target field, a page without an id has
    no page field and revisits a page that has one.  Repeated rows are records
    each; those that share a group's smallest id are all responses.  An empty
    table writes an archive without records.
    """
    register(pages.sparkSession)
    with_revisits(pages, least, **columns).write.format("warc").mode("append").option("date", date).save(path)
    return path


def read_warc(spark: SparkSession, path: str, schema: str = READ_SCHEMA, verify: bool = False) -> DataFrame:
    """Records of the archives under ``path``; fields by ``schema`` alone are read."""
    register(spark)
    return spark.read.format("warc").schema(schema).option("verify", str(verify).lower()).load(path)


def archive_round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back:
    (page_id, payload_bytes, payload_digest, record_type, refers_to).  Every
    response is decoded and held against its digest."""
    spark = pages.sparkSession
    path = write_warc(pages, shared_folder(spark, "warc"), least)
    return read_warc(spark, path, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
                                  "refers_to bigint", verify=True).where(F.col("record_type").isin("response", "revisit"))
