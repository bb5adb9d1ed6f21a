"""WARC archives as a Spark data source, written and read in Python.

``WarcSource`` plans one partition per archive file. Reading parses a record's headers first and applies the pushed
predicates to them (record type, target address, digest, record id); payloads of records that fail are not inflated any
further, and where the archive's gzip members carry the standard's skip lengths (``sl``) the reader jumps to the next
record. Archives are gzip-compressed record by record, and a task starts a new file when one reaches ``file_bytes``.
A writing task names its files itself; the commit lists those of successful tasks in a manifest, so files of lost attempts
are never read. Archives of other programs, compressed or plain, are read as well.

Options: ``path`` (folder or file; ``file:`` and the URIs that Arrow knows), ``payload`` (``false`` leaves payloads out),
``file_bytes``.

Defined cases of :func:`archive_records`: null html is an empty payload, a null address no address; pages that repeat an id and
payload are responses both when theirs is the largest id; an empty table writes an empty manifest; line
breaks in addresses are percent-encoded; other columns are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, StringStartsWith, WriterCommitMessage)

from vintara.llm.common import files_at, new_folder

SCHEMA = ("record_id string, record_type string, target_uri string, date string, refers_to string, payload_digest string, "
          "http_length long, content_length long, payload binary")
# Header names of the WARC standard, by column.
HEADERS = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "date": "warc-date",
           "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST, OWN = "_manifest", "vintara-"  # what the names of manifests and of archives written here begin with


def member(record: bytes) -> bytes:
    """``record`` as one gzip member with skip lengths."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    whole = 24 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, whole, len(record) % 2**32)
    return (b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H", len(extra)) + extra + body
            + struct.pack("<II", zlib.crc32(record), len(record) % 2**32))


def record_bytes(row: Row) -> bytes:
    """A response or revisit record. Its block is an HTTP response head, and the payload unless it is a revisit."""
    payload = bytes(row["payload"] or b"") if row["record_type"] == "response" else b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['http_length']}\r\n\r\n".encode()
    fields = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", f"<{row['record_id']}>"), ("WARC-Date", row["date"]),
              ("WARC-Target-URI", row["target_uri"]), ("WARC-Payload-Digest", row["payload_digest"])]
    if row["record_type"] == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{row['refers_to']}>")]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(http) + len(payload)))]
    one_line = lambda v: v.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in v or "\n" in v else v
    head = "".join(f"{k}: {one_line(v)}\r\n" for k, v in fields if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + http + payload + b"\r\n\r\n"


def parsed_headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:] if ":" in line)}


class _Window:
    """Bytes of a stream, read ahead as far as asked."""

    def __init__(self, stream, chunk: int = 1 << 20):
        self.stream, self.chunk, self.held = stream, chunk, b""

    def ensure(self, n: int) -> bool:
        parts, size = [self.held], len(self.held)
        while size < n and (more := self.stream.read(max(self.chunk, n - size))):
            parts.append(more)
            size += len(more)
        self.held = b"".join(parts)
        return size >= n

    def take(self, n: int) -> bytes:
        self.ensure(n)
        out, self.held = self.held[:n], self.held[n:]
        return out

    def skip(self, n: int) -> None:
        while n > len(self.held):
            n -= len(self.held)
            self.held = self.stream.read(self.chunk)
            if not self.held:
                return
        self.held = self.held[n:]


class _Member:
    """One gzip member, inflated as far as asked."""

    def __init__(self, window: _Window):
        self.window, self.inflate, self.length = window, zlib.decompressobj(31), None
        window.ensure(24)
        start = window.held[:24]
        if start[3:4] == b"\x04" and start[12:14] == b"sl" and len(start) == 24:
            self.length = struct.unpack("<I", start[16:20])[0]
        self.used, self.data = 0, b""

    def ensure(self, n: int) -> bool:
        parts, size = [self.data], len(self.data)
        while size < n and not self.inflate.eof:
            if not self.window.ensure(1):
                break
            fed = self.window.held[:1 << 16]
            out = self.inflate.decompress(fed)
            rest = len(self.inflate.unused_data) if self.inflate.eof else 0
            self.window.held = self.window.held[len(fed) - rest:]
            self.used += len(fed) - rest
            parts.append(out)
            size += len(out)
        self.data = b"".join(parts)
        return size >= n

    def close(self) -> None:
        if self.inflate.eof:
            return
        if self.length is not None:
            self.window.skip(self.length - self.used)
            return
        while not self.inflate.eof and self.ensure(len(self.data) + 1):
            self.data = b""


class _Plain:
    """A record of an archive that is not compressed."""

    def __init__(self, window: _Window):
        self.window = window

    @property
    def data(self) -> bytes:
        return self.window.held

    def ensure(self, n: int) -> bool:
        return self.window.ensure(n)


def records(stream, wanted, payload: bool = True) -> Iterator[tuple]:
    """Rows of ``SCHEMA`` of the records whose headers ``wanted`` accepts."""
    window = _Window(stream)
    while window.ensure(4):
        compressed = window.held[:2] == b"\x1f\x8b"
        if not compressed and window.held[:2] == b"\r\n":
            window.take(2)
            continue
        source = _Member(window) if compressed else _Plain(window)
        size = 4096
        while (end := source.data.find(b"\r\n\r\n")) < 0:
            if not source.ensure(size) and (end := source.data.find(b"\r\n\r\n")) < 0:
                raise ValueError("a record without an end of its headers")
            size *= 2
        headers = parsed_headers(source.data[:end])
        length, at = int(headers.get("content-length", 0)), end + 4
        if wanted(headers):
            block_end = at + length if payload else at
            http_end, http_length, content = -1, None, None
            if headers.get("content-type", "").startswith("application/http"):
                while (http_end := source.data.find(b"\r\n\r\n", at, at + length)) < 0 and len(source.data) < at + length:
                    if not source.ensure(min(at + length, len(source.data) + 8192)):
                        break
                if http_end >= 0:
                    told = parsed_headers(source.data[at:http_end]).get("content-length", "")
                    http_length = int(told) if told.isdigit() else None
            if payload:
                if not source.ensure(block_end):
                    raise ValueError("a record is cut off")
                content = source.data[http_end + 4 if http_end >= 0 else at:block_end]
            value = lambda c: headers.get(HEADERS[c])
            bare = lambda v: v[1:-1] if v and v[0] == "<" and v[-1] == ">" else v
            yield (bare(value("record_id")), value("record_type"), value("target_uri"), value("date"), bare(value("refers_to")),
                   value("payload_digest"), http_length, length, content)
        if compressed:
            source.close()
        else:
            window.skip(at + length)


class Archive(InputPartition):
    def __init__(self, path: str):
        self.path = path


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.folder, self.payload = options["path"], options.get("payload", "true").lower() != "false"
        self.tests: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if column in HEADERS and isinstance(f, EqualTo):
                self.tests.append(("in", column, (f.value,)))
            elif column in HEADERS and isinstance(f, In):
                self.tests.append(("in", column, tuple(f.value)))
            elif column in HEADERS and isinstance(f, StringStartsWith):
                self.tests.append(("starts", column, (f.value,)))
            else:
                yield f

    def partitions(self) -> list[Archive]:
        from pyarrow import fs

        filesystem, base = files_at(self.folder)
        if filesystem.get_file_info(base).type == fs.FileType.File:
            return [Archive(self.folder)]
        found = [f.base_name for f in filesystem.get_file_info(fs.FileSelector(base))]
        manifests = [n for n in found if n.startswith(MANIFEST)]
        if manifests:  # one for each write that ended
            names = []
            for manifest in manifests:
                with filesystem.open_input_stream(f"{base}/{manifest}") as stream:
                    names += stream.read().decode().splitlines()
        else:  # archives of other programs
            names = [n for n in found if n.endswith((".warc", ".warc.gz")) and not n.startswith(OWN)]
        return [Archive(f"{self.folder}/{name}") for name in sorted(names)] or [Archive("")]

    def _accepts(self, headers: dict[str, str]) -> bool:
        for kind, column, values in self.tests:
            found = headers.get(HEADERS[column])
            if found is None:
                return False
            if column in ("record_id", "refers_to"):
                found = found.strip("<>")
            if found not in values if kind == "in" else not found.startswith(values[0]):
                return False
        return True

    def read(self, partition: Archive) -> Iterator[tuple]:
        if not partition.path:
            return
        filesystem, path = files_at(partition.path)
        with filesystem.open_input_file(path) as stream:
            yield from records(stream, self._accepts, self.payload)


class Written(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


class WarcWriter(DataSourceWriter):
    """Archives count as soon as a manifest names them. Each write adds its own, so what is appended joins what is there; a write that
    overwrites takes the others away when it ends."""

    def __init__(self, options: dict[str, str], overwrite: bool = False):
        self.folder, self.file_bytes, self.overwrite = options["path"], int(options.get("file_bytes", 64 << 20)), overwrite

    def write(self, iterator: Iterator[Row]) -> Written:
        filesystem, base = files_at(self.folder)
        filesystem.create_dir(base, recursive=True)
        names, stream, size = [], None, 0
        for row in iterator:
            if stream is None or size >= self.file_bytes:
                if stream is not None:
                    stream.close()
                names.append(f"{OWN}{uuid.uuid4().hex}.warc.gz")
                stream, size = filesystem.open_output_stream(f"{base}/{names[-1]}", compression=None), 0
            data = member(record_bytes(row))
            stream.write(data)
            size += len(data)
        if stream is not None:
            stream.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        filesystem, base = files_at(self.folder)
        filesystem.create_dir(base, recursive=True)
        before = [f.base_name for f in filesystem.get_file_info(fs.FileSelector(base)) if f.base_name.startswith(MANIFEST)] if self.overwrite else []
        with filesystem.open_output_stream(f"{base}/{MANIFEST}-{uuid.uuid4().hex}") as stream:
            stream.write("\n".join(n for m in messages if m is not None for n in m.names).encode())
        for name in before:
            with filesystem.open_input_stream(f"{base}/{name}") as stream:
                old = stream.read().decode().splitlines()
            filesystem.delete_file(f"{base}/{name}")
            self._delete(old)

    def abort(self, messages: list[Written | None]) -> None:
        """Take away what ended tasks wrote; without a manifest it was not read anyway."""
        self._delete(n for m in messages if m is not None for n in m.names)

    def _delete(self, names) -> None:
        from pyarrow import fs

        filesystem, base = files_at(self.folder)
        for name in names:
            if filesystem.get_file_info(f"{base}/{name}").type == fs.FileType.File:
                filesystem.delete_file(f"{base}/{name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "vintara_warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def archive_records(pages: DataFrame, least: int = 1000, page_id: str = "page_id", url: str = "url", html: str = "html",
                    date: str | None = None) -> DataFrame:
    """Rows of ``SCHEMA`` for ``pages``: of equal payloads of at least ``least`` bytes the one with the largest id is the
    response, the others revisit it. Only hashes and ids meet in the grouping."""
    content = F.coalesce(F.col(html), F.lit("")).cast("binary")
    read = pages.select(F.col(page_id).cast("long").alias("_id"), F.col(url).alias("_url"), content.alias("_payload"),
                        F.sha1(content).alias("_sha1"), F.octet_length(content).alias("_bytes"))
    heads = read.where(F.col("_bytes") >= least).groupBy("_sha1", "_bytes").agg(
        F.max("_id").alias("_head"), F.count(F.lit(1)).alias("_n")).where("_n > 1 AND _head IS NOT NULL").select(
        F.col("_sha1").alias("_of"), F.col("_bytes").alias("_of_bytes"), "_head")
    joined = read.join(heads, (F.col("_sha1") == F.col("_of")) & (F.col("_bytes") == F.col("_of_bytes")), "left")
    again = F.col("_head").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_head"))
    name = lambda c: F.concat(F.lit("urn:vintara:page:"), F.coalesce(c.cast("string"), F.lit("")))
    at = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    return joined.select(
        name(F.col("_id")).alias("record_id"), F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.col("_url").alias("target_uri"), F.lit(at).alias("date"), F.when(again, name(F.col("_head"))).alias("refers_to"),
        F.concat(F.lit("sha1:"), F.col("_sha1")).alias("payload_digest"), F.col("_bytes").cast("long").alias("http_length"),
        F.lit(None).cast("long").alias("content_length"), F.when(~again, F.col("_payload")).alias("payload"))


def write_archive(rows: DataFrame, folder: str) -> None:
    register(rows.sparkSession)
    rows.write.format("vintara_warc").mode("append").option("path", folder).save()


def read_archive(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("vintara_warc").option("path", folder).option("payload", str(payload).lower()).load()


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as an archive and read it: page_id, payload_bytes, payload_digest, record_type, refers_to. Figures of a
    response come from its payload, those of a revisit from its headers."""
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    write_archive(archive_records(pages), folder)
    # the record type is pushed to both scans: only responses are inflated
    kept = read_archive(spark, folder).where("record_type = 'response'").unionByName(
        read_archive(spark, folder, payload=False).where("record_type = 'revisit'"))
    number = lambda c: F.nullif(F.regexp_extract(c, "([-0-9]*)$", 1), F.lit("")).cast("long")
    response = F.col("record_type") == "response"
    return kept.select(
        number("record_id").alias("page_id"), F.when(response, F.octet_length("payload")).otherwise(F.col("http_length")).cast(
            "long").alias("payload_bytes"),
        F.when(response, F.sha1("payload")).otherwise(F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        "record_type", F.when(~response, number("refers_to")).alias("refers_to"))
