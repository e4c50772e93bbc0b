"""WARC archives as a Spark data source.

``spark.read.format("warc").load(folder)`` plans one task per archive file. Filters on record type,
target URI, date, digest and record ids are evaluated on a record's headers, which come first; the
rest of a record that they reject is skipped without being decompressed (records written here carry
their lengths in the gzip header) or at least without being decoded. ``option("payload", "false")``
skips all payloads.

``df.write.format("warc").mode("append").save(folder)`` writes ``record_id, record_type, target_uri,
date, payload, payload_digest, refers_to``. Files are gzip members, one per record, written
under a hidden name and renamed when the job commits.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as files
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    StringStartsWith,
    WriterCommitMessage,
)

COLUMNS = ("record_id string, record_type string, target_uri string, date string, "
           "payload_digest string, refers_to string, payload_length long, payload binary")
#: Column and the header that holds it.
HEADERS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type",
           "target_uri": "WARC-Target-URI", "date": "WARC-Date",
           "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"
#: Start of a gzip member with an extra field "sl": compressed and plain length of the record.
_MEMBER = struct.Struct("<4sIBBH2sHII")
_CHUNK = 1 << 16
#: Bytes read at first, which hold the headers of nearly every record.
_HEAD = 1024
_BLANK = b"\r\n\r\n"
_SCHEMA = pa.schema([(c, pa.string()) for c in (
    "record_id", "record_type", "target_uri", "date", "payload_digest", "refers_to")] + [
    ("payload_length", pa.int64()), ("payload", pa.binary())])


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    """A header value: control characters and what is no ASCII as percent codes."""
    return quote(value, safe="".join(map(chr, range(33, 127))))


def record_bytes(record: dict) -> bytes:
    """One record. A revisit has the HTTP headers of its response only, a response the payload too."""
    payload = record["payload"] or b""
    kind = record["record_type"] or "response"
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {_clean(kind)}"]
    for column, name in HEADERS.items():
        value = record.get(column)
        if column == "payload_digest":
            value = f"sha1:{value or digest_of(payload)}"
        if column in ("record_id", "refers_to") and value:
            value = f"<{_clean(value)}>"
        if column == "date":
            value = value or EPOCH
        if value and column != "record_type":
            head.append(f"{name}: {value if column in ('record_id', 'refers_to') else _clean(value)}")
    if kind == "revisit":
        head.append(f"WARC-Profile: {REVISIT}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member_bytes(record: bytes, level: int = 3) -> bytes:
    """The record as a gzip member."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(record) + squeeze.flush()
    size = _MEMBER.size + len(body) + 8
    return (_MEMBER.pack(b"\x1f\x8b\x08\x04", 0, 0, 255, 12, b"sl", 8, size & 0xFFFFFFFF,
                         len(record) & 0xFFFFFFFF)
            + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF))


class _Source:
    """Bytes of a file at any place, read in large blocks."""

    def __init__(self, path: str):
        system, place = files.FileSystem.from_uri(path)
        self.file = system.open_input_file(place)
        self.size, self.start, self.block = self.file.size(), 0, b""

    def at(self, place: int, n: int) -> bytes:
        if place < self.start or place + n > self.start + len(self.block):
            self.start = place
            self.block = self.file.read_at(min(max(n, 1 << 20), self.size - place), place)
        return self.block[place - self.start:place - self.start + n]


class _Record:
    """One record: its headers first, then as much of its block as is asked for."""

    def __init__(self, source: _Source, place: int):
        self.source, self.place, self.next_raw, self.plain = source, place, place, b""
        start = source.at(place, min(_MEMBER.size, source.size - place))
        self.stream = zlib.decompressobj(31) if start[:2] == b"\x1f\x8b" else None
        self.length = 0  # of the member, if its header tells
        if start[:4] == b"\x1f\x8b\x08\x04" and start[12:14] == b"sl":
            self.length = _MEMBER.unpack(start)[7]
        while (end := self.plain.find(b"\r\n\r\n")) < 0 and self._more(_HEAD):
            pass
        lines = self.plain[:max(end, 0)].decode("utf-8", "replace").split("\r\n")
        self.headers = {k.strip().lower(): v.strip() for k, found, v in
                        (line.partition(":") for line in lines[1:]) if found}
        self.first = end + 4
        self.content = int(self.headers.get("content-length", 0))

    def _more(self, n: int) -> bool:
        """Adds about ``n`` plain bytes, or says that there are none."""
        if self.stream is None:
            raw = self.source.at(self.next_raw, min(n, self.source.size - self.next_raw))
            self.next_raw += len(raw)
            self.plain += raw
            return bool(raw)
        if self.stream.eof:
            return False
        raw = self.stream.unconsumed_tail
        if not raw:
            raw = self.source.at(self.next_raw, min(n, self.source.size - self.next_raw))
            self.next_raw += len(raw)
        new = self.stream.decompress(raw, 4 * n) if raw else self.stream.flush()
        self.plain += new
        return bool(raw or new)

    def block(self) -> bytes:
        upto = self.first + self.content
        while len(self.plain) < upto and self._more(upto - len(self.plain)):
            pass
        return self.plain[self.first:upto]

    def upto(self, mark: bytes) -> bytes:
        """The block to the end of the first ``mark`` at least; all of it if there is none."""
        upto, seen = self.first + self.content, self.first
        while self.plain.find(mark, seen, upto) < 0 and len(self.plain) < upto:
            seen = max(self.first, len(self.plain) - len(mark) + 1)
            if not self._more(_HEAD):
                break
        return self.plain[self.first:upto]

    def end(self) -> int:
        """Place of the next record."""
        if self.stream is None:
            return self.place + self.first + self.content + 4
        if self.length:
            return self.place + self.length
        while self._more(_CHUNK):  # a member that does not tell its length has to be read
            self.plain = b""
        return self.next_raw - len(self.stream.unused_data)


def _records(path: str) -> Iterator[_Record]:
    source, place = _Source(path), 0
    while place < source.size:
        record = _Record(source, place)
        if record.first < 4:
            raise ValueError(f"{path} holds no WARC record at byte {place}")
        yield record
        place = record.end()


def _wanted(values: dict, filters: list[Filter]) -> bool:
    for f in filters:
        value = values[f.attribute[0]]
        if isinstance(f, EqualTo):
            good = value == f.value
        elif isinstance(f, In):
            good = value in f.value
        else:
            good = value is not None and value.startswith(f.value)
        if not good:
            return False
    return True


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            if isinstance(f, (EqualTo, In, StringStartsWith)) and f.attribute[0] in HEADERS:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        """One for each archive below the path."""
        system, base = files.FileSystem.from_uri(self.path)
        found = system.get_file_info(files.FileSelector(base, allow_not_found=True, recursive=True))
        names = sorted(f.path for f in found if f.type == files.FileType.File
                       and f.path.endswith((".warc", ".warc.gz"))
                       and not f.base_name.startswith((".", "_")))
        prefix = self.path.partition("://")[0] + "://" if "://" in self.path else ""
        return [InputPartition(prefix + name) for name in names]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition is None or partition.value is None:
            return
        rows, size = [], 0
        for record in _records(partition.value):
            row = {column: record.headers.get(name.lower()) for column, name in HEADERS.items()}
            for column in ("record_id", "refers_to"):
                row[column] = row[column].strip("<>") if row[column] else None
            digest = row["payload_digest"]
            row["payload_digest"] = digest = digest.removeprefix("sha1:") if digest else None
            if not _wanted(row, self.filters):
                continue
            row |= self._payload(record, digest, row["record_type"])
            rows.append(row)
            size += len(row["payload"] or b"") + 400
            if size > 8_000_000:
                yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _SCHEMA)

    def _payload(self, record: _Record, digest: str | None, kind: str | None) -> dict:
        """Length of the payload and the payload itself if the record has it and it is wanted. The
        HTTP headers tell the length, or else the block without them does, whether or not the
        payload is read; a payload that does not match its digest is an error."""
        http = "application/http" in record.headers.get("content-type", "")
        if not self.payload and not http:
            return {"payload_length": record.content, "payload": None}
        block = record.block() if self.payload else record.upto(_BLANK)
        head, blank, body = block.partition(_BLANK) if http else (b"", b"", block)
        length = record.content - len(head) - len(blank)
        for line in head.split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            if name.strip().lower() == b"content-length":
                length = int(value)
        if kind == "revisit" or not self.payload:
            return {"payload_length": length, "payload": None}
        if digest and digest_of(body) != digest:
            raise ValueError(f"the payload of {record.headers.get('warc-record-id')} is damaged")
        return {"payload_length": length, "payload": body}


@dataclass
class _Written(WriterCommitMessage):
    names: list[tuple[str, str]]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.most = int(options.get("max_file_bytes", 1 << 30))
        self.job = uuid.uuid4().hex[:12]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        """Archives of about ``max_file_bytes`` at most, under names that only the commit shows."""
        from pyspark import TaskContext

        system, base = files.FileSystem.from_uri(self.path)
        context = TaskContext.get()
        out, names = None, []
        for batch in iterator:
            for record in batch.to_pylist():
                if out is None:
                    system.create_dir(base, recursive=True)
                    name = f"part-{self.job}-{context.partitionId():06d}-{len(names):04d}.warc.gz"
                    names.append((f"{base}/.{context.taskAttemptId()}-{name}", f"{base}/{name}"))
                    out = system.open_output_stream(names[-1][0], compression=None)
                out.write(member_bytes(record_bytes(record)))
                if out.tell() > self.most:
                    out.close()
                    out = None
        if out:
            out.close()
        return _Written(names)

    def commit(self, messages: list[_Written | None]) -> None:
        system, _ = files.FileSystem.from_uri(self.path)
        for message in messages:
            for own, name in message.names if message else ():
                system.move(own, name)

    def abort(self, messages: list[_Written | None]) -> None:
        system, _ = files.FileSystem.from_uri(self.path)
        for message in messages:
            for own, _ in message.names if message else ():
                system.delete_file(own)


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are added to, not replaced: use mode('append')")
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    """Makes the format known to the session and lets Spark push filters into it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def with_revisits(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html",
                  least: int = 0) -> DataFrame:
    """Pages as records to write: of equal payloads of at least ``least`` bytes that with the
    smallest id is a response and the others revisit it, all other records are responses.

    A null page has an empty payload. A null id comes after all others, and rows that share the
    smallest id are all responses, as are all rows if no id is known. An empty table gives no records, a
    very long page is one record. Other columns are not read, whatever their names.
    """
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url).alias("target_uri"),
                        payload.alias("payload"), F.sha1(payload).alias("sha1"))
    firsts = (rows.where(F.octet_length("payload") >= least).groupBy(F.col("sha1").alias("same"))
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1"))
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    known = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    return rows.join(firsts, F.col("sha1") == F.col("same"), "left").select(
        F.concat(F.lit("urn:page:"), known).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri", F.lit(None).cast("string").alias("date"), "payload",
        F.lit(None).cast("string").alias("payload_digest"),
        F.when(revisit, F.concat(F.lit("urn:page:"), F.col("first"))).alias("refers_to"))


def page_of(record_id: str) -> Column:
    """The page id in a record id that ``with_revisits`` made."""
    return F.expr(f"try_cast(substring_index({record_id}, ':', -1) as bigint)")
