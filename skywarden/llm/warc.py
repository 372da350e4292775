"""WARC archives as a Spark data source, and pages archived with repeated payloads as revisits.

Reading plans one partition per group of files, parses a record's headers first and goes past what no one asked for: a
record whose type or headers fail the pushed predicates is skipped by its length, in compressed archives by the member
length that the writer put into the gzip header (``sl`` extra field), without inflating the payload.

Writing gives every task files of a bounded size. A commit lists the files of the tasks that succeeded; only those are
read, so a task that was lost and ran again leaves nothing twice.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In,
                                    InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage)
from pyspark.sql.types import StructType

from skywarden.llm.store import stored
from skywarden.session import work_dir

FILE_BYTES = 32 << 20
PARTITION_BYTES = 32 << 20
REVISIT_BYTES = 1000
_LIST = "_files.json"
_CHUNK = 1 << 18
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Columns that come straight from a header, and so can be judged before anything else is read.
_HEADERS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
            "date": "WARC-Date", "refers_to": "WARC-Refers-To", "content_type": "Content-Type"}
_READ = ("record_type string, record_id string, target_uri string, date string, refers_to string, content_type string, "
         "headers map<string,string>, payload_bytes long, payload_digest string, payload binary, file string, offset long")
_WRITE = ("record_type string, record_id string, target_uri string, date string, refers_to string, "
          "headers map<string,string>, payload_digest string, payload binary")


# -- archives -------------------------------------------------------------------------------------------------------

def _clean(value: str) -> str:
    return " ".join(value.split())


def record_bytes(record: dict) -> bytes:
    """One record: headers, then for a response its HTTP message, for a revisit the message's headers alone."""
    body = record["payload"] or b""
    digest = record["payload_digest"] or hashlib.sha1(body).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    revisit = record["record_type"] == "revisit"
    block = http if revisit else http + body
    lines = ["WARC/1.1", f"WARC-Type: {record['record_type']}", f"WARC-Record-ID: {record['record_id']}",
             f"WARC-Target-URI: {_clean(record['target_uri'] or '') or 'urn:none'}", f"WARC-Date: {record['date']}",
             f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"]
    if revisit:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record['refers_to']}"]
    lines += [f"{_clean(k)}: {_clean(v)}" for k, v in record["headers"] or () if v is not None]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 1) -> bytes:
    """``data`` as a gzip member that tells its own length in the extra field ``sl``."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    packed = packer.compress(data) + packer.flush()
    extra = b"sl" + struct.pack("<HII", 8, 10 + 14 + len(packed) + 8, len(data) & 0xFFFFFFFF)
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + packed
            + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF))


class _Bytes:
    """Buffered reading with a position, and skipping without reading."""

    def __init__(self, file):
        self.file, self.buffer, self.at, self.begin = file, b"", 0, 0

    @property
    def position(self) -> int:
        return self.begin + self.at

    def more(self) -> bool:
        new = self.file.read(_CHUNK)
        self.buffer, self.begin, self.at = self.buffer[self.at:] + new, self.begin + self.at, 0
        return bool(new)

    def take(self, n: int) -> bytes:
        while len(self.buffer) - self.at < n and self.more():
            pass
        out = self.buffer[self.at:self.at + n]
        self.at += len(out)
        return out

    def until(self, mark: bytes) -> bytes | None:
        while True:
            end = self.buffer.find(mark, self.at)
            if end >= 0:
                out = self.buffer[self.at:end]
                self.at = end + len(mark)
                return out
            if not self.more():
                return None

    def skip_to(self, position: int) -> None:
        if position - self.begin <= len(self.buffer):
            self.at = position - self.begin
        else:
            self.file.seek(position)
            self.buffer, self.begin, self.at = b"", position, 0


class _Inflated:
    """The bytes of one gzip member, inflated as they are asked for."""

    def __init__(self, raw: _Bytes):
        self.raw, self.engine = raw, zlib.decompressobj(31)

    def read(self, n: int) -> bytes:
        while not self.engine.eof:
            if self.raw.at == len(self.raw.buffer) and not self.raw.more():
                return b""
            out = self.engine.decompress(self.raw.buffer[self.raw.at:], n)
            self.raw.at = len(self.raw.buffer) - len(self.engine.unconsumed_tail) - len(self.engine.unused_data)
            if out:
                return out
        return b""


def _headers(text: bytes) -> list[tuple[str, str]]:
    pairs: list[tuple[str, str]] = []
    for line in text.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in " \t" and pairs:
            pairs[-1] = pairs[-1][0], f"{pairs[-1][1]} {line.strip()}"
        elif ":" in line:
            name, _, value = line.partition(":")
            pairs.append((name.strip(), value.strip()))
    return pairs


@dataclass(frozen=True)
class Wanted:
    """What a record's headers must satisfy: (column, operation, values)."""
    tests: tuple[tuple[str, str, tuple[str, ...]], ...] = ()

    def holds(self, headers: dict[str, str]) -> bool:
        for column, operation, values in self.tests:
            value = headers.get(_HEADERS[column].lower())
            if value is None or not (value in values if operation == "in" else value.startswith(values)):
                return False
        return True


def read_records(file, compressed: bool, wanted: Wanted, payload: str) -> Iterator[dict]:
    """Records of an open archive. ``payload``: ``keep``, ``digest`` (length and digest only) or ``skip``."""
    raw = _Bytes(file)
    while True:
        end = None
        if compressed:
            start = raw.position
            head = raw.take(24)
            if not head:
                return
            if len(head) == 24 and head[3] & 4 and head[12:14] == b"sl":
                end = start + struct.unpack("<I", head[16:20])[0]
            raw.at -= len(head)
            stream = _Bytes(_Inflated(raw))
        else:
            while raw.take(1) in (b"\r", b"\n"):
                pass
            if raw.position and raw.at:
                raw.at -= 1
            start, stream = raw.position, raw
        text = stream.until(b"\r\n\r\n")
        if text is None:
            return
        pairs = _headers(text)
        headers = {name.lower(): value for name, value in pairs}
        length = int(headers.get("content-length", 0))
        block_end = stream.position + length
        if wanted.holds(headers):
            digest = headers.get("warc-payload-digest", "")
            if digest.lower().startswith("sha1:"):
                named = digest[5:]
                digest = named.lower() if len(named) == 40 else base64.b32decode(named).hex()
            row = {column: headers.get(name.lower()) for column, name in _HEADERS.items()}
            row |= {"headers": pairs, "payload_bytes": None, "payload_digest": digest or None, "payload": None,
                    "offset": start}
            if payload != "skip" and row["record_type"] in ("response", "resource"):
                block = stream.take(length)
                if row["record_type"] == "response":
                    block = block.partition(b"\r\n\r\n")[2]
                row |= {"payload_bytes": len(block), "payload_digest": hashlib.sha1(block).hexdigest()}
                if digest and digest != row["payload_digest"]:
                    raise ValueError(f"payload of {row['record_id']} does not have the digest it is said to have")
                if payload == "keep":
                    row["payload"] = block
            yield row
        if not compressed:
            raw.skip_to(block_end)
        elif end is not None:
            raw.skip_to(end)
        else:
            while stream.file.read(_CHUNK):
                pass


# -- data source ----------------------------------------------------------------------------------------------------

@dataclass
class FileGroup(InputPartition):
    files: tuple[str, ...]


@dataclass
class Written(WriterCommitMessage):
    files: tuple[str, ...]


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.payload = options["path"], options.get("payload", "keep")
        if self.payload not in ("keep", "digest", "skip"):
            raise ValueError(f"payload is keep, digest or skip, not {self.payload}")
        tests = [(column, "in", tuple(json.loads(options[column]))) for column in _HEADERS if column in options]
        self.wanted = Wanted(tuple(tests))

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        tests = list(self.wanted.tests)
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if column in _HEADERS and isinstance(f, EqualTo) and isinstance(f.value, str):
                tests.append((column, "in", (f.value,)))
            elif column in _HEADERS and isinstance(f, In) and all(isinstance(v, str) for v in f.value):
                tests.append((column, "in", tuple(f.value)))
            elif column in _HEADERS and isinstance(f, StringStartsWith):
                tests.append((column, "starts", (f.value,)))
            elif column in _HEADERS and isinstance(f, IsNotNull):
                tests.append((column, "starts", ("",)))
            else:
                yield f
        self.wanted = Wanted(tuple(tests))

    def partitions(self) -> list[FileGroup]:
        fs, path = _open(self.path)
        infos = fs.get_file_info(pafs.FileSelector(path, recursive=True)) if (
            fs.get_file_info(path).type == pafs.FileType.Directory) else [fs.get_file_info(path)]
        sizes = {i.path: i.size for i in infos if i.is_file and i.base_name.endswith((".warc", ".warc.gz"))}
        lists = [i.path for i in infos if i.is_file and i.base_name.startswith(_LIST)]
        if lists:
            committed = set()
            for name in lists:
                with fs.open_input_stream(name) as file:
                    committed |= set(json.loads(file.read()))
            sizes = {p: n for p, n in sizes.items() if p.rpartition("/")[2] in committed}
        groups: list[list[str]] = []
        room = 0
        for name, size in sorted(sizes.items()):
            if size > room or not groups:
                groups.append([])
                room = PARTITION_BYTES
            groups[-1].append(name)
            room -= size
        return [FileGroup(tuple(g)) for g in groups] or [FileGroup(())]

    def read(self, partition: FileGroup) -> Iterator[pa.RecordBatch]:
        fs, _ = _open(self.path)
        rows, held = [], 0
        for name in partition.files:
            with fs.open_input_file(name) as file:
                for row in read_records(file, name.endswith(".gz"), self.wanted, self.payload):
                    rows.append(row | {"file": name})
                    held += len(row["payload"] or b"") + 500
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW_READ)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _ARROW_READ)


_MAP = pa.map_(pa.string(), pa.string())
_ARROW_READ = pa.schema([*((c, pa.string()) for c in _HEADERS), ("headers", _MAP), ("payload_bytes", pa.int64()),
                         ("payload_digest", pa.string()), ("payload", pa.binary()), ("file", pa.string()),
                         ("offset", pa.int64())])


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.compressed = options["path"], options.get("compression", "gzip") == "gzip"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, path = _open(self.path)
        fs.create_dir(path, recursive=True)
        files: list[str] = []
        file, size = None, 0
        for batch in iterator:
            for i in range(batch.num_rows):
                data = record_bytes({f: batch.column(f)[i].as_py() for f in batch.schema.names})
                data = gzip_member(data) if self.compressed else data
                if file is None or size + len(data) > FILE_BYTES:
                    if file:
                        file.close()
                    files.append(f"{uuid.uuid4().hex}.warc" + ".gz" * self.compressed)
                    file, size = fs.open_output_stream(f"{path}/{files[-1]}", compression=None), 0
                file.write(data)
                size += len(data)
        if file:
            file.close()
        return Written(tuple(files))

    def commit(self, messages: list[Written | None]) -> None:
        fs, path = _open(self.path)
        fs.create_dir(path, recursive=True)
        with fs.open_output_stream(f"{path}/{_LIST}-{uuid.uuid4().hex}") as file:
            file.write(json.dumps([f for m in messages if m for f in m.files]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        fs, path = _open(self.path)
        for name in (f for m in messages if m for f in m.files):
            fs.delete_file(f"{path}/{name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return _READ

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are added to a folder, never replaced")
        return WarcWriter(dict(self.options))


def read_warc(spark: SparkSession, path: str, payload: str = "keep", **wanted: list[str]) -> DataFrame:
    """Records below ``path``. ``wanted`` names header columns and the values that are asked for, as
    ``record_type=["response"]``; filters on the header columns are pushed down as well, for which the session has to
    let Python data sources see filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    options = {column: json.dumps(list(values)) for column, values in wanted.items()}
    return spark.read.format("warc").options(payload=payload, **options).load(path)


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    records.sparkSession.dataSource.register(WarcSource)
    records.write.format("warc").mode("append").options(compression=compression).save(path)


# -- pages ----------------------------------------------------------------------------------------------------------

def archive_pages(pages: DataFrame, path: str) -> None:
    """Write a record for every row of ``pages`` (page_id, url, html).

    Of rows with equal payloads of at least ``REVISIT_BYTES``, those with the largest page_id become responses and the
    others revisits of it. A null html is an empty payload, a null url an unnamed one. A null page_id is smaller than
    any other.
    """
    body = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        body.alias("payload")).withColumn("payload_digest", F.sha1("payload"))
    heads = (rows.where(F.octet_length("payload") >= REVISIT_BYTES).groupBy("payload_digest")
             .agg(F.max("page_id").alias("head"), F.count("*").alias("n")).where("n > 1 AND head IS NOT NULL"))
    heads = stored(heads.select("payload_digest", "head"), "payloads")

    def name(page: F.Column) -> F.Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(":"),
                        F.col("payload_digest"), F.lit(">"))

    revisit = F.col("head").isNotNull() & ~F.col("head").eqNullSafe(F.col("page_id"))
    records = rows.join(heads, "payload_digest", "left").select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), name(F.col("page_id")).alias("record_id"),
        F.col("url").alias("target_uri"), F.lit("1970-01-01T00:00:00Z").alias("date"),
        F.when(revisit, name(F.col("head"))).alias("refers_to"),
        F.create_map(F.lit("Page-ID"), F.col("page_id").cast("string")).alias("headers"), "payload_digest",
        F.when(~revisit, F.col("payload")).alias("payload"))
    write_warc(records, path)


def archived_pages(pages: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` as read back from archives of ``pages``.

    Repeated rows give repeated records. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    path = work_dir(spark, "archives")
    archive_pages(pages, path)
    records = stored(read_warc(spark, path, payload="digest").select(
        F.col("headers")["Page-ID"].cast("long").alias("page_id"), "record_type", "record_id", "refers_to",
        "payload_bytes", "payload_digest"), "records")
    responses = records.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to")).agg(
        F.first("page_id").alias("head"), F.first("payload_bytes").alias("bytes"))
    revisits = records.where("record_type = 'revisit'").drop("payload_bytes").join(responses, "refers_to").select(
        "page_id", F.col("bytes").alias("payload_bytes"), "payload_digest", "record_type", F.col("head").alias("refers_to"))
    return records.where("record_type = 'response'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to")
    ).unionByName(revisits)
