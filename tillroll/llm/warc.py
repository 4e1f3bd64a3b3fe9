"""WARC 1.1 archives as a Spark data source (short name ``warc``), for reading and writing.

Writing: every task writes one file of records, each its own gzip member whose header has
the two lengths of the member (the ``sl`` extra field of the WARC standard's annex on
compression).  Files become part of the archive by a list that the driver writes at commit,
so files of failed or repeated attempts are never read.

Reading: the driver plans partitions of whole files, small ones together.  Filters on
``record_type`` and on other header columns that Spark pushes down are tested on a record's
parsed headers; the payload of a record that fails, or of any record when the schema asked
for has no ``payload``, is passed over by its length: not read where the file tells the
member's length or is not compressed, else inflated without being kept.  Files of other
writers (plain, or one gzip member a record or a file) are read too.

Columns: ``record_id``, ``record_type``, ``target_uri``, ``record_date``, ``refers_to``,
``payload_digest``, ``payload_length`` (strings but for the length) and ``payload``.
A response's block is an HTTP header and the payload; a revisit's block is empty and its
payload null, while digest and length describe the full payload it refers to.

Results for odd input: null header values are left out and read back as null; a null
payload is written as an empty one; line breaks in header values become spaces; an archive
without files gives no rows.
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
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition,
    IsNotNull, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from tillroll.session import scratch_path

SCHEMA = ("record_id string, record_type string, target_uri string, record_date string, refers_to string, "
          "payload_digest string, payload_length long, payload binary")
# Header names of the WARC standard; the length of a payload that a revisit
# leaves out has no standard name and is an extension field.
HEADERS = {
    "record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI",
    "record_date": "WARC-Date", "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest",
    "payload_length": "X-WARC-Payload-Length",
}
COLUMN_OF = {v.lower(): k for k, v in HEADERS.items()}
MANIFEST = "_files.json"
READ_BYTES = 1 << 16
PARTITION_BYTES = 128 << 20
BATCH_BYTES = 8 << 20


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and inner path of a path or URI (local, hdfs, s3, gs); local paths are taken as they are."""
    if path.startswith("file:"):
        path = path[5:] if not path.startswith("file://") else path[7:]
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


# ------------------------------------------------------------------------ writing


def record_bytes(row: dict) -> bytes:
    """One record as a gzip member with its lengths in the header."""
    payload = row.get("payload") or b""
    revisit = row.get("record_type") == "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (
        b"" if revisit else b"Content-Length: %d\r\n" % len(payload)) + b"\r\n"
    block = http if revisit else http + payload
    lines = ["WARC/1.1"]
    for col, name in HEADERS.items():
        if row.get(col) is not None:
            value = str(row[col]).replace("\r", " ").replace("\n", " ")
            lines.append(f"{name}: {f'<{value}>' if col in ('record_id', 'refers_to') else value}")
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return gzip_member("\r\n".join(lines).encode() + block + b"\r\n\r\n")


def gzip_member(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    extra = b"sl" + struct.pack("<HII", 8, 24 + len(body) + 8 & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + tail


@dataclass
class _Written(WriterCommitMessage):
    name: str
    size: int


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, path = _open(self.path)
        system.create_dir(path, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.gz"
        size = 0
        with system.open_output_stream(f"{path}/{name}", compression=None) as out:
            for batch in iterator:
                cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
                for i in range(batch.num_rows):
                    size += out.write(record_bytes({n: c[i].as_py() for n, c in cols.items()}))
        return _Written(name, size)

    def commit(self, messages: list[WriterCommitMessage]) -> None:
        system, path = _open(self.path)
        system.create_dir(path, recursive=True)
        files = [] if self.overwrite else list_files(self.path)
        files += [(m.name, m.size) for m in messages if m is not None and m.size]
        with system.open_output_stream(f"{path}/{MANIFEST}", compression=None) as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list[WriterCommitMessage]) -> None:
        system, path = _open(self.path)
        for m in messages:
            if m is not None:
                system.delete_file(f"{path}/{m.name}")


# ------------------------------------------------------------------------ reading


def list_files(root: str) -> list[tuple[str, int]]:
    """Names and sizes of an archive's files: by its list, else all WARC files in the folder."""
    system, path = _open(root)
    info = system.get_file_info(path)
    if info.type == pafs.FileType.File:
        return [("", info.size)]
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(root)
    if system.get_file_info(f"{path}/{MANIFEST}").type == pafs.FileType.File:
        with system.open_input_stream(f"{path}/{MANIFEST}", compression=None) as f:
            return [tuple(x) for x in json.loads(f.read())]
    found = system.get_file_info(pafs.FileSelector(path, recursive=True))
    return sorted((f.path[len(path):].lstrip("/"), f.size) for f in found
                  if f.type == pafs.FileType.File and f.path.endswith((".warc", ".warc.gz")))


class _Source:
    """Buffered bytes of a file, with a forward skip that seeks."""

    def __init__(self, file, size: int):
        self.file, self.size, self.buf, self.at = file, size, b"", 0  # at: offset of buf in the file

    def fill(self, n: int) -> bytes:
        """At least n bytes ahead, if there are as many."""
        while len(self.buf) < n and (more := self.file.read(max(READ_BYTES, n - len(self.buf)))):
            self.buf += more
        return self.buf

    def skip(self, n: int) -> None:
        if n < len(self.buf):
            self.buf = self.buf[n:]
        else:
            self.file.seek(min(self.at + n, self.size))
            self.buf = b""
        self.at += n


def _headers(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    return out


def _row(h: dict[str, str]) -> dict:
    row = {c: h.get(n) for n, c in COLUMN_OF.items()}
    for c in ("record_id", "refers_to"):
        if row[c] is not None:
            row[c] = row[c].removeprefix("<").removesuffix(">")
    length = row["payload_length"]
    row["payload_length"] = int(length) if length and length.isdigit() else None
    return row


def _payload(h: dict[str, str], block: bytes) -> bytes | None:
    if h.get("warc-type") == "revisit":
        return None
    if h.get("content-type", "").replace(" ", "").startswith("application/http"):
        head, found, body = block.partition(b"\r\n\r\n")
        return body if found else block
    return block


class _Plain:
    """A record stream over bytes that are not compressed: records follow each other."""

    def __init__(self, src: _Source):
        self.src = src

    def records(self, wanted, payload: bool):
        while True:
            while self.src.fill(2)[:2] == b"\r\n":
                self.src.skip(2)
            n = READ_BYTES
            while (end := self.src.fill(n).find(b"\r\n\r\n")) < 0:
                if len(self.src.buf) < n:
                    return
                n *= 2
            h = _headers(self.src.buf[:end])
            row, length = _row(h), int(h.get("content-length", 0))
            self.src.skip(end + 4)
            if wanted(row):
                if payload:
                    row["payload"] = _payload(h, self.src.fill(length)[:length])
                yield row
            self.src.skip(length)


class _Inflated:
    """What _Source offers, over one or more gzip members; a skip inflates and forgets."""

    def __init__(self, src: _Source):
        self.src, self.buf, self.z = src, b"", zlib.decompressobj(31)

    def fill(self, n: int) -> bytes:
        while len(self.buf) < n and (raw := self.src.fill(1)):
            self.buf += self.z.decompress(raw)
            used = len(raw) - len(self.z.unused_data)
            self.src.skip(used)
            if self.z.eof:
                self.z = zlib.decompressobj(31)
        return self.buf

    def skip(self, n: int) -> None:
        while n > len(self.buf):
            n -= len(self.buf)
            self.buf = b""
            if not self.fill(1):
                return
        self.buf = self.buf[n:]


def _member_length(head: bytes) -> int:
    """The length of a gzip member that tells it (one record), else 0."""
    if len(head) < 24 or head[:2] != b"\x1f\x8b" or not head[3] & 4 or head[12:14] != b"sl":
        return 0
    return struct.unpack("<I", head[16:20])[0]


def read_records(file, size: int, wanted=lambda row: True, payload: bool = True) -> Iterator[dict]:
    """The records of one open file whose header columns pass ``wanted``."""
    src = _Source(file, size)
    if src.fill(2)[:2] != b"\x1f\x8b":
        yield from _Plain(src).records(wanted, payload)
        return
    while (length := _member_length(src.fill(24))):
        z, head = zlib.decompressobj(31), b""
        ahead = min(length, 1024)
        while (end := head.find(b"\r\n\r\n")) < 0:  # headers first, by little input
            head = (z := zlib.decompressobj(31)).decompress(src.fill(ahead)[:ahead])
            if ahead == length and b"\r\n\r\n" not in head:
                raise ValueError("a WARC record without the end of its headers")
            ahead, used = min(length, ahead * 4), ahead
        h = _headers(head[:end])
        row = _row(h)
        if wanted(row):
            if payload:
                block = head[end + 4:] + z.decompress(src.fill(length)[used:length])
                row["payload"] = _payload(h, block[:int(h.get("content-length", 0))])
            yield row
        src.skip(length)
    if src.fill(1):  # members of unknown length
        yield from _Plain(_Inflated(src)).records(wanted, payload)


@dataclass
class _Files(InputPartition):
    files: list[tuple[str, int]]


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, partition_bytes: int):
        self.path, self.schema, self.partition_bytes = path, schema, partition_bytes
        self.tests: list[tuple[str, list | None]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes equality, membership and not-null tests on header columns; yields the rest."""
        for f in filters:
            col = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if col not in HEADERS:
                yield f
            elif isinstance(f, (EqualTo, EqualNullSafe)) and f.value is not None:
                self.tests.append((col, [f.value]))
            elif isinstance(f, In):
                self.tests.append((col, [v for v in f.value if v is not None]))
            elif isinstance(f, IsNotNull):
                self.tests.append((col, None))
            else:
                yield f

    def wanted(self, row: dict) -> bool:
        return all(row[c] is not None and (values is None or row[c] in values) for c, values in self.tests)

    def partitions(self) -> list[InputPartition]:
        out, size = [[]], 0
        for name, n in list_files(self.path):
            if out[-1] and size + n > self.partition_bytes:
                out.append([])
                size = 0
            out[-1].append((name, n))
            size += n
        return [_Files(p) for p in out]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        schema = to_arrow_schema(self.schema)
        system, root = _open(self.path)
        rows, held = [], 0
        for name, size in partition.files:
            with system.open_input_file(f"{root}/{name}" if name else root) as f:
                for row in read_records(f, size, self.wanted, "payload" in schema.names):
                    rows.append({n: row.get(n) for n in schema.names})
                    held += 500 + len(row.get("payload") or b"")
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


class WarcDataSource(DataSource):
    """``spark.read.format("warc")``; option ``partition_bytes``: archive bytes a task, at most a file more."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(self.options["path"], schema, int(self.options.get("partition_bytes", PARTITION_BYTES)))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


# ------------------------------------------------------------------------ pages


def base32_digest(payload: bytes | None) -> str:
    return base64.b32encode(hashlib.sha1(payload or b"").digest()).decode()


def _hex_to_base32(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column, hex, as base32."""
    for b in batches:
        last = pa.array([base64.b32encode(bytes.fromhex(x)).decode() for x in b.column(b.num_columns - 1).to_pylist()])
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], last.cast(pa.string())], names=b.schema.names)


SALTS = 32


def archive_records(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                    html_col: str = "html") -> DataFrame:
    """WARC rows of pages: a payload of at least ``min_bytes`` that occurs with a smaller id
    too is a revisit of the smallest.

    Digests of repeated payloads (one row each, their ids pre-aggregated) join the pages by
    digest and a salt, so the copies of one payload spread over SALTS tasks.  Rows that repeat
    the smallest id are responses too; a null id is no one's target, and its row is a
    response unless others with an id have the payload.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).cast("string").alias("target_uri"),
                        F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("payload_length", F.octet_length("payload").cast("long")).withColumn("_sha1", F.sha1("payload"))
    first = (rows.where(F.col("payload_length") >= min_bytes).groupBy("_sha1")
             .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
             .select("_sha1", "_first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")))
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64("_id", "target_uri"), F.lit(SALTS)).cast("int"))
    revisit = F.col("_first").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_first"))
    out = rows.join(first, ["_sha1", "_salt"], "left").select(
        F.concat(F.lit("urn:page:"), F.coalesce(F.col("_id").cast("string"), F.lit("none"))).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), "target_uri",
        F.lit("2024-01-01T00:00:00Z").alias("record_date"),
        F.when(revisit, F.concat(F.lit("urn:page:"), F.col("_first").cast("string"))).alias("refers_to"),
        "payload_length", F.when(~revisit, F.col("payload")).alias("payload"),
        F.col("_sha1").alias("payload_digest"))
    schema = ("record_id string, record_type string, target_uri string, record_date string, refers_to string, "
              "payload_length long, payload binary, payload_digest string")
    return out.mapInArrow(_hex_to_base32, schema)


def write_archive(records: DataFrame, path: str) -> None:
    """Writes records (a digest without its label gets ``sha1:``) as an archive."""
    register(records.sparkSession)
    cols = [F.concat(F.lit("sha1:"), F.col(c)).alias(c) if c == "payload_digest" else F.col(c) for c in records.columns]
    records.select(*cols).write.format("warc").mode("overwrite").save(path)


def read_archive(spark: SparkSession, path: str, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("partition_bytes", partition_bytes).load(path)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Length and digest from the payload where there is one, else as the headers tell."""
    for b in batches:
        digests, lengths = [], []
        for payload, digest, length in zip(b.column(3), b.column(4), b.column(5)):
            if payload.is_valid:
                body = memoryview(payload.as_buffer())
                digests.append(base64.b32encode(hashlib.sha1(body).digest()).decode())
                lengths.append(len(body))
            else:
                digests.append((digest.as_py() or "").removeprefix("sha1:") or None)
                lengths.append(length.as_py())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), b.column(2), pa.array(digests, pa.string()), pa.array(lengths, pa.int64())],
            names=["record_id", "record_type", "refers_to", "payload_digest", "payload_bytes"])


def pages_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages written as an archive in the shared scratch folder and read back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archive(archive_records(pages, min_bytes), path)
    back = read_archive(spark, path).select("record_id", "record_type", "refers_to", "payload", "payload_digest",
                                            "payload_length")
    back = back.mapInArrow(_verified, "record_id string, record_type string, refers_to string, "
                                      "payload_digest string, payload_bytes long")

    def page(col: str):
        return F.nullif(F.regexp_extract(col, "^urn:page:(-?[0-9]+)$", 1), F.lit("")).cast("long")

    return back.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       page("refers_to").alias("refers_to"))
