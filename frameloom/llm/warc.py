"""WARC archives as a PySpark data source, and an archive of pages with revisit records.

Writing: each task writes files of about `roll` compressed bytes, a gzip member per record, whose header has the
skip lengths (extra field "sl"); commit moves the files of successful tasks into place. Reading: a partition per file;
equality and IN filters on record type and header columns are pushed down; a record's headers are inflated first, and
a record that no filter wants is skipped by its length without inflating its payload. Archives without skip lengths,
and plain ones, are read too.

Defined cases of `archive_pages`: null html is an empty payload, null url leaves out the target header; a null id never
is a group's largest, repeated rows with the largest id are all responses; an empty table gives an empty archive and
an empty result; control characters in a url are percent-encoded; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage

from .common import fresh_path, keep

SCHEMA = "warc_type string, record_id string, target_uri string, warc_date string, refers_to string, payload_digest string, payload_bytes long, payload binary"
HEADERS = {"warc_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "warc_date": "WARC-Date", "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest"}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
ARROW = pa.schema([(c, pa.int64() if c == "payload_bytes" else pa.binary() if c == "payload" else pa.string()) for c in COLUMNS])
HEAD = 2048  # compressed bytes that are read for the headers


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """Of a URI that the workers can reach (file, hdfs, s3, gs) or an absolute path."""
    return pafs.FileSystem.from_uri(path)


def clean(value: str) -> str:
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def member(data: bytes, level: int) -> bytes:
    """A gzip member whose extra field holds its compressed and plain length."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    size = 12 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\x03" + struct.pack("<H", 12) + b"sl" + struct.pack("<HII", 8, size & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def record(row: dict) -> bytes:
    payload = row["payload"] or b""
    size = row["payload_bytes"] if row["payload_bytes"] is not None else len(payload)
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    if row["warc_type"] != "revisit":
        block += payload
    lines = [f"{HEADERS[c]}: {clean(row[c]) if c == 'target_uri' else row[c]}" for c in HEADERS if row[c] is not None]
    lines += [f"WARC-Profile: {PROFILE}"] * (row["warc_type"] == "revisit")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_head(data: bytes) -> tuple[dict[str, str], int] | None:
    """Header fields by lower-case name, and where the block starts; None if the headers aren't whole yet."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in data[:end].decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, end + 4


def row_of(fields: dict[str, str], block: bytes, verify: bool) -> dict:
    row = {c: fields.get(h.lower()) for c, h in HEADERS.items()} | {"payload": None, "payload_bytes": None}
    if row["payload_digest"]:
        row["payload_digest"] = row["payload_digest"].removeprefix("sha1:")
    http = fields.get("content-type", "").startswith("application/http")
    cut = block.find(b"\r\n\r\n") + 4 if http else 0
    length = [x.split(b":")[1] for x in block[:cut].split(b"\r\n") if x.lower().startswith(b"content-length:")]
    if row["warc_type"] == "revisit":
        row["payload_bytes"] = int(length[0]) if length else None
        return row
    row["payload"] = block[cut:]
    row["payload_bytes"] = len(row["payload"])
    if verify and row["payload_digest"]:
        got = base64.b32encode(hashlib.sha1(row["payload"]).digest()).decode()
        if got != row["payload_digest"]:
            raise ValueError(f"payload of {row['record_id']} has digest {got}, not {row['payload_digest']}")
    return row


def records(f, wanted, verify: bool = True, skipped: list[int] | None = None) -> Iterator[dict]:
    """The records of an open archive that `wanted` (of the header fields) accepts."""
    while True:
        at = f.tell()
        magic = f.read(2)
        if len(magic) < 2:
            return
        if magic == b"\x1f\x8b":
            head = magic + f.read(10)
            size = None
            if head[3] & 4:
                extra = f.read(struct.unpack("<H", head[10:12])[0])
                i = 0
                while i + 4 <= len(extra):
                    n = struct.unpack("<H", extra[i + 2 : i + 4])[0]
                    if extra[i : i + 2] == b"sl" and n == 8:
                        size = struct.unpack("<I", extra[i + 4 : i + 8])[0]
                    i += 4 + n
            f.seek(at)
            z = zlib.decompressobj(31)
            raw = f.read(min(HEAD, size) if size else HEAD)
            data, found = z.decompress(raw), None
            while (found := parse_head(data)) is None and not z.eof:
                more = f.read(HEAD)
                if not more:
                    raise ValueError(f"record at byte {at} ends within its headers")
                data += z.decompress(more)
            fields, start = found
            take = wanted(fields)
            if not take and size:
                f.seek(at + size)
                if skipped is not None:
                    skipped.append(size)
                continue
            parts = [data]
            while not z.eof:
                more = f.read(min(1 << 20, size - (f.tell() - at)) if size else 1 << 16)
                if not more:
                    raise ValueError(f"record at byte {at} ends within its block")
                parts.append(z.decompress(more))
            f.seek(f.tell() - len(z.unused_data))
            data = b"".join(parts)
            if take:
                yield row_of(fields, data[start : start + int(fields["content-length"])], verify)
        else:
            data = magic
            while (found := parse_head(data)) is None:
                more = f.read(HEAD)
                if not more:
                    return
                data += more
            fields, start = found
            size = int(fields["content-length"])
            if wanted(fields):
                f.seek(at + start)
                yield row_of(fields, f.read(size), verify)
            f.seek(at + start + size + 4)


@dataclass
class ArchivePart(InputPartition):
    path: str


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.verify = options.get("verify", "true").lower() == "true"
        self.batch = int(options.get("batchbytes", 16 << 20))
        self.filters: dict[str, set[str]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if isinstance(f, EqualTo) and name in HEADERS:
                values = {f.value}
            elif isinstance(f, In) and name in HEADERS:
                values = set(f.value)
            else:
                yield f
                continue
            self.filters[name] = self.filters.get(name, values) & values

    def partitions(self) -> list[ArchivePart]:
        fs, root = file_system(self.path)
        found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        names = sorted(x.path for x in found if x.is_file and x.base_name.endswith((".warc", ".warc.gz")))
        return [ArchivePart(n) for n in names]

    def wanted(self, fields: dict[str, str]) -> bool:
        return all(fields.get(HEADERS[c].lower(), "").removeprefix("sha1:" if c == "payload_digest" else "") in values for c, values in self.filters.items())

    def read(self, partition: ArchivePart) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        fs, _ = file_system(self.path)
        with fs.open_input_file(partition.path) as f:
            rows, size = [], 0
            for row in records(f, self.wanted, self.verify):
                rows.append(row)
                size += len(row["payload"] or b"") + 500
                if size >= self.batch:
                    yield pa.RecordBatch.from_pylist(rows, ARROW)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, ARROW)


class ArchiveWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.roll, self.level = int(options.get("roll", 64 << 20)), int(options.get("level", 5))
        self.stage = f"_stage-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = file_system(self.path)
        fs.create_dir(f"{root}/{self.stage}", recursive=True)
        files, out = [], None
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    files.append(f"{uuid.uuid4().hex}.warc.gz")
                    out = fs.open_output_stream(f"{root}/{self.stage}/{files[-1]}", compression=None)
                out.write(member(record(row), self.level))
                if out.tell() >= self.roll:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        if self.overwrite:
            for x in fs.get_file_info(pafs.FileSelector(root)):
                if x.is_file and x.base_name.endswith((".warc", ".warc.gz")):
                    fs.delete_file(x.path)
        for m in messages:
            for name in m.files if m else []:
                fs.move(f"{root}/{self.stage}/{name}", f"{root}/{name}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = file_system(self.path)
        if fs.get_file_info(f"{root}/{self.stage}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/{self.stage}")


class WarcSource(DataSource):
    """Options: path; reading: verify (digests), batchbytes; writing: roll (bytes of a file), level (of gzip)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def base32(hex_digest: str) -> str:
    """SQL: upper-case base32 of 40 hexadecimal digits, from groups of 20 bits."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    return f"""array_join(transform(sequence(0, 31), i -> substr('{letters}', 1 + cast(
      shiftright(cast(conv(substr({hex_digest}, 1 + 5 * cast(i div 4 AS int), 5), 16, 10) AS int), 15 - 5 * (i % 4)) & 31 AS int), 1)), '')"""


def archive_pages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", least: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write a record per page. Of pages with equal payloads of at least `least` bytes the one with the largest id is the
    response, and the others revisit it."""
    register(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(body_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    same = rows.where(F.octet_length("payload") >= least).groupBy("sha").agg(F.count("*").alias("n"), F.max("id").alias("kept_id")).where("n > 1 AND kept_id IS NOT NULL")
    rows = rows.join(keep(same.select("sha", "kept_id"), "same"), "sha", "left")
    again = F.col("kept_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("kept_id"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    rows.select(
        F.when(again, "revisit").otherwise("response").alias("warc_type"),
        name("id").alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("warc_date"),
        F.when(again, name("kept_id")).alias("refers_to"),
        F.concat(F.lit("sha1:"), F.expr(base32("sha"))).alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(~again, F.col("payload")).alias("payload"),
    ).write.format("warc").mode("append").save(path)


def read_archives(spark: SparkSession, path: str, **options) -> DataFrame:
    register(spark)
    return spark.read.format("warc").options(**options).load(path)


def query(spark, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "archives")
    archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, 'urn:page:([0-9-]+)', 1) AS long)")
    back = read_archives(spark, path)
    size = F.coalesce(F.octet_length("payload").cast("long"), F.col("payload_bytes"))
    return back.select(number("record_id").alias("page_id"), size.alias("payload_bytes"), "payload_digest", F.col("warc_type").alias("record_type"), number("refers_to").alias("refers_to"))


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, CAST(octet_length(body) AS BIGINT) AS payload_bytes, sha1(body) AS h FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS kept FROM d)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM g
"""
