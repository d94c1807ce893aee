"""WARC archives as a PySpark Python data source named ``warc``.

Reading: the driver plans partitions from the archive files (a committed set's
manifest, else all ``.warc`` and ``.warc.gz`` files of the folder), several small
files to one partition. A task reads a record's headers first; predicates on
header columns (``=``, ``<=>``, ``IN``, comparisons, ``IS [NOT] NULL``) are pushed
into the source, and a record that fails one, or whose payload isn't wanted
(option ``payload``: ``keep``, ``skip`` or ``verify``), isn't decoded: compressed members
carry their length in the gzip header (the ``sl`` field of the WARC standard's annex),
so the reader goes on to the next one. ``verify`` decodes payloads, compares them
with their digests and drops them.

Writing: a task writes files of bounded size under names of its own and reports them;
the driver's commit writes the manifest, so files of lost or repeated tasks are never
read. A record is a response with its payload, or a revisit that refers to
the response with an equal payload.

Folders are named by URI and reached through Arrow's file systems, from the executors
too, so the archive folder must be a shared one.

Defined cases: a null or empty html is an empty payload; of equal payloads of at least
``min_bytes`` bytes the record with the greatest page id is the response (rows that
repeat that id are responses too); null page ids take no part and are responses; a null
url has no target header; an empty table gives an empty archive.
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
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from polyeval.llm.common import bounded_batches, utf8
from polyeval.session import scratch_path

SCHEMA = ("record_type string, record_id string, page_id long, target_uri string, date string, "
          "payload_digest string, payload_bytes long, refers_to long, payload binary")
HEADER_COLUMNS = ("record_type", "record_id", "page_id", "target_uri", "date", "payload_digest", "payload_bytes", "refers_to")
FILE_BYTES = 64 << 20  # a writer starts a new file beyond this
PARTITION_BYTES = 128 << 20  # small files share a partition up to this
MANIFEST = "_manifest.json"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEAD = 4096  # bytes decoded first; headers beyond them are decoded as needed
BATCH = 256


def _fs(uri: str) -> tuple[pafs.FileSystem, str]:
    fs, path = pafs.FileSystem.from_uri(uri)
    return fs, path.rstrip("/")


def record_id(page_id) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def _page(urn: str | None) -> int | None:
    return int(urn[10:-1]) if urn and urn.startswith("<urn:page:") else None


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode("ascii")


# ---------------------------------------------------------------- records

def render(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One response or revisit record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
             f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:  # as a URI it has neither spaces nor controls
        lines.append(f"WARC-Target-URI: {quote(url, safe=_URI)}")
    if revisit:
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines += [f"WARC-Payload-Length: {len(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_URI = "".join(chr(c) for c in range(0x21, 0x7F) if chr(c) != "%")


def member(record: bytes, level: int) -> bytes:
    """A gzip member that holds its own and the record's length."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    size = 10 + 2 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H", 12) + b"sl" + struct.pack("<HII", 8, size & 0xFFFFFFFF, len(record) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def parse_headers(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, sep, value = line.partition(":")
        if sep:
            out[name.strip().lower()] = value.strip()
    return out


def columns_of(h: dict[str, str]) -> dict:
    digest = h.get("warc-payload-digest")
    length = h.get("warc-payload-length")
    url = h.get("warc-target-uri")
    return {"record_type": h.get("warc-type"), "record_id": h.get("warc-record-id"), "page_id": _page(h.get("warc-record-id")),
            "target_uri": None if url is None else unquote(url), "date": h.get("warc-date"),
            "payload_digest": digest.removeprefix("sha1:") if digest else None,
            "payload_bytes": int(length) if length else None, "refers_to": _page(h.get("warc-refers-to"))}


def payload_of(block: bytes) -> bytes:
    """What follows the HTTP headers of a response block."""
    return block.partition(b"\r\n\r\n")[2]


class Reader:
    """Records of one archive file, headers first."""

    def __init__(self, file: pa.NativeFile, size: int):
        self.file, self.size = file, size

    def records(self) -> Iterator[tuple[dict[str, str], object]]:
        """(headers, function that decodes the block) of each record."""
        at = 0
        while at < self.size:
            start = self.file.read_at(min(HEAD, self.size - at), at)
            if not start:
                raise ValueError(f"the file ends before byte {self.size}")
            if start[:2] == b"\x1f\x8b":
                headers, block, at = self._member(start, at)
            else:
                headers, block, at = self._plain(start, at)
            if headers:
                yield headers, block

    def _plain(self, start: bytes, at: int):
        lead = len(start) - len(start.lstrip(b"\r\n"))
        if lead:
            return {}, None, at + lead
        while (end := start.find(b"\r\n\r\n")) < 0:
            if at + len(start) >= self.size:
                raise ValueError(f"a record's headers don't end, at byte {at}")
            start = self.file.read_at(min(2 * len(start), self.size - at), at)
        headers = parse_headers(start[:end])
        length, body = int(headers["content-length"]), at + end + 4
        return headers, lambda: self.file.read_at(length, body), body + length

    def _member(self, start: bytes, at: int):
        size = self._length(start)
        if not size:  # written elsewhere: the member's end shows only when it is decoded
            return self._unsized(at)
        skip = 12 + struct.unpack_from("<H", start, 10)[0]

        def whole(n: int = 0) -> bytes:
            return zlib.decompressobj(-15).decompress(self.file.read_at(size, at)[skip:-8], n)

        text = zlib.decompressobj(-15).decompress(start[skip:size], HEAD)
        n = HEAD
        while (end := text.find(b"\r\n\r\n")) < 0:
            n *= 4
            longer = whole(n)
            if len(longer) <= len(text):
                raise ValueError(f"a record's headers don't end, at byte {at}")
            text = longer
        headers = parse_headers(text[:end])
        return headers, lambda: whole()[end + 4:end + 4 + int(headers["content-length"])], at + size

    @staticmethod
    def _length(start: bytes) -> int:
        if len(start) < 24 or not start[3] & 4:
            return 0
        extra = start[12:12 + struct.unpack_from("<H", start, 10)[0]]
        while len(extra) >= 4:
            n = struct.unpack_from("<H", extra, 2)[0]
            if extra[:2] == b"sl" and n >= 4:
                return struct.unpack_from("<I", extra, 4)[0]
            extra = extra[4 + n:]
        return 0

    def _unsized(self, at: int):
        decoder, parts, end = zlib.decompressobj(31), [], at
        while not decoder.eof and end < self.size:
            piece = self.file.read_at(min(1 << 16, self.size - end), end)
            if not piece:
                raise ValueError(f"the file ends within a record, at byte {end}")
            parts.append(decoder.decompress(piece))
            end += len(piece) - len(decoder.unused_data)
        text = b"".join(parts)
        head, _, block = text.partition(b"\r\n\r\n")
        headers = parse_headers(head)
        return headers, lambda: block[:int(headers["content-length"])], end


# ---------------------------------------------------------------- data source

_ORDER = {ds.GreaterThan: lambda a, b: a > b, ds.GreaterThanOrEqual: lambda a, b: a >= b,
          ds.LessThan: lambda a, b: a < b, ds.LessThanOrEqual: lambda a, b: a <= b}


def _passes(f: ds.Filter, row: dict) -> bool:
    value = row[f.attribute[0]]
    if isinstance(f, ds.IsNull):
        return value is None
    if isinstance(f, ds.EqualNullSafe):
        return value == f.value
    if value is None:
        return False
    if isinstance(f, ds.IsNotNull):
        return True
    if isinstance(f, ds.In):
        return value in f.value
    if isinstance(f, ds.EqualTo):
        return value == f.value
    return _ORDER[type(f)](value, f.value)


@dataclass
class Files(ds.InputPartition):
    files: list


@dataclass
class Written(ds.WriterCommitMessage):
    files: list
    records: int


class WarcReader(ds.DataSourceReader):
    def __init__(self, path: str, payload: str):
        self.path, self.payload = path, payload
        self.filters: list[ds.Filter] = []

    def pushFilters(self, filters):
        known = (ds.EqualTo, ds.EqualNullSafe, ds.In, ds.IsNull, ds.IsNotNull, *_ORDER)
        for f in filters:
            if isinstance(f, known) and len(f.attribute) == 1 and f.attribute[0] in HEADER_COLUMNS:
                self.filters.append(f)
            else:
                yield f

    def partitions(self):
        fs, path = _fs(self.path)
        info = fs.get_file_info(f"{path}/{MANIFEST}")
        if info.type == pafs.FileType.File:
            with fs.open_input_stream(info.path) as f:
                files = json.loads(f.read())["files"]
        else:
            found = fs.get_file_info(pafs.FileSelector(path))
            files = [[x.base_name, x.size] for x in found if x.base_name.endswith((".warc", ".warc.gz"))]
        out, held = [], 0
        for name, size in sorted(files):
            if not out or held + size > PARTITION_BYTES:
                out.append(Files([]))
                held = 0
            out[-1].files.append((name, size))
            held += size
        return out or [Files([])]

    def read(self, partition):
        fs, path = _fs(self.path)
        rows: list[dict] = []
        for name, size in partition.files:
            with fs.open_input_file(f"{path}/{name}") as f:
                for headers, block in Reader(f, size).records():
                    row = columns_of(headers)
                    if not all(_passes(x, row) for x in self.filters):
                        continue
                    row["payload"] = None
                    if self.payload != "skip" and row["record_type"] == "response":
                        body = payload_of(block())
                        if self.payload == "keep":
                            row["payload"] = body
                        elif base32(hashlib.sha1(body).digest()) != row["payload_digest"] or len(body) != row["payload_bytes"]:
                            raise ValueError(f"{name}: the payload of {row['record_id']} doesn't match its digest")
                    rows.append(row)
                    if len(rows) >= BATCH:
                        yield _batch(rows)
                        rows = []
        if rows:
            yield _batch(rows)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}
    return pa.RecordBatch.from_pydict({c: pa.array([r[c] for r in rows], kinds.get(c, pa.string()))
                                       for c in (*HEADER_COLUMNS, "payload")})


class WarcWriter(ds.DataSourceArrowWriter):
    """Rows: page_id, url, payload, digest (hexadecimal SHA-1), refers_to."""

    def __init__(self, path: str, level: int):
        self.path, self.level = path, level

    def write(self, iterator):
        fs, path = _fs(self.path)
        suffix = ".warc.gz" if self.level else ".warc"
        pack = (lambda r: member(r, self.level)) if self.level else (lambda r: r)
        files, out, size, records = [], None, 0, 0
        for b in iterator:
            for page_id, url, payload, digest, refers_to in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to"))):
                if out is None:
                    name, size = f"part-{uuid.uuid4().hex}{suffix}", 0
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                data = pack(render(page_id, url, payload, base32(bytes.fromhex(digest)), refers_to))
                out.write(data)
                size += len(data)
                records += 1
                if size >= FILE_BYTES:
                    out.close()
                    files.append([name, size])
                    out = None
        if out is not None:
            out.close()
            files.append([name, size])
        return Written(files, records)

    def commit(self, messages):
        fs, path = _fs(self.path)
        done = [m for m in messages if m is not None]
        with fs.open_output_stream(f"{path}/{MANIFEST}") as f:
            f.write(json.dumps({"files": sorted(x for m in done for x in m.files), "records": sum(m.records for m in done)}).encode())

    def abort(self, messages):
        fs, path = _fs(self.path)
        for m in messages:
            for name, _ in m.files if m is not None else ():
                fs.delete_file(f"{path}/{name}")


class WarcDataSource(ds.DataSource):
    """``spark.read.format("warc").load(folder)``; options ``payload`` (reading) and
    ``level`` (writing; gzip level, 0: not compressed)."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options["path"], self.options.get("payload", "keep"))

    def writer(self, schema, overwrite):
        fs, path = _fs(self.options["path"])
        fs.create_dir(path, recursive=True)
        return WarcWriter(self.options["path"], int(self.options.get("level", "1")))


def register(spark) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


# ---------------------------------------------------------------- pages

def with_revisits(df: DataFrame, id_col: str, url_col: str, html_col: str, min_bytes: int) -> DataFrame:
    """The rows to write. Payload digests decide who refers to whom, so only ids and
    digests are grouped, and payloads are joined by page id."""
    pages = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), utf8(html_col).alias("payload"))
    pages = pages.withColumn("digest", F.sha1("payload"))
    ids = pages.where("page_id is not null").select("page_id", "digest", F.length("payload").alias("n"))
    ids = ids.where(F.col("n") >= min_bytes).select("page_id", "digest")
    kept = ids.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least")).where("least < refers_to").drop("least")
    revisits = ids.join(kept, "digest").where("page_id < refers_to").distinct()
    return pages.join(revisits, ["page_id", "digest"], "left")


def write_pages(df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                min_bytes: int = 0, level: int = 1) -> None:
    register(df.sparkSession)
    bounded_batches(df.sparkSession)
    rows = with_revisits(df, id_col, url_col, html_col, min_bytes).select("page_id", "url", "payload", "digest", "refers_to")
    rows.write.format("warc").mode("append").option("level", str(level)).save(path)


def read_records(spark, path: str, payload: str = "keep") -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", payload).load(path)


def round_trip(df: DataFrame) -> DataFrame:
    """Pages written to an archive in the shared folder, and what is read back."""
    spark = df.sparkSession
    path = scratch_path(spark, "warc")
    write_pages(df, path)
    back = read_records(spark, path, "verify").where(F.col("record_type").isin("response", "revisit"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
