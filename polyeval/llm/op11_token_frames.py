"""Token ids in seekable zstandard files, as a PySpark data source named ``token_frames``.

A file is a run of independent zstandard frames whose contents, one after another, are the
ids of consecutive documents (unsigned, little-endian, 2 or 4 bytes); any zstandard
tool decodes it to that flat array. A frame ends at a document's end where it can: only a
document longer than a frame is cut. Two skippable frames follow: the documents' ids and
token counts, then the published seek table of the zstandard seekable format (per frame its
compressed and decompressed size and the low 32 bits of the XXH64 of its content; number of
frames, flags and the magic number at the very end). So a reader fetches the tail,
finds which frames hold the documents that it wants, fetches and decodes those alone, and checks
each against its checksum.

Writing: texts are encoded where they lie and written as a table in the shared checkpoint folder,
so that neither sampling for ranges nor a lost task encodes them again. That table
is dealt by ranges of (id, hash of the text, row), so one id, or null, on a third of all rows spans
several tasks, and each task writes files of bounded size in order. The driver's commit
orders the files, gives each the number of ids before it and writes the manifest; files of
lost or repeated tasks are never read.

Reading: the driver plans partitions from the manifest and leaves out files whose range of
ids fails a pushed predicate (``=``, ``<=>``, ``IN``, comparisons, ``IS [NOT] NULL`` on the id); a task
leaves out documents and so frames. Option ``ids``: ``skip`` decodes no frame.

Folders are named by URI and reached through Arrow's file systems, from the executors too, so the
folder must be a shared one.

Defined cases: a null or empty text is the end id alone; null ids come first; of equal ids the
order is that of the texts' hashes, and each row is a document; an id that isn't an integer
is cast to one; an empty table gives a manifest without files; other columns are not read.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from polyeval.llm.common import bounded_batches, utf8
from polyeval.llm.components import written
from polyeval.llm.op2_bpe import byte_symbols, read_file
from polyeval.session import scratch_path

END_ID = 2
FRAME_BYTES = 1 << 20  # decoded bytes of a frame
FILE_BYTES = 256 << 20  # decoded bytes after which a writer starts a new file
FILE_DOCUMENTS = 1 << 20
PARTITION_BYTES = 64 << 20  # small files share a partition up to this
BATCH_BYTES = 8 << 20  # ids that a reader gives to Spark at once
MANIFEST = "_manifest.json"
MAX_ENTRIES = 500_000  # words and pieces of a worker's table (some 90 MB); the table before it is kept too

# FIXED VALUES of the published zstandard formats.
SKIPPABLE = 0x184D2A50  # to 0x184D2A5F
SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
WITH_CHECKSUMS = 0x80


# ---------------------------------------------------------------- token ids

class Words:
    """Token ids of texts, packed in ``width`` bytes, kept by word in bounded tables.

    Under a tokenizer file of the known form (``RULES``) no token spans white space, and a word of
    Latin-1 letters, ASCII digits and signs splits by its pattern; the merges of such a piece are then
    asked for directly. All other words go to the tokenizer whole, and under a file of any other form
    whole texts do. A full table becomes the older one, from which words that come again are taken back.
    """

    RULES = {"normalizers": ["NFC", "Replace", "Lowercase"],
             "pattern": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
    plain = re.compile("[!-~À-ÖØ-öø-ÿ]+")
    split = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")

    def __init__(self, file: bytes, width: int):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(file.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(file)
        self.kind = {2: "H", 4: "I"}[width]
        self.specials = [x["content"].encode() for x in spec.get("added_tokens", [])]
        self.by_word = self._known_form(spec)
        self.symbols = {b: c for c, b in byte_symbols().items()}
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    @classmethod
    def _known_form(cls, spec: dict) -> bool:
        normalizer, before = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
        steps = before.get("pretokenizers", [])
        return ([x["type"] for x in normalizer.get("normalizers", [])] == cls.RULES["normalizers"]
                and normalizer["normalizers"][1].get("pattern") == {"Regex": r"\s+"} and normalizer["normalizers"][1].get("content") == " "
                and [x["type"] for x in steps] == ["Split", "ByteLevel"] and steps[0].get("pattern") == {"Regex": cls.RULES["pattern"]}
                and steps[0].get("behavior") == "Removed" and steps[0].get("invert") is True
                and steps[1].get("add_prefix_space") is False and steps[1].get("use_regex") is False
                and spec.get("post_processor") is None and all(x["special"] and not x["normalized"] and not x["lstrip"] and not x["rstrip"]
                                                               and not x["single_word"] and " " not in x["content"] for x in spec.get("added_tokens", [])))

    def _packed(self, ids: list[int]) -> bytes:
        return array(self.kind, ids).tobytes()

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [self._packed(e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _learn(self, new: set[bytes]) -> None:
        words, whole = self.words, []
        known, older = words.get, self.older.get
        tokenize, packed = self.tokenizer.model.tokenize, self._packed
        for word in new:
            ids = older(word)
            if ids is None:
                if word.isalpha():  # ASCII letters, as bytes
                    ids = packed([t.id for t in tokenize(word.decode().lower())])
                else:
                    text = word.decode("utf-8", "replace")
                    if not self.plain.fullmatch(text) or any(s in word for s in self.specials):
                        whole.append((word, text))
                        continue
                    pieces = []
                    for piece in self.split.findall(text.lower()):
                        key = piece.encode()  # a piece is a word too
                        own = known(key) or older(key)
                        if own is None:
                            symbols = piece if piece.isascii() else key.decode("latin-1").translate(self.symbols)
                            own = words[key] = packed([t.id for t in tokenize(symbols)])
                        pieces.append(own)
                    ids = pieces[0] if len(pieces) == 1 else b"".join(pieces)
            words[word] = ids
        for (word, _), ids in zip(whole, self._whole([x for _, x in whole])):
            words[word] = ids

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_word:
            return self._whole([x.decode("utf-8", "replace") for x in texts])
        # Lower case is the tokenizer's own rule; special tokens are found before it.
        split = [(x if any(s in x for s in self.specials) else x.lower()).split() for x in texts]
        used = set().union(*split)
        if len(self.words) + len(missing := used.difference(self.words)) > MAX_ENTRIES:
            self.older, self.words, missing = self.words, {}, used
        self._learn(missing)
        known = self.words
        return [b"".join([known[w] for w in ws]) for ws in split]


@lru_cache(maxsize=2)
def words(file: bytes, width: int) -> Words:
    return Words(file, width)


def tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> tuple[DataFrame, int]:
    """doc_id, order (hash of the text), row, ids (packed, with the end id); and the bytes of an id."""
    bounded_batches(df.sparkSession)
    data = read_file(path)
    spec = json.loads(data)
    most = max([end_id, *spec["model"]["vocab"].values(), *(x["id"] for x in spec.get("added_tokens", []))])
    width = 2 if most < 1 << 16 else 4
    file = df.sparkSession.sparkContext.broadcast(data)
    end = end_id.to_bytes(width, "little")
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(utf8(text_col)).alias("order"),
                    F.monotonically_increasing_id().alias("row"), utf8(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = words(file.value, width)
        for b in batches:
            ids = [x + end for x in codec.encode(b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(ids, pa.binary())], ["doc_id", "order", "row", "ids"])

    return src.mapInArrow(run, "doc_id long, order long, row long, ids binary"), width


# ---------------------------------------------------------------- files

def checksum(content: bytes) -> int:
    return xxhash.xxh64_intdigest(content) & 0xFFFFFFFF


class FrameWriter:
    """Writes documents, in the order given, to one file."""

    def __init__(self, out, width: int, level: int = 3, frame_bytes: int = FRAME_BYTES):
        self.out, self.width = out, width
        self.frame_bytes = frame_bytes - frame_bytes % width
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.frame = bytearray()
        self.seek: list[tuple[int, int, int]] = []
        self.keys: list[int | None] = []
        self.counts = array("Q")
        self.tokens = self.size = 0

    @property
    def decoded(self) -> int:
        return self.tokens * self.width

    def add(self, key: int | None, ids: bytes) -> None:
        if self.frame and len(self.frame) + len(ids) > self.frame_bytes:
            self._flush()
        self.keys.append(key)
        self.counts.append(len(ids) // self.width)
        self.tokens += len(ids) // self.width
        at = 0
        while len(ids) - at > self.frame_bytes:
            self._write(ids[at:at + self.frame_bytes])
            at += self.frame_bytes
        self.frame += ids[at:] if at else ids

    def _flush(self) -> None:
        if self.frame:
            self._write(bytes(self.frame))
            self.frame.clear()

    def _write(self, content: bytes) -> None:
        data = self.compressor.compress(content)
        self.out.write(data)
        self.size += len(data)
        self.seek.append((len(data), len(content), checksum(content)))

    def close(self) -> None:
        self._flush()
        nulls = sum(k is None for k in self.keys)
        keys = np.array([0 if k is None else k for k in self.keys], dtype="<i8")
        body = zstandard.ZstdCompressor(level=3, write_checksum=True).compress(
            struct.pack("<QQI", len(keys), nulls, self.width) + keys.tobytes() + np.array(self.counts, dtype="<u8").tobytes())
        self.seek.append((8 + len(body), 0, checksum(b"")))  # the documents' frame decodes to nothing
        self.out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        table = b"".join(struct.pack("<III", *x) for x in self.seek) + struct.pack("<IBI", len(self.seek), WITH_CHECKSUMS, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SEEK_TABLE, len(table)) + table)
        self.size += 8 + len(body) + 8 + len(table)


class FrameReader:
    """Documents of one file, by its seek table. ``read_at(n, offset)`` gives bytes of the file."""

    def __init__(self, read_at, size: int, name: str = "the file"):
        self.read_at, self.name = read_at, name
        frames, flags, magic = struct.unpack("<IBI", read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC or not flags & WITH_CHECKSUMS:
            raise ValueError(f"{name} has no seek table with checksums at its end")
        table = np.frombuffer(read_at(12 * frames, size - 9 - 12 * frames), dtype="<u4").reshape(-1, 3).astype(np.int64)
        starts = np.cumsum(table[:, 0]) - table[:, 0]
        raw = read_at(int(table[-1, 0]), int(starts[-1]))
        if struct.unpack("<I", raw[:4])[0] != SKIPPABLE:
            raise ValueError(f"{name} has no table of documents before its seek table")
        index = zstandard.ZstdDecompressor().decompress(raw[8:])  # checked by its own checksum
        n, nulls, self.width = struct.unpack_from("<QQI", index)
        self.keys = np.frombuffer(index, dtype="<i8", count=n, offset=20)
        self.null = np.arange(n) < nulls  # null ids come first
        self.counts = np.frombuffer(index, dtype="<u8", count=n, offset=20 + 8 * n).astype(np.int64)
        self.starts = np.cumsum(self.counts) - self.counts  # in tokens
        self.at, self.sizes, self.sums = starts[:-1], table[:-1, 0], table[:-1, 2]
        self.ends = np.cumsum(table[:-1, 1])  # in decoded bytes
        self.decoded = 0  # frames decoded so far
        self._last: tuple[int, bytes] = (-1, b"")

    def _frame(self, i: int) -> bytes:
        if self._last[0] != i:
            content = zstandard.ZstdDecompressor().decompress(self.read_at(int(self.sizes[i]), int(self.at[i])))
            if checksum(content) != self.sums[i]:
                raise ValueError(f"{self.name}: frame {i} doesn't match its checksum")
            self.decoded += 1
            self._last = (i, content)
        return self._last[1]

    def ids(self, document: int) -> bytes:
        """The packed ids of a document; asked for in order, each frame is decoded once."""
        begin = int(self.starts[document]) * self.width
        end = begin + int(self.counts[document]) * self.width
        i, parts = int(np.searchsorted(self.ends, begin, side="right")), []
        while begin < end:
            stop, content = int(self.ends[i]), self._frame(i)
            base = stop - len(content)
            parts.append(content[begin - base:min(end, stop) - base])
            begin, i = stop, i + 1
        return parts[0] if len(parts) == 1 else b"".join(parts)


# ---------------------------------------------------------------- data source

def _fs(uri: str) -> tuple[pafs.FileSystem, str]:
    fs, path = pafs.FileSystem.from_uri(uri)
    return fs, path.rstrip("/")


def passes(f: ds.Filter, keys: np.ndarray, null: np.ndarray) -> np.ndarray:
    """Which of the ids a pushed predicate accepts."""
    if isinstance(f, ds.IsNull) or isinstance(f, ds.EqualNullSafe) and f.value is None:
        return null
    if isinstance(f, ds.IsNotNull):
        return ~null
    if isinstance(f, ds.In):
        return ~null & np.isin(keys, np.array([v for v in f.value if v is not None], dtype=np.int64))
    holds = {ds.EqualTo: np.equal, ds.EqualNullSafe: np.equal, ds.GreaterThan: np.greater, ds.GreaterThanOrEqual: np.greater_equal,
             ds.LessThan: np.less, ds.LessThanOrEqual: np.less_equal}[type(f)]
    return ~null & holds(keys, f.value)


def may_hold(f: ds.Filter, file: dict) -> bool:
    """Whether a file can have ids that a predicate accepts, by its least and greatest."""
    some, nulls, least, most = file["documents"] > file["nulls"], file["nulls"] > 0, file["first"], file["last"]
    if isinstance(f, ds.IsNull) or isinstance(f, ds.EqualNullSafe) and f.value is None:
        return nulls
    if not some or isinstance(f, ds.IsNotNull):
        return some
    if isinstance(f, ds.In):
        return any(v is not None and least <= v <= most for v in f.value)
    if isinstance(f, (ds.GreaterThan, ds.GreaterThanOrEqual)):
        return bool(passes(f, np.array([most]), np.array([False]))[0])
    if isinstance(f, (ds.LessThan, ds.LessThanOrEqual)):
        return bool(passes(f, np.array([least]), np.array([False]))[0])
    return least <= f.value <= most


@dataclass
class Files(ds.InputPartition):
    files: list


@dataclass
class Written(ds.WriterCommitMessage):
    task: int
    files: list


class TokenReader(ds.DataSourceReader):
    KNOWN = (ds.EqualTo, ds.EqualNullSafe, ds.In, ds.IsNull, ds.IsNotNull, ds.GreaterThan, ds.GreaterThanOrEqual, ds.LessThan, ds.LessThanOrEqual)

    def __init__(self, path: str, with_ids: bool):
        self.path, self.with_ids = path, with_ids
        self.filters: list[ds.Filter] = []

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, self.KNOWN) and f.attribute == ("doc_id",):
                self.filters.append(f)
            else:
                yield f

    def partitions(self):
        fs, path = _fs(self.path)
        with fs.open_input_stream(f"{path}/{MANIFEST}") as f:
            files = json.loads(f.read())["files"]
        out, held = [], 0
        for x in files:
            if all(may_hold(f, x) for f in self.filters):
                if not out or held + x["bytes"] > PARTITION_BYTES:
                    out.append(Files([]))
                    held = 0
                out[-1].files.append((x["name"], x["bytes"], x["start"]))
                held += x["bytes"]
        return out or [Files([])]

    def read(self, partition):
        fs, path = _fs(self.path)
        for name, size, start in partition.files:
            with fs.open_input_file(f"{path}/{name}") as f:
                reader = FrameReader(f.read_at, size, name)
                wanted = np.ones(len(reader.keys), dtype=bool)
                for p in self.filters:
                    wanted &= passes(p, reader.keys, reader.null)
                rows, held = [], 0
                for i in np.flatnonzero(wanted).tolist():
                    ids = None
                    if self.with_ids:
                        ids = np.frombuffer(reader.ids(i), dtype=f"<u{reader.width}").astype("<u4").tobytes()
                        held += len(ids)
                    rows.append((None if reader.null[i] else int(reader.keys[i]), start + int(reader.starts[i]), int(reader.counts[i]), ids))
                    if held >= BATCH_BYTES or len(rows) >= 4096:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                                      ["doc_id", "start", "n_tokens", "ids"])


class TokenWriter(ds.DataSourceArrowWriter):
    """Rows in ascending order of ids: doc_id, ids (packed)."""

    def __init__(self, path: str, width: int, level: int):
        self.path, self.width, self.level = path, width, level

    def write(self, iterator):
        fs, path = _fs(self.path)
        task, files, out, w = TaskContext.get().partitionId(), [], None, None

        def close():
            w.close()
            out.close()
            known = [k for k in (w.keys[0], w.keys[-1], *(k for k in w.keys if k is not None)) if k is not None]
            files.append({"name": name, "bytes": w.size, "documents": len(w.keys), "nulls": sum(k is None for k in w.keys), "tokens": w.tokens,
                          "first": min(known, default=None), "last": max(known, default=None)})

        for b in iterator:
            for key, ids in zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist()):
                if w is None:
                    name = f"part-{task:06d}-{uuid.uuid4().hex}.zst"
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                    w = FrameWriter(out, self.width, self.level)
                w.add(key, ids)
                if w.decoded >= FILE_BYTES or len(w.keys) >= FILE_DOCUMENTS:
                    close()
                    w = None
        if w is not None:
            close()
        return Written(task, files)

    def commit(self, messages):
        fs, path = _fs(self.path)
        files = [f for m in sorted((m for m in messages if m is not None), key=lambda m: m.task) for f in m.files]
        start = 0
        for f in files:
            f["start"] = start
            start += f["tokens"]
        with fs.open_output_stream(f"{path}/{MANIFEST}") as f:
            f.write(json.dumps({"width": self.width, "tokens": start, "files": files}).encode())

    def abort(self, messages):
        fs, path = _fs(self.path)
        for m in messages:
            for f in m.files if m is not None else ():
                fs.delete_file(f"{path}/{f['name']}")


class TokenFramesDataSource(ds.DataSource):
    """``spark.read.format("token_frames").load(folder)``; options ``ids`` (``keep`` or ``skip``, reading),
    ``width`` and ``level`` (writing)."""

    @classmethod
    def name(cls):
        return "token_frames"

    def schema(self):
        return "doc_id long, start long, n_tokens long, ids binary"

    def reader(self, schema):
        return TokenReader(self.options["path"], self.options.get("ids", "keep") != "skip")

    def writer(self, schema, overwrite):
        fs, path = _fs(self.options["path"])
        fs.create_dir(path, recursive=True)
        return TokenWriter(self.options["path"], int(self.options.get("width", "4")), int(self.options.get("level", "3")))


def register(spark) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TokenFramesDataSource)


# ---------------------------------------------------------------- documents

def write_tokens(df: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
                 level: int = 3) -> None:
    """Texts as token ids, in ascending order of ids, to a folder."""
    spark = df.sparkSession
    register(spark)
    encoded, width = tokens(df, tokenizer, id_col, text_col, end_id)
    keys = ["doc_id", "order", "row"]
    ranged = written(encoded, "tokens").repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged.select("doc_id", "ids").write.format("token_frames").mode("append").option("width", str(width)).option("level", str(level)).save(path)


def read_documents(spark, path: str, ids: str = "keep") -> DataFrame:
    """doc_id, start (ids before it in the whole set), n_tokens, ids (little-endian unsigned 32-bit)."""
    register(spark)
    return spark.read.format("token_frames").option("ids", ids).load(path)


def round_trip(df: DataFrame, tokenizer: str) -> DataFrame:
    """Documents written to files in the shared folder, and what is read back."""
    path = scratch_path(df.sparkSession, "token-frames")
    write_tokens(df, path, tokenizer)
    return read_documents(df.sparkSession, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
