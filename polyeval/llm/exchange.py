"""Which hashes occur in other groups of documents, for any number of hashes.

Documents are dealt into chunks of neighbouring ids. A chunk sends each of its
distinct hashes once (so a passage that a third of all documents share costs
one entry a chunk), packed into one row for each bucket of the hash space. A
bucket's task sorts what it got and answers every chunk with one bit a hash. The
chunk recomputes its hashes in the same order, so no positions travel.

A bucket is chosen by bits that the packed value doesn't hold; both together tell
hashes apart. Buckets follow ``spark.sql.shuffle.partitions``, so that setting
bounds a task's memory as for any other shuffle.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from polyeval.llm.common import utf8

CHUNK_BITS = 7  # 128 neighbouring ids make a chunk

SENT = "bucket int, chunk long, width int, mode int, sent binary"
ANSWERED = "bucket int, chunk long, bits binary"
#: Answer modes: the hash is in another chunk; it is in a chunk that comes earlier;
#: earlier answers that a chunk keeps for its next pass, returned as they are.
ANY, EARLIER, KEPT = 0, 1, 2


def bucket_count(spark: SparkSession) -> int:
    """One for each shuffle partition: more would only cut a chunk's rows smaller."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def chunk_of(id_col: str, bits: int) -> Column:
    """Chunk of a row by its integer id, in the order of ids; null ids come first."""
    return F.coalesce(F.shiftright(F.col(id_col).cast("long"), bits), F.lit(-(1 << 62)))


def by_chunk(df: DataFrame, id_col: str, text_col: str, keep: bool = False, bits: int = CHUNK_BITS) -> DataFrame:
    """chunk, id, text as bytes, and (``keep``) the other columns as one struct."""
    rest = [F.col(c) for c in df.columns if c not in (id_col, text_col)]
    cols = [chunk_of(id_col, bits).alias("chunk"), F.col(id_col).alias("id"), utf8(text_col).alias("text")]
    if keep and rest:
        cols.append(F.struct(*rest).alias("rest"))
    return df.select(*cols)


def pack_sent(chunk: int, values: np.ndarray, buckets: np.ndarray, width: int, mode: int) -> pa.Table:
    """Rows of ``SENT`` for a chunk's distinct hashes; ``values`` are unsigned
    64-bit of which the low ``width`` bytes travel."""
    order, at, edges = bucket_order(buckets)
    raw = values[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    raw = np.ascontiguousarray(raw)
    sent = [raw[i:j].tobytes() for i, j in zip(edges, edges[1:])]
    n = len(at)
    return pa.table({"bucket": pa.array(at, pa.int32()), "chunk": pa.array([chunk] * n, pa.int64()),
                     "width": pa.array([width] * n, pa.int32()), "mode": pa.array([mode] * n, pa.int32()),
                     "sent": pa.array(sent, pa.binary())})


def bucket_order(buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the hashes as sent, the buckets that get any, and their bounds."""
    small = len(buckets) and int(buckets.max()) < 1 << 16  # numpy sorts these by radix
    order = np.argsort(buckets.astype(np.uint16) if small else buckets, kind="stable")
    sorted_ = buckets[order]
    edges = np.concatenate(([0], np.flatnonzero(np.diff(sorted_)) + 1, [len(order)])) if len(order) else np.zeros(1, np.int64)
    return order, sorted_[edges[:-1]], edges


def keep_answers(chunk: int, answered: dict[int, bytes], n_buckets: int) -> pa.Table:
    """A row of ``SENT`` with a chunk's answers so far."""
    return pa.table({"bucket": pa.array([chunk % n_buckets], pa.int32()), "chunk": pa.array([chunk], pa.int64()),
                     "width": pa.array([0], pa.int32()), "mode": pa.array([KEPT], pa.int32()),
                     "sent": pa.array([pickle.dumps(answered)], pa.binary())})


def answer(group: pa.Table) -> pa.Table:
    """A bucket's answers: a bit for each hash that it was sent."""
    kept = group.filter(pc.equal(group["mode"], KEPT))
    group = group.filter(pc.not_equal(group["mode"], KEPT)).sort_by("chunk")
    back = pa.table({"bucket": pa.array([-1] * kept.num_rows, pa.int32()), "chunk": kept["chunk"], "bits": kept["sent"]})
    return pa.concat_tables([back, _answer(group)]) if kept.num_rows else _answer(group)


def _answer(group: pa.Table) -> pa.Table:
    chunks = group["chunk"].to_pylist()
    blobs = group["sent"].to_pylist()
    if not blobs:
        return pa.table({"bucket": pa.array([], pa.int32()), "chunk": pa.array([], pa.int64()), "bits": pa.array([], pa.binary())})
    width, mode, bucket = group["width"][0].as_py(), group["mode"][0].as_py(), group["bucket"][0].as_py()
    raw = np.frombuffer(b"".join(blobs), dtype=np.uint8).reshape(-1, width)
    if width < 8:
        wide = np.zeros((len(raw), 8), dtype=np.uint8)
        wide[:, :width] = raw
    else:
        wide = raw
    values = wide.reshape(-1).view("<u8")
    order = np.argsort(values, kind="stable")  # equal hashes stay in the order of chunks
    same = np.diff(values[order]) == 0
    flags = np.zeros(len(values), dtype=bool)
    flags[order[1:]] = same
    if mode == ANY:
        flags[order[:-1]] |= same
    sizes = [len(b) // width for b in blobs]
    out_chunk, out_bits, at = [], [], 0
    for c, n in zip(chunks, sizes):
        own = flags[at:at + n]
        at += n
        if own.any():
            out_chunk.append(c)
            out_bits.append(np.packbits(own).tobytes())
    return pa.table({"bucket": pa.array([bucket] * len(out_chunk), pa.int32()), "chunk": pa.array(out_chunk, pa.int64()),
                     "bits": pa.array(out_bits, pa.binary())})


def answers(sent: DataFrame) -> DataFrame:
    return sent.groupBy("bucket").applyInArrow(answer, ANSWERED)


def unpack(answered: dict[int, bytes], buckets: np.ndarray) -> np.ndarray:
    """The answered bit of each of a chunk's hashes, in the order that it had
    before ``pack_sent``."""
    flags = np.zeros(len(buckets), dtype=bool)
    order, at, edges = bucket_order(buckets)
    for b, i, j in zip(at.tolist(), edges, edges[1:]):
        bits = answered.get(b)
        if bits is not None:
            flags[order[i:j]] = np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=j - i).astype(bool)
    return flags


def answered_bits(group: pa.Table) -> dict[int, bytes]:
    """A chunk's answers by bucket, those kept from earlier passes too."""
    out = {}
    for bucket, bits in zip(group["bucket"].to_pylist(), group["bits"].to_pylist()):
        if bucket < 0:
            out |= pickle.loads(bits)
        else:
            out[bucket] = bits
    return out


_POWER = np.uint64(0xD6E8FEB86659FD93)
_POWER2 = np.uint64(0xA0761D6478BD642F)
_STEP = 1 << 15  # windows hashed at once, so that the arrays stay in a core's cache
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of ``base`` and of its inverse mod 2^64 (it is odd)."""
    have = _TABLES.get(int(base))
    if have is None or len(have[0]) < n:
        have = _TABLES[int(base)] = tuple(
            np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, x, np.uint64))), dtype=np.uint64)
            for x in (int(base), pow(int(base), -1, 1 << 64)))
    return have


def window_hash(codes: np.ndarray, length: int, base: np.uint64 = _POWER) -> np.ndarray:
    """Rabin-Karp hashes (mod 2^64) of all windows of ``length`` codes: differences of
    running sums of codes by falling powers, raised to the window's own."""
    n = len(codes) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.empty(n, dtype=np.uint64)
    up, down = _powers(base, min(n, _STEP) + length)
    for a in range(0, n, _STEP):
        b = min(a + _STEP, n)
        part = codes[a:b + length - 1]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(part * down[:len(part)], out=sums[1:])
        np.subtract(sums[length:], sums[:-length], out=out[a:b])
        out[a:b] *= up[length - 1:length - 1 + b - a]
    return out


def second_base() -> np.uint64:
    return _POWER2


def empty_table(schema: str) -> pa.Table:
    """An Arrow table without rows, of a Spark schema."""
    return to_arrow_schema(StructType.fromDDL(schema)).empty_table()
