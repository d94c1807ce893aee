"""Substring dedup: Rabin-Karp hashes of every fixed-length word window.

Every window of ``WINDOW`` words of every document is hashed with two rolling
polynomials: one gives the value that travels (64 bits), the other its bucket.
``exchange`` counts them over all documents; a window that also starts anywhere
else, in the same document or another, is repeated, whatever its document's
other windows are. A document's repeated windows merge into maximal removal
intervals, and what they cover goes.

The text is shuffled once, by chunks of neighbouring ids (both passes over it read
that shuffle); 8 bytes travel for a distinct window of a chunk, and one bit
back. Nothing is sampled or capped.

Defined cases: a null or empty text, or one with fewer words than a window,
has no windows and keeps its words; repeated rows are documents of their own, so
their windows are repeated; null ids are documents too; an empty table gives no
rows; other columns pass through ``remove_repeats`` unchanged, whatever their
names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyeval.llm import exchange as ex
from polyeval.llm.common import bounded_batches, mix64

WINDOW = 35
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class ChunkWindows:
    """A chunk's distinct windows, and which window starts where."""

    def __init__(self, words: list[list[bytes]], window: int, n_buckets: int):
        code = xxhash.xxh3_64_intdigest
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        codes = np.fromiter((code(w) for own in words for w in own), dtype=np.uint64, count=int(sizes.sum()))
        first = np.concatenate(([0], np.cumsum(sizes)))
        self.n = len(codes)
        value = mix64(ex.window_hash(codes, window))
        inside = np.zeros(self.n, dtype=bool)
        for a, b in zip(first[:-1], first[1:]):
            inside[a:max(a, b - window + 1)] = True
        self.starts = np.flatnonzero(inside[:len(value)])  # windows that stay in their document
        self.first = first
        self.values, at, self.which, self.counts = np.unique(
            value[self.starts], return_index=True, return_inverse=True, return_counts=True)
        other = mix64(ex.window_hash(codes, window, ex.second_base())[self.starts[at]])
        self.buckets = (other % np.uint64(n_buckets)).astype(np.int64)

    def covered(self, elsewhere: np.ndarray, window: int) -> np.ndarray:
        """Words that repeated windows cover; ``elsewhere``: of the distinct ones."""
        hit = self.starts[((self.counts > 1) | elsewhere)[self.which]]
        edge = np.zeros(self.n + 1, dtype=np.int64)
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + window, -1)
        return np.cumsum(edge[:-1]) > 0


def _words(group: pa.Table) -> list[list[bytes]]:
    return [x.split() for x in group["text"].to_pylist()]  # ASCII white space: 0x20, 0x09-0x0D


def intervals(covered: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of true entries."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(np.int8), [0]))))
    return list(zip(edge[0::2].tolist(), edge[1::2].tolist()))


def without(text: bytes, gone: list[tuple[int, int]], n_words: int) -> bytes:
    """The text less the words in the intervals; what is left keeps its layout."""
    at = [m.span() for m in _WORD.finditer(text)]
    edges = [0, *(x for span in gone for x in span), n_words]
    return b" ".join(text[at[i][0]:at[j - 1][1]] for i, j in zip(edges[0::2], edges[1::2]) if i < j)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   keep_columns: bool = False, keep_layout: bool = False) -> DataFrame:
    """One row per input row: id, n_words, n_removed, removed (word intervals,
    end exclusive), kept_text (the kept words joined by one space; with
    ``keep_layout``, by the white space that they had) and, with ``keep_columns``,
    the other columns as the struct ``rest``."""
    bounded_batches(df.sparkSession)
    n_buckets = ex.bucket_count(df.sparkSession)
    docs = ex.by_chunk(df, id_col, text_col, keep_columns)

    def send(group: pa.Table) -> pa.Table:
        c = ChunkWindows(_words(group), window, n_buckets)
        return ex.pack_sent(group["chunk"][0].as_py(), c.values, c.buckets, 8, ex.ANY)

    def finish(group: pa.Table, answered: pa.Table) -> pa.Table:
        if not group.num_rows:
            return empty
        words = _words(group)
        c = ChunkWindows(words, window, n_buckets)
        covered = c.covered(ex.unpack(ex.answered_bits(answered), c.buckets), window)
        removed, kept = [], []
        for text, own, a, b in zip(group["text"].to_pylist(), words, c.first[:-1], c.first[1:]):
            gone = intervals(covered[a:b])
            removed.append([{"start": i, "end": j} for i, j in gone])
            if keep_layout:
                kept.append(without(text, gone, len(own)) if gone else text)
                continue
            if gone:
                edges = [0, *(x for span in gone for x in span), len(own)]
                own = [w for i, j in zip(edges[0::2], edges[1::2]) for w in own[i:j]]
            kept.append(b" ".join(own))
        n = pa.array([len(w) for w in words], pa.int64())
        gone = pa.array([sum(s["end"] - s["start"] for s in r) for r in removed], pa.int64())
        out = {"id": group["id"], "n_words": n, "n_removed": gone, "removed": pa.array(removed, spans), "kept": pa.array(kept, pa.binary())}
        if "rest" in group.column_names:
            out["rest"] = group["rest"]
        return pa.table(out)

    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = f"id {fields['id']}, n_words long, n_removed long, removed array<struct<start:long,end:long>>, kept binary"
    if "rest" in fields:
        schema += f", rest {fields['rest']}"
    empty = ex.empty_table(schema)
    sent = docs.groupBy("chunk").applyInArrow(send, ex.SENT)
    done = docs.groupBy("chunk").cogroup(ex.answers(sent).groupBy("chunk")).applyInArrow(finish, schema)
    cols = [F.col("id").alias(id_col), "n_words", "n_removed", "removed", F.col("kept").cast("string").alias("kept_text")]
    return done.select(*cols, *(["rest"] if "rest" in fields else []))

