"""Suffix dedup by a depth-limited radix sort.

Suffixes of all texts (as bytes) are grouped through their first ``DEPTH`` bytes by
passes over digits; groups of one document end early, and the groups left after
the last digit are exactly the repeated windows.

A digit is a function of a suffix's first ``DEPTH`` bytes, so equal windows have
equal digits. The first digit is the window's anchor, its ``GRAM``-byte string
of least hash: neighbouring windows share it, so one entry travels for some
thirteen suffixes. Only suffixes whose anchor occurs in two documents go on; a text
that equals one with a smaller id is settled by its digest and goes on neither.
The second digit is the stretch of bytes that the neighbours of one anchor cover
(under twice ``DEPTH``): stretches that occur in an earlier document are settled, all
their suffixes at once, so copies of a passage send one entry for it. The last digit,
of the suffixes still open, is the whole window. So the passes need no order among
different groups, only which suffixes are equal, and hashes of digits say that.

A byte is removed if a window over it also starts in a document with a smaller id.
The text is shuffled once, by chunks of neighbouring ids, and the passes read that
shuffle; ``exchange`` moves the digits. Texts are worked through in small blocks, so
memory follows a chunk's bytes and not their number squared.

Defined cases: a null or empty text has no bytes; texts under ``DEPTH`` bytes keep
all; rows with the same id don't remove each other's bytes, whatever they hold;
null ids come before all others; an empty table gives no rows; other columns
aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyeval.llm import exchange as ex
from polyeval.llm.common import bounded_batches, mix64

DEPTH = 50
GRAM = 26
BLOCK = 1 << 15  # window starts worked on at once: their arrays stay in a core's cache
DIGIT_BYTES = 5  # of a first digit, beside its bucket
_INDEX = np.uint64((1 << 21) - 1)
_CODES = mix64(np.arange(1, 257, dtype=np.uint64))
NULL_ID = -(1 << 63)


class ChunkBytes:
    """The texts of a chunk, in the order of ids."""

    def __init__(self, group: pa.Table, depth: int, gram: int, n_buckets: int):
        order = np.argsort(np.array([NULL_ID if i is None else i for i in group["id"].to_pylist()], dtype=np.int64), kind="stable")
        texts = group["text"].to_pylist()
        ids = group["id"].to_pylist()
        self.depth, self.gram, self.n_buckets = depth, gram, n_buckets
        self.ids = [ids[i] for i in order]
        self.texts = [texts[i] for i in order]
        self.chunk = group["chunk"][0].as_py()
        self.rank = np.array([NULL_ID if i is None else i for i in self.ids], dtype=np.int64)
        self.first = np.concatenate(([0], np.cumsum([len(t) for t in self.texts]))).astype(np.int64)
        self.data = np.frombuffer(b"".join(self.texts), dtype=np.uint8)
        self._copies()

    def _buckets(self, hashes: np.ndarray, digit: int) -> np.ndarray:
        """Buckets of a digit's hashes. Only the last digit fills all buckets of its
        own; the lighter ones (anchors, texts, stretches) have half as many each."""
        half = max(1, self.n_buckets // 2)
        n = self.n_buckets if digit == 3 else half
        return (hashes % np.uint64(n)).astype(np.int64) + digit * half

    def _copies(self) -> None:
        long = [i for i, t in enumerate(self.texts) if len(t) >= self.depth]
        digests = [xxhash.xxh3_128_intdigest(self.texts[i]) for i in long]
        low = np.array([d & 0xFFFFFFFFFFFFFFFF for d in digests], dtype=np.uint64)
        high = np.array([d >> 64 for d in digests], dtype=np.uint64)
        self.long = np.array(long, dtype=np.int64)
        self.digests, at, self.digest_of = np.unique(low, return_index=True, return_inverse=True)
        self.digest_buckets = self._buckets(high[at], 1)
        least = self.rank[self.long[at]]  # ids ascend, so the first has the least
        self.copy = np.zeros(len(self.texts), dtype=bool)
        self.copy[self.long] = least[self.digest_of] < self.rank[self.long]

    def blocks(self):
        """First and last bounds of blocks of window starts, and the codes of a block's bytes."""
        n = len(self.data) - self.depth + 1
        for a in range(0, n, BLOCK):
            b = min(a + BLOCK, n)
            yield a, b, _CODES[self.data[a:b + self.depth - 1]]

    def runs(self, places: bool) -> None:
        """Runs of neighbouring starts of one document that have one anchor at one
        place (else, anchors of one digit): first starts, sizes, documents, and the
        digits. Windows that leave their document, and texts that are copies, have none."""
        reach = self.depth - self.gram + 1
        none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        parts: list[tuple] = [(none[0], none[not places], none[1])]
        for a, b, codes in self.blocks():
            digit = mix64(ex.window_hash(codes, self.gram))
            least = (digit & ~_INDEX) | np.arange(len(digit), dtype=np.uint64)
            size = 1
            while size * 2 <= reach:
                least = np.minimum(least[:-size], least[size:])
                size *= 2
            if size < reach:
                least = np.minimum(least[:size - reach], least[reach - size:])
            new = np.ones(b - a, dtype=bool)
            np.not_equal(least[1:], least[:-1], out=new[1:])
            i, j = np.searchsorted(self.first, [a, b - 1], side="right") - 1
            bounds = np.concatenate((self.first[i:j + 2], self.first[i:j + 2] - self.depth + 1))
            edge = np.zeros(b - a, dtype=bool)
            edge[bounds[(bounds >= a) & (bounds < b)] - a] = True
            head = np.flatnonzero(new | edge)
            at = (least[head] & _INDEX).astype(np.int64)
            if not places:
                new = edge[head]
                new[0] = True
                new[1:] |= digit[at[1:]] != digit[at[:-1]]
                head, at = head[new], at[new]
            parts.append((head + a, at + a if places else digit[at], digit[at]))
        start, place, digit = (np.concatenate([p[k] for p in parts]) for k in range(3))
        parts.clear()
        owner = np.searchsorted(self.first, start, side="right") - 1
        valid = start <= self.first[owner + 1] - self.depth
        new = np.ones(len(start), dtype=bool)  # a run that goes on in the next block is one
        new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1]) | (valid[1:] != valid[:-1])
        start, owner, digit, valid = start[new], owner[new], digit[new], valid[new]
        size = np.diff(start, append=len(self.data) - self.depth + 1)
        valid &= ~self.copy[owner]
        self.start, self.size, self.owner, self.run_digit = start[valid], size[valid], owner[valid], digit[valid]

    def digits(self, places: bool = True) -> None:
        """Distinct anchor digits of the chunk, and which of them are in two documents of it."""
        self.runs(places)
        order = np.argsort(self.run_digit, kind="stable")
        digit, owner = self.run_digit[order], self.owner[order]
        new = np.ones(len(digit), dtype=bool)
        new[1:] = digit[1:] != digit[:-1]
        edges = np.flatnonzero(new)
        self.digit = digit[edges]
        self.digit_of = np.empty(len(digit), dtype=np.int64)
        self.digit_of[order] = np.cumsum(new) - 1
        last = np.append(edges[1:], len(digit))[:len(edges)] - 1
        self.shared = owner[edges] != owner[last]
        self.digit_buckets = self._buckets(self.digit, 0)

    def hashes(self, starts: np.ndarray) -> list[np.ndarray]:
        """Two hashes of each window at ascending ``starts``."""
        out = [np.empty(len(starts), dtype=np.uint64) for _ in range(2)]
        for a, b, codes in self.blocks() if len(starts) else ():
            i, j = np.searchsorted(starts, [a, b])
            if i < j:
                for o, base in zip(out, ((), (ex.second_base(),))):
                    o[i:j] = ex.window_hash(codes, self.depth, *base)[starts[i:j] - a]
        return out

    def first_pass(self) -> pa.Table:
        self.digits(places=False)  # fewer runs, the same digits
        return pa.concat_tables([
            ex.pack_sent(self.chunk, self.digit >> np.uint64(24), self.digit_buckets, DIGIT_BYTES, ex.ANY),
            ex.pack_sent(self.chunk, self.digests, self.digest_buckets, 8, ex.EARLIER)])

    def stretches(self, answered: dict[int, bytes]) -> None:
        """The runs that go on, as stretches."""
        self.digits()
        self.copy[self.long] |= ex.unpack(answered, self.digest_buckets)[self.digest_of]
        alive = self.shared | ex.unpack(answered, self.digit_buckets)
        go = alive[self.digit_of] & ~self.copy[self.owner]
        self.start, self.size, self.owner = self.start[go], self.size[go], self.owner[go]
        more = (self.size - 1).astype(np.uint64)  # with the first and the last window: the whole stretch
        hashes = [mix64(mix64(head) * np.uint64(3) + tail + more)
                  for head, tail in zip(self.hashes(self.start), self.hashes(self.start + self.size - 1))]
        self.stretch, at, self.same = np.unique(hashes[0], return_index=True, return_inverse=True)
        self.stretch_buckets = self._buckets(hashes[1][at], 2)
        self.settled = self.rank[self.owner[at]][self.same] < self.rank[self.owner]

    def second_pass(self, answered: dict[int, bytes]) -> pa.Table:
        self.stretches(answered)
        return pa.concat_tables([
            ex.pack_sent(self.chunk, self.stretch, self.stretch_buckets, 8, ex.EARLIER),
            ex.keep_answers(self.chunk, answered, self.n_buckets)])

    def windows(self, answered: dict[int, bytes]) -> None:
        """The suffixes that no stretch settles, and their distinct windows."""
        self.stretches(answered)
        self.settled |= ex.unpack(answered, self.stretch_buckets)[self.same]
        start, size = self.start[~self.settled], self.size[~self.settled]
        self.open = np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)
        owner = np.repeat(self.owner[~self.settled], size)
        value, other = self.hashes(self.open)
        self.values, at, self.which = np.unique(mix64(value), return_index=True, return_inverse=True)
        self.value_buckets = self._buckets(mix64(other[at]), 3)
        self.earlier = self.rank[owner[at]][self.which] < self.rank[owner]

    def last_pass(self, answered: dict[int, bytes]) -> pa.Table:
        self.windows(answered)
        return pa.concat_tables([
            ex.pack_sent(self.chunk, self.values, self.value_buckets, 8, ex.EARLIER),
            ex.keep_answers(self.chunk, answered, self.n_buckets)])

    def covered(self, answered: dict[int, bytes]) -> np.ndarray:
        """Mask of the bytes to remove."""
        self.windows(answered)
        hit = self.open[self.earlier | ex.unpack(answered, self.value_buckets)[self.which]]
        first = np.concatenate((self.start[self.settled], hit))  # no start is twice in these
        last = np.concatenate(((self.start + self.size - 1)[self.settled], hit))
        edge = np.zeros(len(self.data) + 1, dtype=np.int32)
        edge[first] += 1
        edge[last + self.depth] -= 1
        out = np.cumsum(edge[:-1], dtype=np.int32) > 0
        for i in np.flatnonzero(self.copy):
            out[self.first[i]:self.first[i + 1]] = True
        return out


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   depth: int = DEPTH, gram: int = GRAM) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, removed (byte intervals, end
    exclusive; maximal runs) and kept (the remaining bytes)."""
    bounded_batches(df.sparkSession)
    n_buckets = ex.bucket_count(df.sparkSession)
    docs = ex.by_chunk(df, id_col, text_col)

    def first(group: pa.Table) -> pa.Table:
        return ChunkBytes(group, depth, gram, n_buckets).first_pass()

    def second(group: pa.Table, answered: pa.Table) -> pa.Table:
        if not group.num_rows:
            return no_sent
        return ChunkBytes(group, depth, gram, n_buckets).second_pass(ex.answered_bits(answered))

    def last(group: pa.Table, answered: pa.Table) -> pa.Table:
        if not group.num_rows:
            return no_sent
        return ChunkBytes(group, depth, gram, n_buckets).last_pass(ex.answered_bits(answered))

    def finish(group: pa.Table, answered: pa.Table) -> pa.Table:
        if not group.num_rows:
            return empty
        c = ChunkBytes(group, depth, gram, n_buckets)
        gone = c.covered(ex.answered_bits(answered))
        removed, kept = [], []
        for a, b in zip(c.first[:-1], c.first[1:]):
            own = gone[a:b]
            edge = np.flatnonzero(np.diff(np.concatenate(([0], own.astype(np.int8), [0])))).tolist()
            removed.append([{"start": i, "end": j} for i, j in zip(edge[0::2], edge[1::2])])
            kept.append(c.data[a:b][~own].tobytes())
        return pa.table({"id": pa.array(c.ids, group["id"].type), "n_bytes": pa.array(np.diff(c.first)),
                         "n_removed": pa.array([sum(s["end"] - s["start"] for s in r) for r in removed], pa.int64()),
                         "removed": pa.array(removed, spans), "kept": pa.array(kept, pa.binary())})

    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = (f"id {docs.schema['id'].dataType.simpleString()}, n_bytes long, n_removed long, "
              "removed array<struct<start:long,end:long>>, kept binary")
    empty, no_sent = ex.empty_table(schema), ex.empty_table(ex.SENT)
    grouped = docs.groupBy("chunk")
    answered = ex.answers(grouped.applyInArrow(first, ex.SENT))
    for each in (second, last):
        answered = ex.answers(grouped.cogroup(answered.groupBy("chunk")).applyInArrow(each, ex.SENT))
    done = grouped.cogroup(answered.groupBy("chunk")).applyInArrow(finish, schema)
    return done.withColumnRenamed("id", id_col)


def digest(removed: DataFrame) -> DataFrame:
    return removed.select(*[c for c in removed.columns if c not in ("removed", "kept")],
                          F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
