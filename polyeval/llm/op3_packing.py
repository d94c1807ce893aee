"""Hierarchical multi-length packing.

Documents become token ids (each with an end id) and are routed to context-size
tiers, 256 to 2048 tokens: full 2048-token blocks of a long document are sequences
as they are, and a rest goes to the smallest tier that holds it. Each tier's
documents open windows of the tier's size, the longest first; what is left of a
window is filled from shorter tiers by the largest piece that fits, and, when none
does, by the front of the next longer one, whose rest is routed anew. So every
window is full. Windows of one tier are dealt into step groups of equal token
counts, in snake order of their attention cost.

A task packs what it reads, in rounds of bounded size; what doesn't fill a window
goes on to the next round. Only a task's last tokens (under 256, after cuts at powers
of two) are padded: under one window per task. No shuffle. A lost task
is packed anew from the same rows; sequence ids hold the partition's number.

Defined cases: a null or empty text is the end id alone; repeated ids or rows
are documents of their own; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyeval.llm.common import bounded_batches, utf8

TIERS = (256, 512, 1024, 2048)
ROUND_TOKENS = 1 << 20  # tokens that a task holds before it packs them
STEP_TOKENS = 64 * 2048  # tokens of a step group
MAX_ENTRIES = 400_000
END_ID = 1
ID_BYTES = 4

PIECES = ("start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, "
          "tier int, step_group long")


class WordIds:
    """Token ids (little-endian unsigned 32-bit) of texts under a tokenizer
    that drops white space, kept by word.

    No token spans white space, so a batch's words between ASCII white space
    are encoded once each while the bounded table holds them. Words of plain
    Latin-1 letters, digits and signs are split here into the tokenizer's
    pieces, and new pieces go to it many at a time: each piece ends with its
    first token that ends a word. Any other word goes to it whole.
    """

    plain = re.compile("[!-~À-ÖØ-öø-ÿ]+")
    split = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
    together = 64

    def __init__(self, file: bytes):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(file.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        model = json.loads(file)["model"]
        self.suffix = model["end_of_word_suffix"]
        self.ends = {i for t, i in model["vocab"].items() if t.endswith(self.suffix)} if self.suffix else set()
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _learn(self, new: list[bytes]) -> None:
        if len(self.words) > MAX_ENTRIES:
            self.words.clear()
        if len(self.pieces) > MAX_ENTRIES:
            self.pieces.clear()
        whole, split, pieces = [], [], set()
        for word in new:
            text = word.decode("utf-8", "replace")
            if self.ends and "<|" not in text and self.plain.fullmatch(text):
                own = self.split.findall(text.lower())
                split.append((word, own))
                pieces.update(own)
            else:
                whole.append((word, text))
        for (word, _), ids in zip(whole, self._ids([t for _, t in whole])):
            self.words[word] = array("I", ids).tobytes()
        missing = [x for x in pieces if x not in self.pieces]
        groups = [missing[i:i + self.together] for i in range(0, len(missing), self.together)]
        for group, ids in zip(groups, self._ids([" ".join(g) for g in groups])):
            stops = [0, *(i + 1 for i, t in enumerate(ids) if t in self.ends)]
            if len(stops) != len(group) + 1:
                raise ValueError("the tokenizer joins or splits pieces otherwise than its rule says")
            for piece, i, j in zip(group, stops, stops[1:]):
                self.pieces[piece] = array("I", ids[i:j]).tobytes()
        known = self.pieces
        for word, own in split:
            self.words[word] = known[own[0]] if len(own) == 1 else b"".join([known[x] for x in own])

    def encode(self, texts: list[bytes]) -> list[bytes]:
        # Lower case is the tokenizer's own rule; special tokens come before it.
        split = [(x if b"<|" in x else x.lower()).split() for x in texts]
        known, out = self.words, []
        self._learn(list(set().union(*split).difference(known)))
        try:
            return [b"".join([known[w] for w in ws]) for ws in split]
        except KeyError:  # the table was emptied meanwhile
            self._learn(list(set().union(*split).difference(known)))
            return [b"".join([known[w] for w in ws]) for ws in split]


@lru_cache(maxsize=2)
def word_ids(file: bytes) -> WordIds:
    return WordIds(file)


class Packer:
    """Packs documents given one by one; windows come out in rounds."""

    def __init__(self, task: int, tiers=TIERS, step_tokens: int = STEP_TOKENS):
        self.tiers, self.step_tokens = tuple(sorted(tiers)), step_tokens
        self.top = self.tiers[-1]
        self.by_length: list[list] = [[] for _ in range(self.top + 1)]
        self.lengths = 0  # bit n: there is a piece of n tokens
        self.held = 0
        self.windows: dict[int, list] = {t: [] for t in self.tiers}
        self.next_sequence = self.next_group = task << 40

    def add(self, key, ids: bytes) -> None:
        total = len(ids) // ID_BYTES
        start = 0
        while total - start >= self.top:
            self.windows[self.top].append([self._piece(key, start, ids, self.top, total)])
            start += self.top
        if start < total:
            self._put(self._piece(key, start, ids, total - start, total))
        self.held += total

    @staticmethod
    def _piece(key, start, ids, length, total, base=0):
        at = (start - base) * ID_BYTES
        return (key, start, length, ids[at:at + length * ID_BYTES], total)

    def _put(self, piece) -> None:
        self.by_length[piece[2]].append(piece)
        self.lengths |= 1 << piece[2]

    def _take(self, length: int):
        stack = self.by_length[length]
        piece = stack.pop()
        if not stack:
            self.lengths ^= 1 << length
        return piece

    def _cut(self, piece, length: int):
        """The piece's first ``length`` tokens; the rest is routed anew."""
        key, start, n, ids, total = piece
        self._put(self._piece(key, start + length, ids, n - length, total, start))
        return self._piece(key, start, ids, length, total, start)

    def pack(self, last: bool = False) -> Iterator[tuple]:
        """Rows of the windows that the held pieces fill; all of them if ``last``."""
        while self.lengths:
            longest = self._take(self.lengths.bit_length() - 1)
            tier = next(t for t in self.tiers if t >= longest[2])
            window, gap = [longest], tier - longest[2]
            while gap and self.lengths:
                fitting = self.lengths & ((1 << (gap + 1)) - 1)
                if fitting:
                    piece = self._take(fitting.bit_length() - 1)
                else:
                    longer = self.lengths >> gap
                    piece = self._cut(self._take(gap + (longer & -longer).bit_length() - 1), gap)
                window.append(piece)
                gap -= piece[2]
            if not gap:
                self.windows[tier].append(window)
            elif last:
                self._finish(window)
            else:  # nothing else is held: go on with it in the next round
                for piece in window:
                    self._put(piece)
                break
        self.held = sum(n * len(s) for n, s in enumerate(self.by_length)) if self.lengths else 0
        yield from self._rows()

    def _finish(self, window: list) -> None:
        """Cuts the last window at powers of two; the end under the smallest tier is padded."""
        left = list(window)
        for tier in reversed(self.tiers):
            if sum(p[2] for p in left) >= tier:
                full, gap = [], tier
                while gap:
                    key, start, n, ids, total = left.pop(0)
                    if n > gap:
                        left.insert(0, self._piece(key, start + gap, ids, n - gap, total, start))
                        n = gap
                    full.append(self._piece(key, start, ids, n, total, start))
                    gap -= n
                self.windows[tier].append(full)
        if left:
            self.windows[self.top].append(left)

    def _rows(self) -> Iterator[tuple]:
        for tier, windows in self.windows.items():
            groups = -(-len(windows) * tier // self.step_tokens)
            windows.sort(key=lambda w: -sum(p[2] * p[2] for p in w))
            for i, window in enumerate(windows):
                turn, at = divmod(i, groups)
                group = self.next_group + (groups - 1 - at if turn % 2 else at)
                offset = 0
                for key, start, n, ids, total in window:
                    yield key, start, n, ids, total, self.next_sequence, offset, tier, group
                    offset += n
                self.next_sequence += 1
            self.next_group += groups
            windows.clear()


def pack(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
         end_id: int = END_ID, tiers=TIERS) -> DataFrame:
    """One row per piece: the document's id and ``PIECES`` (``ids`` are
    little-endian unsigned 32-bit integers)."""
    bounded_batches(df.sparkSession)
    from polyeval.llm.op2_bpe import read_file
    file = df.sparkSession.sparkContext.broadcast(read_file(path))
    src = df.select(F.col(id_col).alias("_id"), utf8(text_col).alias("_t"))
    schema = f"{id_col} {src.schema['_id'].dataType.simpleString()}, {PIECES}"
    names = [id_col, *(c.split()[0] for c in PIECES.split(", "))]
    end = end_id.to_bytes(ID_BYTES, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = word_ids(file.value)
        packer = Packer(TaskContext.get().partitionId(), tiers)
        kinds = None

        def out(rows):
            chunk = list(rows)
            for i in range(0, len(chunk), 2000):
                cols = zip(*chunk[i:i + 2000])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)

        for b in batches:
            kinds = [b.schema.types[0], *[pa.int64()] * 2, pa.binary(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
            for key, ids in zip(b.column(0).to_pylist(), codec.encode(b.column(1).to_pylist())):
                packer.add(key, ids + end)
                if packer.held >= ROUND_TOKENS:
                    yield from out(packer.pack())
        if kinds is not None:
            yield from out(packer.pack(last=True))

    return src.mapInArrow(run, schema)


def pieces(packed: DataFrame) -> DataFrame:
    """The packed pieces with a checksum in place of the ids."""
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
