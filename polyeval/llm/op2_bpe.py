"""Byte-level BPE by a tokenization automaton.

The merges are compiled, in rank order, into a deterministic automaton over
tokens that accepts exactly the correct token sequences. It starts with one state
and an arc per byte. The gadget of merge ``u v -> w`` (rank k) sends every arc
``u`` to a copy of its target without the arc ``v``, and adds an arc ``w`` from
wherever ``u v`` led to where it led. So the state after a token t is the one
after t's right part when t was made, less the arcs that later merges ``t x``
took; and an arc t exists where the arc of t's left part existed when t was made.
``Automaton`` keeps the gadgets (who lost which arc at which rank) and fills the
table of transitions as it meets them, since all state-token pairs would be
some 10^9.

Every prefix of a word has one accepted token sequence. Encoding walks the automaton along the
word, the longest label that the word goes on with first; where no arc leads on, it
takes back the last token and closes that position, since no accepted sequence ends there on the way
to the word's end. A position is closed once, so the walk is linear in the word. Decoding
emits the arcs' labels (their bytes).

Encoding is per document: one pass, no shuffle. The tokenizer file is read on
the driver (bounded by ``MAX_FILE``) and sent to the executors; workers keep
bounded tables of the words that they have met.

Defined cases: a null text is empty and has no tokens (the hashes are those of
empty strings); special tokens' strings in a text become their ids, as in the
tokenizers library; invalid UTF-8 is read as U+FFFD; rows are independent, so
repeated ids or rows each give a row.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyeval.llm.common import arrow_map, bounded_batches, decode, utf8

MAX_FILE = 64 << 20  # bytes of tokenizer file that may be sent to executors
MAX_ENTRIES = 300_000  # entries of each of a worker's tables
FOREVER = 1 << 62

#: Pre-split rule of byte-level BPE, as published with its vocabulary.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: The same for printable ASCII.
ASCII_PATTERN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ A-Za-z0-9]+| +(?![^ ])| +")
_MIXED_SPACE = regex.compile(r"\s \s")


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Automaton:
    """Gadgets of all merges, and the transitions met so far."""

    def __init__(self, base: dict[bytes, int], merges: list[tuple[int, int, int]], labels: dict[int, bytes]):
        self.made: dict[int, int] = {}  # token -> rank of the merge that made it
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.lost: dict[tuple[int, int], int] = {}  # (token before, token) -> rank at which the arc went
        self.token: dict[bytes, int] = dict(base)  # label -> token, for the arcs that exist somewhere
        for rank, (u, v, w) in enumerate(merges):
            if self._arc(u, v, rank):
                self.token[labels[w]] = w
            self.left[w], self.right[w], self.made[w] = u, v, rank
            self.lost.setdefault((u, v), rank)
        self.rows: dict[int, dict[str, int]] = {}  # state -> path of labels -> longest token on it whose arc exists
        self.entries = 0
        self.first: dict[str, int] = {}  # path -> longest token on it
        self.label = {token: label for label, token in self.token.items()}
        trie = ahocorasick.Automaton()  # its paths are the labels' prefixes
        for label in self.token:
            trie.add_word(label.decode("latin-1"), 0)
        self.prefix_length = trie.longest_prefix
        self.most = max(map(len, self.token), default=0)
        self.shorter: dict[int, int] = {}  # token -> token of the next shorter label that its own begins with

    def _arc(self, state: int, token: int, until: int) -> bool:
        """Whether an arc ``token`` leaves the state after ``state`` once the
        merges before rank ``until`` are in."""
        lost, made, left, right = self.lost, self.made, self.left, self.right
        while True:
            before, limit = state, until
            while True:
                if lost.get((before, token), FOREVER) < limit:
                    return False
                if before not in made:
                    break
                limit = min(limit, made[before])
                before = right[before]
            if token not in made:
                return True
            until = min(until, made[token] + 1)  # of a merge u u, the state after u has no arc for the new token
            token = left[token]

    def _next(self, state: int, path: str) -> int:
        """The longest token along ``path`` whose arc leaves the state after token ``state``
        (-1: the start, which every arc leaves), kept in the state's row."""
        if self.entries >= 4 * MAX_ENTRIES:
            self.rows.clear()
            self.entries = 0
        token = self.first.get(path)
        if token is None:
            if len(self.first) >= MAX_ENTRIES:
                self.first.clear()
            token = self.first[path] = self._longest(path.encode("latin-1"))
        while token >= 0 <= state and not self._arc(state, token, FOREVER):
            token = self._shorter(token)
        self.rows.setdefault(state, {})[path] = token
        self.entries += 1
        return token

    def _longest(self, label: bytes) -> int:
        """The token of the longest label that ``label`` begins with; -1 if there is none."""
        for end in range(len(label), 0, -1):
            token = self.token.get(label[:end])
            if token is not None:
                return token
        return -1

    def _shorter(self, token: int) -> int:
        out = self.shorter.get(token)
        if out is None:
            out = self.shorter[token] = self._longest(self.label[token][:-1])
        return out

    def run(self, word: bytes) -> list[int]:
        """The accepted token sequence whose labels spell the word."""
        whole = self.token.get(word)
        if whole is not None:
            return [whole]
        text, n = word.decode("latin-1"), len(word)
        row_of, label, prefix = self.rows.get, self.label, self.prefix_length
        out, at, state, closed = [], 0, -1, set()
        while True:
            path = text[at:at + self.most]
            path = path[:prefix(path)]
            row = row_of(state)
            token = None if row is None else row.get(path)
            if token is None:
                token = self._next(state, path)
            while token >= 0:
                end = at + len(label[token])
                if end not in closed:
                    break
                token = self._shorter(token)  # only a shorter one ends elsewhere
                while token >= 0 <= state and not self._arc(state, token, FOREVER):
                    token = self._shorter(token)
            if token >= 0:
                out.append(token)
                if end == n:
                    return out
                at, state = end, token
            else:
                closed.add(at)
                at -= len(label[out.pop()])
                state = out[-1] if out else -1


class Codec:
    """Encoder and decoder of one byte-level BPE tokenizer file."""

    def __init__(self, file: bytes):
        spec = json.loads(file)
        model, symbols = spec["model"], byte_symbols()
        vocab = model["vocab"]
        self.labels = {i: bytes(symbols[c] for c in s) for s, i in vocab.items()}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        base = {bytes([b]): vocab[c] for c, b in symbols.items()}
        self.automaton = Automaton(base, [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], self.labels)
        added = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        self.labels |= {i: s.encode() for s, i in added.items()}
        self.decimal = {i: str(i).encode() for i in self.labels}
        self.added = {s: self._entry([i]) for s, i in added.items()}
        self.specials = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.chunks: dict[str, tuple[bytes, bytes]] = {}
        self.older: dict[str, tuple[bytes, bytes]] = {}  # the table before; what comes again is taken back

    def _entry(self, ids: list[int]) -> tuple[bytes, bytes]:
        """Decimal ids joined by commas, and the ids as unsigned 32-bit integers."""
        decimal = self.decimal
        return b",".join([decimal[i] for i in ids]), array("I", ids).tobytes()

    def _chunk(self, chunk: str) -> tuple[bytes, bytes]:
        """The entry of a text that is split by itself."""
        entry = self.older.get(chunk)
        if entry is None:
            ascii = chunk.isascii()
            if ascii and (chunk[1:] if chunk[0] == " " else chunk).isalpha():  # letters are one piece
                entry = self._entry(self.automaton.run(chunk.encode()))
            else:
                pieces = (ASCII_PATTERN if ascii and chunk.isprintable() else PATTERN).findall(chunk)
                if len(pieces) == 1:
                    entry = self._entry(self.automaton.run(chunk.encode()))
                else:  # a piece is a chunk too
                    entries = [self.chunks.get(x) or self._chunk(x) for x in pieces]
                    entry = b",".join([e[0] for e in entries]), b"".join([e[1] for e in entries])
        if len(chunk) <= 64:
            if len(self.chunks) >= MAX_ENTRIES:
                self.older, self.chunks = self.chunks, {}
            self.chunks[chunk] = entry
        return entry

    def _plain(self, text: str) -> list[tuple[bytes, bytes]]:
        if not text:
            return []
        if _MIXED_SPACE.search(text):  # a space among white space: its run belongs together
            return [self._chunk(text)]
        # A space with a word character on either side starts or ends a piece,
        # so what lies between single spaces is split independently.
        first, *rest = text.split(" ")
        chunk, out = self._chunk, []
        if first:
            out.append(self.chunks.get(first) or chunk(first))
        for x in map(" ".__add__, rest):
            out.append(self.chunks.get(x) or chunk(x))  # the table may be a new one after each chunk
        return out

    def entries(self, text: str) -> list[tuple[bytes, bytes]]:
        if self.specials is None or not self.specials.search(text):
            return self._plain(text)
        out, at = [], 0
        for m in self.specials.finditer(text):
            out += [*self._plain(text[at:m.start()]), self.added[m[0]]]
            at = m.end()
        return out + self._plain(text[at:])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(b"".join(x[1] for x in self.entries(text)), dtype="<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        return decode(b"".join(map(self.labels.__getitem__, ids)))


@lru_cache(maxsize=2)
def codec(file: bytes) -> Codec:
    return Codec(file)


def read_file(path: str) -> bytes:
    with open(path, "rb") as f:
        data = f.read(MAX_FILE + 1)
    if len(data) > MAX_FILE:
        raise ValueError(f"{path} is larger than {MAX_FILE} bytes")
    return data


def _mapped(df: DataFrame, path: str, text_col: str, each, name: str, kind: str, arrow) -> DataFrame:
    bounded_batches(df.sparkSession)
    file = df.sparkSession.sparkContext.broadcast(read_file(path))
    df = df.drop(name) if name != text_col else df  # an older column of the result's name gives way
    at, schema = df.columns.index(text_col), df.schema

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        c = codec(file.value)
        out = pa.array([each(c, x) for x in b.column(at).to_pylist()], arrow)
        return pa.RecordBatch.from_arrays([*b.columns, out], [*b.schema.names, name])

    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return arrow_map(df, run, f"{cols}, `{name}` {kind}")


def encode(df: DataFrame, path: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``df`` with the token ids of each text."""
    return _mapped(df, path, text_col, lambda c, x: c.encode(x or ""), out_col, "array<int>", pa.list_(pa.int32()))


def decode_ids(df: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the text that each row's ids spell (null ids: empty)."""
    return _mapped(df, path, ids_col, lambda c, x: c.decode(x or []), out_col, "string", pa.string())


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, and the hashes of the ids and of the text decoded from them."""
    bounded_batches(df.sparkSession)
    file = df.sparkSession.sparkContext.broadcast(read_file(path))
    src = df.select(F.col(id_col).alias("_id"), utf8(text_col).alias("_t"))

    def one(c: Codec, data: bytes) -> tuple:
        entries = c.entries(decode(data))
        ids = np.frombuffer(b"".join([x[1] for x in entries]), dtype="<u4").tolist()
        return (len(ids), hashlib.sha256(b",".join([x[0] for x in entries])).hexdigest(),
                hashlib.sha256(c.decode(ids).encode()).hexdigest())

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        c = codec(file.value)
        rows = list(zip(*(one(c, x) for x in b.column(1).to_pylist())))
        return pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, rows, (pa.int64(), pa.string(), pa.string()))],
                                          [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return arrow_map(src, each, f"{id_col} {src.schema['_id'].dataType.simpleString()}, n_tokens long, "
                                "ids_sha256 string, decoded_sha256 string")
