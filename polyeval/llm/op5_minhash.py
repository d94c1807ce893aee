"""MinHash near-dedup with tensored banding.

A document's distinct 5-word shingles give ``2 * SIDE`` small hash collections of
``SMALL`` minhashes each, ``SIDE`` left and ``SIDE`` right ones. The key of table (i, j)
combines left collection i with right collection j, so ``SIDE`` squared tables cost
``2 * SIDE * SMALL`` minhashes. A pair of similarity s is missed only if all left or
all right collections differ: about ``2 * (1 - s^SMALL)^SIDE``, 5e-6 at 0.85
and 7e-5 at 0.8.

Steps, each a distributed job; tables of ids are written to the shared folder:

1. signatures; documents with equal shingle sets become one node (least id);
2. a collection that no other node shares can't be part of a shared key, so keys
   are made of shared collections only, and buckets of one node vanish;
3. of the candidates, how many of its shingles occur in another candidate (an
   upper bound on what a node can share): nodes and pairs that can't reach the
   threshold by that bound are dropped, which is exact;
4. each node is compared with the bucket leader that it meets most often, on the
   full sets; the links' components are taken;
5. buckets that still hold several components are looked into: nodes outside a
   bucket's largest component meet all its nodes, and a pair is made only if a sketch
   of ``SKETCH`` minhashes of two bits each says that it may reach the threshold, once
   however many tables it meets in. The sketch is compared inside the join, so a group of
   one template whose members stay well under the threshold makes next to no pairs
   (its nodes are still met by each other there, some ten nanoseconds each). The
   pairs made are confirmed on the full sets.

So no pair of candidates is left out, and copies of one text or one large group aren't
expanded into pairs. The sketch passes a pair at the threshold but for one in a
million (five standard deviations).

Sets travel as 48-bit hashes of shingles.

Defined cases: a null or empty text has an empty set, links with nothing and is
kept; a text of fewer than five words is one shingle; rows with equal ids are one
node; rows with a null id take no part (component null, kept); an empty table gives
no rows; other columns aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyeval.llm import exchange as ex
from polyeval.llm.common import arrow_map, bounded_batches, mix64, utf8
from polyeval.llm.components import components, written

SHINGLE = 5
PERCENT = 85
SIDE = 10
SMALL = 2
SET_BYTES = 6
DF_BYTES = 5
SKETCH = 256
WORDS = [f"w{i}" for i in range(SKETCH // 32)]  # a sketch's longs


def shingles(data: bytes, size: int = SHINGLE) -> np.ndarray:
    """Distinct hashed shingles of a text, ascending."""
    words = data.lower().split()  # A-Z only; ASCII white space
    if not words:
        return np.zeros(0, dtype=np.uint64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    n = min(size, len(words))
    return np.unique(mix64(ex.window_hash(codes, n) + np.uint64(size - n)))


def _multipliers(n: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)


def signature(found: np.ndarray, side: int, small: int) -> tuple[np.ndarray, np.ndarray]:
    """Left and right collections' keys."""
    least = np.empty(2 * side * small, dtype=np.uint64)
    factors = _multipliers(len(least))
    for i in range(0, len(found), 1 << 16):  # bounded memory for very long texts
        part = np.multiply.outer(factors, found[i:i + (1 << 16)]).min(axis=1)
        least = part if not i else np.minimum(least, part)
    parts = least.reshape(2, side, small)
    keys = parts[:, :, 0]
    for k in range(1, small):
        keys = mix64(keys) + parts[:, :, k]
    keys = mix64(keys + np.arange(2 * side, dtype=np.uint64).reshape(2, side))
    return keys[0].view(np.int64), keys[1].view(np.int64)


def signatures(df: DataFrame, id_col: str, text_col: str, side: int, small: int) -> DataFrame:
    """id, n_shingles, set digest (two longs), left and right keys."""
    src = df.select(F.col(id_col).cast("long").alias("id"), utf8(text_col).alias("text"))

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for data in b.column(1).to_pylist():
            found = shingles(data)
            if len(found):
                d = xxhash.xxh3_128_intdigest(found.tobytes())
                left, right = signature(found, side, small)
                rows.append((len(found), _signed(d), _signed(d >> 64), left, right))
            else:
                rows.append((0, None, None, [], []))
        longs, kinds = pa.list_(pa.int64()), [pa.int64()] * 3
        return pa.RecordBatch.from_arrays(
            [b.column(0), *map(pa.array, zip(*rows), [*kinds, longs, longs])],
            ["id", "n", "d1", "d2", "lefts", "rights"])

    return arrow_map(src, each, "id long, n long, d1 long, d2 long, lefts array<long>, rights array<long>")


def _signed(x: int) -> int:
    x &= 0xFFFFFFFFFFFFFFFF
    return x - (1 << 64) if x >> 63 else x


def buckets(nodes: DataFrame) -> DataFrame:
    """key, left, right (the table), node of every table bucket with two nodes or more."""
    sub = nodes.select("node", F.posexplode(F.concat("lefts", "rights")).alias("pos", "key"), F.size("lefts").alias("side"))
    own = sub.join(sub.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "key")
    pair = F.struct("pos", "key")
    sides = own.groupBy("node").agg(F.collect_list(F.when(F.col("pos") < F.col("side"), pair)).alias("l"),
                                    F.collect_list(F.when(F.col("pos") >= F.col("side"), pair)).alias("r"),
                                    F.first("side").alias("side"))  # 2 * SIDE entries at most
    keyed = sides.select("node", "side", F.explode("l").alias("l"), "r").select("node", "side", "l", F.explode("r").alias("r"))
    keyed = keyed.select("node", F.xxhash64("l.key", "r.key").alias("key"), F.col("l.pos").alias("left"),
                         (F.col("r.pos") - F.col("side")).alias("right"))
    many = keyed.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    return keyed.join(many, "key").select("key", "left", "right", "node")


def candidate_sets(df: DataFrame, id_col: str, text_col: str, candidates: DataFrame, percent: int) -> DataFrame:
    """node, n, s (shingles that another candidate has too) and the set of each
    candidate that may reach the threshold."""
    n_buckets = ex.bucket_count(df.sparkSession)
    docs = ex.by_chunk(df, id_col, text_col).groupBy("chunk")
    wanted = candidates.select(ex.chunk_of("node", ex.CHUNK_BITS).alias("chunk"), F.lit(-1).alias("bucket"), "node",
                               F.lit(None).cast("binary").alias("bits"))

    def sets_of(group: pa.Table, extra: pa.Table):
        ids = {n for b, n in zip(extra["bucket"].to_pylist(), extra["node"].to_pylist()) if b == -1}
        found = {}
        for i, text in zip(group["id"].to_pylist(), group["text"].to_pylist()):
            if i in ids and i not in found:
                found[i] = shingles(text)
        every = np.concatenate(list(found.values())) if found else np.zeros(0, np.uint64)
        values, counts = np.unique(every, return_counts=True)
        return found, values, counts, (values % np.uint64(n_buckets)).astype(np.int64)

    def send(group: pa.Table, extra: pa.Table) -> pa.Table:
        if not group.num_rows or not extra.num_rows:
            return no_sent
        _, values, _, at = sets_of(group, extra)
        return ex.pack_sent(group["chunk"][0].as_py(), values >> np.uint64(24), at, DF_BYTES, ex.ANY)

    def finish(group: pa.Table, extra: pa.Table) -> pa.Table:
        if not group.num_rows or not extra.num_rows:
            return empty
        found, values, counts, at = sets_of(group, extra)
        bits = {b: x for b, x in zip(extra["bucket"].to_pylist(), extra["bits"].to_pylist()) if b >= 0}
        shared = values[(counts > 1) | ex.unpack(bits, at)]
        rows = []
        for i, own in found.items():
            s = int(np.isin(own, shared, assume_unique=True).sum())
            if 100 * s >= percent * len(own):
                raw = own.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 8 - SET_BYTES:]
                rows.append((i, len(own), s, np.ascontiguousarray(raw).tobytes()))
        if not rows:
            return empty
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                        ["node", "n", "s", "set"])

    schema = "node long, n long, s long, set binary"
    no_sent, empty = ex.empty_table(ex.SENT), ex.empty_table(schema)
    answered = ex.answers(docs.cogroup(wanted.groupBy("chunk")).applyInArrow(send, ex.SENT))
    extra = wanted.unionByName(answered.withColumn("node", F.lit(None).cast("long")))
    return docs.cogroup(extra.groupBy("chunk")).applyInArrow(finish, schema)


def sketch(own: np.ndarray) -> np.ndarray:
    """A set's sketch as longs: two bits of each of ``SKETCH`` minhashes."""
    own = mix64(own ^ np.uint64(0x9E3779B97F4A7C15))
    factors = _multipliers(SKETCH)
    least = np.full(SKETCH, np.uint64(0xFFFFFFFFFFFFFFFF))
    for i in range(0, len(own), 1 << 14):  # bounded memory for very long texts
        np.minimum(least, np.multiply.outer(factors, own[i:i + (1 << 14)]).min(axis=1), out=least)
    two = (mix64(least) & np.uint64(3)).reshape(-1, 32) << np.arange(0, 64, 2, dtype=np.uint64)
    return np.bitwise_or.reduce(two, axis=1).view(np.int64)


def sketches(sets: DataFrame) -> DataFrame:
    """node and its sketch's longs."""
    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        words = np.stack([sketch(_wide(x)) for x in b.column(1).to_pylist()]).T
        return pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, words)], ["node", *WORDS])

    return arrow_map(sets.select("node", "set"), each, f"node long, {', '.join(w + ' long' for w in WORDS)}")


def most_apart(percent: int) -> int:
    """Differing minhashes of a sketch that a pair at the threshold doesn't exceed, but for
    five standard deviations."""
    p = (1 - percent / 100) * 3 / 4
    return int(SKETCH * p + 5 * (SKETCH * p * (1 - p)) ** 0.5) + 1


def open_pairs(placed: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that a bucket holds and whose sketches
    may reach the threshold."""
    held = placed.groupBy("key", "component").agg(F.count("*").alias("c")).groupBy("key").agg(
        F.count("*").alias("parts"), F.max_by("component", F.struct("c", "component")).alias("main"))
    rows = placed.join(held.where("parts > 1"), "key")
    wanted = sets.join(rows.select("node").distinct(), "node", "left_semi")
    # A pair meets in many tables; it is taken in the one of its first common left
    # and right collections, so a row has those before its own.
    rows = rows.join(sketches(wanted), "node").join(nodes.select("node", "lefts", "rights"), "node").select(
        "key", "node", "n", "s", "component", (F.col("component") == F.col("main")).alias("in_main"), *WORDS,
        F.concat(F.slice("lefts", F.lit(1), F.col("left")), F.slice("rights", F.lit(1), F.col("right"))).alias("before"))
    as_ = lambda x, df: df.select("key", *[F.col(c).alias(f"{c}_{x}") for c in df.columns if c != "key"])
    differ = [f"({w}_a ^ {w}_b)" for w in WORDS]
    apart = " + ".join(f"bit_count(({x} | shiftrightunsigned({x}, 1)) & 6148914691236517205L)" for x in differ)  # low bit of each two
    pairs = as_("a", rows.where("not in_main")).join(as_("b", rows), "key").where(
        f"component_a <> component_b and (in_main_b or node_a < node_b) and {may_link(percent)} "
        f"and {apart} <= {most_apart(percent)} and not arrays_overlap(before_a, before_b)")
    return pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def may_link(percent: int) -> str:
    """The most that the nodes of a pair can share reaches the threshold."""
    return f"100 * least(s_a, s_b) >= {percent} * (n_a + n_b - least(s_a, s_b))"


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    side = lambda x: sets.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("set").alias(f"set_{x}"))
    both = pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a").select("a", "b", "set_a", "set_b")

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        ok = []
        for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
            x, y = _wide(x), _wide(y)
            inter = len(np.intersect1d(x, y))
            ok.append(100 * inter >= percent * (len(x) + len(y) - inter))
        return b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return arrow_map(both, each, "a long, b long")


def _wide(raw: bytes) -> np.ndarray:
    own = np.frombuffer(raw, dtype=np.uint8).reshape(-1, SET_BYTES)
    wide = np.zeros((len(own), 8), dtype=np.uint8)
    wide[:, :SET_BYTES] = own
    return wide.reshape(-1).view("<u8")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                    side: int = SIDE, small: int = SMALL) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept."""
    bounded_batches(df.sparkSession)
    signed = written(signatures(df, id_col, text_col, side, small), "signatures")
    nodes = signed.where("n > 0 and id is not null").groupBy("d1", "d2").agg(
        F.min(F.struct("id", "lefts", "rights")).alias("r")).select(
        "d1", "d2", F.col("r.id").alias("node"), "r.lefts", "r.rights")
    met = written(buckets(nodes), "buckets")
    sets = written(candidate_sets(df, id_col, text_col, met.select("node").distinct(), percent), "sets")

    sized = sets.select("node", "n", "s")
    met = met.join(sized, "node")
    leaders = met.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("c")).where("c > 1").select("key", "a")
    star = met.select("key", F.col("node").alias("b")).join(leaders, "key").where("a <> b")
    star = star.groupBy("a", "b").agg(F.count("*").alias("c")).groupBy("b").agg(F.max_by("a", F.struct("c", F.col("a"))).alias("a"))
    links = written(verified(star, sets, percent), "links")
    parts = components(links)

    placed = written(met.join(parts, "node", "left").select(
        "key", "left", "right", "node", "n", "s", F.coalesce("component", "node").alias("component")), "placed")
    pairs = open_pairs(placed, nodes, sets, percent)
    more = written(verified(pairs, sets, percent), "links")
    if not more.isEmpty():
        parts = components(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))

    named = nodes.select("d1", "d2", "node").join(parts, "node", "left").select(
        "d1", "d2", F.coalesce("component", "node").alias("component_id"))
    out = signed.select("id", "n", "d1", "d2").join(named, ["d1", "d2"], "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.coalesce("component_id", "id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
