"""Homomorphic multiset fingerprints, in DataFrame functions only.

A text is a multiset of paragraphs: up to four words of one sentence and line. Each
paragraph is hashed and added to a vector of sums, so the fingerprint doesn't
depend on the order of paragraphs, and inserting or deleting one adds or subtracts
its vector. The vector has, all modulo powers of two:

* the number of paragraphs (2^63) and ``DENSE`` sums of 32 bits of the hashes (2^32), for
  equality;
* ``LEVELS`` levels of ``SLOTS`` sums (2^16) for likeness. A paragraph is in one slot of
  one level, level l with probability 2^-(l+1). Slots that differ between two
  fingerprints show how many paragraphs differ: level l sees one in 2^(l+1) of
  them, so some level isn't full up to about a million paragraphs; beyond, all levels
  are, and the likeness of similar texts sinks towards 0 (equality isn't touched).

Likeness is the estimated Jaccard similarity of the multisets, from the
difference of the vectors alone.

``near_next`` and the edited text need the next document. Documents are dealt by
blocks of neighbouring ids, so that only a block's last one looks elsewhere;
the blocks' order comes from the blocks of the blocks, and so on, so
no task ever sorts more than ``FANOUT`` ids and one key.

Defined cases: a null text is empty, with zero paragraphs; two empty texts are alike (1),
an empty and another one are not (0). Rows are ordered by id, then text; null ids
come first; rows that repeat an id are documents of their own. The only document is its own
next one. An empty table gives no rows. Other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LEVELS = 12
SLOTS = 96
DENSE = 4
BLOCK_BITS = 6  # 64 neighbouring ids make a block
FANOUT_BITS = 15
#: A paragraph: one to four words without sentence ends between them, on one line.
PARAGRAPH = r"(?:[^\s.!?]+[ \t]*){1,4}[.!?]*|[.!?]+"
_NULL_BLOCK = -(1 << 58)


def paragraph_hashes(text: Column) -> Column:
    """A 64-bit hash for each paragraph of a text."""
    return F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)), lambda p: F.xxhash64(F.rtrim(p)))


def _term(h: Column) -> Column:
    """slot * 2^16 + value that a paragraph adds."""
    low = h.bitwiseAND(F.lit((1 << (LEVELS - 1)) - 1)).bitwiseOR(F.lit(1 << (LEVELS - 1)))
    level = F.bit_count(low.bitwiseAND(-low) - 1)  # trailing zeros
    slot = level * SLOTS + F.pmod(F.shiftright(h, 16), F.lit(SLOTS))
    return F.shiftleft(slot.cast("long"), 16) + F.shiftrightunsigned(h, 48)


def _summed(terms: Column) -> Column:
    """Sorted (slot, value) terms with each slot's values summed modulo 2^16;
    slots whose sum is 0 are left out."""
    slot, value = lambda t: F.shiftright(t, 16), lambda t: t.bitwiseAND(F.lit(0xFFFF))
    state = lambda done, last, total: F.struct(done.alias("done"), last.alias("last"), total.alias("total"))

    def closed(acc):
        total = value(acc["total"])
        return F.when((acc["last"] < 0) | (total == 0), acc["done"]).otherwise(
            F.concat(acc["done"], F.array(F.shiftleft(acc["last"], 16) + total)))

    return F.aggregate(
        F.array_sort(terms), state(F.lit([]).cast("array<bigint>"), F.lit(-1).cast("long"), F.lit(0).cast("long")),
        lambda acc, t: F.when(slot(t) == acc["last"], state(acc["done"], acc["last"], acc["total"] + value(t))).otherwise(
            state(closed(acc), slot(t), value(t))),
        closed)


def _dense(hashes: Column, lane: int) -> Column:
    """Sum modulo 2^32 of one half of a hash of the hashes."""
    half = lambda x: x if lane % 2 else F.shiftrightunsigned(x, 32)
    mask = F.lit(0xFFFFFFFF)
    return F.aggregate(hashes, F.lit(0).cast("long"),
                       lambda a, h: (a + half(F.xxhash64(h, F.lit(lane // 2))).bitwiseAND(mask)).bitwiseAND(mask))


def vector(hashes: Column) -> Column:
    """The fingerprint of a multiset of paragraph hashes: count, sums, slots."""
    return F.struct(F.size(hashes).cast("long").alias("n"),
                    F.array(*[_dense(hashes, i) for i in range(DENSE)]).alias("sums"),
                    _summed(F.transform(hashes, _term)).alias("slots"))


def combined(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint after b's paragraphs are inserted in a's (``sign`` 1) or
    deleted from them (-1), without their texts."""
    negated = F.transform(b["slots"], lambda t: t - t.bitwiseAND(F.lit(0xFFFF)) + (65536 - t.bitwiseAND(F.lit(0xFFFF))))
    return F.struct((a["n"] + sign * b["n"]).alias("n"),
                    F.zip_with(a["sums"], b["sums"], lambda x, y: (x + sign * y).bitwiseAND(F.lit(0xFFFFFFFF))).alias("sums"),
                    _summed(F.concat(a["slots"], b["slots"] if sign > 0 else negated)).alias("slots"))


def written_out(v: Column) -> Column:
    """A fingerprint as hexadecimal digits: count, sums, then 7 digits a slot."""
    digits = lambda x, n: F.lpad(F.lower(F.hex(x)), n, "0")
    return F.concat(digits(v["n"], 12), F.array_join(F.transform(v["sums"], lambda x: digits(x, 8)), ""),
                    F.array_join(F.transform(v["slots"], lambda x: digits(x, 7)), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the paragraphs, 1 only if all sums agree,
    from the slots that either fingerprint uses and those that differ."""
    slot = lambda t: F.shiftright(t, 16)
    union = F.array_distinct(F.transform(F.concat(a["slots"], b["slots"]), slot))
    apart = F.array_distinct(F.transform(
        F.concat(F.array_except(a["slots"], b["slots"]), F.array_except(b["slots"], a["slots"])), slot))
    levels = F.sequence(F.lit(LEVELS - 1), F.lit(0))  # from the sparsest
    used = lambda slots: F.transform(levels, lambda k: F.size(F.filter(slots, lambda s: (s >= k * SLOTS) & (s < (k + 1) * SLOTS))))
    estimate = lambda c: F.log(F.lit(float(SLOTS)) / (F.lit(float(SLOTS)) - F.least(c, F.lit(SLOTS - 1))))
    state = lambda every, differ, full: F.struct(every.alias("every"), differ.alias("differ"), full.alias("full"))
    limit = int(SLOTS * 0.8)
    # Levels from the sparsest to the first full one are samples of the same rate.
    share = F.aggregate(
        F.arrays_zip(used(union).alias("u"), used(apart).alias("d")), state(F.lit(0.0), F.lit(0.0), F.lit(False)),
        lambda acc, x: F.when(acc["full"] | ((x["u"] > limit) & (acc["every"] > 0)), state(acc["every"], acc["differ"], F.lit(True))).otherwise(
            state(acc["every"] + estimate(x["u"]), acc["differ"] + estimate(x["d"]), F.lit(False))),
        lambda acc: F.when(acc["every"] > 0, 1 - acc["differ"] / acc["every"]).otherwise(0.0))
    same = (a["n"] == b["n"]) & (a["sums"] == b["sums"]) & (a["slots"] == b["slots"])
    return F.when(same, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(0.999), share)))


def _successors(keys: DataFrame, levels: int = 3) -> DataFrame:
    """key, next: the next greater key, and the least one after the greatest."""
    if not levels:  # at most 2^FANOUT_BITS keys are left
        w = W.partitionBy(F.lit(0)).orderBy("key")
        ends = keys.agg(F.min("key").alias("least"))
        return keys.withColumn("after", F.lead("key").over(w)).join(F.broadcast(ends), F.lit(True)).select(
            "key", F.coalesce("after", "least").alias("next"))
    held = keys.withColumn("parent", F.shiftright("key", FANOUT_BITS))
    least = held.groupBy("parent").agg(F.min("key").alias("least"))
    up = _successors(least.select(F.col("parent").alias("key")), levels - 1)
    over = up.join(least, F.col("next") == F.col("parent")).select(F.col("key").alias("parent"), "least")
    w = W.partitionBy("parent").orderBy("key")
    return held.withColumn("after", F.lead("key").over(w)).join(over, "parent").select(
        "key", F.coalesce("after", "least").alias("next"))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next."""
    block = F.coalesce(F.shiftright(F.col(id_col).cast("long"), BLOCK_BITS), F.lit(_NULL_BLOCK))
    docs = df.select(block.alias("block"), F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    order = W.partitionBy("block").orderBy(F.col("id").asc_nulls_first(), "text")
    heads = docs.withColumn("rn", F.row_number().over(order)).where("rn = 1").select(
        F.col("block").alias("next"), F.col("text").alias("head"))
    after = _successors(docs.select(F.col("block").alias("key")).distinct())
    after = after.join(heads, "next").select(F.col("key").alias("block"), "head")

    rows = docs.withColumn("rn", F.row_number().over(order)).withColumn("follows", F.lead("text").over(order))
    rows = rows.join(after, "block").withColumn("last", F.col("follows").isNull())
    rows = rows.select("block", "rn", "id", "last", "text", F.coalesce("follows", "head").alias("follows"),
                       F.length("text").cast("long").alias("n_chars"))
    q = (F.col("n_chars") / 4).cast("int")
    rows = rows.withColumn("edited", F.concat(
        F.col("text").substr(F.lit(1), F.col("n_chars").cast("int") - q), F.col("follows").substr(F.lit(1), q)))
    hashed = rows.select(
        "block", "rn", "id", "last", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        paragraph_hashes(F.col("text")).alias("own"), paragraph_hashes(F.col("edited")).alias("changed"),
        F.when(F.col("last"), paragraph_hashes(F.col("follows"))).alias("beyond"))
    vectors = hashed.select(
        "block", "rn", "id", "last", "n_chars", "edited_sha256", vector(F.col("own")).alias("own"),
        vector(F.col("changed")).alias("changed"), F.when(F.col("last"), vector(F.col("beyond"))).alias("beyond"))
    near = vectors.withColumn("beyond", F.coalesce("beyond", F.lead("own").over(W.partitionBy("block").orderBy("rn"))))
    return near.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", written_out(F.col("own")).alias("fingerprint"),
        written_out(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("beyond")).alias("near_next"))
