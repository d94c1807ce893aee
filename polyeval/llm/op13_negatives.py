"""Hard negatives by exact inner products in a residue number system.

Components become whole numbers. Scores of a block of anchors against a block of rows
are matrix products modulo several primes under 1024, each in float32: residues are
centred, and as many dimensions are multiplied at once as keep every sum under 2^24,
so each product is exact. Chinese remaindering (mixed radix) gives back the exact
signed score; the number of primes follows from the greatest squared norm of the table,
which bounds every score (Cauchy-Schwarz).

Two passes meet the stated anchors with all rows, in blocks: the first keeps a block's best
rows of the anchor's label, and each anchor's best of all blocks are its positives; the
second keeps, for each positive, a block's best rows of other labels in the window below its
score. What leaves a block is a few rows an anchor; Spark's ranking makes the final choice.
Rows are dealt into blocks round robin, so no label, vector or id makes a block large; a
block holds at most ``BLOCK_ENTRIES`` numbers. An anchor goes to every block of rows
and a row to every block of anchors. The blocks change no result. Prepared rows and positives are written to the shared
checkpoint folder, so a lost task is repeated from files.

Defined cases: rows with a null label, a null vector, or a null, NaN or infinite component
take no part, nor do those whose scaled squared norm is 2^56 or more (their scores times 100 wouldn't fit a
long); of vectors of different lengths, the shorter is continued by zeros. A row that is repeated stays
as often among the candidates, but equal anchors (id, label and vector) count once.
Positives and negatives of an anchor have another id. Null ids are candidates, after all
others in a tie, and no anchors. Without rows, anchors, positives or rows in a window there are no result rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polyeval.llm.components import written
from polyeval.llm.exchange import empty_table
from polyeval.llm.vectors import finite, padded, whole_numbers

SCALE = 256
POSITIVES = NEGATIVES = 5
LOW, HIGH = 80, 100  # percent of the positive's score
NORM_BOUND = 1 << 56
BLOCK_ENTRIES = 1 << 22
TILE = 1 << 20  # scores that a task holds at once
EXACT = 1 << 24  # whole numbers below it are exact in float32
NONE = np.iinfo(np.int64).min


# ---------------------------------------------------------------- residue arithmetic

@lru_cache(maxsize=1)
def primes() -> tuple[int, ...]:
    """Primes under 1024, the greatest first."""
    return tuple(p for p in range(1023, 2, -2) if all(p % d for d in range(3, int(p ** 0.5) + 1, 2)))


def primes_for(bound: int) -> list[int]:
    """As many primes as tell whole numbers of magnitude up to ``bound`` apart."""
    out, product = [], 1
    for p in primes():
        if product > 2 * bound:
            break
        out.append(p)
        product *= p
    return out


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """Residues between -p/2 and p/2, in float32."""
    return ((x + p // 2) % p - p // 2).astype(np.float32)


def modular_products(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """a @ b.T modulo p, of matrices of centred residues."""
    step = EXACT // (p // 2) ** 2
    out = None
    for at in range(0, max(1, a.shape[1]), step):
        part = (a[:, at:at + step] @ b[:, at:at + step].T).astype(np.int32) % p
        out = part if out is None else (out + part) % p
    return out


def signed(parts: list[np.ndarray], moduli: list[int]) -> np.ndarray:
    """The whole numbers nearest to 0 that have these residues."""
    out, product = parts[0].astype(np.int64), moduli[0]
    for r, p in zip(parts[1:], moduli[1:]):
        digit = (r - out % p) * pow(product, -1, p) % p
        out += digit * product
        product *= p
    out[out > product // 2] -= product
    return out


class Scores:
    """Exact scores of anchors against a block of rows."""

    def __init__(self, rows: np.ndarray, anchors: np.ndarray, moduli: list[int]):
        self.moduli = moduli
        self.rows = [residues(rows, p) for p in moduli]
        self.anchors = [residues(anchors, p) for p in moduli]

    def of(self, i: int, j: int) -> np.ndarray:
        return signed([modular_products(a[i:j], r, p) for a, r, p in zip(self.anchors, self.rows, self.moduli)], self.moduli)


def best(scores: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(line, column, score) of each line's k best columns, in k rounds; of equal ones the
    first. ``scores`` is used up; ``NONE`` stands for no candidate."""
    lines = np.arange(len(scores))
    for _ in range(k):
        at = scores.argmax(axis=1)
        top = scores[lines, at]
        found = top != NONE
        if not found.any():
            return
        yield lines[found], at[found], top[found]
        scores[lines, at] = NONE


# ---------------------------------------------------------------- blocks

def prepare(df: DataFrame, anchors: Column, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """slot (a number of each row), id, label, is_anchor, comps (32-bit integers), norm2, size."""
    rows = df.where(finite(vector_col) & F.col(label_col).isNotNull()).select(
        F.monotonically_increasing_id().alias("slot"), F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("is_anchor"), F.col(vector_col).cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column("v")
            sizes = v.value_lengths().to_numpy(zero_copy_only=False)
            x = whole_numbers(padded(v, int(sizes.max(initial=0))), scale)
            with np.errstate(over="ignore"):
                fits = (x.astype(np.float64) ** 2).sum(axis=1) < NORM_BOUND
            x[~fits] = 0
            comps = [row[:n].astype("<i4").tobytes() for row, n in zip(x, sizes)]
            out = pa.RecordBatch.from_arrays([*(b.column(c) for c in ("slot", "id", "label", "is_anchor")), pa.array(comps, pa.binary()),
                                              pa.array((x * x).sum(axis=1), pa.int64()), pa.array(sizes, pa.int32())],
                                             ["slot", "id", "label", "is_anchor", "comps", "norm2", "size"])
            yield out.filter(pa.array(fits))
    return rows.mapInArrow(run, "slot long, id long, label string, is_anchor boolean, comps binary, norm2 long, size int")


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of 32-bit integers as a matrix of 64-bit ones."""
    blobs = column.to_pylist()
    out = np.zeros((len(blobs), width), dtype=np.int64)
    if all(len(x) == 4 * width for x in blobs):
        out[:] = np.frombuffer(b"".join(blobs), dtype="<i4").reshape(out.shape)
    else:
        for line, x in zip(out, blobs):
            line[:len(x) // 4] = np.frombuffer(x, dtype="<i4")
    return out


def by_id(t: pa.Table) -> pa.Table:
    """Rows by id, null ids last; of equal ids by slot."""
    return t.sort_by([("id", "ascending"), ("slot", "ascending")])


class Grid:
    """Deals rows and anchors into blocks and meets each block of anchors with each
    block of rows in a task."""

    def __init__(self, rows: DataFrame, moduli: list[int], width: int, n_rows: int, n_anchors: int):
        spark = rows.sparkSession
        most = max(16, BLOCK_ENTRIES // max(1, width))
        # Enough blocks for all tasks where the table is small; at most ``most`` rows in one.
        even = -(-n_rows // (2 * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))))
        self.n_r = max(1, -(-n_rows // min(most, max(512, even))))
        self.n_a = max(1, -(-n_anchors // most))
        self.moduli, self.width = moduli, width
        self.rows = rows.select("slot", "id", "label", "comps", F.explode(F.sequence(F.lit(0), F.lit(self.n_a - 1))).alias("a")).withColumn(
            "cell", F.col("a") * F.lit(self.n_r) + F.pmod("slot", F.lit(self.n_r))).drop("a")

    def meet(self, anchors: DataFrame, each, schema: str) -> DataFrame:
        """``each(rows, anchors, labels of both as numbers, scores)`` gives a table for a tile of anchors."""
        dealt = anchors.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(self.n_r - 1)))).withColumn(
            "cell", F.pmod(F.col("slot"), F.lit(self.n_a)) * F.lit(self.n_r) + F.col("r")).drop("r")
        moduli, width, none = self.moduli, self.width, empty_table(schema)

        def run(rows: pa.Table, own: pa.Table) -> pa.Table:
            rows = by_id(rows)
            x, y = matrix(rows["comps"], width), matrix(own["comps"], width)
            labels = {s: i for i, s in enumerate(set(rows["label"].to_pylist()) | set(own["label"].to_pylist()))}
            of_rows, of_own = (np.array([labels[s] for s in t["label"].to_pylist()], dtype=np.int64) for t in (rows, own))
            scores, out = Scores(x, y, moduli), []
            step = max(1, TILE // max(1, rows.num_rows))
            for at in range(0, own.num_rows if rows.num_rows else 0, step):
                tile = own.slice(at, step)
                same = of_own[at:at + step, None] == of_rows[None, :]
                out += each(rows, tile, same, scores.of(at, at + tile.num_rows))
            return pa.concat_tables([none, *out])

        return self.rows.groupBy("cell").cogroup(dealt.groupBy("cell")).applyInArrow(run, schema)


def mine(df: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank.
    ``anchors`` says which rows are anchors; a negative's score is between ``low`` and ``high`` percent of the positive's."""
    spark = df.sparkSession
    rows = written(prepare(df, anchors, id_col, vector_col, label_col, scale), "vectors")
    asked = rows.where("is_anchor and id is not null").dropDuplicates(["id", "label", "comps"]).select(
        *(F.col(c).alias(c) for c in ("slot", "id", "label", "comps")))  # columns of its own, as it meets the rows again
    top = rows.agg(F.count("*").alias("n"), F.max("norm2").alias("norm2"), F.max("size").alias("size"),
                   F.count_if(F.expr("is_anchor and id is not null")).alias("asked")).first()
    schema = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, positive_rank int")
    if not top.n or not top.asked or positives < 1 or negatives < 1:
        return spark.createDataFrame([], schema)
    grid = Grid(rows, primes_for(max(1, top.norm2)), top.size, top.n, top.asked)

    def other_ids(ids: np.ndarray, known: np.ndarray, own: pa.Table) -> np.ndarray:
        return (ids[None, :] != own["id"].to_numpy()[:, None]) | ~known[None, :]

    def ids_of(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        known = np.asarray(rows["id"].is_valid())
        return rows["id"].fill_null(0).to_numpy(), known

    def of_label(rows, own, same, scores):
        ids, known = ids_of(rows)
        near = np.where(same & other_ids(ids, known, own), scores, NONE)
        return [pa.table({"anchor": own["slot"].take(pa.array(line)), "id": rows["id"].take(pa.array(at)), "score": pa.array(score)})
                for line, at, score in best(near, positives)]

    found = grid.meet(asked, of_label, "anchor long, id long, score long")
    order = Window.partitionBy("anchor").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    found = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    found = written(found.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "score", "id"))).alias("found")), "positives")

    def in_window(rows, own, same, scores):
        ids, known = ids_of(rows)
        apart, out = ~same & other_ids(ids, known, own), []
        each = own["found"].to_pylist()
        hundred = scores * 100
        for place in range(positives):
            goal = np.array([x[place]["score"] if place < len(x) else -1 for x in each], dtype=np.int64)[:, None]
            inside = apart & (hundred >= low * goal) & (hundred <= high * goal) & np.array([place < len(x) for x in each])[:, None]
            for line, at, score in best(np.where(inside, scores, NONE), negatives):
                out.append(pa.table({
                    "anchor": own["slot"].take(pa.array(line)), "anchor_id": own["id"].take(pa.array(line)),
                    "positive_rank": pa.array(np.full(len(line), place + 1), pa.int32()),
                    "positive_id": pa.array([each[i][place]["id"] for i in line], pa.int64()),
                    "positive_score": pa.array(goal[line, 0]), "negative_id": rows["id"].take(pa.array(at)), "negative_score": pa.array(score)}))
        return out

    mined = grid.meet(asked.join(found.withColumnRenamed("anchor", "slot"), "slot"), in_window,
                      "anchor long, anchor_id long, positive_rank int, positive_id long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor", "positive_rank").orderBy(F.col("negative_score").desc(), F.col("negative_id").asc_nulls_last())
    mined = mined.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "positive_rank")
