"""Whitening of embeddings from an exact, bit-sliced scatter matrix.

Components become whole numbers x. A task gathers rows into blocks, shifts each
dimension of a block by its least value, so that none is negative, and packs bit
b of dimension i, over the block's rows, into 64-bit words: one bit plane for each
(b, i). The number of common ones of two planes (AND, then popcount), weighted by
2^(a+b) and summed over planes, is the exact cross-product of two dimensions; the
shifts are undone in whole numbers. Spark sums the tasks' counts in limbs of 30 bits,
so no sum is rounded or overflows, whatever the number of rows.

The driver gets these sums: a number for each pair of dimensions, however many rows
there are. It centres them as integers, n * sum(x_i x_j) - sum(x_i) sum(x_j), and only
that matrix, divided by n^2, is rounded to doubles and given to ``eigh``. A
component's sign makes its largest entry positive. Rows are then projected where
they lie; no row is shuffled. The covariance of the whitened rows is measured in a
pass over them.

Defined cases: rows whose vector is null or has a null, NaN or infinite entry are
dropped; a vector shorter than the longest is continued by zeros; scaled entries beyond
2^62 are held there; repeated ids or rows are rows of their own, and null ids stay null;
components without variance (none in a table of one row, fewer than the rank in one of
few rows) are left out, so an empty table, or one of equal vectors, gives no rows. A
deviation beyond a long is null and its digits are in ``deviation_exact``. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyeval.llm.vectors import finite, padded, whole_numbers

SCALE, ADD = 1024, 100_000
COMPONENTS = 8
BLOCK_ENTRIES = 1 << 18  # entries of a block of rows
LIMB = 30
#: Components with a lesser share of the variance, by dimension, are rounding errors.
NO_VARIANCE = 2.0 ** -50


# ---------------------------------------------------------------- scatter

def bit_planes(shifted: np.ndarray) -> np.ndarray:
    """Planes (bit, dimension, word) of a matrix of non-negative integers."""
    rows, width = shifted.shape
    bits = int(shifted.max(initial=0)).bit_length()
    words = -(-rows // 64)
    out = np.zeros((bits, width, words * 8), dtype=np.uint8)
    columns = np.ascontiguousarray(shifted.T)
    for b in range(bits):
        packed = np.packbits(((columns >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), axis=1)
        out[b, :, :packed.shape[1]] = packed
    return out.view(np.uint64)


def plane_products(planes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and cross-products (Python integers) of the rows that the planes hold."""
    bits, width, words = planes.shape
    sums, products = np.zeros(width, dtype=object), np.zeros((width, width), dtype=object)
    for b in range(bits):
        sums += np.bitwise_count(planes[b]).sum(axis=1, dtype=np.int64).astype(object) << b
    by_weight = np.zeros((max(0, 2 * bits - 1), width, width), dtype=np.int64)
    for a in range(bits):
        upper = planes[a:].reshape(-1, words)  # planes of this bit and the higher ones
        for i in range(width):
            common = np.bitwise_count(upper & planes[a, i]).sum(axis=1, dtype=np.int64).reshape(-1, width)
            for b, counts in enumerate(common, a):
                by_weight[a + b, i] += counts
                if b > a:
                    by_weight[a + b, :, i] += counts
    for weight, counts in enumerate(by_weight):
        products += counts.astype(object) << weight
    return sums, products


def block_moments(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and cross-products of a block of rows of 64-bit integers."""
    least = x.min(axis=0)
    shifted = x.astype(np.uint64) - least.astype(np.uint64)  # modulo 2^64, so right for any two longs
    sums, products = plane_products(bit_planes(shifted))
    m = least.astype(object)
    products = products + np.outer(m, sums) + np.outer(sums, m) + len(x) * np.outer(m, m)
    return sums + len(x) * m, products


def _limbs(value: int) -> list[int]:
    out = []
    while value >> LIMB not in (0, -1):
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*out, value]


@dataclass
class Moments:
    """Rows, their sums, and the sums of their products; all whole numbers."""

    n: int
    sums: list[int]
    products: list[list[int]]

    def centred(self) -> list[list[int]]:
        """n^2 times the covariance."""
        s = self.sums
        return [[self.n * q - a * b for q, b in zip(row, s)] for row, a in zip(self.products, s)]


def _rows(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return df.where(finite(vector_col)).select(F.col(id_col).alias("_id"), F.col(vector_col).cast("array<double>").alias("_v"))


def moments(rows: DataFrame, width: int, scale: int = SCALE, add: int = ADD) -> Moments:
    block = max(64, BLOCK_ENTRIES // max(1, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(width, dtype=object), np.zeros((width, width), dtype=object)
        held, rows_held = [], 0

        def take():
            nonlocal n, sums, products, held, rows_held
            x = np.concatenate(held)
            s, p = block_moments(x)
            n, sums, products = n + len(x), sums + s, products + p
            held, rows_held = [], 0

        for b in batches:
            x = whole_numbers(padded(b.column(0), width), scale, add)
            for at in range(0, len(x), block):
                held.append(x[at:at + block])
                rows_held += len(held[-1])
                if rows_held >= block:
                    take()
        if held:
            take()
        out = [(-1, -1, k, v) for k, v in enumerate(_limbs(n))]
        out += [(i, -1, k, v) for i in range(width) for k, v in enumerate(_limbs(int(sums[i])))]
        out += [(i, j, k, v) for i in range(width) for j in range(i, width) for k, v in enumerate(_limbs(int(products[i, j])))]
        i, j, k, v = zip(*out)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(k, pa.int32()), pa.array(v, pa.int64())], ["i", "j", "limb", "v"])

    parts = rows.select("_v").mapInArrow(run, "i int, j int, limb int, v long")
    n, sums, products = 0, [0] * width, [[0] * width for _ in range(width)]
    for r in parts.groupBy("i", "j", "limb").agg(F.sum("v").alias("v")).toLocalIterator():
        value = int(r.v) << (LIMB * r.limb)
        if r.i < 0:
            n += value
        elif r.j < 0:
            sums[r.i] += value
        else:
            products[r.i][r.j] += value
            if r.i != r.j:
                products[r.j][r.i] += value
    return Moments(n, sums, products)


# ---------------------------------------------------------------- whitening

@dataclass
class Whitening:
    """What turns x into whitened components."""

    n: int
    sums: list[int]
    vectors: np.ndarray  # a column a component
    values: np.ndarray
    explained: np.ndarray
    scale: int = SCALE
    add: int = ADD

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """x - S/n, and the exact sum of (n*x - S)^2 of each row: with S = n*base + rest and
        d = x - base it is n^2 * sum(d^2) - 2n * sum(d * rest) + sum(rest^2)."""
        n, width = self.n, max(1, x.shape[1])
        base, rest = [s // n for s in self.sums], [s % n for s in self.sums]
        far = max((abs(int(v)) for v in (x.max(initial=0), x.min(initial=0), *base)), default=0)
        d = x - np.array(base, dtype=np.int64) if far < 1 << 61 else x.astype(object) - np.array(base, dtype=object)
        near = int(np.abs(d).max(initial=0))
        kind = np.int64 if d.dtype == np.int64 and near * max(near, n) * width < 1 << 63 else object
        whole, left = d.astype(kind, copy=False), np.array(rest, dtype=kind)
        squares, across = (whole * whole).sum(axis=1).tolist(), (whole * left).sum(axis=1).tolist()
        same = sum(r * r for r in rest)
        exact = [n * n * int(a) - 2 * n * int(b) + same for a, b in zip(squares, across)]
        return d.astype(np.float64) - np.array([r / n for r in rest]), exact

    def project(self, z: np.ndarray) -> np.ndarray:
        """Whitened components of rows x - S/n."""
        return (z @ self.vectors) / np.sqrt(self.values)


def whitening(m: Moments, components: int = COMPONENTS, scale: int = SCALE, add: int = ADD) -> Whitening:
    centred = m.centred()
    width = len(centred)
    trace = sum(centred[i][i] for i in range(width))
    if not trace:
        return Whitening(m.n, m.sums, np.zeros((width, 0)), np.zeros(0), np.zeros(0), scale, add)
    square = m.n * m.n
    values, vectors = np.linalg.eigh(np.array([[c / square for c in row] for row in centred]))
    total = trace / square
    order = [i for i in np.argsort(-values, kind="stable") if values[i] > total * width * NO_VARIANCE][:components]
    values, vectors = values[order], vectors[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    return Whitening(m.n, m.sums, vectors * signs, values, values / total, scale, add)


def fit(rows: DataFrame, components: int, scale: int = SCALE, add: int = ADD) -> Whitening | None:
    width = rows.agg(F.max(F.size("_v")).alias("n")).first().n
    if not width:
        return None
    return whitening(moments(rows, width, scale, add), components, scale, add)


def identity_error(rows: DataFrame, w: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    width, k = w.vectors.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))  # the last column is 1: sums and the count
        for b in batches:
            z, _ = w.centred(whole_numbers(padded(b.column(0), width), w.scale, w.add))
            y = np.hstack([w.project(z), np.ones((len(z), 1))])
            total += y.T @ y
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], ["i", "j", "v"])

    total = np.zeros((k + 1, k + 1))
    for r in rows.select("_v").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toLocalIterator():
        total[r.i, r.j] = r.v
    mean = total[:k, k] / total[k, k]
    return float(np.abs(total[:k, :k] / total[k, k] - np.outer(mean, mean) - np.eye(k)).max())


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, add: int = ADD) -> DataFrame:
    """A row for each sound vector and component."""
    rows = _rows(df, id_col, vector_col)
    schema = (f"{id_col} {rows.schema['_id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double, deviation_exact string")
    w = fit(rows, components, scale, add)
    if w is None or not len(w.values):
        return df.sparkSession.createDataFrame([], schema)
    error, (width, k) = identity_error(rows, w), w.vectors.shape
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            z, squares = w.centred(whole_numbers(padded(b.column(1), width), w.scale, w.add))
            y, n = w.project(z), b.num_rows
            each = np.repeat(np.arange(n), k)
            exact = [None if s < 1 << 63 else str(s) for s in squares]
            fits = pa.array([s if t is None else None for s, t in zip(squares, exact)], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), n), pa.int32()), pa.array(np.full(n * k, w.n)),
                 fits.take(pa.array(each)), pa.array(y.ravel()), pa.array(np.tile(w.explained, n)), pa.array(np.full(n * k, error)),
                 pa.array(exact, pa.string()).take(pa.array(each))], names)

    return rows.mapInArrow(run, schema)
