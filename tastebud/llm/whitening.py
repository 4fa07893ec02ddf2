"""Embedding whitening from exact bit-sliced cross-products.

An entry c becomes the integer ``x = floor(64 c) + 1000000``.

1. One pass finds the number of vectors and each dimension's smallest and largest x.
2. Each dimension, less its smallest value, is cut into bit planes: bit b of 64 rows is one word.
   The sum over rows of ``u_j u_k`` is then ``sum over bits a, b of 2**(a + b) popcount(plane_ja AND
   plane_kb)``, exactly; sums of u are weighted popcounts too.  Dimensions wider than 16 bits are cut
   into digits of 16 bits first, so that every count of a task fits 64 bits.  Tasks add up their rows
   and send one row per pair of digits.
3. The driver (d x d numbers, whatever the number of rows) centres as integers,
   ``n sum(u_j u_k) - sum(u_j) sum(u_k)``, divides by n**2 and takes eigenvectors by ``eigh``.
4. Vectors are projected in tasks and written; the identity error is measured on what was written.

Components whose eigenvalue is nothing but rounding (a constant dimension, fewer vectors than
dimensions) can't be scaled to variance 1 and are left out.

Defined cases: vectors that are null, empty or hold null or non-finite entries are dropped, and so
are those of another length than the most frequent one (the shortest of equals); ``64 c`` beyond
+-2**61 counts as that; rows that repeat an id or a vector count one by one, a null id stays; no
vectors, or vectors that are all equal, give no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
LIMIT = 1 << 61
#: rows whose planes are made at once
BLOCK_ROWS = 1 << 14
DIGIT = 16


def _integers(column: pa.Array, d: int) -> np.ndarray:
    """The vectors of a list column as a matrix of x."""
    c = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
    return np.clip(np.floor(SCALE * c), -LIMIT, LIMIT).astype(np.int64) + OFFSET


def _blocks(batches, d: int):
    for batch in batches:
        for i in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(i, BLOCK_ROWS)
            if part.num_rows:
                yield part, _integers(part.column(0), d)


def _ranges(batches, d: int):
    n, low, high = 0, None, None
    for _, x in _blocks(batches, d):
        n += len(x)
        low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
        high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array(np.full(d, n)), pa.array(low), pa.array(high)], names=["dim", "n", "low", "high"])


class Planes:
    """Which digits and bit planes the dimensions have."""

    def __init__(self, low: np.ndarray, high: np.ndarray):
        self.low = low
        digits = [(j, g) for j, (a, b) in enumerate(zip(low.tolist(), high.tolist())) for g in range(-(-(b - a).bit_length() // DIGIT))]
        self.dim = np.array([j for j, _ in digits], np.int64)
        self.digit = np.array([g for _, g in digits], np.int64)
        bits = [min(DIGIT, (int(high[j]) - int(low[j])).bit_length() - DIGIT * g) for j, g in digits]
        self.first = np.concatenate([[0], np.cumsum(bits)]).astype(np.int64)  # of each digit's planes
        self.owner = np.repeat(np.arange(len(digits)), bits)
        self.bit = np.arange(len(self.owner)) - self.first[self.owner]

    def cut(self, x: np.ndarray) -> np.ndarray:
        """Bit planes of some rows: one row of 64-bit words per plane."""
        u = (x - self.low).astype(np.uint64).T
        words = -(-x.shape[0] // 64)
        out = np.zeros((len(self.owner), words * 8), np.uint8)
        for p, (q, b) in enumerate(zip(self.owner, self.bit)):
            bits = (u[self.dim[q]] >> np.uint64(DIGIT * self.digit[q] + b)) & np.uint64(1)
            packed = np.packbits(bits.astype(np.uint8))
            out[p, : len(packed)] = packed
        return out.view(np.uint64)


def _products(batches, d: int, planes: Planes):
    """(p, q, s) for digits p <= q: the task's sum of their products; (p, -1, s): of digit p itself."""
    size = len(planes.dim)
    sums, cross = np.zeros(size, np.int64), np.zeros((size, size), np.int64)
    weight = np.int64(1) << planes.bit
    for _, x in _blocks(batches, d):
        cut = planes.cut(x)
        if not size:
            continue
        sums += np.add.reduceat(np.bitwise_count(cut).sum(axis=1, dtype=np.int64) * weight, planes.first[:-1])
        for p in range(len(cut)):
            q = planes.owner[p]
            start = planes.first[q]
            both = np.bitwise_count(cut[start:] & cut[p]).sum(axis=1, dtype=np.int64) * weight[start:]
            cross[q, q:] += weight[p] * np.add.reduceat(both, planes.first[q:-1] - start)
    i, j = np.triu_indices(size)
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.arange(size), i]).astype(np.int32)), pa.array(np.concatenate([np.full(size, -1), j]).astype(np.int32)),
                                      pa.array(np.concatenate([sums, cross[i, j]]))], names=["p", "q", "s"])


def centred_products(n: int, rows, planes: Planes, d: int) -> tuple[list[int], list[list[int]]]:
    """Sums of u and ``n sum(u_j u_k) - sum(u_j) sum(u_k)``, exact."""
    dim, digit = planes.dim.tolist(), planes.digit.tolist()
    sums, cross = [0] * d, [[0] * d for _ in range(d)]
    for p, q, s in rows:
        if q < 0:
            sums[dim[p]] += s << DIGIT * digit[p]
            continue
        j, k, v = dim[p], dim[q], s << DIGIT * (digit[p] + digit[q])
        cross[j][k] += v if j != k or p == q else 2 * v  # two digits of one dimension meet twice
    for j in range(d):
        for k in range(j, d):
            cross[j][k] = cross[k][j] = n * cross[j][k] - sums[j] * sums[k]
    return sums, cross


def _project(batches, d: int, n: int, low: np.ndarray, sums: list[int], basis: np.ndarray, wide: bool):
    """(vec_id, deviation, whitened) of each vector."""
    whole, part = zip(*(divmod(s, n) for s in sums))
    whole, part = np.array(whole, np.int64), np.array(part, np.float64) / n
    for batch, x in _blocks(batches, d):
        u = x - low
        z = ((u - whole).astype(np.float64) - part) @ basis
        if wide:  # Python's integers where 64 bits don't hold the result
            deviation = pa.array([str(sum((n * a - b) ** 2 for a, b in zip(row, sums))) for row in u.tolist()]).cast(pa.decimal128(38, 0))
        else:
            deviation = pa.array(((n * u - np.array(sums, np.int64)) ** 2).sum(axis=1)).cast(pa.decimal128(38, 0))
        cuts = np.arange(len(x) + 1, dtype=np.int32) * basis.shape[1]
        yield pa.RecordBatch.from_arrays([batch.column(1), deviation, pa.ListArray.from_arrays(cuts, pa.array(z.ravel()))], names=["vec_id", "deviation", "whitened"])


def _second_moments(batches, size: int):
    """(a, b, s): sums of z_a z_b, and of z_a where b = -1."""
    total, cross = np.zeros(size), np.zeros((size, size))
    for batch in batches:
        z = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
        total += z.sum(axis=0)
        cross += z.T @ z
    a, b = np.divmod(np.arange(size * size), size)
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.arange(size), a]).astype(np.int32)), pa.array(np.concatenate([np.full(size, -1), b]).astype(np.int32)),
                                      pa.array(np.concatenate([total, cross.ravel()]))], names=["a", "b", "s"])


class Whitening:
    """The fit: number of vectors, exact sums and centred products, eigenvalues and unit eigenvectors (falling)."""

    def __init__(self, vectors: DataFrame, d: int):
        """``vectors``: one column of valid vectors of length ``d``."""
        rows = vectors.mapInArrow(lambda it: _ranges(it, d), "dim int, n long, low long, high long")
        found = sorted(rows.groupBy("dim").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).collect())  # d rows
        self.d, self.n = d, found[0].n
        self.low = np.array([r.low for r in found], np.int64)
        self.high = np.array([r.high for r in found], np.int64)
        planes = Planes(self.low, self.high)
        parts = vectors.mapInArrow(lambda it: _products(it, d, planes), "p int, q int, s long")
        total = parts.groupBy("p", "q").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
        # one row per pair of digits: about d * d / 2, whatever the number of vectors
        self.sums, self.centred = centred_products(self.n, ((r.p, r.q, int(r.s)) for r in total.toLocalIterator()), planes, d)
        square = self.n * self.n
        self.covariance = np.array([[v / square for v in row] for row in self.centred])
        values, vectors_ = np.linalg.eigh(self.covariance)
        self.values, self.vectors = values[::-1], vectors_[:, ::-1]
        self.trace = sum(self.centred[j][j] for j in range(d)) / square

    def components(self, most: int) -> int:
        """How many of the first ``most`` eigenvalues are more than rounding."""
        floor = max(self.values[0], 0.0) * self.d * 8 * np.finfo(float).eps
        return int((self.values[:most] > floor).sum())


def valid_vectors(table: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(vector, id) of the vectors that count, and their length (0: none)."""
    ok = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = table.select(F.col(f"`{vector_col}`").cast("array<double>").alias("v"), F.col(f"`{id_col}`").cast("long").alias("vec_id"))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0)).where(ok)
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.col("count").desc(), "d").first()
    return (rows.where(F.size("v") == common.d), common.d) if common else (rows, 0)


RESULT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error."""
    spark = table.sparkSession
    rows, d = valid_vectors(table, id_col, vector_col)
    fit = Whitening(rows.select("v"), d) if d else None
    k = fit.components(min(components, d)) if fit else 0
    if not k:
        return spark.createDataFrame([], RESULT)
    basis = fit.vectors[:, :k] / np.sqrt(fit.values[:k])
    n, low, sums = fit.n, fit.low, fit.sums
    wide = d * (n * int((fit.high - fit.low).max())) ** 2 >= 1 << 62
    written, _ = materialize(rows.mapInArrow(lambda it: _project(it, d, n, low, sums, basis, wide), "vec_id long, deviation decimal(38,0), whitened array<double>"))
    moments = written.select("whitened").mapInArrow(lambda it: _second_moments(it, k), "a int, b int, s double").groupBy("a", "b").agg(F.sum("s").alias("s")).collect()  # k * (k + 1) rows
    mean, cross = np.zeros(k), np.zeros((k, k))
    for a, b, s in moments:
        if b < 0:
            mean[a] = s / n
        else:
            cross[a, b] = s / n
    error = float(np.abs(cross - np.outer(mean, mean) - np.eye(k)).max())
    explained = F.array(*[F.lit(float(e / fit.trace)) for e in fit.values[:k]])
    each = written.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select("vec_id", (F.col("place") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                       explained[F.col("place")].alias("explained"), F.lit(error).alias("identity_error"))
