"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers, so equal vectors are equal exactly and sums are
exact.  The principal components of the distinct vectors come from the singular
vectors of the centred rows X (never formed as a matrix, and no covariance is):

    u_k a_k     = X v_k - b_(k-1) u_(k-1)
    v_(k+1) b_k = X' u_k - a_k v_k

Both products of a step are one pass over the stored vectors.  A left vector is
as long as the table and is never kept: it is X w for a w as long as an
embedding, which the driver holds beside the v.  Both families are
orthogonalised against all of their earlier members in every step (of the left
ones the tasks return their products with the new one), and a step that finds
an invariant subspace goes on from a direction orthogonal to all before it.

The small bidiagonal matrix is decomposed after each step.  The steps end when
the wanted components have converged and what is left of the variance is less
than the smallest of them, so that none can be missed, or when all dimensions
are used.

What the driver holds is bounded by the square of the embedding's length.

Edge cases: vectors that are NULL or hold NULL or non-finite entries are left
out; repeated rows count once for the components and are all returned; vectors
of different lengths are whitened apart, each length by its own; empty vectors
and lengths without variance have no component and so no row, and a length has
no more components than its variance has dimensions; entries beyond 2^52 in
steps are cut there; a deviation beyond the range of a long is NULL; an empty
table gives no row; all other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftscore.llm.common import store, text_batches

COMPONENTS = 16
#: Steps of a unit, and what is added to make entries positive.
STEPS, SHIFT = 64, 1_000_000
MOST = float(2 ** 52)
#: Singular values under this share of the largest are rounding.
NOISE = 1e-11
#: A residual under this share of the largest singular value is convergence.
CONVERGED = 1e-14
ROWS = 1024


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id, size, x``: usable vectors in whole steps, as little-endian 64-bit values."""
    schema = pa.schema([("vec_id", pa.int64()), ("size", pa.int32()), ("x", pa.binary())])

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not vector.is_valid or vector.values.null_count:
                    continue
                v = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if len(v) and np.isfinite(v).all():
                    ids.append(vec_id)
                    out.append((np.clip(np.floor(STEPS * v), -MOST, MOST).astype("<i8") + SHIFT).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(x) // 8 for x in out], pa.int32()),
                                              pa.array(out, pa.binary())], schema=schema)

    text_batches(embeddings.sparkSession, ROWS)
    return embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(
        convert, "vec_id long, size int, x binary")


def _matrices(batches: Iterator[pa.RecordBatch], size: int, kind: str = "<i8") -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Every batch with its vectors as a matrix."""
    for batch in batches:
        if batch.num_rows:
            yield batch, np.frombuffer(b"".join(batch.column("x").to_pylist()), dtype=kind).reshape(-1, size)


def _summed(df: DataFrame, value: str) -> list:
    """Sums by place of the arrays ``value``: one row for each place comes back."""
    rows = df.select(F.posexplode(value).alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect()
    return [r.v for r in sorted(rows, key=lambda r: r.at)]


class Rows:
    """The distinct vectors of one length: exact sums, and products with the centred rows in passes over them.

    What the passes read is ``x - m`` for a whole ``m`` near the mean, in blocks
    of ``ROWS`` vectors and as few bytes an entry as hold them all.
    """

    def __init__(self, fit: DataFrame, size: int):
        self.size, self.passes = size, 0
        parts = fit.select("x").mapInArrow(self._sums(size), "n array<decimal(38,0)>, least long, most long")
        parts = store(parts, "vector-sums")
        sums = _summed(parts, "n")
        self.n, self.sums = (int(sums[0]), [int(v) for v in sums[1:]]) if sums else (0, [0] * size)
        # Centred entries are (n (x - m) - r) / n with whole m and r, r at most n / 2 in size: exact up to one rounding.
        self.middle = np.array([(2 * s + self.n) // (2 * self.n) if self.n else 0 for s in self.sums], dtype=np.int64)
        self.rest = [s - self.n * int(m) for s, m in zip(self.sums, self.middle)]
        if self.n:
            least, most = parts.agg(F.min("least"), F.max("most")).first()
            widest = max(most - int(self.middle.min()), int(self.middle.max()) - least)
            self.kind = next(k for k in ("<i2", "<i4", "<i8") if widest <= np.iinfo(k).max)
            self.blocks = store(fit.select("x").mapInArrow(self._block(size, self.middle, self.kind), "x binary"), "vector-blocks")

    @staticmethod
    def _sums(size: int):
        def total(batches):
            n, sums, least, most = 0, [0] * size, None, None
            for _, x in _matrices(batches, size):
                n += len(x)
                # High and low halves apart, so that no sum can run over.
                high, low = (x >> 26).sum(axis=0).tolist(), (x & ((1 << 26) - 1)).sum(axis=0).tolist()
                sums = [s + (h << 26) + k for s, h, k in zip(sums, high, low)]
                least, most = min(int(x.min()), x.max() if least is None else least), max(int(x.max()), x.min() if most is None else most)
            if n:
                yield pa.RecordBatch.from_arrays([
                    pa.array([[Decimal(v) for v in (n, *sums)]], pa.list_(pa.decimal128(38, 0))),
                    pa.array([int(least)], pa.int64()), pa.array([int(most)], pa.int64())], ["n", "least", "most"])
        return total

    @staticmethod
    def _block(size: int, middle: np.ndarray, kind: str):
        def pack(batches):
            for _, x in _matrices(batches, size):
                yield pa.RecordBatch.from_arrays([pa.array([(x - middle).astype(kind).tobytes()], pa.binary())], ["x"])
        return pack

    def centre(self):
        rest = np.array([float(r) / self.n for r in self.rest])
        return lambda off: off.astype(np.float64) - rest

    def over(self, total) -> DataFrame:
        """One row of a task: ``total`` of its centred matrices."""
        centre, size, kind = self.centre(), self.size, self.kind

        def pass_over(batches):
            s = total(centre(x) for _, x in _matrices(batches, size, kind))
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.list_(pa.float64()))], ["s"])

        self.passes += 1
        return self.blocks.mapInArrow(pass_over, "s array<double>")

    def product(self, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """For r = X v: X' r, U' r for the left vectors U = X w, and r' r."""
        size = self.size

        def total(matrices):
            back, with_u, square = np.zeros(size), np.zeros(w.shape[1]), 0.0
            for c in matrices:
                r = c @ v
                back += c.T @ r
                with_u += (c @ w).T @ r
                square += float(r @ r)
            return [*back, *with_u, square]

        s = np.array(_summed(self.over(total), "s"))
        return s[:size], s[size:-1], float(s[-1])

    def moments(self, project: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums and sums of products of the rows times ``project``."""
        k = project.shape[1]

        def total(matrices):
            sums, products = np.zeros(k), np.zeros((k, k))
            for c in matrices:
                z = c @ project
                sums += z.sum(axis=0)
                products += z.T @ z
            return [*sums, *products.ravel()]

        s = np.array(_summed(self.over(total), "s"))
        return s[:k], s[k:].reshape(k, k)

    def variance(self) -> float:
        """Sum of squares of all centred entries."""
        return float(_summed(self.over(lambda matrices: [float(sum((c ** 2).sum() for c in matrices))]), "s")[0])


def _fresh(basis: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A unit vector orthogonal to the columns of ``basis``."""
    v = rng.standard_normal(len(basis))
    for _ in range(3):
        v -= basis @ (basis.T @ v)
    return v / np.linalg.norm(v)


def principal(rows: Rows, wanted: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Components (columns) and their singular values by falling value, and the sum of all squared ones."""
    size, total = rows.size, rows.variance()
    if total <= 0:
        return np.empty((size, 0)), np.empty(0), total
    rng = np.random.default_rng(0)
    v = _fresh(np.empty((size, 0)), rng)
    right, left = np.empty((size, 0)), np.empty((size, 0))   # V, and w of U = X w
    diagonal, above = [], []                                 # of the bidiagonal matrix
    before = None                                            # b_(k-1)
    scale = np.sqrt(total)
    while True:
        right = np.column_stack([right, v])
        w = v.copy()
        if before:
            w -= before * left[:, -1]
        back, with_u, square = rows.product(w, left)
        # A left vector that is not orthogonal to those before it, beyond rounding, is corrected and looked at again.
        for _ in range(3):
            if not len(with_u) or np.linalg.norm(with_u) <= 1e-13 * np.sqrt(max(square, 0.0)) or square <= (1e-13 * scale) ** 2:
                break
            w = w - left @ with_u
            back, with_u, square = rows.product(w, left)
        a = np.sqrt(max(square, 0.0))
        if a <= 1e-13 * scale:  # this direction has no variance of its own
            a, back = 0.0, np.zeros(size)
            left = np.column_stack([left, np.zeros(size)])
        else:
            left = np.column_stack([left, w / a])
            back = back / a
        diagonal.append(a)
        rest = back - right @ (right.T @ back)
        rest -= right @ (right.T @ rest)
        b = float(np.linalg.norm(rest))
        k = len(diagonal)
        matrix = np.diag(diagonal) + (np.diag(above, 1) if above else 0)
        p, s, q = np.linalg.svd(matrix)
        least = min(wanted, k)
        # A singular triple's residual is b times the last entry of its left vector.
        near = b * np.abs(p[-1, :least]).max() <= CONVERGED * s[0]
        left_over = max(total - float((s ** 2).sum()), b * b)
        if k == size or (k >= wanted and near and left_over < s[wanted - 1] ** 2):
            break
        if b <= 1e-13 * scale:
            v, before = _fresh(right, rng), None
            above.append(0.0)
        else:
            v, before = rest / b, b
            above.append(b)
    good = [i for i in range(min(wanted, len(s))) if s[i] > NOISE * s[0]]
    components = right @ q[good].T
    # Either sign is right; this one doesn't depend on the run.
    components *= np.where(components[np.abs(components).argmax(axis=0), range(len(good))] < 0, -1, 1)
    return components, s[good], total


ROW = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
WHITE = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                   ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])


def whitened(vectors: DataFrame, fit: DataFrame, size: int, wanted: int = COMPONENTS) -> DataFrame:
    """Rows of the output for the vectors of one length, by the components of the distinct ones."""
    rows = Rows(fit, size)
    if not rows.n:
        return vectors.sparkSession.createDataFrame([], ROW)
    components, values, total = principal(rows, wanted)
    k, n = len(values), rows.n
    if not k:
        return vectors.sparkSession.createDataFrame([], ROW)
    project = components * (np.sqrt(n) / values)
    sums, products = rows.moments(project)
    error = float(np.abs(products / n - np.outer(sums / n, sums / n) - np.eye(k)).max())
    explained = values ** 2 / total
    centre, middle, rest = rows.centre(), rows.middle, rows.rest

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fits = max(abs(r) for r in rest) < 1 << 62
        for batch, x in _matrices(batches, size):
            off = x - middle
            z = centre(off) @ project
            # n (x - m) - r in 64 bits where the squares' sum is sure to fit, else in Python's own numbers.
            short = fits and (n * int(np.abs(off).max()) + max(abs(r) for r in rest)) ** 2 * size < 1 << 63
            if short:
                deviation = ((n * off - np.array(rest, dtype=np.int64)) ** 2).sum(axis=1).tolist()
            else:
                deviation = [sum((n * e - r) ** 2 for e, r in zip(row, rest)) for row in off.tolist()]
                deviation = [d if d < 1 << 63 else None for d in deviation]
            m = len(z)
            at = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n, dtype=np.int64)), pa.array(deviation, pa.int64()).take(pa.array(at)),
                pa.array(z.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))], schema=WHITE)

    return vectors.select("vec_id", "x").mapInArrow(give, ROW)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of all usable vectors of ``embeddings``."""
    vectors = store(whole_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet")), "vectors")
    distinct = store(vectors.select("size", "x").distinct(), "distinct-vectors")
    out = spark.createDataFrame([], ROW)
    for size in sorted(r.size for r in distinct.select("size").distinct().toLocalIterator()):
        of = F.col("size") == size
        out = out.union(whitened(vectors.where(of), distinct.where(of), size))
    return out
