"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The rows, as integers, are packed into blocks once. With X the centred rows, the steps

    u_j = X v_j - beta u_(j-1),  alpha = |u_j|;    v_(j+1) = X' u_j - alpha v_j,  beta = |v_(j+1)|

turn X into a bidiagonal matrix U' X V = B. Each step makes the products X v and X' u
over the blocks; a task centres its rows before it multiplies, and the sums over rows
are made by Spark. Both sides are reorthogonalised in full, twice. The right vectors
have one entry for each dimension and stay on the driver. A left vector has one entry
for each row and is never kept: as all left vectors are X times something, it is kept
as that something, w with u = X w, and made anew from the rows in each product. Then
U'u = W' X' (X w), so the same distributed product serves its reorthogonalisation.

The singular values of the small B give the deviations along the components, its right
singular vectors the components themselves. Where a step comes to an end, because the
rows span no more or a variance occurs several times, it starts again with a new
vector that is orthogonal to all before, until all dimensions are taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.llm.columns import inputs
from tapelake.workspace import materialize

COMPONENTS = 32
STEP, ORIGIN = 64, 1_000_000
BLOCK_ENTRIES = 1 << 18
LARGEST = float(1 << 52)  # larger entries count as this one
VANISHED = 1e-10  # of |X|: a length that is rounding only
FLAT = 1e-8  # of the largest deviation: a component in which the rows do not vary
LARGEST_LONG = float(1 << 63)

BLOCK = "ids binary, missing binary, x binary, n long"
ROW = "vec_id long, component int, deviation long, whitened double"


def block_rows(dims: int):
    """Vectors as rows of integers, some thousand entries to a block; those with bad entries are dropped."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, BLOCK_ENTRIES // dims)
            for at in range(0, len(batch), step):
                part = batch.slice(at, step)
                vectors = part.column("vector")
                flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64)
                rows = flat.reshape(-1, dims)
                good = np.isfinite(rows).all(axis=1)
                ids = part.column("vec_id").to_numpy(zero_copy_only=False)
                missing = part.column("vec_id").is_null().to_numpy(zero_copy_only=False)
                ids = np.where(missing, 0, ids).astype(np.int64)
                x = np.floor(np.clip(rows[good] * STEP, -LARGEST, LARGEST)).astype(np.int64) + ORIGIN
                row = (ids[good].tobytes(), missing[good].tobytes(), x.tobytes(), int(good.sum()))
                types = (pa.binary(), pa.binary(), pa.binary(), pa.int64())
                if row[-1]:
                    arrays = [pa.array([v], t) for v, t in zip(row, types, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["ids", "missing", "x", "n"])

    return pack


def blocks_of(rows: DataFrame) -> tuple[DataFrame, int]:
    """The blocks of all good vectors, and their length."""
    rows = rows.where("vector IS NOT NULL AND size(vector) > 0")
    lengths = rows.groupBy(F.size("vector").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("dims")).first()
    dims = usual["dims"] if usual else 1
    rows = rows.where(F.size("vector") == dims).where(~F.exists("vector", lambda c: c.isNull()))
    return materialize(rows.mapInArrow(block_rows(dims), BLOCK), "vector-blocks"), dims


def block_matrices(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for raw in batch.column("x"):
            yield np.frombuffer(raw.as_buffer(), np.int64).reshape(-1, dims)


def summed(blocks: DataFrame, of_task, kind: str = "double") -> list:
    """Sums over all tasks of an array of fixed size that ``of_task`` makes from a task's blocks."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = of_task(batches)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(own)), pa.int64()), pa.array(own)], names=["i", "value"]
        )

    each = blocks.mapInArrow(read, f"i long, value {kind}")
    value = F.col("value").cast("decimal(38,0)") if kind == "long" else F.col("value")
    return [s for _, s in sorted(each.groupBy("i").agg(F.sum(value)).collect())]


@dataclass
class Fit:
    n: int
    sums: list[int]
    components: np.ndarray  # a row for each component
    variances: np.ndarray
    trace: float

    @property
    def means(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def centred_product(blocks: DataFrame, means: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, float]:
    """X' u and |u|^2 of u = X w for the centred rows X: each task makes its part of u, then of X' u."""
    dims = len(means)

    def of_task(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(dims + 1)
        for x in block_matrices(batches, dims):
            rows = x - means
            u = rows @ w
            total[:dims] += u @ rows
            total[dims] += u @ u
        return total

    sums = np.array(summed(blocks, of_task))
    return sums[:dims], float(sums[dims])


def orthogonal(vector: np.ndarray, against: list[np.ndarray]) -> np.ndarray:
    """What is left of a vector beside an orthonormal set, taken off twice."""
    if against:
        basis = np.array(against)
        for _ in range(2):
            vector = vector - basis.T @ (basis @ vector)
    return vector


def bidiagonalise(product, dims: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """(V, B): right vectors as rows, and the bidiagonal matrix.

    ``product`` gives X'u and |u|^2 of u = X w, ``scale`` is |X|.
    """
    rng = np.random.default_rng(7)
    right: list[np.ndarray] = []
    left = np.empty((0, dims))  # w with u = X w
    back = np.empty((0, dims))  # X' u
    bidiagonal = np.zeros((dims, dims))
    ahead, beta = rng.standard_normal(dims), 0.0
    for j in range(dims):
        v = orthogonal(ahead, right)
        v /= np.linalg.norm(v)
        right.append(v)
        if j:
            bidiagonal[j - 1, j] = beta
        w = v - beta * left[-1] if beta else v
        xtu, square = product(w)
        for _ in range(2):  # u beside all u before; what goes is known by its X' u
            shares = left @ xtu
            w, xtu = w - shares @ left, xtu - shares @ back
            square -= float(shares @ shares)
        alpha = np.sqrt(max(0.0, square))
        if alpha <= VANISHED * scale:  # X v lies in the left vectors: start again
            left, back = np.vstack([left, np.zeros(dims)]), np.vstack([back, np.zeros(dims)])
            ahead, beta = rng.standard_normal(dims), 0.0
            continue
        left, back = np.vstack([left, w / alpha]), np.vstack([back, xtu / alpha])
        bidiagonal[j, j] = alpha
        ahead = orthogonal(back[-1] - alpha * v, right)
        beta = float(np.linalg.norm(ahead))
        if beta <= VANISHED * scale:
            ahead, beta = rng.standard_normal(dims), 0.0
    return np.array(right), bidiagonal


def fit(blocks: DataFrame, dims: int, components: int = COMPONENTS) -> Fit:
    """The components of all blocks by falling variance; none where the variance is rounding only."""
    n = blocks.agg(F.sum("n")).first()[0] or 0
    if not n:
        return Fit(0, [], np.empty((0, dims)), np.empty(0), 0.0)

    def column_sums(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(dims, np.int64)
        for x in block_matrices(batches, dims):
            total += x.sum(axis=0)
        return total

    sums = [int(s) for s in summed(blocks, column_sums, "long")]
    means = np.array([s / n for s in sums])

    def square_sums(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        return np.array([sum((float(((x - means) ** 2).sum()) for x in block_matrices(batches, dims)), 0.0)])

    trace = summed(blocks, square_sums)[0] / n
    if not trace:
        return Fit(n, sums, np.empty((0, dims)), np.empty(0), 0.0)
    right, bidiagonal = bidiagonalise(
        lambda w: centred_product(blocks, means, w), dims, float(np.sqrt(trace * n))
    )
    _, deviations, turned = np.linalg.svd(bidiagonal)
    kept = [i for i in range(min(components, dims)) if deviations[i] > FLAT * deviations[0]]
    return Fit(n, sums, (turned @ right)[kept], deviations[kept] ** 2 / n, trace)


def projected(x: np.ndarray, found: Fit) -> np.ndarray:
    return (x - found.means) @ found.components.T / np.sqrt(found.variances)


def identity_error(blocks: DataFrame, found: Fit) -> float:
    """Largest entry of the whitened rows' covariance minus the identity."""
    k, dims = found.components.shape

    def first(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        return sum((projected(x, found).sum(axis=0) for x in block_matrices(batches, dims)), np.zeros(k))

    mean = np.array(summed(blocks, first)) / found.n

    def second(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((k, k))
        for x in block_matrices(batches, dims):
            rows = projected(x, found) - mean
            total += rows.T @ rows
        return total.ravel()

    covariance = np.array(summed(blocks, second)).reshape(k, k) / found.n
    return float(np.abs(covariance - np.eye(k)).max())


def exact_deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2 of each row; null beyond 64 bits."""
    rough = ((n * (x - np.array([s / n for s in sums]))) ** 2).sum(axis=1)
    if max(rough.max(), n * float(np.abs(x).max())) < LARGEST_LONG / 4:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [d if d < 1 << 63 else None for d in exact]


def whitened_rows(found: Fit):
    k, dims = found.components.shape

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, x in enumerate(block_matrices([batch], dims)):
                ids = np.frombuffer(batch.column("ids")[i].as_buffer(), np.int64)
                missing = np.frombuffer(batch.column("missing")[i].as_buffer(), bool)
                deviations = exact_deviations(x, found.n, found.sums)
                arrays = [
                    pa.array(np.repeat(ids, k), pa.int64(), mask=np.repeat(missing, k)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(ids))),
                    pa.array([d for d in deviations for _ in range(k)], pa.int64()),
                    pa.array(projected(x, found).ravel()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "component", "deviation", "whitened"])

    return read


def whiten(
    vectors: DataFrame,
    components: int = COMPONENTS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every good row and component.

    Rows whose vector is null, empty, or holds null or non-finite entries are dropped, and
    so are those of another length than most rows have (of lengths as frequent: the
    longest). An entry c counts as floor(64 c) + 1000000, beyond 2**52 as 2**52.
    Components in which the rows do not vary are left out, so equal rows, a single row
    and an empty table give no rows. ``deviation`` is null beyond 64 bits. A row without
    vec_id keeps it null; repeated rows count and are given repeatedly. Other columns
    are ignored.
    """
    vector = F.col("vector").cast("array<double>")
    rows = inputs(vectors, vec_id=id_col, vector=vector_col)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    blocks, dims = blocks_of(rows)
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = fit(blocks, dims, components)
        error = identity_error(blocks, found) if len(found.variances) else 0.0
    finally:
        blocks.unpersist()
    shares = [float(e / found.trace) for e in found.variances]
    explained = F.element_at(F.array(*map(F.lit, shares)), F.col("component")) if shares else F.lit(0.0)
    return blocks.mapInArrow(whitened_rows(found), ROW).select(
        "vec_id",
        "component",
        F.lit(found.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained.alias("explained"),
        F.lit(error).alias("identity_error"),
    )
