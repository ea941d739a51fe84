"""Whitening of embeddings.

Entries become whole numbers (``scale`` times the entry, floored, plus
``shift``), so that counts and sums are exact.  Two passes over the vectors
give their number and sums, then the scatter of the centred vectors: each task
adds up its own, the parts are added by row of the scatter.  Only the scatter
(dimensions squared) reaches the driver.  There it goes through a Cholesky
factorisation with diagonal pivoting; one-sided Jacobi rotations of the
triangular factor's columns make them orthogonal, so that their squared norms
are the eigenvalues and, normalised, they are the components.  The factor is
never multiplied out again, which keeps small eigenvalues accurate."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from streamkit.llm.registry import query, saved, table

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
LIMIT = 1 << 52  # entries' size, beyond which they are held there
SWEEPS = 60  # of Jacobi, far more than it ever takes


def pivoted_cholesky(a: np.ndarray, tolerance: float | None = None) -> np.ndarray:
    """F with a = F F^T and a column per rank: the rows, put in pivot order, are
    a lower triangular factor.  Ends when no pivot above ``tolerance`` (dimension
    times machine precision of the largest, by default) is left."""
    d = len(a)
    factor, rest = np.zeros((d, d)), np.diag(a).astype(float).copy()
    floor = (d * np.finfo(float).eps if tolerance is None else tolerance) * rest.max(initial=0)
    done = np.zeros(d, bool)
    for k in range(d):
        p = int(np.argmax(np.where(done, -np.inf, rest)))
        if rest[p] <= floor:
            return factor[:, :k]
        column = (a[:, p] - factor[:, :k] @ factor[p, :k]) / np.sqrt(rest[p])
        column[done] = 0
        column[p] = np.sqrt(rest[p])
        factor[:, k] = column
        rest -= column * column
        done[p] = True
    return factor


def rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each pair of columns once, in rounds of disjoint pairs (a round robin)."""
    seats = list(range(n + n % 2))
    out = []
    for _ in range(len(seats) - 1):
        half = len(seats) // 2
        pairs = [(min(p), max(p)) for p in zip(seats[:half], seats[:half - 1:-1]) if max(p) < n]
        out.append(tuple(np.array(c) for c in zip(*pairs)))
        seats.insert(1, seats.pop())
    return out


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of factor factor^T."""
    f = factor.copy()
    n = f.shape[1]
    plan = rounds(n) if n > 1 else []
    for _ in range(SWEEPS):
        most = 0.0
        for i, j in plan:
            x, y = f[:, i], f[:, j]
            a, b, c = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            size = np.sqrt(a * b)
            off = np.divide(np.abs(c), size, out=np.zeros_like(c), where=size > 0)
            most = max(most, float(off.max()))
            turn = off > 1e-16
            safe = np.where(turn, c, 1.0)
            z = (b - a) / (2 * safe)
            t = np.where(z >= 0, 1.0, -1.0) / (np.abs(z) + np.sqrt(1 + z * z))
            t = np.where(turn, t, 0.0)
            cos = 1 / np.sqrt(1 + t * t)
            sin = cos * t
            f[:, i], f[:, j] = cos * x - sin * y, sin * x + cos * y
        if most < 1e-15:
            break
    norms = np.sqrt((f * f).sum(axis=0))
    order = np.argsort(-norms, kind="stable")
    order = order[norms[order] > 0]
    return norms[order] ** 2, f[:, order] / norms[order]


def _whole(batch: pa.RecordBatch, at: int, dims: int, scale: float, shift: int) -> np.ndarray:
    values = np.asarray(batch.column(at).flatten(), dtype=np.float64).reshape(-1, dims)
    return np.clip(np.floor(values * scale), -LIMIT, LIMIT).astype(np.int64) + shift


def _sums(dims: int, scale: float, shift: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for batch in batches:
            x = _whole(batch, 0, dims, scale, shift)
            n, high, low = n + len(x), high + (x >> 26).sum(axis=0), low + (x & (1 << 26) - 1).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims), pa.int32()), pa.array(np.full(dims, n)), pa.array(high), pa.array(low)], names=["dim", "n", "high", "low"])
    return run


def _scatter(mean_of: tuple[int, np.ndarray, np.ndarray], scale: float, shift: int):
    """Each task's rows of the sum of outer products of centred vectors."""
    n, whole, part = mean_of
    dims = len(whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            c = (_whole(batch, 0, dims, scale, shift) - whole) - part
            total += c.T @ c
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(dims), dims), pa.int32()), pa.array(np.tile(np.arange(dims), dims), pa.int32()),
                                          pa.array(total.ravel())], names=["i", "j", "v"])
    return run


def _project(n: int, sums: list[int], weights: np.ndarray, whole: np.ndarray, part: np.ndarray, scale: float, shift: int):
    """Each vector's exact deviation and its projections."""
    sums_at = np.array(sums, dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _whole(batch, 1, len(sums), scale, shift)
            far = int(np.abs(x - whole).max(initial=0)) + 1
            if len(sums) * (n * far) ** 2 < 1 << 62:  # fits a long at every step
                d = n * (x - whole) - np.array([s - n * w for s, w in zip(sums, whole.tolist())], np.int64)
                deviation = pa.array((d * d).sum(axis=1))
            else:
                exact = [int(((n * row - sums_at) ** 2).sum()) for row in x.astype(object)]
                deviation = pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())
            y = ((x - whole) - part) @ weights
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * weights.shape[1]), pa.array(y.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), deviation, lists], names=["vec_id", "deviation", "whitened"])
    return run


def _moments(k: int):
    """Each task's number, sums and sums of products of the whitened vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            y = np.asarray(batch.column(0).flatten()).reshape(-1, k)
            y = np.concatenate([y, np.ones((len(y), 1))], axis=1)
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(k + 1), k + 1), pa.int32()), pa.array(np.tile(np.arange(k + 1), k + 1), pa.int32()),
                                          pa.array(total.ravel())], names=["i", "j", "v"])
    return run


def _matrix(parts: DataFrame, size: int) -> np.ndarray:
    """The parts of all tasks added up: size squared rows reach the driver."""
    out = np.zeros((size, size))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r.i, r.j] = r.v
    return out


def whiten(vectors: DataFrame, *, components: int = COMPONENTS, scale: float = SCALE, shift: int = SHIFT,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per vector (vec_id, n, deviation, whitened, values, trace, identity_error):
    the number of vectors; the sum over dimensions of (n * x - S)^2, exact (null
    if it is beyond a long); the vector's projections on up to ``components``
    components over the roots of their eigenvalues; those eigenvalues, falling;
    the covariance's trace; and the largest entry by which the covariance of the
    whitened vectors differs from the identity.

    Rows whose vector is null, empty or holds a null or non-finite entry are
    dropped; so are those of another length than most (of equally many: than the
    longest).  Entries whose multiple is beyond 2^52 are held there.  There are
    as many components as the covariance has rank (vectors that are all equal
    have none: empty arrays).  Null and repeated ids are vectors of their own;
    other columns are ignored; no vectors give an empty table."""
    spark = vectors.sparkSession
    entry = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), entry.alias("vector")) \
        .where("vector IS NOT NULL AND size(vector) > 0 AND forall(vector, e -> e IS NOT NULL AND NOT isnan(e) AND abs(e) < double('infinity'))")
    common = rows.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    empty = "vec_id long, n long, deviation long, whitened array<double>, values array<double>, trace double, identity_error double"
    if common is None:
        return spark.createDataFrame([], empty)
    dims = common["dims"]
    rows = rows.where(F.size("vector") == dims)
    total = rows.select("vector").mapInArrow(_sums(dims, scale, shift), "dim int, n long, high long, low long") \
        .groupBy("dim").agg(F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low")).collect()
    n = int(total[0].n)
    sums = [int(r.high) * (1 << 26) + int(r.low) for r in sorted(total, key=lambda r: r.dim)]
    whole = np.array([s // n for s in sums], np.int64)  # the means' whole parts and the rest
    part = np.array([(s % n) / n for s in sums])
    scatter = _matrix(rows.select("vector").mapInArrow(_scatter((n, whole, part), scale, shift), "i int, j int, v double"), dims)
    values, axes = one_sided_jacobi(pivoted_cholesky((scatter + scatter.T) / 2))
    values, axes, trace = values[:components] / n, axes[:, :components], float(np.trace(scatter)) / n
    weights = axes / np.sqrt(values)
    projected = rows.mapInArrow(_project(n, sums, weights, whole, part, scale, shift), "vec_id long, deviation long, whitened array<double>")
    error = 0.0
    if len(values):
        projected = saved(projected, "whitened")
        m = _matrix(projected.select("whitened").mapInArrow(_moments(len(values)), "i int, j int, v double"), len(values) + 1)
        mean = m[-1, :-1] / n
        error = float(np.abs(m[:-1, :-1] / n - np.outer(mean, mean) - np.eye(len(values))).max())
    return projected.select("vec_id", F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.array(*[F.lit(float(v)) for v in values]).cast("array<double>").alias("values"),
                            F.lit(trace).alias("trace"), F.lit(error).alias("identity_error"))


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "n", "deviation", "trace", "identity_error", F.posexplode(F.arrays_zip("whitened", "values"))) \
        .select("vec_id", (F.col("pos") + 1).cast("int").alias("component"), "n", "deviation", F.col("col.whitened").alias("whitened"),
                (F.col("col.values") / F.col("trace")).alias("explained"), "identity_error")
