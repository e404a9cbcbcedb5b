"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Each entry c becomes the whole number x = floor(64 * c) + 1000000; the fit list
holds each distinct x vector once (n of them, with sums S).  With A the fit
list's rows less S / n, the bidiagonalisation alternates

    alpha_j u_j     = A v_j  - beta_j u_(j-1)
    beta_(j+1) v_(j+1) = A' u_j - alpha_j v_j

and reorthogonalises every new u against all earlier u, every new v against all
earlier v.  The singular values and right vectors of the small bidiagonal matrix
give the components and their deviations.

The long vectors u are never stored: u_j = A y_j for a short vector y_j, so a
task recomputes its part of all of them from its rows.  One pass over the rows
returns |p|^2, U'p and A'p of the new product p, which is all that a step needs:
p less its share of the earlier u has the norm |p|^2 - |U'p|^2 and, as A'u of
the earlier steps is known, its product with A' needs no second pass.  Sums come
back added up by Spark, one number for each dimension and step; the driver holds
vectors of the embedding's dimension alone, as many as it has dimensions.  The
rows lie in blocks in shared storage and are read once a step, as many steps as
dimensions: stopping earlier could miss equal eigenvalues.  A step that finds
nothing new (fewer directions than dimensions) goes on with a fresh orthogonal
start.

Defined cases: a vector that is null or holds null, non-finite or huge entries
(64 c beyond 2^52) takes no part; a shorter vector is filled up with zeros; rows
with a null or repeated vec_id are kept, each by itself; equal vectors count
once in the fit; directions without variance are no components (one distinct
vector alone gives no rows); a deviation beyond a long is null; an empty table
gives an empty result; columns other than vec_id and embedding are not read."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, small_batches

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
#: Vectors in a block.
BLOCK = 4096
#: Singular values below this share of the largest are rounding.
RANK = 1e-11


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, x): x - OFFSET of the vectors that take part, as 64-bit little-endian whole numbers; a written table.

    The offset is left out until it matters: it cancels wherever a mean is taken away."""
    small_batches(vectors.sparkSession)
    schema = pa.schema([("vec_id", pa.int64()), ("x", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, xs = [], []
            for vec_id, v in zip(b.column("vec_id").to_pylist(), b.column("embedding")):
                if not v.is_valid or v.values.null_count:
                    continue
                x = np.floor(SCALE * v.values.to_numpy(zero_copy_only=False).astype(float))
                if np.isfinite(x).all() and (np.abs(x) < 1 << 52).all():
                    ids.append(vec_id)
                    xs.append(x.astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(xs, pa.binary())], schema=schema)

    chosen = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return saved(chosen.mapInArrow(run, "vec_id long, x binary"), "vectors")


def blocks(rows: DataFrame, dims: int) -> DataFrame:
    """(n, data): each distinct vector once, in blocks; a written table."""
    schema = pa.schema([("n", pa.int64()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([len(held)], pa.int64()), pa.array([b"".join(held)], pa.binary())], schema=schema)

        for b in batches:
            for x in b.column("x").to_pylist():
                held.append(x)
                if len(held) == BLOCK:
                    yield closed()
                    held = []
        if held:
            yield closed()

    distinct = rows.select(F.expr(f"rpad(x, {8 * dims}, X'00')").alias("x")).distinct()
    return saved(distinct.mapInArrow(run, "n long, data binary"), "blocks")


def column_sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums of each dimension."""
    schema = pa.schema([("dim", pa.int32()), ("total", pa.decimal128(38, 0))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dims
        for b in batches:
            for data in b.column("data").to_pylist():
                x = np.frombuffer(data, "<i8").reshape(-1, dims)
                low, high = x & 0xFFFFFF, x >> 24  # halves, whose sums over a block fit
                total = [t + (h << 24) + lo for t, h, lo in zip(total, high.sum(axis=0).tolist(), low.sum(axis=0).tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array(total, pa.decimal128(38, 0))], schema=schema)

    n = fit.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    sums = fit.select("data").mapInArrow(run, "dim int, total decimal(38,0)").groupBy("dim").agg(F.sum("total").alias("total"))
    by_dim = {r["dim"]: int(r["total"]) for r in sums.collect()}  # a number per dimension
    return n, [by_dim.get(k, 0) for k in range(dims)]


def summed(fit: DataFrame, mean: np.ndarray, width: int, of_block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sums over all blocks of `of_block` (a vector of `width` numbers) of the centred rows."""
    dims = len(mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for b in batches:
            for data in b.column("data").to_pylist():
                total += of_block(np.frombuffer(data, "<i8").reshape(-1, dims) - mean)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(total)], names=["place", "value"])

    parts = fit.select("data").mapInArrow(run, "place int, value double")
    out = np.zeros(width)
    for r in parts.groupBy("place").agg(F.sum("value").alias("value")).collect():  # `width` numbers
        out[r["place"]] = r["value"]
    return out


def orthogonal(v: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """v less its parts along the columns of `basis`, taken away twice."""
    for _ in range(2):
        v = v - basis @ (basis.T @ v)
    return v


def bidiagonalise(fit: DataFrame, mean: np.ndarray, steps: int | None = None, seed: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(V, B): right Lanczos vectors as columns, and the upper bidiagonal matrix with A V = U B."""
    dims = len(mean)
    steps = min(steps or dims, dims)
    fresh = np.random.default_rng(seed)
    v = fresh.normal(size=dims)
    v /= np.linalg.norm(v)
    vs, ys, gs = (np.zeros((dims, 0)) for _ in range(3))  # v_j, y_j with u_j = A y_j, and A' u_j
    bidiagonal = np.zeros((steps, steps))
    beta, size = 0.0, 0.0
    for j in range(steps):
        vs = np.column_stack([vs, v])
        raw = v - (beta * ys[:, -1] if j else 0.0)
        earlier = ys

        def of_block(a: np.ndarray) -> np.ndarray:
            p = a @ raw
            return np.concatenate([[p @ p], (a @ earlier).T @ p, a.T @ p])

        got = summed(fit, mean, 1 + j + dims, of_block)
        dots, g = got[1 : 1 + j], got[1 + j :]
        y, g = raw - ys @ dots, g - gs @ dots
        alpha = math.sqrt(max(got[0] - dots @ dots, 0.0))
        size = max(size, alpha, beta)
        if alpha <= RANK * size:
            alpha, y, g = 0.0, np.zeros(dims), np.zeros(dims)  # v is without variance
        else:
            y, g = y / alpha, g / alpha
        bidiagonal[j, j] = alpha
        if j:
            bidiagonal[j - 1, j] = beta
        ys, gs = np.column_stack([ys, y]), np.column_stack([gs, g])
        if j + 1 == steps:
            break
        v = orthogonal(g - alpha * v, vs)
        beta = float(np.linalg.norm(v))
        if beta <= RANK * size:  # nothing new in this direction
            beta, v = 0.0, orthogonal(fresh.normal(size=dims), vs)
        v = orthogonal(v / np.linalg.norm(v), vs)
        v /= np.linalg.norm(v)
    return vs, bidiagonal


class Whitening:
    """Fitted means, components and their variances."""

    def __init__(self, n: int, sums: list[int], components: np.ndarray, variances: np.ndarray, trace: float):
        self.n, self.sums, self.trace = n, sums, trace
        self.mean = np.array([float(Fraction(s, n)) for s in sums])
        self.components, self.variances = components, variances
        self.identity_error = math.nan

    @property
    def weights(self) -> np.ndarray:
        return self.components / np.sqrt(self.variances)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n x - S)^2 over the dimensions; null where beyond a long."""
        far = max(self.n * (int(np.abs(x).max(initial=0)) + 1) + max(map(abs, self.sums), default=0), 1)
        if far * far * max(x.shape[1], 1) < 1 << 63:
            off = self.n * x - np.array(self.sums, np.int64)
            return (off * off).sum(axis=1).tolist()
        off = self.n * x.astype(object) - np.array(self.sums, object)
        return [t if t < 1 << 63 else None for t in (off * off).sum(axis=1).tolist()]


def fit(table: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a table of blocks; none where nothing varies."""
    n, sums = column_sums(table, dims)
    if not n or not dims:
        return None
    mean = np.array([float(Fraction(s, n)) for s in sums])
    vs, bidiagonal = bidiagonalise(table, mean)
    _, sigma, right = np.linalg.svd(bidiagonal)
    keep = (sigma[:components] > RANK * sigma[0]) & (sigma[:components] > 0)
    chosen = (vs @ right.T)[:, : len(keep)][:, keep]
    chosen /= np.linalg.norm(chosen, axis=0)
    trace = float((bidiagonal**2).sum()) / n  # all of A's squares: V spans every dimension
    out = Whitening(n, sums, chosen, sigma[: len(keep)][keep] ** 2 / n, trace)
    k = out.components.shape[1]
    if not k:
        return None
    weights = out.weights
    at = summed(table, mean, k, lambda a: (a @ weights).sum(axis=0)) / n

    def second(a: np.ndarray) -> np.ndarray:
        z = a @ weights - at
        return (z.T @ z).ravel()

    covariance = summed(table, mean, k * k, second).reshape(k, k) / n
    out.identity_error = float(np.abs(covariance - np.eye(k)).max())
    return out


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: its whitened coordinate, and how far the vector lies from the mean."""
    rows = whole_vectors(vectors)
    dims = int(rows.agg(F.coalesce(F.max(F.length("x")), F.lit(0)).alias("bytes")).first()["bytes"]) // 8
    model = fit(blocks(rows, dims), dims, components) if dims else None
    if model is None:
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    k, weights, mean = model.components.shape[1], model.weights, model.mean

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = np.frombuffer(b"".join(v.ljust(8 * dims, b"\0") for v in b.column("x").to_pylist()), "<i8").reshape(-1, dims)
            m = len(x)
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("vec_id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n, np.int64)),
                    pa.array(model.deviations(x), pa.int64()).take(pa.array(each)),
                    pa.array(((x - mean) @ weights).ravel()),
                    pa.array(np.tile(model.variances / model.trace, m)),
                    pa.array(np.full(m * k, model.identity_error)),
                ],
                names=[f.split()[0] for f in SCHEMA.split(", ")],
            )

    return rows.mapInArrow(run, SCHEMA)
