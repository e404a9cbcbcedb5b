"""Exact top-k by inner product with a vector-approximation file.

Vectors become whole numbers, floor(64 * x), and equal vectors one class with
its k + 1 smallest ids (no result can need more of one class).  The
approximation file holds each class's cells: every component without its lowest
`CELL_BITS` bits.  A query block scans all blocks of that file; a cell's edges
bound the inner product from both sides, the (k + 1)-th best lower bound is the
bar, and classes whose upper bound misses it are pruned.  Exact vectors are then
read in the order of their bounds: first the best few of each query, then only
those whose bound still reaches the (k + 1)-th exact score.  What is left out
can't be among the results.

Queries are every `EVERY`-th id against all rows, in blocks; one task holds a
query block and one block of cells at a time.

Defined cases: a vector that is null or holds null or non-finite components
takes no part, nor does a null vec_id; a repeated row counts once; vectors of
unequal length are compared as if filled up with zeros (an empty one scores 0);
ties go to the smaller vec_id; with fewer candidates all are returned; an empty
table gives an empty result; columns other than vec_id and embedding are not read.
Scores must fit a long."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, small_batches

K = 20
EVERY = 20
SCALE = 64
CELL_BITS = 1
#: Classes in a block of cells, and query classes in a query block.
CELLS = 4096
QUERIES = 512


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): distinct rows that take part, as whole numbers."""
    e = F.col("embedding")
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = F.transform(e, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    ok = F.col("vec_id").isNotNull() & e.isNotNull() & ~F.coalesce(bad, F.lit(True))
    return vectors.filter(ok).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).distinct()


def classes(rows: DataFrame, k: int) -> DataFrame:
    """(cid, v, ids): distinct vectors with their k + 1 smallest ids; a written table."""
    nth = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))  # limited before the shuffle, too
    few = rows.withColumn("nth", nth).filter(F.col("nth") <= k + 1)
    grouped = few.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    return saved(grouped.select(F.monotonically_increasing_id().alias("cid"), "v", "ids"), "classes")


def cell_blocks(table: DataFrame, cell_bits: int = CELL_BITS, size: int = CELLS) -> DataFrame:
    """The approximation file: (cids, dims, width, cells) in blocks of at most `size` classes."""
    schema = pa.schema([("cids", pa.binary()), ("dims", pa.int32()), ("width", pa.int32()), ("cells", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, size):
                part = b.slice(at, size)
                cells = padded(part.column("v")) >> cell_bits
                top = max(int(np.abs(cells).max(initial=0)), 1)
                width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w - 1))
                row = (part.column("cid").to_numpy().tobytes(), cells.shape[1], width, cells.astype(f"<i{width}").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([x], type=f.type) for x, f in zip(row, schema)], schema=schema)

    return table.select("cid", "v").mapInArrow(run, "cids binary, dims int, width int, cells binary")


def padded(lists: pa.Array) -> np.ndarray:
    """Lists of whole numbers as rows of one matrix, filled up with zeros."""
    offsets = lists.offsets.to_numpy()
    sizes = np.diff(offsets)
    values = lists.values.to_numpy()[offsets[0] : offsets[-1]]
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = values
    return out


def product(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """q @ c.T without rounding: doubles while every partial sum is exact in them, else whole numbers of any size."""
    d = min(q.shape[1], c.shape[1])
    q, c = q[:, :d], c[:, :d]
    most = int(np.abs(q).max(initial=0)) * int(np.abs(c).max(initial=0)) * max(d, 1)
    if most < 1 << 53:
        return q.astype(float) @ c.astype(float).T
    return q.astype(object) @ c.astype(object).T


def candidates(queries: DataFrame, blocks: DataFrame, k: int, cell_bits: int = CELL_BITS) -> DataFrame:
    """(qid, cid, bound): classes that the bounds can't rule out. queries: (qid, v)."""
    n = -(-max(queries.count(), 1) // QUERIES)
    q = queries.select(
        F.pmod(F.xxhash64("qid"), F.lit(n)).cast("int").alias("block"), F.lit(0).alias("kind"),
        F.col("qid").alias("qid"), "v", F.lit(None).cast("binary").alias("cids"), F.lit(0).alias("dims"),
        F.lit(0).alias("width"), F.lit(None).cast("binary").alias("cells"),
    )
    d = blocks.select(
        F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("block"), F.lit(1).alias("kind"),
        F.lit(None).cast("long").alias("qid"), F.lit(None).cast("array<long>").alias("v"), "cids", "dims", "width", "cells",
    )
    rows = q.union(d).repartition("block").sortWithinPartitions("block", "kind")
    schema = pa.schema([("qid", pa.int64()), ("cid", pa.int64()), ("bound", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = None
        for b in batches:
            number, kind = b.column("block").to_numpy(), b.column("kind").to_numpy()
            for at in range(0, b.num_rows):
                if scan is None or scan.number != number[at]:
                    if scan is not None:
                        yield scan.result(schema)
                    scan = Scan(number[at], k, cell_bits)
                if kind[at] == 0:
                    scan.add_query(b.column("qid")[at].as_py(), b.column("v")[at].as_py())
                else:
                    scan.add_cells(*(b.column(c)[at].as_py() for c in ("cids", "dims", "width", "cells")))
        if scan is not None:
            yield scan.result(schema)

    return rows.mapInArrow(run, "qid long, cid long, bound long")


class Scan:
    """One query block's way through the approximation file."""

    def __init__(self, number: int, k: int, cell_bits: int):
        self.number, self.k, self.bits = number, k, cell_bits
        self.ids: list[int] = []
        self.vectors: list[list[int]] = []
        self.q = None
        self.kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # query, class, upper bound

    def add_query(self, qid: int, v: list[int]) -> None:
        self.ids.append(qid)
        self.vectors.append(v)

    def add_cells(self, cids: bytes, dims: int, width: int, cells: bytes) -> None:
        if not self.ids:
            return
        if self.q is None:
            self.q = np.zeros((len(self.ids), max(map(len, self.vectors))), np.int64)
            for row, v in zip(self.q, self.vectors):
                row[: len(v)] = v
            self.best = np.full((len(self.ids), 0), 0.0)
        cid = np.frombuffer(cids, "<i8")
        low = np.frombuffer(cells, f"<i{width}").reshape(len(cid), dims).astype(np.int64) << self.bits
        base = product(self.q, low)
        d = min(dims, self.q.shape[1])
        step = (1 << self.bits) - 1
        upper = base + step * np.maximum(self.q[:, :d], 0).sum(axis=1)[:, None]
        lower = base + step * np.minimum(self.q[:, :d], 0).sum(axis=1)[:, None]
        best = np.concatenate([self.best, lower], axis=1)
        if best.shape[1] > self.k + 1:
            best = -np.partition(-best, self.k, axis=1)[:, : self.k + 1]
        self.best = best
        i, j = np.nonzero(upper >= self.bar()[:, None])
        self.kept.append((i, cid[j], upper[i, j]))
        if sum(len(x[0]) for x in self.kept) > 4_000_000:
            self.prune()

    def bar(self) -> np.ndarray:
        """What a class must be able to reach: the (k + 1)-th best lower bound so far."""
        if self.best.shape[1] <= self.k:
            return np.full(len(self.ids), -np.inf)
        return self.best.min(axis=1)

    def prune(self) -> None:
        i, c, u = (np.concatenate(v) for v in zip(*self.kept))
        ok = np.asarray(u >= self.bar()[i], bool)
        self.kept = [(i[ok], c[ok], u[ok])]

    def result(self, schema: pa.Schema) -> pa.RecordBatch:
        if not self.kept:
            return pa.RecordBatch.from_arrays([pa.array([], type=f.type) for f in schema], schema=schema)
        self.prune()
        i, c, u = self.kept[0]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(self.ids, np.int64)[i]), pa.array(c), pa.array([min(int(x), (1 << 63) - 1) for x in u], pa.int64())], schema=schema
        )


def exact(pairs: DataFrame, queries: DataFrame, table: DataFrame) -> DataFrame:
    """(qid, cid, ids, score) of candidate pairs, from the exact vectors."""
    zero = F.lit(0).cast("long")
    terms = F.zip_with("v", "qv", lambda x, y: F.coalesce(x * y, zero))
    return (
        pairs.join(table, "cid")
        .join(queries.select("qid", F.col("v").alias("qv")), "qid")
        .select("qid", "cid", "ids", F.aggregate(terms, zero, lambda a, x: a + x).alias("score"))
    )


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, cell_bits: int = CELL_BITS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of every `every`-th id against all others."""
    small_batches(vectors.sparkSession)
    rows = saved(whole_vectors(vectors), "vectors")
    table = classes(rows, k)
    asked = rows.filter(F.col("vec_id") % every == 0).join(table.select("cid", "v"), "v")
    asked = saved(asked.select(F.col("vec_id").alias("query_id"), F.col("cid").alias("qid")), "asked")
    queries = table.join(asked.select(F.col("qid").alias("cid")).distinct(), "cid").select(F.col("cid").alias("qid"), "v")
    near = candidates(queries, cell_blocks(table, cell_bits), k, cell_bits)
    place = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("bound"), "cid"))
    near = saved(near.withColumn("place", place), "candidates")
    first = saved(exact(near.filter(F.col("place") <= 2 * (k + 1)), queries, table), "first")
    nth = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "cid"))
    bar = first.withColumn("nth", nth).filter(F.col("nth") == k + 1).select("qid", F.col("score").alias("bar"))
    late = near.filter(F.col("place") > 2 * (k + 1)).join(bar, "qid").filter("bound >= bar").select("qid", "cid")
    scored = first.union(exact(late, queries, table))
    each = scored.select("qid", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    best = each.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k + 1).select("qid", "score", "vec_id")
    # one of the k + 1 may be the query itself
    others = asked.join(best, "qid").filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "qid").orderBy(F.desc("score"), "vec_id"))
    return others.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
