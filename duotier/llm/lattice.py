"""Embedding near-duplicates by lattice hashing.

Vectors of one label are linked where their cosine, in double precision, is
`MIN_COSINE` or more.  Each of `TABLES` tables projects a unit vector on 2 * 8
random directions and decodes both halves to the nearest point of the lattice
E8, the densest packing of eight dimensions; the two points are the vector's
cell.  Besides its own (home) cell a vector probes the `PROBES` neighbouring
cells, one minimal vector of the lattice away, whose walls are nearest to it.
Two vectors meet where one's home cell is a cell of the other, and meeting
vectors are compared exactly.  With these settings a pair at the very threshold
meets in at least one of the tables with a probability of about 0.9995, closer
ones with more; an unrelated pair with about 5e-6.

Equal vectors become one class before anything else, so a third of all rows being
copies costs nothing.  Cells that nothing else uses (nearly all) are told apart
by packed questions (shards.py); only members of shared cells are dealt out with
their vectors.  A cell of very many members is dealt out in blocks, every two of
which meet in a group of bounded size; a group returns a count and one link per
member, never pairs.  A pair that meets several times is counted only in the
first table's smallest such cell, which any group can tell, as projections are
done in whole numbers and come out alike everywhere.

Defined cases: a vector that is null, zero or holds null or non-finite
components, or whose label is null, links with nothing and is kept; vectors of
unequal length do not link; rows with equal vector and label link, repeated rows
among them, and each counts; a null vec_id keeps its row and names no component
(null where no member has an id); an empty table gives an empty result; columns
other than vec_id, embedding and label are not read; a label that is not a whole
number is told apart by a 64-bit hash."""

from __future__ import annotations

import itertools
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import saved, small_batches
from .shards import QUESTION_SCHEMA, QUESTIONS, answers, by_shard, shard_count
from .simhash import components

MIN_COSINE = 0.98
TABLES = 8
PROBES = 4
HALVES = 2
#: Lattice units per standard deviation of a unit vector's projection: 0.15 for the difference of a pair at the threshold.
UNITS = 0.75
SEED = 8
#: Classes in a batch; members of a cell that meet in one group are at most about twice GROUP.
BATCH = 4096
GROUP = 1024
#: Cosines this near to the threshold are computed again without rounding.
CLOSE = 1e-9


def roots() -> np.ndarray:
    """The 240 minimal vectors of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = [0.0] * 8
            v[i], v[j] = a, b
            out.append(v)
    out += [list(v) for v in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(out)


ROOTS = roots()


def nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates of an even sum (the lattice D8), along the last axis."""
    point = np.rint(x)
    off = x - point
    worst = np.abs(off).argmax(axis=-1)[..., None]
    step = np.where(np.take_along_axis(off, worst, -1) >= 0, 1.0, -1.0)
    odd = point.sum(axis=-1, keepdims=True) % 2 != 0
    np.put_along_axis(point, worst, np.take_along_axis(point, worst, -1) + np.where(odd, step, 0.0), -1)
    return point


def nearest_point(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8: D8, or D8 moved by a half in every coordinate."""
    a, b = nearest_even(x), nearest_even(x - 0.5) + 0.5
    closer = ((x - a) ** 2).sum(axis=-1) <= ((x - b) ** 2).sum(axis=-1)
    return np.where(closer[..., None], a, b)


@lru_cache(maxsize=8)
def directions(dims: int) -> np.ndarray:
    """Random directions of all tables, in whole numbers of 1 / 1024."""
    return np.rint(np.random.default_rng([SEED, dims]).normal(size=(dims, TABLES * HALVES * 8)) * 1024)


def units(v: np.ndarray) -> np.ndarray:
    """Rows of length one (rows of zeros never come here)."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def cell_keys(u: np.ndarray, label: np.ndarray) -> np.ndarray:
    """(vectors, tables, 1 + probes) keys of the home cell and of the probed ones, each a 64-bit hash.

    Unit vectors are rounded to 2^-24, directions to 2^-10: sums of products are whole numbers below 2^53, so a
    vector's cells do not depend on what it is computed with."""
    n, dims = u.shape
    whole = np.rint(u * (1 << 24)) @ directions(dims)
    x = (whole * (UNITS * 2.0**-34)).reshape(n, TABLES, HALVES, 8)
    out = np.empty((n, TABLES, 1 + PROBES), np.uint64)
    for t in range(TABLES):
        home = nearest_point(x[:, t])
        reach = ((x[:, t] - home) @ ROOTS.T).reshape(n, HALVES * len(ROOTS))
        best = np.argpartition(-reach, PROBES, axis=1)[:, :PROBES]
        cells = np.repeat(home[:, None], 1 + PROBES, axis=1)  # vectors, cells, halves, coordinates
        at, probe = np.arange(n)[:, None], np.arange(1, 1 + PROBES)[None, :]
        cells[at, probe, best // len(ROOTS)] += ROOTS[best % len(ROOTS)]
        codes = (2 * cells).astype(np.int64).reshape(n, 1 + PROBES, HALVES * 8).view(np.uint64)
        h = np.broadcast_to(mixed(label.view(np.uint64) ^ np.uint64((t << 32) + dims))[:, None], (n, 1 + PROBES)).copy()
        for k in range(HALVES * 8):
            h = mixed(h ^ codes[:, :, k])
        out[:, t] = h
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def labelled(vectors: DataFrame) -> DataFrame:
    """(vec_id, key, label, v): rows as a written table; key is null where the vector links with nothing."""
    small_batches(vectors.sparkSession)
    single = isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    whole = isinstance(vectors.schema["label"].dataType, T.IntegralType)
    label = F.col("label").cast("long") if whole else F.when(F.col("label").isNotNull(), F.xxhash64("label"))
    kind = "<f4" if single else "<f8"
    schema = pa.schema([("vec_id", pa.int64()), ("key", pa.binary()), ("label", pa.int64()), ("v", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for b in batches:
            keys, raws = [], []
            for own, e in zip(b.column("label").to_pylist(), b.column("embedding")):
                key = raw = None
                if own is not None and e.is_valid and len(e.values) and not e.values.null_count:
                    v = e.values.to_numpy(zero_copy_only=False)
                    if np.isfinite(v).all() and v.any():
                        raw = v.astype(kind).tobytes()
                        key = hashlib.blake2b(raw, digest_size=16, key=str(own).encode()).digest()
                keys.append(key)
                raws.append(raw)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(keys, pa.binary()), b.column("label"), pa.array(raws, pa.binary())], schema=schema)

    kept = F.col("embedding") if single else F.col("embedding").cast("array<double>")
    chosen = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), kept.alias("embedding"))
    return saved(chosen.mapInArrow(run, "vec_id long, key binary, label long, v binary"), "rows")


BATCHES = "batch long, dims int, cids binary, copies binary, labels binary, vectors binary"


def class_batches(classes: DataFrame, width: int) -> DataFrame:
    """Classes (cid, n, label, v) of equal dimension as packed rows of at most `BATCH`; a written table."""
    schema = pa.schema([("batch", pa.int64()), ("dims", pa.int32())] + [(c, pa.binary()) for c in ("cids", "copies", "labels", "vectors")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: dict[int, list[tuple]] = {}

        def closed(size: int) -> pa.RecordBatch:
            nonlocal number
            cids, copies, labels, vs = zip(*held.pop(size))
            longs = [np.array(c, "<i8").tobytes() for c in (cids, copies, labels)]
            number += 1
            row = (number - 1, size // width, *longs, b"".join(vs))
            return pa.RecordBatch.from_arrays([pa.array([x], type=f.type) for x, f in zip(row, schema)], schema=schema)

        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("cid", "n", "label", "v"))):
                size = len(row[3])
                held.setdefault(size, []).append(row)
                if len(held[size]) == BATCH:
                    yield closed(size)
        for size in sorted(held):
            yield closed(size)

    return saved(classes.select("cid", "n", "label", "v").mapInArrow(run, BATCHES), "batches")


def unpacked(row: tuple, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(cids, copies, labels, vectors) of a packed row (dims, cids, copies, labels, vectors)."""
    dims, *longs, raw = row
    return (*(np.frombuffer(c, "<i8") for c in longs), np.frombuffer(raw, kind).reshape(-1, dims))


def distinct_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of a batch, and of each its members, its home members, and the key's number of every entry."""
    every, number = np.unique(keys.ravel(), return_inverse=True)
    number = number.reshape(keys.shape)
    members = np.bincount(number.ravel(), minlength=len(every))
    homes = np.bincount(number[:, :, 0].ravel(), minlength=len(every))
    return every, members, homes, number


def shared_cells(batches: DataFrame, kind: str, shards: int) -> DataFrame:
    """(batch, answers): number of members of each of a batch's cells, 0 where none can meet another there."""

    def ask(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            for batch, *row in zip(*(b.column(c.split()[0]).to_pylist() for c in BATCHES.split(", "))):
                _, _, label, v = unpacked(row, kind)
                every, members, homes, _ = distinct_keys(cell_keys(units(v.astype(float)), label))
                for shard, at in by_shard(every, shards):
                    extra = zlib.compress(np.stack([members[at], homes[at]]).astype("<u2").tobytes(), 1)
                    row_of_shard = (shard, batch, every[at].tobytes(), extra)
                    yield pa.RecordBatch.from_arrays([pa.array([x], type=f.type) for x, f in zip(row_of_shard, QUESTION_SCHEMA)], schema=QUESTION_SCHEMA)

    def solve(asked: list[tuple[int, bytes, bytes]]) -> list[bytes]:
        keys = [np.frombuffer(k, np.uint64) for _, k, _ in asked]
        counts = np.concatenate([np.frombuffer(zlib.decompress(e), "<u2").reshape(2, -1) for _, _, e in asked], axis=1).astype(float)
        _, number = np.unique(np.concatenate(keys), return_inverse=True)
        members, homes = (np.bincount(number, weights=c) for c in counts)
        found = np.where((members > 1) & (homes > 0), members, 0).astype("<u4")[number]
        ends = np.cumsum([len(k) for k in keys])
        return [zlib.compress(part.tobytes(), 1) for part in np.split(found, ends[:-1])]

    return answers(batches.mapInArrow(ask, QUESTIONS), solve)


MEMBERS = "key long, lo int, hi int, own int, blocks int, home boolean, cid long, n long, label long, v binary"


def members(batches: DataFrame, shared: DataFrame, kind: str, shards: int, group: int) -> DataFrame:
    """Members of the cells that several vectors share, with their vectors, once for each block that they meet."""
    names = [f.split()[0] for f in BATCHES.split(", ")]
    columns = [f.split()[0] for f in MEMBERS.split(", ")]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            for _, *row, own_answers in zip(*(b.column(c).to_pylist() for c in [*names, "answers"])):
                cid, n, label, v = unpacked(row, kind)
                every, _, _, number = distinct_keys(cell_keys(units(v.astype(float)), label))
                size = np.zeros(len(every), np.int64)
                found = {a["shard"]: a["answer"] for a in own_answers}
                for shard, at in by_shard(every, shards):
                    size[at] = np.frombuffer(zlib.decompress(found[shard]), "<u4")
                i, t, c = np.nonzero(size[number])
                cell = number[i, t, c]
                blocks = -(-size[cell] // group)
                own = (mixed(cid[i].astype(np.uint64)) % blocks.astype(np.uint64)).astype(np.int64)
                each = np.repeat(np.arange(len(i)), blocks)
                other = np.arange(len(each)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                for at in range(0, len(each), 4096):
                    e, o = each[at : at + 4096], other[at : at + 4096]
                    k = i[e]
                    raw = [x.tobytes() for x in v[k]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(every[cell[e]].view(np.int64)), pa.array(np.minimum(own[e], o).astype(np.int32)),
                            pa.array(np.maximum(own[e], o).astype(np.int32)), pa.array(own[e].astype(np.int32)),
                            pa.array(blocks[e].astype(np.int32)), pa.array(c[e] == 0), pa.array(cid[k]), pa.array(n[k]),
                            pa.array(label[k]), pa.array(raw, pa.binary()),
                        ],
                        names=columns,
                    )

    joined = batches.join(shared, "batch").select(*names, "answers")
    return joined.mapInArrow(run, MEMBERS)


def links(u: np.ndarray, v: np.ndarray, min_cosine: float) -> np.ndarray:
    """Which rows link: a symmetric matrix, False on the diagonal."""
    cosine = u @ u.T
    out = cosine >= min_cosine
    close = np.abs(cosine - min_cosine) < CLOSE
    for i, j in zip(*np.nonzero(np.triu(close, 1))):  # as if without rounding, and alike in every group
        a, b = v[i].tolist(), v[j].tolist()
        length = math.sqrt(math.fsum(x * x for x in a)) * math.sqrt(math.fsum(x * x for x in b))
        out[i, j] = out[j, i] = math.fsum(x * y for x, y in zip(a, b)) / length >= min_cosine
    np.fill_diagonal(out, False)
    return out


def first_meeting(keys: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The key at which each pair of members counts: the smallest of its first table that they share."""
    out = np.zeros(len(i), np.uint64)
    open_ = np.arange(len(i))
    most = np.uint64(0xFFFFFFFFFFFFFFFF)
    for t in range(TABLES):
        a, b = keys[i[open_], t], keys[j[open_], t]
        at_a = np.where((b == a[:, :1]).any(axis=1), a[:, 0], most)
        at_b = np.where((a == b[:, :1]).any(axis=1), b[:, 0], most)
        low = np.minimum(at_a, at_b)
        out[open_] = low
        open_ = open_[low == most]
        if not len(open_):
            break
    return out


def group_result(key: int, cross: bool, own: np.ndarray, home: np.ndarray, cid: np.ndarray, n: np.ndarray, label: np.ndarray, v: np.ndarray, min_cosine: float):
    """(cid, links counted here, smallest cid linked over this group) of the members that link in one group."""
    u = units(v)
    linked = links(u, v, min_cosine)
    linked &= home[:, None] | home[None, :]
    linked &= label[:, None] == label[None, :]  # two labels may share a hash
    if cross:  # two blocks: members of the same one meet elsewhere
        linked &= own[:, None] != own[None, :]
    some = np.flatnonzero(linked.any(axis=1))
    if not len(some):
        return None
    linked, cid, n = linked[np.ix_(some, some)], cid[some], n[some]
    keys = cell_keys(u[some], label[some])
    i, j = np.nonzero(np.triu(linked))
    counts = np.zeros(len(some))
    for at in range(0, len(i), 1 << 18):
        a, b = i[at : at + (1 << 18)], j[at : at + (1 << 18)]
        here = first_meeting(keys, a, b) == np.uint64(key)
        counts += np.bincount(a[here], weights=n[b[here]], minlength=len(some))
        counts += np.bincount(b[here], weights=n[a[here]], minlength=len(some))
    low = cid.copy()
    left = np.ones(len(some), bool)
    while left.any():  # each member is reached once
        reached = np.zeros(len(some), bool)
        front = np.flatnonzero(left)[:1]
        while len(front):
            reached[front] = True
            front = np.flatnonzero(linked[front].any(axis=0) & ~reached)
        low[reached] = cid[reached].min()
        left &= ~reached
    return cid, counts.astype(np.int64), low


def far_pairs(raw: list[bytes], firsts: np.ndarray, kind: str, min_cosine: float) -> np.ndarray:
    """Marks, at the first of its two members, each of most groups: two vectors that are clearly no link."""
    out = np.zeros(len(raw), bool)
    by_size: dict[int, list[int]] = {}
    for p in firsts.tolist():
        if len(raw[p]) == len(raw[p + 1]):
            by_size.setdefault(len(raw[p]), []).append(p)
    for at in by_size.values():
        a, b = (units(np.frombuffer(b"".join(raw[p + k] for p in at), kind).reshape(len(at), -1).astype(float)) for k in (0, 1))
        out[at] = (a * b).sum(axis=1) < min_cosine - CLOSE
    return out


def meetings(dealt: DataFrame, kind: str, min_cosine: float) -> DataFrame:
    """(cid, links, low) of every member that links, from each group."""
    schema = pa.schema([("cid", pa.int64()), ("links", pa.int64()), ("low", pa.int64())])
    columns = [f.split()[0] for f in MEMBERS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def found(table: pa.Table) -> Iterator[pa.RecordBatch]:
            key, lo, hi, own, _, home, cid, n, label = (table.column(c).to_numpy() for c in columns[:-1])
            raw = table.column("v").to_pylist()
            cuts = np.flatnonzero((np.diff(key) != 0) | (np.diff(lo) != 0) | (np.diff(hi) != 0)) + 1
            begins, ends = np.append(0, cuts), np.append(cuts, len(key))
            far = far_pairs(raw, begins[ends - begins == 2], kind, min_cosine)
            for p, q in zip(begins, ends):
                if q - p < 2 or (q - p == 2 and far[p]):
                    continue
                sizes = {len(x) for x in raw[p:q]}
                for size in sizes:  # more than one only where hashes of two dimensions are equal
                    at = np.array([k for k in range(p, q) if len(raw[k]) == size])
                    v = np.frombuffer(b"".join(raw[k] for k in at), kind).reshape(len(at), -1).astype(float)
                    got = group_result(
                        int(key[p]) & 0xFFFFFFFFFFFFFFFF, lo[p] != hi[p], own[at], home[at], cid[at], n[at], label[at], v, min_cosine
                    )
                    if got is not None:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in got], schema=schema)

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None and held.num_rows:
                table = pa.concat_tables([held, table]).combine_chunks()
            if not table.num_rows:
                continue
            key, lo, hi = (table.column(c).to_numpy() for c in columns[:3])
            # the last group may go on in the next batch
            last = int(np.flatnonzero((key == key[-1]) & (lo == lo[-1]) & (hi == hi[-1]))[0])
            held = table.slice(last)
            if last:
                yield from found(table.slice(0, last))
        if held is not None and held.num_rows:
            yield from found(held)

    parts = dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "cid")
    return saved(parts.mapInArrow(run, "cid long, links long, low long"), "meetings")


def near_duplicates(vectors: DataFrame, min_cosine: float = MIN_COSINE, group: int = GROUP) -> DataFrame:
    """One row per vector: vec_id, n_links (other rows linked directly), component_id (smallest vec_id reachable), kept."""
    single = isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    kind, width = ("<f4", 4) if single else ("<f8", 8)
    rows = labelled(vectors)
    some = rows.filter("key IS NOT NULL")
    # copies are counted before the shuffle; a key stands for its label and vector
    classes = some.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"), F.first("label").alias("label"), F.first("v").alias("v")
    )
    classes = saved(classes.select(F.monotonically_increasing_id().alias("cid"), "*"), "classes")
    shards = shard_count(classes.count() * TABLES * (1 + PROBES))
    batches = class_batches(classes, width)
    met = meetings(members(batches, shared_cells(batches, kind, shards), kind, shards, group), kind, min_cosine)
    counted = met.groupBy("cid").agg(F.sum("links").alias("links"))
    edges = met.filter("cid <> low").select(F.col("cid").alias("a"), F.col("low").alias("b"))
    roots_ = components(edges).select(F.col("v").alias("cid"), "root")
    known = classes.select("cid", "key", "n", "least").join(counted, "cid", "left").join(roots_, "cid", "left")
    known = known.select("key", "least", F.coalesce("root", "cid").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    names = known.groupBy("root").agg(F.min("least").alias("component_id"))
    of_key = known.join(names, "root").select("key", "n_links", "component_id")
    out = some.select("vec_id", "key").join(of_key, "key").select("vec_id", "n_links", "component_id")
    alone = rows.filter("key IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
