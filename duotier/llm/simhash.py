"""SimHash near-duplicates: 64-bit fingerprints, pigeonring candidates, connected components.

Fingerprint: lower-case A-Z, words, 3-word shingles with repeats; a bit is set
if more than half of the shingles' XXH64 (seed 42) have it.  Documents whose
fingerprints differ in at most `MAX_BITS` bits are linked, and a component is
named by its smallest doc_id.

Pigeonring filter: cut the 64 bits into a ring of `RING` segments.  If two
fingerprints differ in d <= MAX_BITS bits, some segment starts a chain in which
the first l segments together differ in at most l * MAX_BITS / RING bits, for
every l.  With 8 segments and 3 bits the first two segments of that chain are
equal (16 bits); the other 48 bits differ in at most 3, so one of four blocks
of 12 bits is equal, too.  Chain start, block and these 28 bits are the join
key.  Whole chains are tested before the full Hamming distance.

Copies collapse into one fingerprint before any join.  A key shared by very
many fingerprints is dealt out in blocks, every two of which meet in a group of
bounded size, and a group returns at most one link per member (its own
components), never all pairs.  Components of the whole: repeated contraction to
the smallest neighbour, each round written to shared storage.

Defined cases: null, empty and wordless texts have fingerprint zero and are
linked like any other; fewer words than a shingle make one shingle; repeated
rows are kept and share a component; a null doc_id keeps its row, its
component is that of its fingerprint (null if no member has an id); an empty
table gives an empty result; columns other than doc_id and text are not read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, saved, small_batches

SHINGLE = 3
MAX_BITS = 3
RING = 8
BLOCKS = 4
#: Fingerprints of a key that meet in one group are at most about twice this many.
GROUP = 2048


def fingerprint(text: bytes, shingle: int, digest) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
    n, ones = 0, np.zeros(64, np.int64)
    hashes = np.fromiter((digest(g, 42) for g in grams), np.uint64)
    for at in range(0, len(hashes), 1 << 16):  # a very long text in slices
        part = hashes[at : at + (1 << 16)]
        n += len(part)
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    return sum(1 << int(k) for k in np.flatnonzero(2 * ones > n))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            got = [fingerprint(t, shingle, xxhash.xxh64_intdigest) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.array(got, np.uint64).view(np.int64))], schema=schema
            )

    return as_bytes(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(run, "doc_id long, fp long")


def ring_keys(fps: DataFrame, max_bits: int) -> DataFrame:
    """(key, fp): chain start, block and the 28 bits that a linked pair shares at one of its chains."""
    if max_bits >= BLOCKS or 2 * max_bits >= RING:
        raise ValueError("a chain of two equal segments needs max_bits below 4")
    schema = pa.schema([("key", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for start in range(RING):
                turned = rotated(fp, 8 * start)  # the chain's first two segments are its lowest 16 bits
                for block in range(BLOCKS):
                    bits = (turned >> np.uint64(16 + 12 * block)) & np.uint64(0xFFF)
                    key = (turned & np.uint64(0xFFFF)) | (bits << np.uint64(16)) | np.uint64((start * BLOCKS + block) << 28)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(fp.view(np.int64))], schema=schema)

    return fps.select("fp").mapInArrow(run, "key long, fp long")


def rotated(x: np.ndarray, by: int) -> np.ndarray:
    return x if not by else (x >> np.uint64(by)) | (x << np.uint64(64 - by))


def chain_ok(x: np.ndarray, start: int, max_bits: int) -> np.ndarray:
    """Pigeonring test of differences x: every chain from `start` keeps its proportional budget (the last is Hamming's)."""
    turned = rotated(x, 8 * start)
    ok = np.ones(x.shape, bool)
    for length in range(1, RING + 1):
        mask = np.uint64((1 << (8 * length)) - 1)
        ok &= np.bitwise_count(turned & mask) <= length * max_bits // RING
    return ok


def group_links(fp: np.ndarray, start: int, max_bits: int) -> np.ndarray:
    """Each member's label: the smallest position reachable by links inside the group."""
    n = len(fp)
    label = np.arange(n)
    pairs = []
    for at in range(0, n, 256):
        x = fp[at : at + 256, None] ^ fp[None, :]
        i, j = np.nonzero(chain_ok(x, start, max_bits))
        keep = i + at < j
        pairs.append((i[keep] + at, j[keep]))
    a, b = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def links(fps: DataFrame, max_bits: int = MAX_BITS, group: int = GROUP) -> DataFrame:
    """(a, b): links between distinct fingerprints that join exactly those within `max_bits`, possibly over others."""
    keys = ring_keys(fps, max_bits)
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = keys.join(_shuffled(sizes), "key").withColumn("blocks", F.ceil(F.col("n") / group).cast("int"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = shared.select("key", "fp", own.alias("own"), "blocks", other).select(
        "key", "fp", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "blocks"
    )
    # members of one block alone need no group of their own beside those with other blocks
    dealt = dealt.filter("blocks = 1 OR lo <> hi").select("key", "lo", "hi", "fp")
    parts = dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "fp")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def found(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            key, lo, hi, fp = cols
            new = np.flatnonzero((np.diff(key) != 0) | (np.diff(lo) != 0) | (np.diff(hi) != 0)) + 1
            ends = np.append(new, len(key))
            begins = np.append(0, new)
            size = ends - begins
            a, b = [], []
            two = begins[size == 2]  # most groups are pairs: tested all at once
            x = fp[two] ^ fp[two + 1]
            for start in range(RING):
                of = (key[two] >> 28) // BLOCKS == start
                ok = chain_ok(x[of], start, max_bits)
                a.append(fp[two[of]][ok])
                b.append(fp[two[of] + 1][ok])
            for p, q in zip(begins[size > 2], ends[size > 2]):
                label = group_links(fp[p:q], int(key[p] >> 28) // BLOCKS, max_bits)
                moved = np.flatnonzero(label != np.arange(q - p))
                a.append(fp[p:q][moved])
                b.append(fp[p:q][label[moved]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(v).view(np.int64)) for v in (a, b)], schema=schema
            )

        for batch in batches:
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
            cols[3] = cols[3].view(np.uint64)
            if held is not None:
                cols = [np.concatenate(v) for v in zip(held, cols)]
            # the last group may go on in the next batch
            last = int(np.flatnonzero((cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1]) & (cols[2] == cols[2][-1]))[0])
            held = [v[last:] for v in cols]
            if last:
                yield from found([v[:last] for v in cols])
        if held is not None and len(held[0]):
            yield from found(held)

    return parts.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(v, root) for every end of an edge; `root` names v's connected component.

    Each round every vertex moves to the smallest vertex in its neighbourhood, and the edges between what is
    left go on: at least the largest vertex of each component disappears, and of hashed names a fixed share does."""
    step = edges.filter("a <> b").select("a", "b")
    step = saved(step.union(step.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    moves: list[DataFrame] = []
    while not step.isEmpty():
        move = saved(step.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "moves")
        moves.append(move)
        at_a = step.join(_shuffled(move), "a").select(F.col("m").alias("x"), F.col("b").alias("a"))
        step = saved(
            at_a.join(_shuffled(move), "a").select(F.col("x").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct(), "edges"
        )
    if not moves:
        return edges.select(F.col("a").alias("v"), F.col("a").alias("root")).limit(0)
    out = moves[0].select(F.col("a").alias("v"), F.col("m").alias("root"))
    for move in moves[1:]:
        out = out.join(_shuffled(move), out.root == move.a, "left").select("v", F.coalesce("m", "root").alias("root"))
    return out


def _shuffled(side: DataFrame) -> DataFrame:
    """The side of a join that grows with the documents: never broadcast, as its compressed file may look small
    while the table of its rows, and one for every such join of a plan, would pass through the driver."""
    return side.hint("merge")


def classes(got: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root): the component of every distinct fingerprint, a written table."""
    fps = got.select("fp").distinct()
    roots = components(links(fps, max_bits))
    return saved(fps.join(_shuffled(roots), fps.fp == roots.v, "left").select("fp", F.coalesce("root", "fp").alias("root")), "classes")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    got = saved(fingerprints(docs, shingle), "fingerprints")
    named = classes(got, max_bits)
    least = got.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    ids = named.join(_shuffled(least), "fp").groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_fp = named.join(_shuffled(ids), "root").select("fp", "component_id")
    return got.join(_shuffled(of_fp), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def representatives(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component with all its columns: that of the smallest doc_id (a null one only where no other is)."""
    at = docs.columns.index("text")
    small_batches(docs.sparkSession)
    # the caller's columns travel in one, so that none of their names can clash
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    packed = docs.select(whole, F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("h"))
    schema = packed.withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            texts = b.column(0).field(at).to_pylist()
            got = [fingerprint((t or "").encode(), shingle, xxhash.xxh64_intdigest) for t in texts]
            fp = pa.array(np.array(got, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*b.columns, fp], names=[*b.schema.names, "fp"])

    rows = saved(packed.mapInArrow(run, schema), "rows")
    named = classes(rows.select("fp"), max_bits)
    order = F.struct(F.col("id").isNull().alias("x"), "id", "h", "fp")
    chosen = rows.groupBy("fp").agg(F.min(order).alias("k")).join(_shuffled(named), "fp").groupBy("root").agg(F.min("k").alias("k"))
    chosen = chosen.select(F.col("k.fp").alias("k_fp"), F.col("k.id").alias("k_id"), F.col("k.h").alias("k_h"))
    same = (F.col("fp") == F.col("k_fp")) & F.col("id").eqNullSafe(F.col("k_id")) & (F.col("h") == F.col("k_h"))
    return rows.join(_shuffled(chosen), same).dropDuplicates(["fp", "id", "h"]).select("row.*")
