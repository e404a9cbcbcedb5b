"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in a fixed shuffled order, are cut into blocks of
`block` characters (a document belongs to the block in which it begins).
Weights are exact fractions of whole numbers.  Block i (from 1) of a source of
weight w is released at slot floor((i - 1) / w) and due by ceil(i / w); each
slot goes to the released block with the earliest deadline.  So at every slot a
source has got less than one block more or less than its share.  The schedule
holds the corpus' blocks, one by one.  When a source runs out, the others go on
within their own windows: every document is placed exactly once.

A source may hold a third of all rows: positions are counted within (source,
hash bucket), and bucket sizes are summed up in a small table.

Defined cases: a null source is a source of its own; null and empty texts take
no room; a document longer than a block takes its source's next blocks, too;
repeated rows are all placed; a null doc_id is a value like any other; sources
without a weight of their own get those of `temperature`; a weight below 1e-12
of the largest (zero, too) counts as that; an empty table gives an empty result;
extra columns are passed through whatever their names, but `mix` replaces any
that are named like its own (mix_slot and so on)."""

from __future__ import annotations

import heapq
import inspect
import math
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 100_000
#: Up to so many blocks the schedule is broadcast; beyond, the join is left to adaptive execution.
BROADCAST_BLOCKS = 1_000_000
#: Share of a source is its size to this power, so small sources are raised.
TEMPERATURE = 0.7
#: Bound on the sources, whose names and sizes come to the driver.
MAX_SOURCES = 100_000
ROWS_PER_BUCKET = 20_000
OWN = ("mix_block", "mix_slot", "mix_release", "mix_deadline", "mix_start")


def quotas(weights: list[float], period: int) -> list[int]:
    """Whole slots per period for each weight: at least one, adding up to `period` (largest remainders first)."""
    total, spare = sum(weights), period - len(weights)
    exact = [w / total * spare for w in weights]
    out = [1 + int(x) for x in exact]
    by_rest = sorted(range(len(weights)), key=lambda k: (int(exact[k]) - exact[k], k))
    for k in by_rest[: period - sum(out)]:
        out[k] += 1
    return out


def fractions(weights: list[float]) -> list[int]:
    """Whole numbers in exactly the proportions of `weights`."""
    least = max(weights) * 1e-12
    exact = [Fraction(max(w, least)) for w in weights]
    whole = math.lcm(*(x.denominator for x in exact))
    out = [int(x * whole) for x in exact]
    common = math.gcd(*out)
    return [x // common for x in out]


def schedule(slots: list[int], blocks: list[int] | None = None) -> list[tuple[int, int, int, int, int]]:
    """(source, block, slot, release, deadline) of `blocks` of each source (default: one period), by earliest deadline
    first among released blocks; slots that only sources with no blocks left would take stay empty."""
    period, blocks = sum(slots), slots if blocks is None else blocks
    waiting = [(0, k, 0) for k in range(len(slots)) if blocks[k]]  # (release, source, block)
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int, int]] = []
    out, slot = [], 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            release, k, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * period // slots[k]), k, i, release))
        deadline, k, i, release = heapq.heappop(ready)
        out.append((k, i, slot, release, deadline))
        if i + 1 < blocks[k]:
            heapq.heappush(waiting, ((i + 1) * period // slots[k], k, i + 1))
        slot += 1
    return out


def sized(docs: DataFrame, keep: list[str]) -> DataFrame:
    """`keep` as one column, so that no name can clash, with each row's size in characters and its key in the shuffled order."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("__row"),
        F.length(text).cast("long").alias("__size"),
        F.xxhash64("doc_id", text).alias("__key"),
        F.col("doc_id").alias("__id"),
        F.col("source").cast("string").alias("__source"),
    )


def placed(rows: DataFrame, n_rows: int) -> DataFrame:
    """`rows` with mix_start: the size of all rows of the same source before this one, in shuffled order."""
    bits = (n_rows // ROWS_PER_BUCKET).bit_length()
    keyed = rows.withColumn("__bucket", F.shiftrightunsigned("__key", 64 - bits) if bits else F.lit(0).cast("long"))
    sums = keyed.groupBy("__source", "__bucket").agg(F.sum("__size").alias("__sum"))
    w = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(
        F.col("__source").alias("__s"), F.col("__bucket").alias("__b"),
        F.coalesce(F.sum("__sum").over(w), F.lit(0)).alias("__before"),
    )
    # the key without a sign, as in the buckets: one order at every number of rows
    inside = Window.partitionBy("__source", "__bucket").orderBy(F.col("__key").bitwiseXOR(F.lit(-(1 << 63))), "__id", "__size")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        keyed.withColumn("__inside", F.coalesce(F.sum("__size").over(inside), F.lit(0)))
        .join(before, F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__bucket") == F.col("__b")))
        .withColumn("mix_start", F.col("__before") + F.col("__inside"))
    )


def mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    keep: list[str] | None = None,
    block: int = BLOCK,
    period: int | None = None,
    temperature: float = TEMPERATURE,
) -> DataFrame:
    """Columns `keep` (default: all) with mix_slot, mix_block, mix_release, mix_deadline and mix_start.

    (mix_slot, mix_start) is the mixed order.  A caller's `period` rounds the weights to whole slots of that period."""
    keep = [c for c in docs.columns if c not in OWN] if keep is None else keep
    found, _ = located(docs, keep, weights, block, period, temperature)
    return found.select("__row.*", *OWN)


def located(
    docs: DataFrame, keep: list[str], weights: dict[str | None, float] | None, block: int, period: int | None, temperature: float
) -> tuple[DataFrame, int]:
    """Columns `keep` as one (__row) with the operator's own, and the last slot that holds a block."""
    spark = docs.sparkSession
    rows = sized(docs, keep)
    totals = rows.groupBy("__source").agg(F.sum("__size").alias("size"), F.count(F.lit(1)).alias("n"))
    totals = totals.limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: map them to fewer before mixing")
    totals = sorted(totals, key=lambda r: (r["__source"] is not None, r["__source"] or ""))
    scale = max((r["size"] for r in totals), default=1) or 1
    shares = [float((weights or {}).get(r["__source"], max(r["size"] / scale, 1e-9) ** temperature)) for r in totals]
    slots = (quotas(shares, max(period, 4 * len(totals))) if period else fractions(shares)) if totals else []
    plan = schedule(slots, [r["size"] // block + 1 for r in totals])
    # a row of five numbers for each block
    names = ("__t", "__i", "__slot", "__release", "__deadline")
    columns = zip(*plan) if plan else [()] * len(names)
    table = spark.createDataFrame(pa.table([pa.array(c, pa.int64()) for c in columns], names=list(names)))
    table = F.broadcast(table) if len(plan) <= BROADCAST_BLOCKS else table
    numbers = spark.createDataFrame([(r["__source"], k) for k, r in enumerate(totals)], "__c string, __k long")
    found = (
        placed(rows, sum(r["n"] for r in totals))
        .join(F.broadcast(numbers), F.col("__source").eqNullSafe(F.col("__c")))
        .withColumn("mix_block", F.expr(f"mix_start div {block}"))
    )
    at = (F.col("__k") == F.col("__t")) & (F.col("mix_block") == F.col("__i"))
    named = [F.col(f"__{c}").alias(f"mix_{c}") for c in ("slot", "release", "deadline")]
    found = found.join(table, at).select("__row", "mix_block", *named, "mix_start")
    return found, max((slot for _, _, slot, _, _ in plan), default=0)


def in_mixed_order(docs: DataFrame, **options) -> DataFrame:
    """The rows and columns of `docs` in the mixed order: range by range of slots, sorted within each; `options` as in `mix`."""
    bound = inspect.signature(mix).bind(docs, keep=docs.columns, **options)
    bound.apply_defaults()
    mixed, last = located(**bound.arguments)
    # slots are dealt evenly from 0 on, so their ranges need no sampling; the end is the last block's turn
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.least(F.lit(parts - 1), F.floor(F.col("mix_slot") * parts / (last + 1)).cast("int"))
    return mixed.repartitionById(parts, part).sortWithinPartitions("mix_slot", "mix_start").select("__row.*")
