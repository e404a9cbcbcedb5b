"""Best-fit packing of documents into sequences of bounded length, improved by swap-based local search.

Documents become pieces: whole, or cut into full sequences where longer.  Only
lengths matter for packing, so the work is on length classes: how many pieces
there are of each length (at most `size` numbers), and patterns, i.e. lists of
lengths that share a sequence, each with the number of sequences like it.
Best fit in descending length makes the first patterns.  Local search then
takes two underfull patterns at a time and moves one document, exchanges one
for one, two for one or one for two, whenever that raises the sum of squared fills;
it acts on as many sequences as both patterns have, and ends when no two
underfull patterns are left that gain.  Emptied sequences go.

Each length's pieces are numbered across the corpus (a count per task and
length, summed up), and the n-th piece of a length takes the n-th place of that
length: a lookup in the bounded pattern table, without any group of pieces.

Where the documents come in an order, pieces of a length are numbered in it and
every pattern's sequences are dealt evenly over `CHUNKS` parts, so sequences
follow the order as far as their lengths allow.

Defined cases: a null text is empty and its piece holds the end id alone; a
null doc_id keeps its pieces; repeated rows are all packed; an empty table
gives an empty result; columns other than doc_id and text are not read."""

from __future__ import annotations

import bisect
import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import as_bytes, saved
from .tokens import tokenizer_path, worker_encoder

SIZE = 2048
END_ID = 0
#: Parts of the corpus, one after the other, that the sequences of ordered documents are numbered by.
CHUNKS = 256

PIECE = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
     ("ids_crc32", pa.int64()), ("part", pa.int32()), ("nth", pa.int64()), ("ids", pa.binary())]
)


def pieces(docs: DataFrame, size: int = SIZE, end_id: int = END_ID, tokenizer: str | None = None, ids: bool = False) -> DataFrame:
    """Pieces of all documents; `nth` counts a task's pieces of that length, `ids` holds the ids if asked for."""
    path = tokenizer or tokenizer_path()
    end = np.array([end_id], "<u4").tobytes()
    schema = PIECE if ids else pa.schema(list(PIECE)[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part, seen = worker_encoder(path), TaskContext.get().partitionId(), Counter()
        for b in batches:
            rows = []
            for doc_id, got in zip(b.column("doc_id").to_pylist(), encoder.encode(b.column("text").to_pylist())):
                got += end
                for k, at in enumerate(range(0, len(got), 4 * size)):
                    own = got[at : at + 4 * size]
                    n = len(own) // 4
                    rows.append((doc_id, k, at // 4, n, zlib.crc32(own), part, seen[n], own)[: len(schema)])
                    seen[n] += 1
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema
                )

    out = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
    return as_bytes(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(run, out + ", ids binary" * ids)


Pattern = tuple[int, ...]


def best_fit(counts: dict[int, int], size: int) -> Counter:
    """Patterns and how many sequences follow each: each length, largest first, goes where least room is left over."""
    room: dict[int, Counter] = {}  # free room -> patterns
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            free = min((r for r in room if r >= length), default=None)
            if free is None:
                per, (full, rest) = size // length, divmod(left, size // length)
                for pattern, n in (((length,) * per, full), ((length,) * rest, bool(rest))):
                    if n and pattern:
                        room.setdefault(size - length * len(pattern), Counter())[pattern] += int(n)
                break
            pattern, n = next(iter(sorted(room[free].items(), reverse=True)))
            m = min(n, left)
            room[free][pattern] -= m
            if n == m:
                del room[free][pattern]
                if not room[free]:
                    del room[free]
            room.setdefault(free - length, Counter())[(*pattern, length)] += m
            left -= m
    out: Counter = Counter()
    for patterns in room.values():
        out.update(patterns)
    return out


class Sums(NamedTuple):
    """Lengths of a pattern, and bit sets of them and of the sums of two of its documents."""

    lengths: list[int]
    ones: int
    twos: int


def sums(p: Pattern) -> Sums:
    count = Counter(p)
    ones, twos = sum(1 << x for x in count), 0
    for x, n in count.items():
        twos |= (ones if n > 1 else ones ^ (1 << x)) << x
    return Sums(sorted(count), ones, twos)


def two(p: Pattern, total: int) -> Pattern:
    """Two documents of a pattern with that sum."""
    return next((x, total - x) for x in sorted(set(p)) if total - x in p and (2 * x != total or p.count(x) > 1))


def better(a: Pattern, b: Pattern, size: int, held: dict[Pattern, Sums]) -> tuple[Pattern, Pattern] | None:
    """The move or exchange between two sequences that raises the sum of squared fills most: b, the fuller, gains.

    That is the one with the largest difference of lengths that b has room for."""
    free, x, y = size - sum(b), held[a], held[b]
    fits, either = (1 << free) - 1, x.ones | x.twos
    # bit d - 1 is a difference of d
    d = (x.ones >> 1 & fits).bit_length()
    for take in y.lengths:
        if d == free:
            break
        d = max(d, (either >> (take + 1) & fits).bit_length())
    for give in x.lengths:
        if d == free:
            break
        # bit free - d is a difference of d
        left = (y.twos >> (give - free) if give > free else y.twos << (free - give)) & fits
        if left:
            d = max(d, free + 1 - (left & -left).bit_length())
    if not d:
        return None
    if x.ones >> d & 1:
        give, take = (d,), ()
    elif (n := next((n for n in y.lengths if x.ones >> (n + d) & 1), 0)):
        give, take = (n + d,), (n,)
    elif (n := next((n for n in y.lengths if x.twos >> (n + d) & 1), 0)):
        give, take = two(a, n + d), (n,)
    else:
        n = next(n for n in x.lengths if n > d and y.twos >> (n - d) & 1)
        give, take = (n,), two(b, n - d)
    return swapped(a, give, take), swapped(b, take, give)


def swapped(p: Pattern, out: Pattern, new: Pattern) -> Pattern:
    left = list(p)
    for x in out:
        left.remove(x)
    return tuple(sorted([*left, *new], reverse=True))


def local_search(patterns: Counter, size: int) -> Counter:
    """Exchanges between underfull patterns until no two of them have one; empty sequences are dropped."""
    found: Counter = Counter()
    for p, n in patterns.items():
        found[tuple(sorted(p, reverse=True))] += n
    under = sorted((sum(p), p) for p in found if p and sum(p) < size)
    held = {p: sums(p) for _, p in under}
    # patterns still to be compared with all others, the emptiest first: those are to be emptied
    waiting, queued = list(under), set(held)
    while waiting:
        own = heapq.heappop(waiting)
        p = own[1]
        queued.discard(p)
        if not found[p]:
            continue
        for other in under[::-1]:
            q = other[1]
            a, b = (p, q) if own <= other else (q, p)
            while found[a] and found[b] and (a != b or found[a] > 1):
                new = better(a, b, size, held)
                if new is None:
                    break
                m = min(found[a], found[b]) if a != b else found[a] // 2
                for x in (a, b):
                    found[x] -= m
                    if not found[x] and x in held:
                        del under[bisect.bisect_left(under, (sum(x), x))], held[x]
                for x in new:
                    at = (sum(x), x)
                    if x and at[0] < size:
                        if not found[x]:
                            bisect.insort(under, at)
                            held[x] = sums(x)
                        # also where there are two of it now: these may gain from each other
                        if found[x] < 2 and x not in queued:
                            heapq.heappush(waiting, at)
                            queued.add(x)
                    found[x] += m
            if not found[p]:
                break
    return Counter({p: n for p, n in found.items() if n and p})


def dealt(patterns: Counter, chunks: int) -> Iterator[tuple[Pattern, int]]:
    """Patterns with numbers of sequences: each pattern's are spread over the chunks, and a chunk holds nearly the same number."""
    parts: list[list[tuple[Pattern, int]]] = [[] for _ in range(chunks)]
    for at, (pattern, n) in enumerate(sorted(patterns.items(), reverse=True)):
        # sequence k of n lies at (k + start) / n of the way; starts go round evenly, as single sequences do
        start, cuts = at * 0.6180339887498949 % 1, Counter()
        if n <= chunks:
            cuts.update(int((k + start) / n * chunks) for k in range(n))
        else:
            ends = [0, *(min(n, max(0, math.ceil((c + 1) * n / chunks - start))) for c in range(chunks - 1)), n]
            cuts.update({c: ends[c + 1] - ends[c] for c in range(chunks)})
        for c, m in cuts.items():
            if m:
                parts[c].append((pattern, m))
    for part in parts:
        yield from part


def places(patterns: Counter, chunks: int = 1) -> list[tuple[int, int, int, int, int]]:
    """(length, from, to, sequence, offset): the pieces numbered from..to-1 of a length, in sequences from `sequence` on."""
    used: Counter = Counter()
    out, sequence = [], 0
    for pattern, n in dealt(patterns, chunks):
        offset = 0
        for length in pattern:
            out.append((length, used[length], used[length] + n, sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    return out


def assign(cut: DataFrame, size: int = SIZE, chunks: int = 1) -> DataFrame:
    """Pieces (a written table) with sequence_id and offset."""
    per_part = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = saved(per_part.select("part", "length", "n", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before")), "counts")
    counts = {r.length: r.n for r in before.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `size` rows
    table = sorted(places(local_search(best_fit(counts, size), size), chunks))
    plan = cut.sparkSession.sparkContext.broadcast(np.array(table, np.int64).reshape(-1, 5))  # a few patterns per length
    numbered = cut.join(before.select("part", "length", "before"), ["part", "length"])
    numbered = numbered.withColumn("rank", F.col("nth") + F.col("before")).drop("part", "nth", "before")
    keep = [c for c in numbered.columns if c != "rank"]
    schema = numbered.select(*keep).schema.add("sequence_id", "long").add("offset", "long")

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = plan.value
        span = int(rows[:, 2].max()) + 1 if len(rows) else 1
        firsts = rows[:, 0] * span + rows[:, 1]
        for b in batches:
            length, rank = (b.column(c).to_numpy() for c in ("length", "rank"))
            k = np.searchsorted(firsts, length * span + rank, side="right") - 1
            new = [pa.array(rows[k, 3] + rank - rows[k, 1]), pa.array(rows[k, 4])]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *new], names=[*keep, "sequence_id", "offset"])

    return numbered.mapInArrow(look_up, schema)


def pack(docs: DataFrame, size: int = SIZE, end_id: int = END_ID, tokenizer: str | None = None, ids: bool = False, ordered: bool = False) -> DataFrame:
    """Pieces with their place: sequence_id and offset in it.

    With `ordered`, the order of `docs` (by partition, then by row) is that of the sequences, too."""
    return assign(saved(pieces(docs, size, end_id, tokenizer, ids), "pieces"), size, CHUNKS if ordered else 1)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed ids of each sequence as bytes; a group holds at most `size` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.transform(parts, lambda x: x["ids"]).alias("parts")).select(
        "sequence_id", F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x)).alias("ids")
    )
