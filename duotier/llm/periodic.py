"""Periodic runs of words by block convolution.

A run is a stretch of consecutive words with smallest period q, at least
max(`LEAST`, `TIMES` * q) words long, that no neighbouring word extends.

Words become whole numbers.  At every dyadic scale B the text is cut into blocks
that begin at the multiples of B and are B words long (`BLOCK` at most).  The
squared differences of a block and of the words at every distance from B to
2B - 1 after it are

    sum b^2 + sum w^2 - 2 * (block correlated with the window),

and the correlation is a number theoretic transform over the whole numbers
modulo the prime `PRIME`, done with products that stay exact in doubles.  A sum
of zero means an occurrence without a mismatch, and its distance a possible
period.  Sums are zero modulo the prime wherever they are zero, so no occurrence
is missed; each one is then extended word by word to both sides, so those that
are zero modulo the prime alone find nothing.  A run of period q in [B, 2B) has
4q words, so it holds a whole block of that scale and its next occurrence.

An occurrence inside a run that is already known, at a multiple of its period,
belongs to that run and is not extended again, nor is a second one at the same
distance inside the same stretch: a text of one repeated word is linear work.
Distances beyond `BLOCK` take several transforms of the same size, so a text of
any length needs the same memory for them.  Documents are independent: there is
no shuffle, and many short ones are transformed together.

Defined cases: a null or empty text has no runs, and an empty collapsed text;
rows with a null or repeated doc_id are kept, each by itself; an empty table
gives an empty result; columns other than doc_id and text are not read."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes

LEAST = 6
TIMES = 4
#: The prime 2^16 + 1 and a generator of its multiplicative group.
PRIME = 65537
GENERATOR = 3
#: Longest block, in words; a transform has twice as many places.
BLOCK = 128
#: Words of short documents that are transformed together, and numbers in one product.
TOGETHER = 1 << 17
SLICE = 1 << 16

RUNS = "array<struct<start:long,length:long,period:long>>"


def reduced(x: np.ndarray) -> np.ndarray:
    """Whole numbers in doubles (below 2^53) modulo the prime, in place; between -PRIME / 2 and PRIME / 2."""
    q = x * (1.0 / PRIME)
    np.rint(q, out=q)
    q *= PRIME
    x -= q
    return x


class Transform:
    """Forward and inverse transforms of `size` places (a power of two), as two products with small matrices."""

    def __init__(self, size: int):
        self.size = size
        self.rows = 1 << ((size.bit_length() - 1) // 2) if size > 64 else 1
        self.cols = size // self.rows
        root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
        self.forward = self.tables(root, 1)
        # the block's: root inverted, for a correlation, and divided by the size, for the way back
        self.block = self.tables(pow(root, -1, PRIME), pow(size, -1, PRIME))
        self.back = self.tables(pow(root, -1, PRIME), 1)

    def tables(self, root: int, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        powers = np.array([pow(root, k, PRIME) for k in range(self.size)], np.int64)
        r, c = np.arange(self.rows), np.arange(self.cols)
        across = powers[(r[:, None] * r[None, :] * self.cols) % self.size]
        twist = powers[(r[:, None] * c[None, :]) % self.size]
        along = powers[(c[:, None] * c[None, :] * self.rows) % self.size] * scale % PRIME
        return tuple(reduced(m.astype(float)) for m in (across, twist, along))

    def apply(self, x: np.ndarray, tables) -> np.ndarray:
        """Transforms of the rows of x; places come out as (k1, k2), which `inverse` takes."""
        across, twist, along = tables
        if self.rows == 1:  # a row may be shorter: the rest is zero
            return reduced(x @ along[: x.shape[1]])
        x = reduced(np.matmul(across, x.reshape(-1, self.rows, self.cols)))
        x *= twist
        return reduced(reduced(x).reshape(-1, self.cols) @ along).reshape(-1, self.size)

    def inverse(self, z: np.ndarray) -> np.ndarray:
        across, twist, along = self.back
        y = reduced(z.reshape(-1, self.cols) @ along)
        if self.rows > 1:
            y = y.reshape(-1, self.rows, self.cols)
            y *= twist
            y = np.matmul(across, reduced(y))
        return y.reshape(-1, self.size)


@lru_cache(maxsize=None)
def transform(size: int) -> Transform:
    return Transform(size)


def zero_mismatches(x: np.ndarray, squares: np.ndarray, starts: np.ndarray, distance: int, length: int):
    """(start, distance) of every block of `length` words that occurs again, for `length` distances from `distance` on.

    x: whole numbers modulo the prime, filled up with 2 * length places; squares: running sums of x * x."""
    t = transform(2 * length)
    inside, lags = np.arange(length), np.arange(length)
    found_s, found_d = [], []
    step = max(SLICE // (2 * length), 1)
    for at in range(0, len(starts), step):
        s = starts[at : at + step]
        block = x[s[:, None] + inside]
        if t.rows > 1:
            block = np.concatenate([block, np.zeros_like(block)], axis=1)
        window = x[s[:, None] + distance + np.arange(2 * length)]
        product = t.apply(block, t.block)
        product *= t.apply(window, t.forward)
        cross = t.inverse(reduced(product))[:, :length]
        w = s[:, None] + distance + lags
        total = (squares[s + length] - squares[s])[:, None] + (squares[w + length] - squares[w])
        i, d = np.nonzero(reduced(total - 2.0 * reduced(cross)) == 0)
        found_s.append(s[i])
        found_d.append(distance + d)
    return np.concatenate(found_s), np.concatenate(found_d)


def stretch(x: np.ndarray, s: int, d: int, length: int, low: int, high: int) -> tuple[int, int]:
    """The longest stretch of words around s, inside low..high, that has period d; words s to s + length are known to."""
    end, step = s + length, 32
    while end + d < high:
        m = min(step, high - d - end)
        differ = x[end : end + m] != x[end + d : end + d + m]
        k = int(differ.argmax())
        if differ[k]:
            end += k
            break
        end, step = end + m, 2 * step
    begin, step = s, 32
    while begin > low:
        m = min(step, begin - low)
        differ = (x[begin - m : begin] != x[begin - m + d : begin + d])[::-1]
        k = int(differ.argmax())
        if differ[k]:
            begin -= k
            break
        begin, step = begin - m, 2 * step
    return begin, end + d


def runs_of(ids: np.ndarray, ends: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs, by start and period, of each of the texts that `ids` holds one after another.

    ids: a whole number for each word; ends: where each text ends."""
    n = len(ids)
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    sizes = ends - begins
    found: list[dict[tuple[int, int], int]] = [{} for _ in ends]
    longest = int(sizes.max(initial=0))
    if not longest:
        return [[] for _ in ends]
    x = np.zeros(n + 4 * BLOCK, float)
    x[:n] = reduced(ids.astype(float))
    squares = np.concatenate([[0.0], np.cumsum(x * x)])  # below 2^53 for 8 million words; else in whole numbers
    if n >= 1 << 22:
        squares = np.concatenate([[0], np.cumsum((x * x).astype(np.int64))])
    text_of = np.repeat(np.arange(len(ends)), sizes)
    cover_end, cover_q = np.zeros(n, np.int64), np.ones(n, np.int64)
    scale = 1
    while TIMES * scale <= longest:
        length = min(scale, BLOCK)
        s = np.arange(0, n, scale)
        text = text_of[s]
        room = ends[text] - s
        s = s[(sizes[text] >= max(LEAST, TIMES * scale)) & (room >= scale + length)]
        got_s, got_d = [], []
        for distance in range(scale, 2 * scale, length):
            s = s[ends[text_of[s]] - s >= distance + length]
            if not len(s):
                break
            for k in range(0, len(s), 1 << 20):
                a, d = zero_mismatches(x, squares, s[k : k + (1 << 20)], distance, length)
                ok = (a + d + length <= ends[text_of[a]]) & ~((cover_end[a] >= a + d + length) & (d % cover_q[a] == 0))
                got_s.append(a[ok])
                got_d.append(d[ok])
        if got_s:
            a, d = np.concatenate(got_s), np.concatenate(got_d)
            order = np.lexsort((a, d))
            last_d, last_end = 0, 0
            for p, q in zip(a[order].tolist(), d[order].tolist()):
                if q == last_d and p + q < last_end:
                    continue  # inside the last stretch of this distance
                k = int(text_of[p])
                if (ids[p : p + length] != ids[p + q : p + q + length]).any():
                    continue  # equal modulo the prime alone
                begin, end = stretch(ids, p, q, length, int(begins[k]), int(ends[k]))
                last_d, last_end = q, end
                if end - begin >= max(LEAST, TIMES * q) and (begin, end) not in found[k]:
                    found[k][begin, end] = q
                    part = slice(begin, end)
                    wider = cover_end[part] < end
                    cover_q[part][wider] = q
                    cover_end[part][wider] = end
        scale *= 2
    out = []
    for b, own in zip(begins.tolist(), found):
        out.append(sorted(((i - b, j - i, q) for (i, j), q in own.items()), key=lambda r: (r[0], r[2])))
    return out


def kept(words: list, runs: list[tuple[int, int, int]]) -> list:
    """Words that no run contains after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [w for w, g in zip(words, np.cumsum(gone[:-1]).tolist()) if not g]


def find(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, runs (by start, then period) and collapsed, the text's words that no run
    repeats, joined by a space."""
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", run_type), ("collapsed", pa.string())])

    def rows(held: list[tuple]) -> pa.RecordBatch:
        split = [t.split() for _, t in held]
        every = [w for words in split for w in words]
        number = dict(zip(set(every), range(len(every))))
        ids = np.fromiter(map(number.__getitem__, every), np.int64, len(every))
        ends = np.cumsum([len(words) for words in split])
        found = runs_of(ids, ends)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([doc_id for doc_id, _ in held], pa.int64()),
                pa.array([len(words) for words in split], pa.int64()),
                pa.array([[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found], run_type),
                pa.array([b" ".join(kept(words, runs)).decode() for words, runs in zip(split, found)], pa.string()),
            ],
            schema=schema,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for row in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                held.append(row)
                size += len(row[1])
                if size >= 6 * TOGETHER:  # bytes: words are rarely shorter, and nothing depends on it
                    yield rows(held)
                    held, size = [], 0
        if held:
            yield rows(held)

    texts = as_bytes(docs, F.col("doc_id").cast("long").alias("doc_id"))
    return texts.mapInArrow(run, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every text whose crc32(doc_id as text) is divisible by 10 gets a planted period.

    With n words, h the checksum and g = floor(h / 10): each word i >= a becomes word a + (i - a) % p, where a = g % n
    and p = 1 + floor((n - a) / (3 + g % 8)).  A null doc_id has no checksum and changes nothing."""
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), h.alias("h"))
    # the words of those texts alone, once
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = rows.withColumn("words", F.when((F.col("h") % 10 == 0) & F.col("text").isNotNull(), words))
    rows = rows.withColumn("n", F.coalesce(F.size("words"), F.lit(0)))
    g, n = F.floor(F.col("h") / 10).cast("long"), F.col("n").cast("long")
    rows = rows.where("true").select("doc_id", "text", "words", "n", F.when(F.col("n") > 0, g % n).alias("a"), g.alias("g"))
    p = F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8))
    rows = rows.select("*", p.alias("p"))
    left = (F.col("n") - F.col("a")).cast("int")
    period = F.slice("words", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    again = F.flatten(F.array_repeat(period, F.ceil(left / F.col("p")).cast("int")))
    planted = F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")), F.slice(again, F.lit(1), left))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of the greatest length / period, and checksums of all runs and of the collapsed text."""

    def greater_first(a, b):
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        first = (x > y) | ((x == y) & ((a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["period"] < b["period"]))))
        return F.when(first, F.lit(-1)).otherwise(F.lit(1))

    best = found.withColumn("best", F.get(F.array_sort("runs", greater_first), F.lit(0)))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
