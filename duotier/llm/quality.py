"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Two multinomials over `BUCKETS` hashed unigrams and bigrams are counted: one
over the trusted target (every well labelled document), one over every
document.  A document's score is the mean log ratio
of its n-grams, so it does not depend on its length; its own n-grams are left
out of both counts, so that labelled and other documents score alike.  A few bad
words hardly move the mean of a long text, so the worst words are scored, too:
the mean log ratio of the lowest `WORST` of a text's words (one at least).

The two thresholds are fixed before any document is judged: the `QUANTILES` of the
trusted documents' own means and of their worst words, exact at any size (a
global sort).  Every document gets the verdict of these two.  Each text is scored
once, as a trusted one and as another; which of the two holds comes from a join of
these small rows with the trusted ids, so the ids are never gathered in one place.
For the counts each text meets the ids as its packed buckets, not as a whole.  The
joins are shuffled at every size, so what they write grows with the input alone.

Before that verdict stand plain rules: at least `MIN_WORDS` words, and at most
half of the words inside a repeated window of three.

Defined cases: a null or empty text has no words and fails the rules; a null
doc_id keeps its row; repeated rows are scored one by one; without a target
(no labels, or none that passes the rules) the rules alone decide; an empty
table gives an empty result; columns other than doc_id and text are not read."""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BATCH_ROWS, as_bytes, rows_to_batches, saved, small_batches

BUCKETS = 1 << 16
#: Shares of the trusted documents below the threshold of the mean, and below that of the worst words.
QUANTILES = (0.005, 0.01)
#: Share of a text's words that count as its worst.
WORST = 0.02
MIN_WORDS = 50
SMOOTHING = 1.0

SCHEMA_RULES = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")

SPACE = b" \t\n\r\x0b\x0c"
CONTINUATION = bytes(range(0x80, 0xC0))
SYMBOLS = b"#*$%&|<>"


class Words(dict):
    """Word -> small number, in order of first sight; `hashes` holds each word's 64-bit hash."""

    #: A fresh table beyond this many words bounds the memory of a task.
    FULL = 500_000

    def __init__(self):
        import xxhash

        super().__init__()
        self.hash = xxhash.xxh64_intdigest
        self.hashes = array("Q")

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.hashes)
        self.hashes.append(self.hash(word, 0))
        return n

    def ids(self, words: list[bytes]) -> np.ndarray:
        if len(self.hashes) > self.FULL:
            self.clear()
            self.hashes = array("Q")
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def hashes_of(self, ids: np.ndarray) -> np.ndarray:
        return np.frombuffer(self.hashes, np.uint64)[ids] if len(ids) else np.empty(0, np.uint64)


def n_gram_buckets(h: np.ndarray) -> np.ndarray:
    """Buckets of all unigrams and bigrams of a sequence of word hashes."""
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] + np.uint64(0x632BE59BD9B4E019))
    pairs *= np.uint64(0xD6E8FEB86659FD93)
    return np.concatenate([h >> shift, pairs >> shift]).astype(np.int64)


def n_repeat_words(ids: np.ndarray, n_types: int) -> int:
    """Words inside a window of three words that occurs more than once; the window's key is exact."""
    if len(ids) < 4:
        return 0
    pairs = ids[:-1] * n_types + ids[1:]
    if n_types > 1 << 20:  # three numbers would not fit into one
        pairs = np.unique(pairs, return_inverse=True)[1]
    keys = pairs[:-1] * n_types + ids[2:]
    order = np.sort(keys)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    hit = np.isin(keys, twice)
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[k : k + len(hit)] |= hit
    return int(covered.sum())


def target_ids(labels: DataFrame) -> DataFrame:
    """All ids whose every label is good and not toxic."""
    good = (
        labels.filter(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
        .filter("q = 1 AND t = 0")
    )
    return good.select(F.col("doc_id").cast("long").alias("doc_id"))


def with_target(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """`rows` (with a long doc_id) and whether their id is a trusted one. Shuffled at every size, and hashed, as `rows` may be too wide to sort."""
    target = target_ids(labels).withColumn("is_target", F.lit(True))
    return rows.join(target.hint("shuffle_hash"), "doc_id", "left").withColumn("is_target", F.coalesce("is_target", F.lit(False)))


def packed(at: np.ndarray) -> bytes:
    """Buckets in ascending order as compressed differences: a fraction of the text's size."""
    return zlib.compress(np.diff(np.sort(at), prepend=0).astype("<u2").tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(data), "<u2"), dtype=np.int64)


def n_grams(docs: DataFrame) -> DataFrame:
    """(doc_id, n_grams): the packed buckets of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_grams", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        rows = (
            (doc_id, packed(n_gram_buckets(words.hashes_of(words.ids(t.split())))))
            for b in batches
            for doc_id, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist())
        )
        yield from rows_to_batches(rows, schema, BATCH_ROWS)

    return as_bytes(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(run, "doc_id long, n_grams binary")


def n_gram_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, raw, target): n-gram counts of all documents and of the trusted target; at most BUCKETS rows."""
    schema = pa.schema([("bucket", pa.int32()), ("raw", pa.int64()), ("target", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for b in batches:
            for data, is_target in zip(b.column("n_grams").to_pylist(), b.column("is_target").to_pylist()):
                at = unpacked(data)
                np.add.at(raw, at, 1)
                if is_target:
                    np.add.at(good, at, 1)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(raw[at]), pa.array(good[at])], schema=schema
        )

    return (
        with_target(n_grams(docs), labels)
        .select("n_grams", "is_target")
        .mapInArrow(count, "bucket int, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    )


class Model:
    """Bucket counts of the target and the raw corpus, add-SMOOTHING smoothed."""

    def __init__(self, good: np.ndarray, raw: np.ndarray):
        self.good, self.raw = good, raw
        self.n_good, self.n_raw = float(good.sum()), float(raw.sum())

    def log_ratios(self, at: np.ndarray, is_target: bool) -> np.ndarray:
        """Log of target over raw probability of each n-gram in buckets `at`, not counting these themselves."""
        if not len(at) or not self.n_good:
            return np.zeros(len(at))
        _, number, times = np.unique(at, return_inverse=True, return_counts=True)
        own, rest = times[number], SMOOTHING * BUCKETS
        good = self.good[at] - own if is_target else self.good[at]
        n_good = self.n_good - len(at) if is_target else self.n_good
        logs = np.log((good + SMOOTHING) / (self.raw[at] - own + SMOOTHING))
        return logs + np.log((self.n_raw - len(at) + rest) / (n_good + rest))


def mean_and_worst(logs: np.ndarray, n: int, share: float = WORST) -> tuple[float, float]:
    """Mean of all n-grams of n words, and of the lowest `share` of its words (one at least).

    logs: of the n words, then of their n - 1 pairs."""
    if not n:
        return 0.0, 0.0
    k = max(int(share * n), 1)
    return float(logs.mean()), float(np.partition(logs[:n], k - 1)[:k].mean())


def model(counts: DataFrame) -> Model:
    """Both multinomials on the driver: BUCKETS numbers each, whatever the corpus holds."""
    raw, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counts.collect():
        raw[r.bucket], good[r.bucket] = r.raw, r.target
    return Model(good, raw)


def judged(
    text: bytes, words: Words, fitted: Model, is_target: bool, min_score: float, min_worst: float = -np.inf, min_words: int = MIN_WORDS
) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score, worst of one text."""
    ids = words.ids(text.split())
    n = len(ids)
    lines = [x for x in text.split(b"\n") if x.strip(SPACE)]
    repeats = n_repeat_words(ids, len(words.hashes))
    mean, worst = mean_and_worst(fitted.log_ratios(n_gram_buckets(words.hashes_of(ids)), is_target), n)
    failed = n < min_words or 100 * repeats > 50 * n
    return (
        n, len(text.translate(None, SPACE + CONTINUATION)), len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)), repeats, failed, not failed and mean >= min_score and worst >= min_worst, mean, worst,
    )


@dataclass
class Judge:
    """All that a verdict needs: the counts, the trusted ids (a table) and the two thresholds."""

    fitted: Model
    ids: DataFrame
    min_score: float = -np.inf
    min_worst: float = -np.inf

    @cached_property
    def target(self) -> frozenset[int]:
        """The trusted ids on the driver, for looking at small tables; no query calls this."""
        return frozenset(r.doc_id for r in self.ids.collect())


def _both(fitted: Model, text: bytes, words: Words) -> tuple:
    """Rules of a text, then score and worst words if it is not trusted, and if it is."""
    other = judged(text, words, fitted, False, -np.inf)
    ids = words.ids(text.split())
    own = mean_and_worst(fitted.log_ratios(n_gram_buckets(words.hashes_of(ids)), True), len(ids))
    return *other[:6], *other[7:], *own


def scores(docs: DataFrame, fitted: Model) -> DataFrame:
    """(doc_id, rules, score_0, worst_0, score_1, worst_1) of every document: as another, and as a trusted one."""
    shared = docs.sparkSession.sparkContext.broadcast((fitted.good, fitted.raw))
    longs = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    doubles = ("score_0", "worst_0", "score_1", "worst_1")
    schema = pa.schema(
        [(c, pa.int64()) for c in longs] + [("base_failed", pa.bool_())] + [(c, pa.float64()) for c in doubles]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, words = Model(*shared.value), Words()
        rows = (
            (doc_id, *_both(fitted, t, words))
            for b in batches
            for doc_id, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist())
        )
        yield from rows_to_batches(rows, schema)

    names = ", ".join([f"{c} long" for c in longs] + ["base_failed boolean"] + [f"{c} double" for c in doubles])
    return as_bytes(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(run, names)


def own_scores(docs: DataFrame, labels: DataFrame, fitted: Model) -> DataFrame:
    """The written scores of every document, each the one that holds for it."""
    rows = with_target(saved(scores(docs, fitted), "scores"), labels)
    of = lambda c: F.when(F.col("is_target"), F.col(f"{c}_1")).otherwise(F.col(f"{c}_0")).alias(c)
    return rows.select(*SCHEMA_RULES, "is_target", of("score"), of("worst"))


def quantile(rows: DataFrame, column: str, n: int, share: float) -> float:
    """The exact quantile of n numbers, between its two neighbours in proportion; Spark sorts them."""
    at = share * (n - 1)
    low = int(at)
    ordered = rows.select(column).orderBy(column).rdd.zipWithIndex()
    near = ordered.filter(lambda r: low <= r[1] <= low + 1).map(lambda r: (r[1], r[0][0])).collect()  # two numbers
    near = dict(near)
    return float(near[low] + (at - low) * (near.get(low + 1, near[low]) - near[low]))


def thresholds(rows: DataFrame) -> tuple[float, float]:
    """Quantiles of the trusted documents' scores, of those that pass the rules; of rows of one id the lowest."""
    own = rows.where("is_target AND NOT base_failed").groupBy("doc_id").agg(F.min("score").alias("score"), F.min("worst").alias("worst"))
    n = own.count()
    if not n:
        return -np.inf, -np.inf
    return tuple(quantile(own, c, n, q) for c, q in zip(("score", "worst"), QUANTILES))


def fit(docs: DataFrame, labels: DataFrame) -> Judge:
    """Counts of all documents, and the thresholds from the trusted ones."""
    fitted = model(n_gram_counts(docs, labels))
    return Judge(fitted, target_ids(labels), *thresholds(own_scores(docs, labels, fitted)))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document with its rules, score and verdict."""
    rows = own_scores(docs, labels, model(n_gram_counts(docs, labels)))
    min_score, min_worst = thresholds(rows)
    kept = ~F.col("base_failed") & (F.col("score") >= F.lit(min_score)) & (F.col("worst") >= F.lit(min_worst))
    return rows.select(*SCHEMA_RULES, kept.alias("kept"), "score", "worst")


def filtered(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` whose verdict is to keep them, with all their columns."""
    judge = fit(docs, labels)
    limits = judge.min_score, judge.min_worst
    shared = docs.sparkSession.sparkContext.broadcast((judge.fitted.good, judge.fitted.raw))
    at = docs.columns.index("text")
    small_batches(docs.sparkSession)
    # the caller's columns travel in one, so that none of their names can clash
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    flagged = with_target(docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole), labels).select("row", "is_target")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, words = Model(*shared.value), Words()
        for b in batches:
            rows = zip(b.column(0).field(at).to_pylist(), b.column(1).to_pylist())
            yield b.filter(pa.array([judged((t or "").encode(), words, fitted, f, *limits)[6] for t, f in rows], pa.bool_()))

    return flagged.mapInArrow(keep, flagged.schema).select("row.*")
