"""Language-model scoring with a weighted backoff automaton, trained on the corpus itself.

The model is a bigram model with Dirichlet smoothing over a discounted unigram
model.  As an automaton: a state for the text's start and for every known word,
and a root.  From state u the arc of word w weighs
    log10((c(u w) + MU * p(w)) / (c(u) + MU))
where u w was seen in training; else the failure arc to the root weighs
log10(MU / (c(u) + MU)) and the root's arc log10 p(w).  The root has an arc for
every known word and one for any unknown word:
    p(w) = (c(w) - D) / N,  p(unknown) = D * V / N,  D = n1 / (n1 + 2 * n2),
or 1/2 if no word was seen once, or none twice.
Reading a word leads to its state (an unknown one to the root), so a text is
scored in one pass from left to right that carries the state and adds weights.

Neither counts nor vocabulary fit into one place.  Documents are numbered into
buckets of about `BUCKET` tokens and written once.  Each bucket sends the hashes
and training counts of its words and word pairs to shards of the hash range; a
shard adds them up and answers every bucket in the order of its question.  So a
bucket gets the part of the automaton that its own texts can reach, and scores
them.  All that moves is packed, and grows with the corpus.

Words are known by 64-bit hashes.  A bucket's size bounds a task's memory; the
number of shards is spark.sql.shuffle.partitions.

Defined cases: a null text is empty: its only token is the end; a null doc_id
keeps its row and is trained on; repeated rows count and are scored one by one;
without training documents every count is 0, N and V, too, and the unknown word
has probability 1; an empty table gives an empty result; columns other than
doc_id and text are not read."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, saved, small_batches

#: Tokens of a bucket.
BUCKET = 1_000_000
#: Weight of the unigram model in a state.
MU = 500.0
FOLDS, HELD_OUT = 7, 2
#: Neither can be a word: they hold white space.
END, START = b"\n", b"\t"


def is_held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


class Bucket:
    """Documents as numbers of the bucket's own words; number 0 is the end of a text."""

    def __init__(self, words: np.ndarray, ids: np.ndarray, lengths: np.ndarray, held: np.ndarray):
        self.words, self.ids, self.lengths, self.held = words, ids, lengths, held

    def tokens_held(self) -> np.ndarray:
        return np.repeat(self.held, self.lengths)

    def word_keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys of the words, their training counts, and the place of each word number."""
        counts = np.bincount(self.ids[~self.tokens_held()], minlength=len(self.words))
        order = np.argsort(self.words)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return self.words[order], counts[order], place

    def previous(self) -> np.ndarray:
        """Number of the word before each token, -1 at a text's start."""
        out = np.empty(len(self.ids), np.int64)
        out[1:] = self.ids[:-1]
        out[np.cumsum(self.lengths) - self.lengths] = -1
        return out

    def pair_keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys of the word pairs, their training counts, and the place of each token's pair."""
        first = np.append(self.words, np.uint64(zlib.crc32(START)))[self.previous()]
        keys = (first * np.uint64(0x9E3779B97F4A7C15)) ^ (self.words[self.ids] + np.uint64(0x7F4A7C159E3779B9))
        keys ^= keys >> np.uint64(31)
        keys *= np.uint64(0xD6E8FEB86659FD93)
        unique, place = np.unique(keys, return_inverse=True)
        return unique, np.bincount(place[~self.tokens_held()], minlength=len(unique)), place

    def pack(self) -> bytes:
        head = np.array([len(self.words), len(self.ids), len(self.lengths)], "<i8")
        parts = [head, self.words.astype("<u8"), self.ids.astype("<i4"), self.lengths.astype("<i4"), self.held.astype("u1")]
        return b"".join(p.tobytes() for p in parts)

    @staticmethod
    def unpack(data: bytes) -> Bucket:
        n_words, n_ids, n_docs = np.frombuffer(data, "<i8", 3)
        at, out = 24, []
        for kind, n in (("<u8", n_words), ("<i4", n_ids), ("<i4", n_docs), ("u1", n_docs)):
            out.append(np.frombuffer(data, kind, n, at))
            at += out[-1].nbytes
        return Bucket(out[0].astype(np.uint64), out[1].astype(np.int64), out[2].astype(np.int64), out[3].astype(bool))


def buckets(docs: DataFrame, size: int = BUCKET) -> DataFrame:
    """(bucket, doc_ids, data): all documents, a written table."""
    schema = pa.schema([("bucket", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32

        class Numbers(dict):
            def __missing__(self, word):
                self[word] = n = len(self)
                return n

        def fresh():
            return Numbers({END: 0}), [], [], 0

        known, doc_ids, texts, n = fresh()

        def closed() -> pa.RecordBatch:
            words = np.fromiter((xxhash.xxh64_intdigest(w, 0) for w in known), np.uint64, len(known))
            held = np.array([is_held_out(d) for d in doc_ids], bool)
            data = Bucket(words, np.concatenate(texts), np.array([len(t) for t in texts]), held).pack()
            cols = [[number], [doc_ids], [data]]
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)

        for b in batches:
            for doc_id, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                words = t.lower().split()
                words.append(END)
                texts.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
                doc_ids.append(doc_id)
                n += len(words)
                if n >= size:
                    yield closed()
                    number += 1
                    known, doc_ids, texts, n = fresh()
        if texts:
            yield closed()

    rows = as_bytes(docs, F.col("doc_id").cast("long").alias("doc_id"))
    return saved(rows.mapInArrow(run, "bucket long, doc_ids array<long>, data binary"), "buckets")


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, in as few bytes each as the largest needs."""
    diff = np.diff(keys, prepend=keys[:1]) if len(keys) else keys
    width = max(1, -(-int(diff.max(initial=0)).bit_length() // 8))
    first = keys[:1].astype("<u8").tobytes()
    return bytes([width]) + first + diff.astype("<u8").view("u1").reshape(-1, 8)[:, :width].tobytes()


def unpacked_keys(data: bytes) -> np.ndarray:
    width = data[0]
    if len(data) <= 9:
        return np.empty(0, np.uint64)
    small = np.frombuffer(data, "u1", offset=9).reshape(-1, width)
    diff = np.zeros((len(small), 8), "u1")
    diff[:, :width] = small
    diff = diff.view("<u8").ravel().astype(np.uint64)
    return np.frombuffer(data, "<u8", 1, 1).astype(np.uint64)[0] + np.cumsum(diff, dtype=np.uint64)


def packed_counts(counts: np.ndarray) -> bytes:
    width = next(w for w in (1, 2, 4, 8) if int(counts.max(initial=0)) < 1 << (8 * w))
    return zlib.compress(bytes([width]) + counts.astype(f"<u{width}").tobytes(), 1)


def unpacked_counts(data: bytes) -> np.ndarray:
    raw = zlib.decompress(data)
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


def shard_bounds(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's keys begin among sorted keys, and their end: shards are equal parts of the hash range."""
    edges = np.array([(k << 64) // shards for k in range(1, shards)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def totals(table: DataFrame, pairs: bool) -> DataFrame:
    """(bucket, shard, counts, n, types, once, twice): the corpus' training counts of a bucket's keys in its order.

    One row per shard has bucket -1: tokens, types, and types seen once and twice in training."""
    shards = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = pa.schema([("shard", pa.int32()), ("bucket", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
    given = pa.schema(
        [("bucket", pa.int64()), ("shard", pa.int32()), ("counts", pa.binary())]
        + [(c, pa.int64()) for c in ("n", "types", "once", "twice")]
    )

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number, data in zip(b.column("bucket").to_pylist(), b.column("data").to_pylist()):
                own = Bucket.unpack(data)
                keys, counts, _ = own.pair_keys() if pairs else own.word_keys()
                at = shard_bounds(keys, shards)
                rows = [
                    (k, number, packed_keys(keys[p:q]), packed_counts(counts[p:q]))
                    for k, (p, q) in enumerate(zip(at[:-1], at[1:])) if q > p
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(zip(*rows), asked)], schema=asked
                )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A partition is a shard."""
        numbers, keys, counts, shard = [], [], [], None
        for b in batches:
            for shard, number, k, c in zip(*(b.column(x).to_pylist() for x in asked.names)):
                numbers.append(number)
                keys.append(unpacked_keys(k))
                counts.append(unpacked_counts(c).astype(np.uint32))
        if shard is None:
            return
        sizes = [len(k) for k in keys]
        every = np.concatenate(keys)
        del keys
        order = np.argsort(every)
        every = every[order]
        new = np.concatenate([[True], every[1:] != every[:-1]])
        del every
        sums = np.add.reduceat(np.concatenate(counts)[order].astype(np.int64), np.flatnonzero(new))
        whole = np.empty(len(order), np.int64)
        whole[order] = sums[np.cumsum(new) - 1]
        stats = [int(x) for x in (sums.sum(), (sums > 0).sum(), (sums == 1).sum(), (sums == 2).sum())]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], type=f.type) for x, f in zip((-1, shard, None, *stats), given)], schema=given
        )
        at = 0
        for number, size in zip(numbers, sizes):
            row = (number, shard, packed_counts(whole[at : at + size]), None, None, None, None)
            yield pa.RecordBatch.from_arrays([pa.array([x], type=f.type) for x, f in zip(row, given)], schema=given)
            at += size

    questions = table.select("bucket", "data").mapInArrow(ask, "shard int, bucket long, keys binary, counts binary")
    return questions.repartitionById(shards, F.col("shard")).mapInArrow(
        answer, "bucket long, shard int, counts binary, n long, types long, once long, twice long"
    )


class Automaton:
    """The part of the automaton that a bucket's texts can reach."""

    def __init__(self, words: np.ndarray, stats: tuple[int, int, int, int]):
        """words: training counts by the bucket's word numbers; stats: tokens, types, types seen once, twice."""
        n, types, once, twice = stats
        self.n, self.types = n, types
        d = once / (once + 2 * twice) if once and twice else 0.5
        known = (words - d) / max(n, 1)
        unknown = d * types / n if n else 1.0
        self.p = np.where(words > 0, known, unknown)
        self.root = np.log10(self.p)  # arcs of the root
        self.base = np.log10((words + 1) / (n + types + 1))
        # a state for each known word, and as the last one (-1) for the start: as many texts begin as end
        self.seen = np.append(words, words[0]).astype(float)
        self.fail = np.log10(MU / (self.seen + MU))

    def weights(self, state: np.ndarray, word: np.ndarray, pair: np.ndarray) -> np.ndarray:
        """Weight of reading `word` in `state` (-1: start), `pair` being how often training saw them together."""
        arc = np.log10((pair + MU * self.p[word]) / (self.seen[state] + MU))
        return np.where(pair > 0, arc, self.fail[state] + self.root[word])


def score(docs: DataFrame, bucket_tokens: int = BUCKET) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    small_batches(docs.sparkSession)
    table = buckets(docs, bucket_tokens)
    words = saved(totals(table, pairs=False), "words")
    sums = words.filter("bucket = -1").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "types", "once", "twice")])
    stats = tuple(sums.first())  # four numbers
    none = F.lit(None)
    parts = (
        words.filter("bucket >= 0").select("bucket", F.lit(0).alias("kind"), "shard", "counts", none.cast("array<long>").alias("doc_ids"))
        .union(totals(table, pairs=True).filter("bucket >= 0").select("bucket", F.lit(1), "shard", "counts", none))
        .union(table.select("bucket", F.lit(2), F.lit(0), "data", "doc_ids"))
    )
    parts = parts.repartition("bucket").sortWithinPartitions("bucket", "kind", "shard")
    schema = pa.schema(
        [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
         ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: tuple[list, list] = ([], [])
        for b in batches:
            for kind, data, doc_ids in zip(*(b.column(c).to_pylist() for c in ("kind", "counts", "doc_ids"))):
                if kind < 2:
                    got[kind].append(unpacked_counts(data))
                    continue
                own = Bucket.unpack(data)
                automaton = Automaton(np.concatenate(got[0])[own.word_keys()[2]], stats)
                pair = np.concatenate(got[1])[own.pair_keys()[2]]
                got = ([], [])
                weights = automaton.weights(own.previous(), own.ids, pair)
                begins = np.cumsum(own.lengths) - own.lengths
                known = (automaton.seen[:-1] > 0)[own.ids].astype(np.int64)
                cols = [
                    doc_ids, own.held, own.lengths, np.add.reduceat(known, begins), np.full(len(begins), automaton.n),
                    np.add.reduceat(automaton.base[own.ids], begins), np.add.reduceat(weights, begins),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)

    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return parts.mapInArrow(run, out)
