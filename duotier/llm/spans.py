"""Substring deduplication by sliding sentence spans.

A text is cut into sentences (after . ! ? before white space, and at line
ends).  A sentence of more than `LONG` words is cut after every word, so that
equal passages are cut alike wherever they begin.  From every sentence on, and
up to every sentence, the shortest span of two sentences and `MIN_WORDS` words
is taken; its 64-bit hash is joined over all documents.  The first place of a
hash, by (doc_id, position), stays; every sentence that another place covers is
removed from its text.  Any longer repeated run is made up of such spans, each
repeated at the same places, so this is what comparing all runs would remove.

Most spans occur once, so there is no row per span.  Texts lie packed in batches
in shared storage; a batch sends each of its distinct hashes once, as bytes, to
the shard of its value (shards.py), with the documents that have them first.
A shard answers whether other batches have a hash, too, and whose place is the
first of all; places of the same batch are compared there.  A passage that a
third of all rows share comes once from each batch and never gathers in a group.

Defined cases: a null or empty text has no sentences and stays as it is (null:
null); rows with equal doc_id and equal text are one document and get the same
result; a null doc_id sorts first; a text too short for a span is kept whole;
an empty table gives an empty result; columns other than doc_id and text are
not read."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, small_batches
from .shards import QUESTION_SCHEMA, QUESTIONS, answers, by_shard, shard_count

MIN_SENTENCES = 2
MIN_WORDS = 12
LONG = 24
#: Bytes of text in a batch; a longer text is a batch by itself.
BATCH = 2_000_000
END = re.compile(rb"[.!?]+[\x20\x09-\x0D]+|\n+")
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def sentences(text: bytes) -> list[tuple[int, int, bytes, int]]:
    """(begin, end, words joined by a space, number of words) of each sentence; ends include what separates."""
    out, begin = [], 0
    ends = [m.end() for m in END.finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    for end in ends:
        words = text[begin:end].split()
        if not words:
            continue  # joins the next
        if len(words) <= LONG:
            out.append((begin, end, b" ".join(words), len(words)))
        else:
            stops = [begin + m.end() for m in WORD.finditer(text[begin:end])]
            for word, stop in zip(words, [*stops[:-1], end]):
                out.append((begin, stop, word, 1))
                begin = stop
        begin = end
    return out


def pieces(text: bytes) -> tuple[list[bytes], np.ndarray]:
    """Words (joined by a space) and number of words of each sentence, without its place."""
    words, counts, begin = [], [], 0
    ends = [m.end() for m in END.finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    for end in ends:
        own = text[begin:end].split()
        begin = end
        if len(own) > LONG:
            words += own
            counts += [1] * len(own)
        elif own:
            words.append(b" ".join(own))
            counts.append(len(own))
    return words, np.array(counts, np.int64)


def bounds(counts: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, last sentence) of the shortest span of enough sentences and words from each sentence on, and up to each."""
    n = len(counts)
    before = np.concatenate([[0], np.cumsum(counts)])
    i = np.arange(n)
    j = np.maximum(np.searchsorted(before, before[:-1] + min_words) - 1, i + MIN_SENTENCES - 1)
    i, j = i[j < n], j[j < n]
    # up to each sentence, but those that are one from a sentence on
    last = np.arange(n)
    first = np.minimum(np.searchsorted(before, before[1:] - min_words, side="right") - 1, last - MIN_SENTENCES + 1)
    new = first >= 0
    known = np.full(n, -1)
    known[i] = j
    new &= known[first] != last
    order = np.argsort(np.concatenate([i, first[new]]), kind="stable")
    return np.concatenate([i, first[new]])[order], np.concatenate([j, last[new]])[order]


def hashed(text: bytes, digest, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Hashes, first and last sentences of a text's spans by first sentence, and its number of sentences."""
    words, counts = pieces(text)
    i, j = bounds(counts, min_words)
    joined = b"\n".join(words)
    begins = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)])
    places = zip(begins[i].tolist(), (begins[j + 1] - 1).tolist())
    return np.fromiter((digest(joined[a:b], 0) for a, b in places), np.uint64, len(i)), i, j, len(words)


def spans(text: bytes, digest, min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """(hash, first, last sentence) of each span of a text."""
    return list(zip(*(x.tolist() for x in hashed(text, digest, min_words)[:3])))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text that tells apart texts of the same doc_id, and the text as bytes (null stays)."""
    small_batches(docs.sparkSession)
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.cast("binary").alias("text"))


BATCHES = "batch long, size long, doc_ids binary, nulls binary, h binary, lengths binary, texts binary"
NAMES = [f.split()[0] for f in BATCHES.split(", ")]


def packed(docs: DataFrame) -> DataFrame:
    """Documents in batches of about `BATCH` bytes, ordered by (doc_id, hash) in each, texts compressed; a written table."""
    schema = pa.schema([("batch", pa.int64()), ("size", pa.int64())] + [(c, pa.binary()) for c in NAMES[2:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def closed() -> pa.RecordBatch:
            held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
            ids, hashes, texts = zip(*held)
            row = (
                number, size, np.array([d or 0 for d in ids], "<i8").tobytes(), np.array([d is None for d in ids]).tobytes(),
                np.array(hashes, "<i8").tobytes(), np.array([-1 if t is None else len(t) for t in texts], "<i8").tobytes(),
                zlib.compress(b"".join(t or b"" for t in texts), 1),
            )
            return pa.RecordBatch.from_arrays([pa.array([x], type=f.type) for x, f in zip(row, schema)], schema=schema)

        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("doc_id", "h", "text"))):
                held.append(row)
                size += len(row[2] or b"")
                if size >= BATCH:
                    yield closed()
                    number, held, size = number + 1, [], 0
        if held:
            yield closed()

    return saved(keyed(docs).mapInArrow(run, BATCHES), "batches")


def unpacked(row: tuple) -> tuple[list, np.ndarray, list]:
    """(doc_ids, hashes, texts) of a batch's row after its number and size."""
    ids, nulls, hashes, lengths, raw = row
    ids = [None if null else d for d, null in zip(np.frombuffer(ids, "<i8").tolist(), np.frombuffer(nulls, bool).tolist())]
    text, at, texts = zlib.decompress(raw), 0, []
    for n in np.frombuffer(lengths, "<i8").tolist():
        texts.append(None if n < 0 else text[at : at + n])
        at += max(n, 0)
    return ids, np.frombuffer(hashes, "<i8"), texts


class Places:
    """All spans of a batch: documents in order, a document's spans by first sentence.

    doc, i, j: of every span; sentences: number of them in each text; keys: distinct hashes in the order of their first places; number: each span's key;
    first: whether a span is its key's first place here (a repeated document's is, too)."""

    def __init__(self, ids: list, hashes: np.ndarray, texts: list, min_words: int, digest):
        own = [hashed(t or b"", digest, min_words) for t in texts]
        found, self.i, self.j = (np.concatenate([o[k] for o in own]) for k in range(3))
        counts, self.sentences = [len(o[0]) for o in own], [o[3] for o in own]
        self.doc = np.repeat(np.arange(len(texts)), counts)
        keys, at, number = np.unique(found, return_index=True, return_inverse=True)
        order = np.argsort(at)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.keys, at, self.number = keys[order], at[order], rank[number]
        same = [k > 0 and ids[k] == ids[k - 1] and hashes[k] == hashes[k - 1] for k in range(len(ids))]
        document = np.cumsum(~np.array(same, bool)) if same else np.empty(0, np.int64)
        self.key_doc = self.doc[at]
        self.first = (document[self.doc] == document[self.key_doc[self.number]]) & (self.i == self.i[at][self.number])
        self.here = np.bincount(self.number, minlength=len(self.keys))


def first_places(batches: DataFrame, min_words: int, shards: int) -> DataFrame:
    """(batch, answers): of each distinct hash of a batch, 0 if no other batch has it, 2 if its first place here is the
    first of all, else 1."""

    def ask(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in rows:
            for batch, _, *row in zip(*(b.column(c).to_pylist() for c in NAMES)):
                ids, hashes, texts = unpacked(row)
                places = Places(ids, hashes, texts, min_words, xxhash.xxh64_intdigest)
                null = np.array([d is None for d in ids], bool)
                numbers = np.array([d or 0 for d in ids], "<i8")
                for shard, at in by_shard(places.keys, shards):
                    docs, counts = np.unique(places.key_doc[at], return_counts=True)
                    own = np.diff(numbers[docs], prepend=0), hashes[docs], counts, null[docs]
                    extra = zlib.compress(b"".join(x.astype("<i8").tobytes() for x in own), 1)
                    out = (shard, batch, places.keys[at].tobytes(), extra)
                    yield pa.RecordBatch.from_arrays([pa.array([x], type=f.type) for x, f in zip(out, QUESTION_SCHEMA)], schema=QUESTION_SCHEMA)

    def solve(asked: list[tuple[int, bytes, bytes]]) -> list[bytes]:
        keys, ids, hashes, nulls = [], [], [], []
        for _, own, extra in asked:
            keys.append(np.frombuffer(own, np.uint64))
            step, h, counts, null = np.frombuffer(zlib.decompress(extra), "<i8").reshape(4, -1)
            for kept, column in ((ids, np.cumsum(step)), (hashes, h), (nulls, null)):
                kept.append(np.repeat(column, counts))
        ends = np.cumsum([len(k) for k in keys])
        key = np.concatenate(keys)
        order = np.argsort(key)
        again = np.zeros(len(key), bool)
        equal = key[order][1:] == key[order][:-1]
        again[1:] |= equal
        again[:-1] |= equal
        at = order[again]  # places of hashes that several batches have
        k, d, h, known = key[at], np.concatenate(ids)[at], np.concatenate(hashes)[at], 1 - np.concatenate(nulls)[at]
        by_place = np.lexsort((h, d, known, k))
        at, k, d, h, known = at[by_place], k[by_place], d[by_place], h[by_place], known[by_place]
        begins = np.append(True, k[1:] != k[:-1]) if len(k) else np.empty(0, bool)
        head = np.flatnonzero(begins)[np.cumsum(begins) - 1] if len(k) else np.empty(0, np.int64)
        found = np.zeros(len(key), np.uint8)
        found[at] = 1 + ((d == d[head]) & (h == h[head]) & (known == known[head]))
        return [zlib.compress(part.tobytes(), 1) for part in np.split(found, ends[:-1])]

    return answers(batches.mapInArrow(ask, QUESTIONS), solve)


def deduplicate(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: doc_id, n_sentences, n_repeated (in any repeated span), n_removed, text without those."""
    batches = packed(docs)
    total = batches.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    shards = shard_count(total // 6)  # a span for each word at most
    joined = batches.join(first_places(batches, min_words, shards), "batch", "left").select(*NAMES, "answers")
    schema = pa.schema([("doc_id", pa.int64()), ("n_sentences", pa.int32()), ("n_repeated", pa.int32()), ("n_removed", pa.int32()), ("text", pa.string())])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in rows:
            for _, _, *row, found in zip(*(b.column(c).to_pylist() for c in [*NAMES, "answers"])):
                ids, hashes, texts = unpacked(row)
                places = Places(ids, hashes, texts, min_words, xxhash.xxh64_intdigest)
                answer = np.zeros(len(places.keys), np.uint8)
                by_number = {a["shard"]: a["answer"] for a in found or ()}
                for shard, at in by_shard(places.keys, shards):
                    answer[at] = np.frombuffer(zlib.decompress(by_number[shard]), np.uint8)
                repeated = (answer[places.number] > 0) | (places.here[places.number] > 1)
                first = places.first & (answer[places.number] != 1)
                ends = np.searchsorted(places.doc, np.arange(1, len(ids) + 1))
                out, begin = [], 0
                for doc_id, t, n, end in zip(ids, texts, places.sentences, ends.tolist()):
                    own = np.flatnonzero(repeated[begin:end]) + begin
                    seen, gone = covered(places, own, n), covered(places, own[~first[own]], n)
                    begin = end
                    if gone.any():
                        t = b"".join(t[s[0] : s[1]] for s, out_of in zip(sentences(t), gone.tolist()) if not out_of)
                    out.append((doc_id, n, int(seen.sum()), int(gone.sum()), None if t is None else t.decode()))
                for k in range(0, len(out), 500):
                    columns = zip(*out[k : k + 500])
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)

    return joined.mapInArrow(run, "doc_id long, n_sentences int, n_repeated int, n_removed int, text string")


def covered(places: Places, which: np.ndarray, n: int) -> np.ndarray:
    """Which of n sentences lie in any of the spans numbered `which`."""
    if not len(which):
        return np.zeros(n, bool)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, places.i[which], 1)
    np.add.at(edge, places.j[which] + 1, -1)
    return np.cumsum(edge[:-1]) > 0
