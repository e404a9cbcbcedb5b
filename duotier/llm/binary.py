"""Token ids in binary files: static range asymmetric numeral system (rANS).

Texts are tokenized where they are read, and their ids (two bytes each, where the
vocabulary allows) written to shared storage; these are dealt to tasks by ranges
of doc_id and sorted.  A task encodes them in segments of about `SEGMENT` ids; a segment is one row of the written
table and holds, as bytes,

    header     magic, version, precision, counts, CRC-32 of the rest
    documents  id, null flag and number of ids of each document
    table      frequency of each id, the one table all blocks share
    blocks     about `BLOCK` ids each, each decodable by itself

A block interleaves `lanes` coders: id i belongs to lane i mod lanes, so one
array operation codes a step of all lanes.  States lie in [2^31, 2^63) and give
off 32-bit words.  A block keeps the lanes' states and the word position at
every `CHECKPOINT` steps, so a reader may start at any of them, and the CRC-32
of its ids and of its words.

Defined cases: a null text is empty and has the end id alone; a null doc_id
sorts first and stays null; repeated rows are all written, rows of one doc_id in
the order of their texts' first 64 bytes, then of their ids; a text longer than a
segment makes a longer segment; an empty table gives no segments; columns other
than doc_id and text are not read."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, rows_to_batches, saved, scratch, small_batches
from .tokens import tokenizer_path, worker_encoder

END_ID = 2
PRECISION = 20
LOW = np.uint64(1 << 31)
LANES = 1024
BLOCK = 1 << 18
SEGMENT = 1 << 21
CHECKPOINT = 128
#: Words that a worker keeps in each generation of its cache.
CACHE = 1_200_000
#: Below this id two bytes hold an id on its way to the files.
SHORT = 1 << 16
#: Bytes of a text that order rows of the same doc_id, before their ids do.
HEAD_BYTES = 64

MAGIC = b"RANS"
HEAD = "<4sHHIIQI"  # magic, version, precision, documents, blocks, ids, crc of the rest
BLOCK_HEAD = "<IIIIIII"  # ids, lanes, checkpoint steps, checkpoints, words, crc of ids, crc of words


class Damaged(ValueError):
    """A checksum does not agree with the bytes it covers."""


def frequencies(counts: np.ndarray, precision: int = PRECISION) -> np.ndarray:
    """Counts scaled to add up to 2**precision, at least 1 where the count is; largest remainders first."""
    total, seen = 1 << precision, np.flatnonzero(counts)
    if not len(seen):
        return np.zeros(len(counts), np.uint64)
    if len(seen) > total:
        raise ValueError("more ids than the precision can tell apart")
    exact = counts[seen] * ((total - len(seen)) / counts[seen].sum())
    whole = 1 + exact.astype(np.int64)
    order = np.argsort(whole - 1 - exact, kind="stable")
    whole[order[: total - whole.sum()]] += 1
    out = np.zeros(len(counts), np.uint64)
    out[seen] = whole.astype(np.uint64)
    return out


def starts(freq: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)


def encode_block(ids: np.ndarray, freq: np.ndarray, start: np.ndarray, lanes: int = LANES, every: int = CHECKPOINT) -> bytes:
    """One block: header, checkpoints (word position, states) and words."""
    lanes = max(1, min(lanes, len(ids) // 64))
    steps = -(-len(ids) // lanes)
    f, c = freq[ids], start[ids]
    x = np.full(lanes, LOW, np.uint64)
    given: list[np.ndarray] = []  # words of each step, last step first
    marks: list[tuple[int, np.ndarray]] = []
    count, shift, half, full = 0, np.uint64(PRECISION), np.uint64(32), np.uint64(0xFFFFFFFF)
    top = np.uint64(63 - PRECISION)
    for step in range(steps - 1, -1, -1):
        fs, cs = f[step * lanes : (step + 1) * lanes], c[step * lanes : (step + 1) * lanes]
        live = x[: len(fs)]
        over = live >= (fs << top)
        if over.any():
            given.append((live[over] & full).astype("<u4"))
            count += len(given[-1])
            live = np.where(over, live >> half, live)
        q = live // fs
        x[: len(fs)] = (q << shift) + (live - q * fs) + cs
        if step % every == 0:
            marks.append((count, x.copy()))
    words = np.concatenate(given[::-1]) if given else np.empty(0, "<u4")
    marks.reverse()
    points = b"".join(struct.pack("<I", count - n) + state.astype("<u8").tobytes() for n, state in marks)
    payload = points + words.tobytes()
    head = struct.pack(
        BLOCK_HEAD,
        len(ids), lanes, every, len(marks), len(words), zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(payload)
    )
    return head + payload


def decode_block(
    data: bytes, at: int, freq: np.ndarray, start: np.ndarray, slots: np.ndarray, point: int = 0, stop: int | None = None
) -> tuple[np.ndarray, int]:
    """Ids of the block at byte `at` from checkpoint `point` on (up to the block's id `stop`), and where the next block begins."""
    n, lanes, every, points, n_words, ids_crc, crc = struct.unpack_from(BLOCK_HEAD, data, at)
    at += struct.calcsize(BLOCK_HEAD)
    size = 4 + 8 * lanes
    end = at + points * size + 4 * n_words
    if point == 0 and zlib.crc32(data[at:end]) != crc:
        raise Damaged("words of a block")
    mark = at + point * size
    (pos,) = struct.unpack_from("<I", data, mark)
    x = np.frombuffer(data, "<u8", lanes, mark + 4).astype(np.uint64)
    words = np.frombuffer(data, "<u4", n_words, at + points * size)
    first = point * every
    out = np.empty((n if stop is None else min(stop, n)) - first * lanes, np.uint32)
    shift, half, mask = np.uint64(PRECISION), np.uint64(32), np.uint64((1 << PRECISION) - 1)
    for step in range(0, -(-len(out) // lanes)):
        live = x[: min(lanes, len(out) - step * lanes)]
        slot = live & mask
        ids = slots[slot]
        out[step * lanes : step * lanes + len(ids)] = ids
        new = freq[ids] * (live >> shift) + slot - start[ids]
        low = np.flatnonzero(new < LOW)
        if len(low):
            new[low] = (new[low] << half) | words[pos : pos + len(low)]
            pos += len(low)
        x[: len(new)] = new
    if len(out) == n and zlib.crc32(out.astype("<u4").tobytes()) != ids_crc:
        raise Damaged("ids of a block")
    return out, end


def decode_slice(data: bytes, begin: int, end: int) -> np.ndarray:
    """Ids begin to end of a segment, from the last checkpoint before them on; blocks without any are not decoded."""
    _, _, at, freq = opened(data)
    start = starts(freq)
    slots = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))
    parts, before = [], 0
    while before < end and at < len(data):
        n, lanes, every, points, n_words, _, _ = struct.unpack_from(BLOCK_HEAD, data, at)
        if before + n > begin:
            point = max(begin - before, 0) // (lanes * every)
            ids, _ = decode_block(data, at, freq, start, slots, point, end - before)
            parts.append(ids[max(begin - before, 0) - point * lanes * every :])
        at += struct.calcsize(BLOCK_HEAD) + points * (4 + 8 * lanes) + 4 * n_words
        before += n
    return np.concatenate(parts) if parts else np.empty(0, np.uint32)


def encode_segment(doc_ids: list, texts: list[bytes], block: int = BLOCK) -> bytes:
    """Documents' ids (little-endian unsigned 32-bit) as one segment."""
    ids = np.frombuffer(b"".join(texts), "<u4")
    freq = frequencies(np.bincount(ids))
    start = starts(freq)
    lengths = np.array([len(t) // 4 for t in texts], "<u4")
    numbers = np.array([0 if d is None else d for d in doc_ids], "<i8")
    nulls = np.packbits(np.array([d is None for d in doc_ids], np.uint8))
    table = zlib.compress(freq.astype("<u4").tobytes(), 6)
    blocks = [encode_block(ids[at : at + block], freq, start) for at in range(0, len(ids), block)]
    rest = b"".join(
        [numbers.tobytes(), lengths.tobytes(), nulls.tobytes(), struct.pack("<I", len(table)), table, *blocks]
    )
    return struct.pack(HEAD, MAGIC, 1, PRECISION, len(doc_ids), len(blocks), len(ids), zlib.crc32(rest)) + rest


def opened(data: bytes) -> tuple[list, np.ndarray, int, np.ndarray]:
    """Document ids, number of ids of each, where the first block begins, and the frequency table."""
    magic, version, precision, n_docs, n_blocks, n_ids, crc = struct.unpack_from(HEAD, data)
    if magic != MAGIC or version != 1 or precision != PRECISION or zlib.crc32(memoryview(data)[struct.calcsize(HEAD) :]) != crc:
        raise Damaged("segment")
    at = struct.calcsize(HEAD)
    numbers = np.frombuffer(data, "<i8", n_docs, at)
    lengths = np.frombuffer(data, "<u4", n_docs, at + 8 * n_docs)
    at += 12 * n_docs
    nulls = np.unpackbits(np.frombuffer(data, np.uint8, -(-n_docs // 8), at))[:n_docs]
    at += -(-n_docs // 8)
    (size,) = struct.unpack_from("<I", data, at)
    freq = np.frombuffer(zlib.decompress(data[at + 4 : at + 4 + size]), "<u4").astype(np.uint64)
    return [None if null else int(d) for d, null in zip(numbers, nulls)], lengths, at + 4 + size, freq


def decode_segment(data: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """Document ids, number of ids of each document, and all ids."""
    doc_ids, lengths, at, freq = opened(data)
    n_blocks, n_ids = struct.unpack_from(HEAD, data)[4:6]
    start = starts(freq)
    slots = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))
    parts = []
    for _ in range(n_blocks):
        ids, at = decode_block(data, at, freq, start, slots)
        parts.append(ids)
    ids = np.concatenate(parts) if parts else np.empty(0, np.uint32)
    if len(ids) != n_ids:
        raise Damaged("number of ids")
    return doc_ids, lengths, ids


def write(docs: DataFrame, path: str, end_id: int = END_ID, tokenizer: str | None = None, segment: int = SEGMENT) -> None:
    """Encode all texts, in ascending doc_id order, into the table of segments at `path`.

    Columns: shard (ascending ranges of doc_id), segment (within the shard), shard_start (ids of the shard before
    it), n_ids, data."""
    schema = pa.schema(
        [("shard", pa.int32()), ("segment", pa.int32()), ("shard_start", pa.int64()), ("n_ids", pa.int64()), ("data", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, number, before, held_ids, held, n = TaskContext.get().partitionId(), 0, 0, [], [], 0

        def closed() -> pa.RecordBatch:
            row = (shard, number, before, n, encode_segment(held_ids, held))
            return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, schema)], schema=schema)

        for b in batches:
            for doc_id, width, ids in zip(*(b.column(c).to_pylist() for c in ("doc_id", "width", "ids"))):
                held_ids.append(doc_id)
                held.append(ids if width == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes())
                n += len(held[-1]) // 4
                if n >= segment:
                    yield closed()
                    number, before, held_ids, held, n = number + 1, before + n, [], [], 0
        if held:
            yield closed()

    # written first: dealing out by ranges reads its input twice, the first time doc_id alone
    rows = saved(tokenized(docs, end_id, tokenizer), "ids")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "head", "ids")
    out = rows.mapInArrow(run, "shard int, segment int, shard_start long, n_ids long, data binary")
    out.write.option("compression", "uncompressed").parquet(path)


def tokenized(docs: DataFrame, end_id: int = END_ID, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, head, width, ids): every text's first bytes, and its ids and the end id, little-endian, in `width` bytes each."""
    place = tokenizer or tokenizer_path()
    schema = pa.schema([("doc_id", pa.int64()), ("head", pa.binary()), ("width", pa.int32()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(place, CACHE)
        short = len(encoder.ends) <= SHORT and end_id < SHORT
        end = np.array([end_id], "<u2" if short else "<u4").tobytes()
        for b in batches:
            texts = b.column("text").to_pylist()
            got = encoder.encode(texts)
            if short:
                got = [np.frombuffer(ids, "<u4").astype("<u2").tobytes() for ids in got]
            width = pa.array(np.full(len(got), 2 if short else 4, np.int32))
            head, ids = (pa.array(x, pa.binary()) for x in ([t[:HEAD_BYTES] for t in texts], [ids + end for ids in got]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), head, width, ids], schema=schema)

    return as_bytes(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(run, "doc_id long, head binary, width int, ids binary")


def read(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document of the file in its place, ids as little-endian unsigned 32 bits."""
    return _read(spark, path, with_ids=True)


def digests(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the file."""
    return _read(spark, path, with_ids=False)


def shard_starts(rows: DataFrame) -> dict[int, int]:
    """Ids before each shard: a number per shard."""
    totals = {r.shard: r.n for r in rows.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()}
    base, before = {}, 0
    for shard in sorted(totals):
        base[shard], before = before, before + totals[shard]
    return base


def _read(spark, path: str, with_ids: bool) -> DataFrame:
    small_batches(spark)
    rows = spark.read.schema("shard int, segment int, shard_start long, n_ids long, data binary").parquet(path)
    base = shard_starts(rows)
    last = ("ids", pa.binary()) if with_ids else ("ids_crc32", pa.int64())
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), last])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for b in batches:
                for shard, at, data in zip(*(b.column(c).to_pylist() for c in ("shard", "shard_start", "data"))):
                    doc_ids, lengths, ids = decode_segment(data)
                    raw, start = memoryview(ids.astype("<u4").tobytes()), base[shard] + at
                    done = 0
                    for doc_id, n in zip(doc_ids, lengths.tolist()):
                        own = raw[4 * done : 4 * (done + n)]
                        yield doc_id, start + done, n, bytes(own) if with_ids else zlib.crc32(own)
                        done += n

        yield from rows_to_batches(found(), schema, 1000)

    kind = "ids binary" if with_ids else "ids_crc32 long"
    return rows.select("shard", "shard_start", "data").mapInArrow(run, f"doc_id long, start long, n_tokens long, {kind}")


def read_slice(spark, path: str, begin: int, end: int) -> DataFrame:
    """(start, ids): ids begin to end of the whole file, one row for each segment that has some, decoded from checkpoints."""
    small_batches(spark)
    rows = spark.read.schema("shard int, segment int, shard_start long, n_ids long, data binary").parquet(path)
    base = shard_starts(rows)
    known = F.element_at(F.create_map(*[F.lit(x) for pair in base.items() for x in pair]), F.col("shard")) if base else F.lit(0)
    rows = rows.withColumn("start", (known + F.col("shard_start")).cast("long"))
    rows = rows.filter((F.col("start") < end) & (F.col("start") + F.col("n_ids") > begin)).select("start", "data")
    schema = pa.schema([("start", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for b in batches:
                for start, data in zip(*(b.column(c).to_pylist() for c in ("start", "data"))):
                    first = max(begin - start, 0)
                    yield start + first, decode_slice(data, first, end - start).astype("<u4").tobytes()

        yield from rows_to_batches(found(), schema, 16)

    return rows.mapInArrow(run, "start long, ids binary")


def round_trip(docs: DataFrame) -> DataFrame:
    """Write all texts to shared storage and return the documents' digests as read back."""
    spark = docs.sparkSession
    path = f"{scratch(spark)}/tokens"
    write(docs, path)
    return digests(spark, path)
