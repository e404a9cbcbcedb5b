"""Which keys of many batches meet, without a row per key.

A batch (a few thousand documents or vectors) has very many 64-bit keys, most of
which no other batch has.  Instead of one row per key, a batch sends one row per
shard of the key range, with its distinct keys of that range as bytes; a shard
gets the rows of all batches, and answers each with a few bytes per key, in the
batch's order.  A key that a third of all rows share comes once from each batch,
not once from each row.  The number of shards follows the number of keys, so a
shard's size does not grow with the corpus."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys of a shard, about.
SHARD_KEYS = 2_000_000

QUESTIONS = "shard int, batch long, keys binary, extra binary"
QUESTION_SCHEMA = pa.schema([("shard", pa.int32()), ("batch", pa.int64()), ("keys", pa.binary()), ("extra", pa.binary())])
ANSWER_SCHEMA = pa.schema([("batch", pa.int64()), ("shard", pa.int32()), ("answer", pa.binary())])


def shard_count(keys: int) -> int:
    return max(1, -(-keys // SHARD_KEYS))


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each key (unsigned, evenly spread): its top 32 bits scaled to the number of shards."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


def by_shard(keys: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, places of its keys) of a batch's keys, places in ascending order."""
    shard = shard_of(keys, shards)
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order])) + 1
    for places in np.split(order, cuts):
        if len(places):
            yield int(shard[places[0]]), places


def answers(questions: DataFrame, solve: Callable[[list[tuple[int, bytes, bytes]]], list[bytes]]) -> DataFrame:
    """(batch, answers): of each batch, the shards' answers as [shard, answer].

    questions: (shard, batch, keys, extra), one row per shard and batch; solve: from all (batch, keys, extra) of one
    shard to the answer of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = None, []

        def closed() -> Iterator[pa.RecordBatch]:
            found = solve(held)
            for at in range(0, len(held), 1000):
                own = [h[0] for h in held[at : at + 1000]]
                columns = [pa.array(own, pa.int64()), pa.array([number] * len(own), pa.int32()), pa.array(found[at : at + 1000], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema=ANSWER_SCHEMA)

        for b in batches:
            for shard, *row in zip(*(b.column(c).to_pylist() for c in ("shard", "batch", "keys", "extra"))):
                if shard != number:
                    if held:
                        yield from closed()
                    number, held = shard, []
                held.append(tuple(row))
        if held:
            yield from closed()

    dealt = questions.repartition("shard").sortWithinPartitions("shard", "batch")
    found = dealt.mapInArrow(run, "batch long, shard int, answer binary")
    # as many answers as the batch asked shards: bounded by the batch's own keys
    return found.groupBy("batch").agg(F.collect_list(F.struct("shard", "answer")).alias("answers"))
