"""The k most frequent terms of a stream of unbounded distinct terms, exactly, without shuffling them.

First pass: each task keeps a Misra-Gries summary of its terms.  When it holds
more than twice `width` terms, the (width + 1)-th largest count is taken off
every count, terms without a rest go, and the amount is added to the summary's
error.  Summaries merge the same way, in a tree.  In the end

    kept count <= true count <= kept count + error,

and a term that is not kept occurs `error` times at most.  Second pass: exact
counts of the terms that can still be among the k first, at most 2 * `width` of
them, which are broadcast.  The result is proven if the k-th exact count is above the
error (or the error is zero); otherwise both passes are repeated with summaries
four times as wide.  What is shuffled is bounded by the summaries' width, not by
the number of distinct terms."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import COLS, Cols
from . import grams
from .features import term_array

WIDTH = 8192
#: Nodes of the levels of the merge tree; a node merges one summary after another.
LEVELS = (64, 8, 1)
SUMMARY = "error long, terms array<string>, counts array<long>"


def _worker(width: int, summarised: bool):
    """Arrow batches of term arrays, or of summaries, to one summary; nested, so that it travels to workers by value."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([("error", pa.int64()), ("terms", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
        kept: dict[str, int] = {}
        error, seen = 0, False

        def add(terms: list, counts: list) -> int:
            for t, n in zip(terms, counts):
                kept[t] = kept.get(t, 0) + n
            if len(kept) <= 2 * width:
                return 0
            taken = sorted(kept.values(), reverse=True)[width]
            rest = {t: n - taken for t, n in kept.items() if n > taken}
            kept.clear()
            kept.update(rest)
            return taken

        for b in batches:
            if summarised:
                for e, terms, counts in zip(*(b.column(c).to_pylist() for c in ("error", "terms", "counts"))):
                    error += e + add(terms, counts)
                    seen = True
            else:
                column = b.column(0)
                for at in range(0, len(column), 256):
                    found = column.slice(at, 256).flatten().drop_null().value_counts()
                    if len(found):
                        error += add(found.field("values").to_pylist(), found.field("counts").to_pylist())
                        seen = True
        if seen:
            row = (error, list(kept), list(kept.values()))
            yield pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, schema)], schema=schema)

    return run


def summary(term_arrays: DataFrame, width: int = WIDTH) -> tuple[int, dict[str, int]]:
    """Error and kept counts of the merged summary of a one-column frame of term arrays; at most 2 * width terms."""
    out = term_arrays.mapInArrow(_worker(width, False), SUMMARY)
    for nodes in LEVELS:
        out = out.repartition(nodes).mapInArrow(_worker(width, True), SUMMARY)
    row = out.first()
    return (row["error"], dict(zip(row["terms"], row["counts"]))) if row else (0, {})


def candidates(error: int, kept: dict[str, int], k: int) -> list[str]:
    """Kept terms whose true count can reach the k-th largest kept count."""
    if len(kept) <= k:
        return sorted(kept)
    bar = sorted(kept.values(), reverse=True)[k - 1]
    return sorted(t for t, n in kept.items() if n + error >= bar)


def exact_counts(term_arrays: DataFrame, terms: list[str]) -> DataFrame:
    """(term, freq, df) of the given terms: occurrences, and rows that hold the term. term_arrays: column `_terms`."""
    spark = term_arrays.sparkSession
    known = F.broadcast(spark.createDataFrame([(t,) for t in terms], "term string"))  # at most 2 * width terms
    counts = term_arrays.select("_terms").mapInArrow(grams.among(terms), grams.COUNTS)  # a row per term and batch
    return counts.join(known, "term").groupBy("term").agg(F.sum("freq").alias("freq"), F.sum("df").alias("df"))


def vocabulary(
    df: DataFrame, k: int = C.VOCAB_SIZE, cols: Cols = COLS, stop=None, n: int = C.NGRAM_MAX, width: int = WIDTH
) -> DataFrame:
    """The same terms and counts as `features.vocabulary`: the k most frequent (ties: smaller term first)."""
    arrays = term_array(df, cols, stop, n).select("_terms")
    while True:
        error, kept = summary(arrays, width)
        top = exact_counts(arrays, candidates(error, kept, k)).orderBy(F.desc("freq"), F.asc("term")).limit(k)
        if error == 0:
            return top
        found = top.collect()  # k rows
        if len(found) == k and found[-1]["freq"] > error:
            return df.sparkSession.createDataFrame(found, "term string, freq long, df long")
        width *= 4
