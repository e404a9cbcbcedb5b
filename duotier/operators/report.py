"""Precision, recall and F1 per code and level of the taxonomy.

A code has three levels: its first two characters, its first five, and itself.
The confusion pairs (true code, final code) are counted once, sparsely; both
sides are rolled up all levels with grouping sets.  The pairs are at most as many
as codes squared, however many rows there are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import COLS, Cols
from ..functions.text import exact_ratio

#: Characters of a code at each level; the last is the whole code.
LEVELS = (2, 5, None)


def confusion(classified: DataFrame, truth: DataFrame, cols: Cols = COLS) -> DataFrame:
    """(true_code, final_code, n) of every pair that occurs; a row without a true code has a null one."""
    rows = classified.select(cols.id, F.col(cols.final).alias("final_code"))
    known = truth.select(cols.id, F.col(cols.truth).alias("true_code"))
    return rows.join(known, cols.id, "left").groupBy("true_code", "final_code").agg(F.count(F.lit(1)).alias("n"))


def _cut(col: str, size: int | None):
    return F.col(col) if size is None else F.substring(col, 1, size)


def _side(pairs: DataFrame, side: str, total: str) -> DataFrame:
    """(level, code, `total`, and its rows that agree at that level) of one side of the pairs."""
    at = {f"_{k}": _cut(side, size) for k, size in enumerate(LEVELS, start=1)}
    agree = {f"_a{k}": (_cut("true_code", size) == _cut("final_code", size)) for k, size in enumerate(LEVELS, start=1)}
    rows = pairs.where(F.col(side).isNotNull()).withColumns(at | agree)
    keys = [F.col(c) for c in at]
    rolled = rows.groupingSets([[k] for k in keys], *keys).agg(
        F.sum("n").alias(total),
        *[F.sum(F.when(F.col(f"_a{k}"), F.col("n")).otherwise(0)).alias(f"_h{k}") for k in range(1, len(LEVELS) + 1)],
    )
    level, code, hits = F.lit(None).cast("int"), F.lit(None).cast("string"), F.lit(0).cast("long")
    for k in range(1, len(LEVELS) + 1):  # exactly one key of each row is set
        here = F.col(f"_{k}").isNotNull()
        level, code, hits = (F.when(here, x).otherwise(y) for x, y in ((F.lit(k), level), (F.col(f"_{k}"), code), (F.col(f"_h{k}"), hits)))
    return rolled.select(level.alias("level"), code.alias("code"), total, hits.alias("n_correct"))


def per_code(pairs: DataFrame) -> DataFrame:
    """One row per level and code: support, predicted, n_correct, precision, recall, f1 (null where undefined)."""
    true_side = _side(pairs, "true_code", "support")
    final_side = _side(pairs, "final_code", "predicted").withColumnRenamed("n_correct", "_c")
    joined = true_side.join(final_side, ["level", "code"], "full")
    zero = F.lit(0).cast("long")
    out = joined.select(
        "level", "code", F.coalesce("support", zero).alias("support"), F.coalesce("predicted", zero).alias("predicted"),
        F.coalesce("n_correct", "_c", zero).alias("n_correct"),
    )
    return out.select(
        "*",
        exact_ratio("n_correct", "predicted").alias("precision"),
        exact_ratio("n_correct", "support").alias("recall"),
        exact_ratio(F.col("n_correct") * 2, F.col("support") + F.col("predicted")).alias("f1"),
    )
