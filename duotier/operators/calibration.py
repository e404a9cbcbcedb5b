"""Choosing the gate's threshold from labelled results (P5, A4, A5, Q18).

`curve` gives, for each confidence, how many rows a gate at it accepts and how
many of those are wrong (risk and coverage).  `threshold` is the least
confidence whose accepted rows stay within a wanted error.  `calibrate` is the
isotonic (never falling) estimate of the share of right rows per confidence.

Rows are first counted per distinct confidence, with map-side combination, so a
confidence that a third of all rows share is one row.  Running sums are taken
within ranges of confidence, cut at quantiles of its distinct values, and ranges
are joined with the sums of those beyond them: no window spans all values.
Isotonic pooling is done the same way: adjacent violators are pooled in each
range, then what is left of two neighbouring ranges at a time over their seam.

All shares are ratios of whole numbers, so results do not depend on the order of
anything.  A missing confidence takes no part; a missing result counts as wrong."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import exact_ratio

RANGES = 64


def counts(df: DataFrame, confidence: str, correct: Column) -> DataFrame:
    """(confidence, n, n_correct) per distinct confidence."""
    rows = df.select(F.col(confidence).cast("double").alias("confidence"), F.coalesce(correct, F.lit(False)).alias("_ok"))
    rows = rows.where(F.col("confidence").isNotNull() & ~F.isnan("confidence"))
    return rows.groupBy("confidence").agg(F.count(F.lit(1)).alias("n"), F.count_if("_ok").alias("n_correct"))


def with_range(per_value: DataFrame, ranges: int = RANGES) -> DataFrame:
    """`per_value` with `_range`, a number that rises with the confidence; cuts are quantiles of the distinct values."""
    shares = [k / ranges for k in range(1, ranges)]
    cuts = per_value.agg(F.percentile_approx("confidence", shares, 10_000).alias("c")).first()["c"] or []  # ranges - 1 numbers
    cuts = F.array(*[F.lit(float(c)) for c in sorted(set(cuts))]).cast("array<double>")
    return per_value.withColumn("_range", F.size(F.filter(cuts, lambda c: c <= F.col("confidence"))))


def curve(per_value: DataFrame, ranges: int = RANGES) -> DataFrame:
    """(confidence, n_accepted, n_wrong, coverage, risk) of a gate at each distinct confidence."""
    ranged = with_range(per_value, ranges)
    totals = ranged.groupBy("_range").agg(F.sum("n").alias("_n"), F.sum("n_correct").alias("_ok"))
    above = Window.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    offsets = totals.select(
        F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_ok").over(above), F.lit(0)).alias("_ok0")
    )
    total = totals.agg(F.sum("_n")).scalar()
    down = Window.partitionBy("_range").orderBy(F.desc("confidence")).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumns({"_n1": F.sum("n").over(down), "_ok1": F.sum("n_correct").over(down)})
    joined = summed.join(F.broadcast(offsets), F.col("_range") == F.col("_r"))  # at most `ranges` rows
    accepted = F.col("_n0") + F.col("_n1")
    wrong = accepted - F.col("_ok0") - F.col("_ok1")
    return joined.select("confidence", accepted.alias("n_accepted"), wrong.alias("n_wrong")).select(
        "*", exact_ratio("n_accepted", total).alias("coverage"), exact_ratio("n_wrong", "n_accepted").alias("risk")
    )


def thresholds(risk_curve: DataFrame, wanted: list[float]) -> DataFrame:
    """(wanted_error, threshold, n_accepted, coverage, risk) for each wanted error: the least threshold that keeps it.

    Nulls where no threshold does."""
    least = [
        F.min(F.when(F.col("risk") <= F.lit(float(w)), F.struct("confidence", "n_accepted", "coverage", "risk"))).alias(f"w{k}")
        for k, w in enumerate(wanted)
    ]
    found = risk_curve.agg(*least)
    each = F.array(*[F.struct(F.lit(float(w)).alias("wanted_error"), F.col(f"w{k}").alias("at")) for k, w in enumerate(wanted)])
    return found.select(F.explode(each).alias("e")).select(
        "e.wanted_error", F.col("e.at.confidence").alias("threshold"), "e.at.n_accepted", "e.at.coverage", "e.at.risk"
    )


POOLED = "_range int, lo double, hi double, n long, n_correct long"


def _pool():
    """Pool-adjacent-violators over one frame of blocks; nested, so that it travels to workers by value."""

    def pool(key, pdf):
        import pandas as pd

        out: list[list] = []
        rows = pdf.sort_values("lo")
        for lo, hi, n, ok in zip(rows["lo"].tolist(), rows["hi"].tolist(), rows["n"].tolist(), rows["n_correct"].tolist()):
            block = [lo, hi, n, ok]
            # whole numbers: no block's share may be above the next one's
            while out and out[-1][3] * block[2] >= block[3] * out[-1][2]:
                last = out.pop()
                block = [last[0], block[1], last[2] + block[2], last[3] + block[3]]
            out.append(block)
        frame = pd.DataFrame(out, columns=["lo", "hi", "n", "n_correct"])
        frame.insert(0, "_range", int(key[0]))
        return frame

    return pool


def blocks(per_value: DataFrame, ranges: int = RANGES) -> DataFrame:
    """(lo, hi, n, n_correct): blocks of confidences with one isotonic estimate each, whose shares rise strictly.

    Ranges are pooled by themselves, then two neighbours at a time: what is pooled once stays one block."""
    start = with_range(per_value, ranges).select("_range", F.col("confidence").alias("lo"), F.col("confidence").alias("hi"), "n", "n_correct")
    pooled = start.groupBy("_range").applyInPandas(_pool(), POOLED)
    span = ranges
    while span > 1:
        pooled = pooled.withColumn("_range", F.expr("_range div 2")).groupBy("_range").applyInPandas(_pool(), POOLED)
        span = -(-span // 2)
    return pooled.select("lo", "hi", "n", "n_correct")


def calibrate(per_value: DataFrame, ranges: int = RANGES) -> DataFrame:
    """(confidence, n, n_correct, calibrated) of each distinct confidence."""
    found = blocks(per_value, ranges).select("lo", "hi", exact_ratio("n_correct", "n").alias("calibrated"))
    # a block's values lie between its ends and every value in one block: blocks are told apart by their least value
    marked = per_value.join(found, F.col("confidence") == F.col("lo"), "left")
    ranged = with_range(marked, ranges)
    # shares rise, so the last block begun at or below a value has the greatest share so far
    run = Window.partitionBy("_range").orderBy("confidence").rowsBetween(Window.unboundedPreceding, 0)
    totals = ranged.groupBy("_range").agg(F.max("calibrated").alias("_m"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    offsets = totals.select(F.col("_range").alias("_r"), F.max("_m").over(before).alias("_before"))
    ranged = ranged.withColumn("_own", F.max("calibrated").over(run)).join(F.broadcast(offsets), F.col("_range") == F.col("_r"))
    return ranged.select("confidence", "n", "n_correct", F.greatest("_own", "_before").alias("calibrated"))
