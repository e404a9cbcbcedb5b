"""Confidence gate and confidence reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import COLS, Cols
from ..functions.text import exact_ratio, scaled_sum


def round_confidence(df: DataFrame, raw: str, cols: Cols = COLS) -> DataFrame:
    """Confidence rounded half-even to 4 places; the gate compares this value."""
    return df.withColumn(cols.confidence, F.bround(F.col(raw), C.CONFIDENCE_DECIMALS))


def accept(df: DataFrame, t: float = C.CONFIDENCE_THRESHOLD, cols: Cols = COLS) -> DataFrame:
    """Rows at or above the threshold, accepted with the model's code."""
    return df.where(F.col(cols.confidence) >= F.lit(t)).withColumns(
        {
            cols.final: F.col(cols.predicted),
            cols.method: F.lit(C.METHOD_ML),
            cols.final_confidence: F.col(cols.confidence).cast("double"),
        }
    )


def route(df: DataFrame, t: float = C.CONFIDENCE_THRESHOLD, cols: Cols = COLS) -> DataFrame:
    """Rows below the threshold, sent to the answerer."""
    return df.where(F.col(cols.confidence) < F.lit(t))


def gate_report(df: DataFrame, t: float = C.CONFIDENCE_THRESHOLD, cols: Cols = COLS) -> DataFrame:
    """One row: rows on each side of the gate and their percentages."""
    conf = F.col(cols.confidence)
    r = df.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(conf >= F.lit(t)).alias("n_accepted"),
        F.count_if(conf < F.lit(t)).alias("n_routed"),
    )
    return r.select(
        "n_total",
        "n_accepted",
        "n_routed",
        exact_ratio(F.col("n_accepted") * 100, "n_total").alias("pct_accepted"),
        exact_ratio(F.col("n_routed") * 100, "n_total").alias("pct_routed"),
    )


def _band_table(spark) -> DataFrame:
    rows = [(o, label, action) for o, label, _lo, _hi, action in C.CONFIDENCE_BANDS]
    return spark.createDataFrame(rows, "band_order int, band string, action string")


def _band_of(conf) -> F.Column:
    expr = None
    for o, _label, lo, hi, _a in C.CONFIDENCE_BANDS:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (conf >= F.lit(lo))
        if hi is not None:
            cond = cond & (conf < F.lit(hi))
        expr = F.when(cond, F.lit(o)) if expr is None else expr.when(cond, F.lit(o))
    return expr


def bands(df: DataFrame, conf_col: str | None = None, cols: Cols = COLS) -> DataFrame:
    """Histogram over the five confidence bands; empty bands show 0."""
    from pyspark.sql import Window

    conf = F.col(conf_col or cols.confidence)
    # one pass over the data; everything after the aggregate has at most five rows
    counts = df.groupBy(_band_of(conf).alias("band_order")).agg(F.count(F.lit(1)).alias("n"))
    table = _band_table(df.sparkSession)
    n = F.coalesce(F.col("n"), F.lit(0))
    return (
        F.broadcast(table)
        .join(counts, "band_order", "left")
        .select(
            "band_order",
            "band",
            n.alias("n"),
            exact_ratio(n * 100, F.sum(n).over(Window.partitionBy())).alias("pct"),
            "action",
        )
    )


def confidence_summary(
    df: DataFrame,
    t: float = C.CONFIDENCE_THRESHOLD,
    conf_col: str | None = None,
    decimals: int | None = None,
    cols: Cols = COLS,
) -> DataFrame:
    """Mean confidence and the percentage below the threshold.

    Raw model probabilities are averaged as they are; for stored confidences
    with a fixed number of `decimals` the mean is an exact integer ratio."""
    conf = F.col(conf_col or cols.confidence)
    total = scaled_sum(conf, decimals) if decimals is not None else F.sum(conf)
    r = df.agg(
        F.count(F.lit(1)).alias("n"),
        total.alias("_s"),
        F.count_if(conf < F.lit(t)).alias("n_below"),
    )
    scale = 10**decimals if decimals is not None else 1
    return r.select(
        "n",
        exact_ratio("_s", F.col("n") * scale).alias("mean_confidence"),
        "n_below",
        exact_ratio(F.col("n_below") * 100, "n").alias("pct_below"),
    )


def top_class(df: DataFrame, prob_col: str, out_index: str = "best_index", out_prob: str = "best_prob") -> DataFrame:
    """Row-wise argmax of a probability array (first index wins ties, 0-based)."""
    p = F.col(prob_col)
    best = F.array_max(p)
    return df.withColumns(
        {out_prob: best.cast("double"), out_index: (F.array_position(p, best) - 1).cast("int")}
    )
