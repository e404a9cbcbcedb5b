"""End-to-end evaluation against known codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import COLS, Cols
from ..functions.text import exact_ratio


def correct_flag(final: str, truth: str) -> F.Column:
    """final = truth; a missing truth counts as wrong."""
    return F.coalesce(F.col(final) == F.col(truth), F.lit(False))


def evaluate(classified: DataFrame, truth: DataFrame, cols: Cols = COLS) -> DataFrame:
    """Accuracy overall, of the classifier tier and of the answered tier; rows the
    answerer reclassified.  `truth` has (id, truth code)."""
    j = classified.join(truth.select(cols.id, cols.truth), cols.id, "left")
    ok = correct_flag(cols.final, cols.truth)
    m = F.col(cols.method)
    r = j.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(ok).alias("n_correct"),
        F.count_if(m == C.METHOD_ML).alias("n_ml"),
        F.count_if((m == C.METHOD_ML) & ok).alias("n_ml_correct"),
        F.count_if(m == C.METHOD_LLM).alias("n_llm"),
        F.count_if((m == C.METHOD_LLM) & ok).alias("n_llm_correct"),
        F.count_if((m == C.METHOD_LLM) & (F.col(cols.final) != F.col(cols.predicted))).alias("n_reclassified"),
    )
    return r.select(
        "n",
        exact_ratio("n_correct", "n").alias("accuracy"),
        "n_ml",
        exact_ratio("n_ml_correct", "n_ml").alias("ml_accuracy"),
        "n_llm",
        exact_ratio("n_llm_correct", "n_llm").alias("llm_accuracy"),
        "n_reclassified",
    )


def accuracy(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Holdout accuracy: share of rows whose prediction equals the label."""
    return predictions.agg(
        F.count(F.lit(1)).alias("n"),
        exact_ratio(F.count_if(F.col(label) == F.col(prediction)), F.count(F.lit(1))).alias("accuracy"),
    )
