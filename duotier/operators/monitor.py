"""Monitoring signals, drift flags, the retrain decision and the inference profile
(A9-A12, A18, R1-R4, R8, R9, X16)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import COLS, Cols
from ..functions.text import exact_ratio, fixed_text, scaled_sum


def _not(col, value) -> F.Column:
    """Null-safe inequality (a missing value differs from every value)."""
    return ~F.col(col).eqNullSafe(value if isinstance(value, F.Column) else F.lit(value))


def signals(classified: DataFrame, scope: str = "ml", cols: Cols = COLS) -> DataFrame:
    """One row with all monitoring signals, from a single pass.

    * mean confidence of classifier-accepted rows (`scope='ml'`, 0 if none) or of all rows
    * percentage of rows not accepted by the classifier (NULL on an empty table)
    * percentage of answered rows whose final code differs from the model's (0 if none)
    """
    m = F.col(cols.method)
    is_ml = m == F.lit(C.METHOD_ML)
    is_llm = m == F.lit(C.METHOD_LLM)
    conf = F.col(cols.confidence)
    in_scope = is_ml if scope == "ml" else F.lit(True)
    r = classified.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(is_ml).alias("n_ml"),
        F.count_if(is_llm).alias("n_llm"),
        F.count_if(m == F.lit(C.METHOD_FALLBACK)).alias("n_fallback"),
        F.count_if(in_scope & conf.isNotNull()).alias("_n_scope"),
        scaled_sum(F.when(in_scope, conf)).alias("_s_scope"),
        F.count_if(_not(cols.method, C.METHOD_ML)).alias("n_not_ml"),
        F.count_if(is_llm & _not(cols.final, F.col(cols.predicted))).alias("n_overridden"),
    )
    scale = 10**C.CONFIDENCE_DECIMALS
    return r.select(
        "n_total",
        "n_ml",
        "n_llm",
        "n_fallback",
        F.coalesce(exact_ratio("_s_scope", F.col("_n_scope") * scale), F.lit(0.0)).alias("avg_confidence"),
        exact_ratio(F.col("n_not_ml") * 100, "n_total").alias("fallback_pct"),
        F.coalesce(exact_ratio(F.col("n_overridden") * 100, "n_llm"), F.lit(0.0)).alias("override_pct"),
        # exact parts, kept for fixed-digit text
        F.col("_s_scope").alias("conf_sum_e4"),
        F.col("_n_scope").alias("conf_n"),
        "n_not_ml",
    )


def weak_codes(classified: DataFrame, floor: float = C.WEAK_CODE_FLOOR, cols: Cols = COLS) -> DataFrame:
    """Final codes whose mean model confidence is below `floor`, weakest first."""
    g = classified.groupBy(cols.final).agg(
        F.count(F.col(cols.confidence)).alias("n"),
        scaled_sum(cols.confidence).alias("_s"),
    )
    mean = exact_ratio("_s", F.col("n") * 10**C.CONFIDENCE_DECIMALS)
    return (
        g.select(cols.final, "n", mean.alias("mean_confidence"))
        .where(F.col("mean_confidence") < F.lit(floor))
        .orderBy("mean_confidence", cols.final)
    )


def drift_flags(
    sig: DataFrame,
    conf_floor: float = C.AVG_CONFIDENCE_FLOOR,
    pct_ceiling: float = C.FALLBACK_PCT_CEILING,
    override_ceiling: float = C.OVERRIDE_PCT_CEILING,
) -> DataFrame:
    """Both drift flags are strict comparisons; the override alarm is reported only."""
    return sig.select(
        "avg_confidence",
        "fallback_pct",
        "override_pct",
        (F.col("avg_confidence") < F.lit(conf_floor)).alias("conf_drift"),
        F.coalesce(F.col("fallback_pct") > F.lit(pct_ceiling), F.lit(False)).alias("volume_drift"),
        F.coalesce(F.col("override_pct") > F.lit(override_ceiling), F.lit(False)).alias("override_alarm"),
    )


def decision(
    flags: DataFrame, corrections: DataFrame, need: int = C.MIN_CORRECTIONS, use_override: bool = False
) -> DataFrame:
    """Retrain when a drift flag is set and at least `need` corrections exist."""
    n_corr = corrections.agg(F.count(F.lit(1))).scalar()
    drift = F.col("conf_drift") | F.col("volume_drift")
    if use_override:
        drift = drift | F.col("override_alarm")
    return flags.select(
        "*",
        n_corr.alias("n_corrections"),
        (drift & (n_corr >= F.lit(need))).alias("retrain"),
        F.greatest(F.lit(need) - n_corr, F.lit(0)).cast("long").alias("shortfall"),
    )


def status_line(sig: DataFrame, dec: DataFrame, promotion: DataFrame | None = None) -> DataFrame:
    """Outcome text: `RETRAIN:NO|AVG_CONF:x.xxxx|LOW_PCT:x.x|CORRECTIONS:n`, or after a
    retrain `RETRAIN:YES|OLD_ACC:x.xxxx|NEW_ACC:x.xxxx|PROMOTED:YES|NO`.

    `sig`, `dec` and `promotion` are one-row frames; their values are read as
    scalar subqueries."""
    retrain = dec.select("retrain").scalar()
    n_corr = dec.select("n_corrections").scalar()
    avg_txt = F.when(
        F.col("conf_n") > 0, fixed_text("conf_sum_e4", F.col("conf_n") * 10**C.CONFIDENCE_DECIMALS, 4)
    ).otherwise(F.lit("0.0000"))
    pct_txt = F.when(F.col("n_total") > 0, fixed_text(F.col("n_not_ml") * 100, "n_total", 1)).otherwise(F.lit("nan"))
    monitor_txt = F.concat(
        F.lit("|AVG_CONF:"), avg_txt, F.lit("|LOW_PCT:"), pct_txt, F.lit("|CORRECTIONS:"), n_corr.cast("string")
    )
    if promotion is None:
        line = F.concat(F.when(retrain, F.lit("RETRAIN:YES")).otherwise(F.lit("RETRAIN:NO")), monitor_txt)
        return sig.select(retrain.alias("retrain"), line.alias("status"))
    old = promotion.select("old_accuracy").scalar()
    new = promotion.select("new_accuracy").scalar()
    promoted = promotion.select("promoted").scalar()
    yes = F.concat(
        F.lit("RETRAIN:YES|OLD_ACC:"), F.format_string("%.4f", old),
        F.lit("|NEW_ACC:"), F.format_string("%.4f", new),
        F.lit("|PROMOTED:"), F.when(promoted, F.lit("YES")).otherwise(F.lit("NO")),
    )
    line = F.when(retrain, yes).otherwise(F.concat(F.lit("RETRAIN:NO"), monitor_txt))
    return sig.select(retrain.alias("retrain"), line.alias("status"))


def inference_profile(
    df: DataFrame,
    ts: str = "scored_at",
    version: str = "model_version",
    prediction: str = COLS.final,
    measure: str = COLS.final_confidence,
    every: str = "1 day",
    measure_decimals: int | None = None,
) -> DataFrame:
    """Per time bucket and model version: rows, distinct predictions, share of
    missing predictions and the mean of `measure`.

    `measure_decimals` makes the mean an exact ratio of whole numbers, for a
    measure stored with that many decimals."""
    exact = measure_decimals is not None
    total = scaled_sum(measure, measure_decimals) if exact else F.sum(measure)
    g = df.groupBy(F.window(ts, every).alias("w"), F.col(version).alias("model_version")).agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct(prediction).alias("n_predictions"),
        F.count_if(F.col(prediction).isNull()).alias("_n_null"),
        F.count(measure).alias("_n_m"),
        total.alias("_s_m"),
    )
    return g.select(
        F.col("w.start").cast("date").alias("bucket"),
        "model_version",
        "n",
        "n_predictions",
        exact_ratio("_n_null", "n").alias("null_rate"),
        exact_ratio("_s_m", F.col("_n_m") * (10**measure_decimals if exact else 1)).alias("mean_measure"),
    )
