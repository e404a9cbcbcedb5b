"""Merge of both tiers into the audited output table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..config import COLS, Cols
from ..functions.text import exact_ratio


def classified_schema(cols: Cols = COLS) -> T.StructType:
    """The 13-column output contract (all nullable, confidences as DOUBLE)."""
    s, d = T.StringType(), T.DoubleType()
    return T.StructType(
        [
            T.StructField(cols.id, s),
            T.StructField(cols.vendor, s),
            T.StructField(cols.text, s),
            T.StructField(cols.price, d),
            T.StructField(cols.currency, s),
            T.StructField(cols.predicted, s),
            T.StructField(cols.confidence, d),
            T.StructField(cols.final, s),
            T.StructField(cols.method, s),
            T.StructField(cols.final_confidence, d),
            T.StructField("scored_at", T.TimestampType()),
            T.StructField("model_version", s),
            T.StructField(cols.reason, s),
        ]
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns, in order, cast to its types; absent columns are NULL."""
    have = set(df.columns)
    return df.select(
        [
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def merge(
    accepted: DataFrame,
    resolved: DataFrame,
    run_ts: str,
    model_version: str,
    cols: Cols = COLS,
) -> DataFrame:
    """Accepted ∪ resolved rows with one run timestamp and the model version."""
    schema = classified_schema(cols)
    stamp = {
        "scored_at": F.lit(run_ts).cast("timestamp"),
        "model_version": F.lit(str(model_version)),
    }
    a = conform(accepted.withColumns(stamp), schema)
    r = conform(resolved.withColumns(stamp), schema)
    out = a.unionByName(r)
    return out.withColumn(cols.reason, F.nullif(F.col(cols.reason), F.lit("None")))


def method_counts(classified: DataFrame, cols: Cols = COLS) -> DataFrame:
    """Rows per classification method (all three methods always listed)."""
    methods = classified.sparkSession.createDataFrame(
        [(C.METHOD_ML,), (C.METHOD_LLM,), (C.METHOD_FALLBACK,)], f"{cols.method} string"
    )
    counts = classified.groupBy(cols.method).agg(F.count(F.lit(1)).alias("n"))
    return (
        F.broadcast(methods)
        .join(counts, cols.method, "full")
        .select(cols.method, F.coalesce(F.col("n"), F.lit(0)).alias("n"))
    )


def cost_report(
    classified: DataFrame,
    ml_cost: float = C.COST_ML_PER_ITEM,
    llm_cost: float = C.COST_LLM_PER_ITEM,
    cols: Cols = COLS,
) -> DataFrame:
    """Cost of the run per tier against sending every item to the language model.

    Every item is scored by the classifier; routed items (any method other
    than the classifier) also cost one answer."""
    method = F.col(cols.method)
    r = classified.agg(
        F.count(F.lit(1)).alias("n_items"),
        F.count_if(method != F.lit(C.METHOD_ML)).alias("n_routed"),
    )
    return r.select(
        "n_items",
        "n_routed",
        F.round(F.col("n_items") * F.lit(ml_cost), 6).alias("cost_ml"),
        F.round(F.col("n_routed") * F.lit(llm_cost), 6).alias("cost_llm"),
        F.round(F.col("n_items") * F.lit(ml_cost) + F.col("n_routed") * F.lit(llm_cost), 6).alias("cost_total"),
        F.round(F.col("n_items") * F.lit(llm_cost), 6).alias("cost_all_llm"),
        exact_ratio((F.col("n_items") - F.col("n_routed")) * 100, "n_items").alias("pct_llm_calls_saved"),
    )
