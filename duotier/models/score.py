"""Batch scoring with a fitted model.

`score` keeps everything in the JVM (`PipelineModel.transform`).
`score_udf` runs a foreign Python model over Arrow batches with
`mapInPandas`; the model travels once per executor as a broadcast variable.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import COLS, Cols
from .features_ml import label_names, without_label


def score(
    df: DataFrame,
    features_model: PipelineModel,
    model,
    run_ts: str,
    version: str,
    cols: Cols = COLS,
) -> DataFrame:
    """Predicted code and confidence (largest probability, rounded half-even to 4 places)."""
    names = label_names(features_model)
    feats = without_label(features_model).transform(df)
    pred = model.transform(feats)
    if "probability" in pred.columns:
        best = F.array_max(vector_to_array("probability"))
    else:  # one-vs-rest: softmax over the raw margins
        raw = vector_to_array("rawPrediction")
        mx = F.array_max(raw)
        ex = F.transform(raw, lambda x: F.exp(x - mx))
        best = F.array_max(F.transform(ex, lambda x: x / F.aggregate(ex, F.lit(0.0), lambda a, y: a + y)))
    decode = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("prediction").cast("int") + 1)
    keep = [c for c in df.columns]
    return pred.select(
        *keep,
        decode.alias(cols.predicted),
        F.bround(best, C.CONFIDENCE_DECIMALS).alias(cols.confidence),
        F.lit(run_ts).cast("timestamp").alias("scored_at"),
        F.lit(str(version)).alias("model_version"),
    )


def score_udf(
    df: DataFrame,
    predict_fn: Callable,
    model_obj,
    feature_cols: list[str],
    out_schema: str,
    keep: list[str],
) -> DataFrame:
    """Score a Python model over Arrow batches.

    `predict_fn(model_obj, pandas_frame_of_feature_cols) -> pandas DataFrame`
    with the columns of `out_schema`.  `model_obj` is pickled once into a
    broadcast variable and unpickled once per task."""
    spark = df.sparkSession
    blob = spark.sparkContext.broadcast(pickle.dumps(model_obj))
    cache: dict = {}

    def run(batches):
        if "m" not in cache:
            cache["m"] = pickle.loads(blob.value)
        m = cache["m"]
        for pdf in batches:
            out = predict_fn(m, pdf[feature_cols])
            yield pd.concat([pdf[keep].reset_index(drop=True), out.reset_index(drop=True)], axis=1)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields)
    return df.select(*keep, *feature_cols).mapInPandas(run, f"{schema}, {out_schema}")
