"""Inference profile as a Structured Streaming job (R9, continuous form).

New rows of the output table (or any stream with a time, a model version, a
prediction and a measure) are counted per (time bucket, model version,
prediction).  Each
micro-batch appends its updated counts, tagged with the batch id, to a
parquet log in the shared storage; `read_profile` keeps the latest row per key
and rolls the counts up per (bucket, version).  The log is append-only, so a
retried batch only repeats rows with the same batch id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import exact_ratio


def profile_counts(
    stream: DataFrame,
    ts: str,
    version: str,
    prediction: str,
    measure: str,
    every: str = "1 day",
    watermark: str | None = None,
    measure_decimals: int = 4,
) -> DataFrame:
    """Streaming aggregate per (bucket, version, prediction).

    Without a watermark late rows count, as they do in the batch form, and the
    state holds a row per key; with one, later rows are left out and closed
    buckets leave the state."""
    scale = float(10**measure_decimals)
    # the watermark needs a TIMESTAMP; a TIMESTAMP_NTZ column is read as session (UTC) time
    rows = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    rows = rows.withWatermark(ts, watermark) if watermark else rows
    return (
        rows.groupBy(F.window(ts, every).alias("w"), F.col(version).alias("model_version"), F.col(prediction).alias("prediction"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count(measure).alias("n_measure"),
            F.sum(F.round(F.col(measure) * scale).cast("long")).alias("measure_scaled"),
        )
        .select(F.col("w.start").alias("bucket_start"), "model_version", "prediction", "n", "n_measure", "measure_scaled")
    )


def start_profile(
    stream: DataFrame,
    log_path: str,
    checkpoint: str,
    ts: str,
    version: str,
    prediction: str,
    measure: str,
    every: str = "1 day",
    watermark: str | None = None,
    measure_decimals: int = 4,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the streaming profile; `checkpoint` must be in shared storage."""
    counts = profile_counts(stream, ts, version, prediction, measure, every, watermark, measure_decimals)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("append").parquet(log_path)

    w = counts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_profile(spark: SparkSession, log_path: str, measure_decimals: int = 4) -> DataFrame:
    """Profile per (bucket, version) from the latest counts of each key."""
    log = spark.read.parquet(log_path)
    key = ["bucket_start", "model_version", "prediction"]
    latest = log.groupBy(*key).agg(
        F.max_by(F.struct("n", "n_measure", "measure_scaled"), "batch_id").alias("c")
    ).select(*key, "c.*")
    g = latest.groupBy("bucket_start", "model_version").agg(
        F.sum("n").alias("n"),
        F.count("prediction").alias("n_predictions"),
        F.sum(F.when(F.col("prediction").isNull(), F.col("n")).otherwise(0)).alias("_n_null"),
        F.sum("n_measure").alias("_n_m"),
        F.sum("measure_scaled").alias("_s_m"),
    )
    return g.select(
        F.col("bucket_start").cast("date").alias("bucket"),
        "model_version",
        "n",
        "n_predictions",
        exact_ratio("_n_null", "n").alias("null_rate"),
        exact_ratio("_s_m", F.col("_n_m") * 10**measure_decimals).alias("mean_measure"),
    )


