"""The streaming inference profile ends equal to the batch profile."""

import os
import tempfile

from conftest import SF
from pyspark.sql import functions as F

from duotier.operators import monitor
from duotier.streaming.profile import read_profile, start_profile


def test_streaming_profile_equals_batch(spark):
    d = tempfile.mkdtemp(prefix="duotier-stream-", dir="/tmp")
    src = f"{SF['tiny']}/events.parquet"
    schema = spark.read.parquet(src).schema
    # the file source reads a folder; take only the events file from it
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(SF["tiny"]).select(
        F.col("ts").alias("scored_at"),
        (F.col("user_id") % 3).cast("string").alias("model_version"),
        F.col("event_type").alias("prediction"),
        "value",
    )
    q = start_profile(stream, os.path.join(d, "log"), os.path.join(d, "ck"), "scored_at", "model_version",
                      "prediction", "value", measure_decimals=2)
    q.awaitTermination(120)
    got = read_profile(spark, os.path.join(d, "log"), measure_decimals=2)
    batch = monitor.inference_profile(
        spark.read.parquet(src).select(
            F.col("ts").alias("scored_at"), (F.col("user_id") % 3).cast("string").alias("model_version"),
            F.col("event_type").alias("prediction"), "value"),
        prediction="prediction", measure="value", measure_decimals=2,
    )
    key = lambda r: (r["bucket"], r["model_version"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, batch.select(*got.columns).collect()), key=str)
    assert got.count() == batch.count() and key
