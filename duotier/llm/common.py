"""Shared pieces: scratch tables in the cluster's shared folder, document columns, Arrow batches as bytes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Rows per Arrow batch: keeps a batch of very long texts well inside a worker's memory.
BATCH_ROWS = 1000
BATCH_BYTES = "16m"


def scratch(spark: SparkSession) -> str:
    """A new folder below the shared folder named by spark.checkpoint.dir.

    Only where no folder is named (tests on one machine) a temporary one is set."""
    root = checkpoint_dir(spark)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm/{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to shared storage and read it back: later plans start from files that outlive executors."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def as_bytes(df: DataFrame, *cols: str, text: str = "text") -> DataFrame:
    """`cols` and the text as UTF-8 bytes (null: empty), and nothing else: other columns cannot clash."""
    small_batches(df.sparkSession)
    return df.select(*cols, F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))


def rows_to_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Tuples into Arrow batches of at most `size` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema
    )
