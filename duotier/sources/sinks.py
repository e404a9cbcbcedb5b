"""Sinks and table DDL.

Tables live as parquet folders under the shared storage root (see
`session.storage_root`); a name containing `/` or `:` is taken as a full path.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import storage_root


def table_path(spark: SparkSession, name: str) -> str:
    if "/" in name or ":" in name:
        return name
    return f"{storage_root(spark)}/tables/{name}"


def save_table(df: DataFrame, name: str) -> None:
    """Full-replace write; a parquet overwrite also replaces the schema."""
    df.write.mode("overwrite").parquet(table_path(df.sparkSession, name))


def written_once(df: DataFrame, name: str) -> DataFrame:
    """`df` read back from a new folder of shared storage: branches that follow read files instead of computing it again."""
    path = f"{storage_root(df.sparkSession)}/scratch/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return read_table(df.sparkSession, path, df.schema)


def append_table(df: DataFrame, name: str) -> None:
    df.write.mode("append").parquet(table_path(df.sparkSession, name))


def append_batch(df: DataFrame, name: str) -> None:
    """Append into a folder of its own: two writers at once share no commit folder. Read with `read_batches`."""
    df.write.parquet(f"{table_path(df.sparkSession, name)}/batch={uuid.uuid4().hex}")


def read_batches(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """All batches of a table; no rows where nothing has been written yet."""
    ensure_folder(spark, table_path(spark, name))
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(table_path(spark, name))


def replace_parts(df: DataFrame, name: str, *by: str) -> None:
    """Replace only those partitions (values of `by`) that `df` has rows of; the others' files stay as they are."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    w.partitionBy(*by).parquet(table_path(df.sparkSession, name))


def read_table(spark: SparkSession, name: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(table_path(spark, name))


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def table_exists(spark: SparkSession, name: str) -> bool:
    fs, p = _file_system(spark, table_path(spark, name))
    return fs.exists(p)


def ensure_folder(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.mkdirs(p)


def claim(spark: SparkSession, name: str, start: int) -> int:
    """The first free number from `start` on in the series `name`, now taken: no other caller gets it.

    A number is an empty file that only one writer can create.  Hadoop's local file
    system looks before it creates, so there Java's own exclusive create is used."""
    folder = f"{storage_root(spark)}/claims/{name}"
    ensure_folder(spark, folder)
    number = start
    while not _create_once(spark, f"{folder}/{number}"):
        number += 1
    return number


def _create_once(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    if fs.getUri().getScheme() == "file":
        return spark.sparkContext._jvm.java.io.File(p.toUri().getPath()).createNewFile()
    try:
        fs.create(p, False).close()
        return True
    except Exception:
        if fs.exists(p):  # another writer's; anything else is a real failure
            return False
        raise


def ensure_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Create an empty table with `schema` if it does not exist."""
    if not table_exists(spark, name):
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(table_path(spark, name))


def save_catalog_table(df: DataFrame, name: str, recreate: bool = False) -> None:
    """Managed-catalog variant: overwrite, or drop then create (schema change)."""
    if recreate:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    df.write.mode("overwrite").saveAsTable(name)


def export_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append_jdbc(df: DataFrame, url: str, table: str, driver: str | None = None, **options) -> None:
    """Append rows to a table of an external database over JDBC."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table)
    if driver:
        w = w.option("driver", driver)
    for k, v in options.items():
        w = w.option(k, v)
    w.mode("append").save()


def table_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Row count of each named frame, as one union of global aggregates."""
    out = None
    for name, df in frames.items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out
