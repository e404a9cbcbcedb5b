"""Session set-up, namespace bootstrap and shared storage."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

ROOT_CONF = "duotier.root"
SCHEMA_CONF = "duotier.schema"
DEFAULT_SCHEMA = "duotier"


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "duotier", event_log_dir: str | None = None
) -> SparkSession:
    """Session for tests and local benchmarks (UTC, AQE on, no UI).

    `event_log_dir` writes Spark's event log there (stage and task times)."""
    b = SparkSession.builder
    if event_log_dir:
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    return (
        b.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("DUOTIER_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )


def configure(spark: SparkSession) -> SparkSession:
    """Settings the engine relies on: UTC time and adaptive execution."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    try:
        return spark.conf.get("spark.checkpoint.dir")
    except Exception:
        return None


def storage_root(spark: SparkSession) -> str:
    """Shared folder for tables, models and stored answers.

    `duotier.root` wins; otherwise a sub-folder of the cluster's checkpoint
    folder.  Never a machine-local temporary folder.
    """
    try:
        root = spark.conf.get(ROOT_CONF)
    except Exception:
        root = None
    if not root:
        ck = checkpoint_dir(spark)
        if not ck:
            raise RuntimeError(
                f"set {ROOT_CONF} or spark.checkpoint.dir to a shared folder before writing tables"
            )
        root = ck.rstrip("/") + "/duotier"
    return root.rstrip("/")


def has_storage(spark: SparkSession) -> bool:
    """Whether the cluster names a shared folder."""
    try:
        return bool(storage_root(spark))
    except RuntimeError:
        return False


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Use the session's checkpoint folder; set `fallback` only where none is set (tests)."""
    d = checkpoint_dir(spark)
    if not d:
        spark.sparkContext.setCheckpointDir(fallback)
        d = spark.sparkContext.getCheckpointDir()
    return d


def cores(spark: SparkSession) -> int:
    """Tasks that run at once, as far as the session knows."""
    return max(spark.sparkContext.defaultParallelism, 1)


def bootstrap(spark: SparkSession, schema: str | None = None) -> str:
    """Create the working namespace if absent and make it current."""
    if schema is None:
        try:
            schema = spark.conf.get(SCHEMA_CONF)
        except Exception:
            schema = None
    schema = schema or DEFAULT_SCHEMA
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    spark.sql(f"USE `{schema}`")
    return schema
