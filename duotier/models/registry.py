"""Model registry as tables: versions, an append-only alias log and a run log
(M5-M8, M12, A16, A17).

Aliases are never overwritten in place: setting an alias appends an event, and
the current alias is the latest event per alias.  So no job overwrites a table
it is reading.  Version and event numbers are claimed before use
(`sinks.claim`) and every row is written to a folder of its own, so writers in
other sessions share neither a number nor a commit folder.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..sources import sinks

VERSIONS = "model_versions"
ALIASES = "model_alias_log"
RUNS = "model_runs"

VERSION_SCHEMA = T.StructType(
    [
        T.StructField("version", T.IntegerType()),
        T.StructField("algorithm", T.StringType()),
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("path", T.StringType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("description", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)
ALIAS_SCHEMA = T.StructType(
    [
        T.StructField("alias", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("seq", T.LongType()),
    ]
)
RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("algorithm", T.StringType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("logged_at", T.TimestampType()),
    ]
)


# --- pure DataFrame operators ----------------------------------------------------

def select_best(runs: DataFrame) -> DataFrame:
    """Candidate with the highest accuracy; the first listed wins ties."""
    key = F.struct(F.col("accuracy"), (-F.col("ordinal")).alias("o"))
    return runs.agg(
        F.max_by("algorithm", key).alias("best_algorithm"),
        F.max_by("version", key).alias("best_version"),
        F.max("accuracy").alias("best_accuracy"),
    )


def latest(versions: DataFrame) -> DataFrame:
    """Numeric maximum of the version column, whose values may be text ("10" is after "9")."""
    return versions.agg(F.max(F.expr("try_cast(version AS INT)")).alias("latest_version"))


def current_aliases(alias_log: DataFrame) -> DataFrame:
    """alias → version of its latest event."""
    return alias_log.groupBy("alias").agg(F.max_by("version", "seq").alias("version"))


def set_alias(alias_log: DataFrame, alias: str, version) -> DataFrame:
    """The event to append that points `alias` at `version` (a value or a one-row frame column)."""
    seq = alias_log.agg(F.coalesce(F.max("seq"), F.lit(0)) + 1).scalar()
    v = version if isinstance(version, F.Column) else F.lit(int(version))
    return alias_log.sparkSession.range(1).select(
        F.lit(alias).alias("alias"), v.cast("int").alias("version"), seq.cast("long").alias("seq")
    )


def upsert_alias(aliases: DataFrame, alias: str, version) -> DataFrame:
    """Current aliases with `alias` replaced (anti-join + union)."""
    v = version if isinstance(version, F.Column) else F.lit(int(version))
    new = aliases.sparkSession.range(1).select(F.lit(alias).alias("alias"), v.cast("int").alias("version"))
    return aliases.where(F.col("alias") != F.lit(alias)).select("alias", "version").unionByName(new)


def resolve(aliases: DataFrame, versions: DataFrame, alias: str) -> DataFrame:
    """The version row an alias points to."""
    return aliases.where(F.col("alias") == F.lit(alias)).select("alias", "version").join(versions, "version")


# --- table-backed registry ----------------------------------------------------------

def _read(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    return sinks.read_batches(spark, name, schema)


def versions_table(spark: SparkSession) -> DataFrame:
    return _read(spark, VERSIONS, VERSION_SCHEMA)


def alias_log_table(spark: SparkSession) -> DataFrame:
    return _read(spark, ALIASES, ALIAS_SCHEMA)


def runs_table(spark: SparkSession) -> DataFrame:
    return _read(spark, RUNS, RUN_SCHEMA)


def log_run(spark: SparkSession, algorithm: str, params: dict, metrics: dict) -> str:
    run_id = f"{algorithm}-{uuid.uuid4().hex}"
    row = [(run_id, algorithm, {k: json.dumps(v) if not isinstance(v, str) else v for k, v in params.items()},
            {k: float(v) for k, v in metrics.items()}, None)]
    df = spark.createDataFrame(row, RUN_SCHEMA).withColumn("logged_at", F.current_timestamp())
    sinks.append_batch(df, RUNS)
    return run_id


def register(spark: SparkSession, model, algorithm: str, accuracy: float, threshold: float = C.CONFIDENCE_THRESHOLD,
             description: str = "", run_id: str | None = None) -> int:
    """Save the fitted pipeline under the next free version and add its version row, linked to its run.

    The number is claimed first; a writer that dies after that leaves it unused."""
    v = sinks.claim(spark, "versions", _next(versions_table(spark), "version"))
    path = f"{sinks.table_path(spark, 'models')}/v{v}"
    model.save(path)
    row = [(v, algorithm, float(accuracy), path, float(threshold), description, run_id, None)]
    sinks.append_batch(spark.createDataFrame(row, VERSION_SCHEMA).withColumn("created_at", F.current_timestamp()), VERSIONS)
    return v


def _next(table: DataFrame, number: str) -> int:
    return int(table.agg(F.coalesce(F.max(number), F.lit(0)) + 1).first()[0])


def run_of(spark: SparkSession, alias: str) -> DataFrame:
    """The logged run behind an alias: alias → version → run, with its parameters and metrics."""
    row = resolve(current_aliases(alias_log_table(spark)), versions_table(spark), alias)
    return row.select("alias", "version", "run_id").join(runs_table(spark), "run_id")


def stored_threshold(spark: SparkSession, alias: str = C.CHAMPION) -> float | None:
    """The gate threshold registered with the version an alias points to."""
    row = resolve(current_aliases(alias_log_table(spark)), versions_table(spark), alias).first()
    return None if row is None else row["threshold"]


def point_alias(spark: SparkSession, alias: str, version: int) -> None:
    """Point `alias` at `version`; of two writers at once, the one with the later number wins."""
    seq = sinks.claim(spark, "alias_events", _next(alias_log_table(spark), "seq"))
    sinks.append_batch(spark.createDataFrame([(alias, int(version), seq)], ALIAS_SCHEMA), ALIASES)


def load(spark: SparkSession, alias: str):
    """(PipelineModel, version row) of the version an alias points to."""
    from pyspark.ml import PipelineModel

    row = resolve(current_aliases(alias_log_table(spark)), versions_table(spark), alias).first()
    if row is None:
        raise LookupError(f"no model version has alias {alias}")
    return PipelineModel.load(row["path"]), row
