"""Resumable answers: a ledger of committed batches keyed by (prompt digest, run).

Every task of `ask` writes its batch of answers when it ends, and what it has
written stays when the job fails later.  A rerun of the same run asks only the
prompts that have no answer yet.  Equal prompts of a run are asked once.
An entry with an error is kept, but its prompt counts as unanswered.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import COLS
from ..sources import sinks
from . import answers

DIGEST = "prompt_digest"
ENTRY = T.StructType([T.StructField(c, T.StringType()) for c in (DIGEST, "response", "error_message")])
#: prompts a task asks before it commits: what a lost task costs
BATCH = 256
#: beyond this many tasks their batches grow instead
MAX_TASKS = 20_000
#: a prompt of more than one in so many items is hot; so there are fewer hot prompts than this
HOT_SHARE = 1000


def with_digest(prompts: DataFrame) -> DataFrame:
    return prompts.withColumn(DIGEST, F.sha2("prompt", 256))


def settled(entries: DataFrame) -> DataFrame:
    """One entry per digest: an answer before an error, then the smaller text."""
    entry = F.struct(F.col("response").isNull().alias("failed"), "response", "error_message")
    best = entries.groupBy(DIGEST).agg(F.min(entry).alias("e"))
    return best.select(DIGEST, "e.response", "e.error_message")


def pending(prompts: DataFrame, entries: DataFrame) -> DataFrame:
    """Distinct prompts without an answer, with the number of items that wait for each.

    Equal prompts are counted on the map side, so a hot one is a row per task."""
    distinct = prompts.groupBy(DIGEST).agg(F.first("prompt").alias("prompt"), F.count(F.lit(1)).alias("n_items"))
    return distinct.join(entries.where(F.col("response").isNotNull()).select(DIGEST), DIGEST, "left_anti")


def to_items(prompts: DataFrame, entries: DataFrame, id_col: str = COLS.id) -> DataFrame:
    """Each item with its prompt's entry (null response: none, or only an error).

    Entries of hot prompts, fewer than `HOT_SHARE`, are broadcast; the items they
    serve then meet no other entry and spread by their own id."""
    rows = prompts.select(id_col, DIGEST)
    sizes = rows.groupBy(DIGEST).agg(F.count(F.lit(1)).alias("n"))
    total = rows.agg(F.count(F.lit(1))).scalar()
    hot = sizes.where(F.col("n") * HOT_SHARE > total).select(DIGEST)
    one = settled(entries)
    entry = F.struct("response", "error_message")
    hot_entries = hot.join(one.join(F.broadcast(hot), DIGEST, "left_semi"), DIGEST, "left")
    marked = rows.join(F.broadcast(hot_entries.select(DIGEST, entry.alias("_hot"))), DIGEST, "left")
    key = F.when(F.col("_hot").isNull(), F.col(DIGEST)).otherwise(F.concat(F.lit("of "), F.col(id_col).cast("string")))
    cold = one.select(F.col(DIGEST).alias("_key"), entry.alias("_cold"))
    both = F.coalesce("_hot", "_cold")
    return marked.withColumn("_key", key).join(cold, "_key", "left").select(
        id_col, DIGEST, both["response"].alias("response"), both["error_message"].alias("error_message")
    )


def _folder(spark: SparkSession, table: str, run_id: str) -> str:
    """The run's folder; a time of day as run id has colons, which paths may not hold."""
    return f"{sinks.table_path(spark, table)}/run_id={quote(run_id, safe='')}"


def entries(spark: SparkSession, table: str, run_id: str) -> DataFrame:
    """What the ledger holds of a run."""
    return sinks.read_batches(spark, _folder(spark, table, run_id), ENTRY)


def ask(
    prompts: DataFrame,
    answerer: Callable[[pd.Series], pd.Series],
    table: str,
    run_id: str,
    error_mode: bool = True,
    id_col: str = COLS.id,
    batch: int = BATCH,
) -> DataFrame:
    """Ask what the run's ledger does not answer yet, then give each item its answer.

    The unanswered prompts are written first, so that neither a retried task nor
    the count of them builds prompts again.  The second commit algorithm of
    Hadoop moves a task's file in place when the task ends; where a store has a
    committer of its own, what a failed job answered may be asked again."""
    spark = prompts.sparkSession
    prompts = with_digest(prompts)
    todo_table = _folder(spark, f"{sinks.table_path(spark, table)}__todo", run_id)
    sinks.save_table(pending(prompts, entries(spark, table, run_id)).select(DIGEST, "prompt"), todo_table)
    todo = sinks.read_table(spark, todo_table)
    n = todo.count()
    if n:
        todo = todo.repartition(min(-(-n // batch), MAX_TASKS), DIGEST)
        got = answers.answer(todo, answerer, error_mode, DIGEST)
        w = got.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        w.parquet(_folder(spark, table, run_id))
    return to_items(prompts, entries(spark, table, run_id), id_col)
