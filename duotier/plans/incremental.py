"""Incremental scoring: only new or changed items are scored, only their buckets are written.

The scored table is its own manifest: every row carries the digest of the content
it was scored from and the model version.  It is partitioned by a bucket of the
id's hash.  A result and its digest are in one file, so a run that dies while
buckets are being replaced leaves items that the next run scores again, never
stale ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import COLS, Cols
from ..sources import sinks

DIGEST, BUCKET, SCORED_BY = "content_digest", "bucket", "scored_by"


def content(cols: Cols = COLS) -> list[str]:
    """The columns a score depends on."""
    return [cols.text, cols.vendor, cols.price, cols.currency]


def content_digest(columns: list[str]) -> Column:
    """SHA-256 of the columns as JSON; a null differs from an empty text."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def to_rescore(items: DataFrame, manifest: DataFrame, version: str, columns: list[str], id_col: str = COLS.id) -> DataFrame:
    """(id, why) of items to score: `new`, `changed` content, or another model `version` since. Ids are unique."""
    now = items.select(id_col, content_digest(columns).alias("_now"))
    had = manifest.select(id_col, F.col(DIGEST).alias("_had"), F.col(SCORED_BY).alias("_by"))
    why = (
        F.when(F.col("_had").isNull(), F.lit("new"))
        .when(F.col("_had") != F.col("_now"), F.lit("changed"))
        .when(F.col("_by") != F.lit(version), F.lit("version"))
    )
    return now.join(had, id_col, "left").select(id_col, why.alias("why")).where("why IS NOT NULL")


def score_changes(
    items: DataFrame,
    scorer: Callable[[DataFrame], DataFrame],
    table: str,
    version: str,
    cols: Cols = COLS,
    buckets: int = 256,
    files: int = 1,
) -> DataFrame:
    """Bring `table` up to date with `items` and return it; `scorer` sees only what changed.

    `scorer` maps item rows to scored rows, one per id, without the three columns of the manifest.
    Rows of items that are no longer given stay.  `buckets` is fixed with the
    table's first run (choose about a GB each); `files` spreads a bucket over so many."""
    spark = items.sparkSession
    settings = f"{sinks.table_path(spark, table)}__buckets"
    if not sinks.table_exists(spark, settings):
        sinks.save_table(spark.createDataFrame([(buckets,)], "buckets int"), settings)
    buckets = sinks.read_table(spark, settings).first()["buckets"]
    exists = sinks.table_exists(spark, table)
    old = sinks.read_table(spark, table) if exists else None
    columns = content(cols)
    if exists:
        due = items.join(to_rescore(items, old, version, columns, cols.id).select(cols.id), cols.id, "left_semi")
    else:
        due = items
    todo_table = f"{sinks.table_path(spark, table)}__todo"
    sinks.save_table(due, todo_table)  # the change set, once: a lost executor reads it again
    due = sinks.read_table(spark, todo_table)
    empty = due.isEmpty()
    if empty and exists:
        return old
    stamp = due.select(
        cols.id,
        content_digest(columns).alias(DIGEST),
        F.lit(version).alias(SCORED_BY),
        F.pmod(F.xxhash64(cols.id), F.lit(buckets)).cast("int").alias(BUCKET),
    )
    out = scorer(due).join(stamp, cols.id)
    if empty:  # nothing to score in a first run: no table yet
        return out
    if exists:
        touched = F.broadcast(stamp.select(BUCKET).distinct())  # at most `buckets` numbers
        kept = old.join(touched, BUCKET, "left_semi").join(due.select(cols.id), cols.id, "left_anti")
        out = out.unionByName(kept)
    spread = F.pmod(F.xxhash64(cols.id, F.lit(1)), F.lit(files))
    sinks.replace_parts(out.repartition(BUCKET, spread), table, BUCKET)
    return sinks.read_table(spark, table, out.schema)
