"""Best target per row by shared distinct tokens, counted within the row.

Rows are dealt out by id once; the join with the targets' tokens and both
aggregations then stay in place.  A token that every target has adds one to
each score alike, so it is counted on the row and never joined: a word of all
codes does not make rows x codes pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def best_overlap(rows: DataFrame, row_id: str, row_tokens: Column, targets: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(row_id, keep.., name, score) per row; `targets` is (name, ord, tokens).

    Most shared tokens win, then the smaller ord; no shared token gives NULLs."""
    keep = keep or []
    own = rows.select(row_id, *keep, row_tokens.alias("_tok")).repartition(row_id)
    each = targets.select("name", "ord", F.explode(F.array_distinct("tokens")).alias("token"))
    n_targets = targets.agg(F.count(F.lit(1))).scalar()
    common = each.groupBy("token").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == n_targets).select("token")
    # one short array: tokens of every target, hence at most those of the shortest one
    all_have = common.agg(F.collect_list("token")).scalar()
    first = targets.agg(F.min(F.struct("ord", "name"))).scalar()
    rare = each.join(common, "token", "left_anti")
    own = own.select(row_id, *keep, "_tok", F.size(F.array_intersect("_tok", all_have)).alias("_all"))
    hits = own.select(row_id, *keep, "_all", F.explode_outer("_tok").alias("token")).join(rare, "token", "left")
    scores = hits.groupBy(row_id, *keep, "_all", "name", "ord").agg(F.count("name").alias("_score"))
    best = scores.groupBy(row_id, *keep, "_all").agg(
        F.min(F.when(F.col("name").isNotNull(), F.struct((-F.col("_score")).alias("neg"), "ord", "name"))).alias("_b")
    )
    name = F.when(F.col("_b").isNotNull(), F.col("_b.name")).when(F.col("_all") > 0, first["name"])
    score = F.coalesce(-F.col("_b.neg"), F.lit(0)) + F.col("_all")
    return best.select(row_id, *keep, name.alias("name"), F.when(name.isNotNull(), score).alias("score"))
