"""Registry queries over rule models that need no training, so that model
comparison, selection, aliasing and promotion are checked against SQL.

Candidates, in order (version = position):
1. `stored_guess`    – the classifier guess stored with each new item
2. `lexical`         – the bundled lexical answerer applied to every new item
3. `vendor_majority` – the most common training code of the item's vendor
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..config import COLS
from ..functions.text import exact_ratio
from ..models import registry
from ..operators import answers
from ..sources import adapters as A


RULES = ("stored_guess", "lexical", "vendor_majority")


def rule_runs(spark: SparkSession, d: str) -> DataFrame:
    """Rows and hits of the three rule models, from one aggregation over the scored items."""
    s = A.scored(spark, d)
    lex = answers.parse(answers.lexical_answers(s, A.codes(spark, d))).select("item_id", "llm_code")
    counts = A.labeled(spark, d).groupBy("vendor_name", "code").agg(F.count(F.lit(1)).alias("_n"))
    top = counts.groupBy("vendor_name").agg(
        F.min(F.struct((-F.col("_n")).alias("neg"), F.col("code").alias("code"))).alias("_b")
    ).select("vendor_name", F.col("_b.code").alias("majority_code"))
    hit = lambda c: F.count_if(F.coalesce(F.col(c) == F.col(COLS.truth), F.lit(False)))
    one = s.join(lex, "item_id", "left").join(top, "vendor_name", "left").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(hit(COLS.predicted), hit("llm_code"), hit("majority_code")).alias("hits"),
    )
    each = one.select("n", F.posexplode("hits").alias("i", "n_correct"))
    name = F.element_at(F.array(*[F.lit(r) for r in RULES]), F.col("i") + 1)
    return each.select(
        (F.col("i") + 1).alias("version"), (F.col("i") + 1).alias("ordinal"), name.alias("algorithm"),
        "n", "n_correct", exact_ratio("n_correct", "n").alias("accuracy"),
    )


def version_history(spark: SparkSession, d: str) -> DataFrame:
    """Versions that scored the items, as text: "10" sorts before "9" unless compared as numbers."""
    return A.scored(spark, d).select((F.col("k") % 12 + 1).cast("string").alias("version")).distinct()


def aliases_after(spark: SparkSession, d: str) -> DataFrame:
    """Start: Champion → version 1.  After comparison: Champion → best version,
    Challenger → the latest version that scored items."""
    start = spark.range(1).select(F.lit(C.CHAMPION).alias("alias"), F.lit(1).alias("version"))
    best = registry.select_best(rule_runs(spark, d)).select("best_version").scalar()
    newest = registry.latest(version_history(spark, d)).select("latest_version").scalar()
    a = registry.upsert_alias(start, C.CHAMPION, best)
    return registry.upsert_alias(a, C.CHALLENGER, newest)


def promotion_check(spark: SparkSession, d: str) -> DataFrame:
    """The latest candidate against the first (Champion): promoted when not worse."""
    runs = rule_runs(spark, d)
    # both from one pass: three rows
    both = runs.agg(
        F.max_by("accuracy", "version").alias("accuracy"), F.max(F.when(F.col("version") == 1, F.col("accuracy"))).alias("first")
    )
    old = F.coalesce("first", F.lit(0.0))
    promoted = F.col("accuracy") >= old
    return both.select(
        old.alias("old_accuracy"), F.col("accuracy").alias("new_accuracy"), promoted.alias("promoted"),
        F.when(promoted, F.lit(C.CHAMPION)).otherwise(F.lit(C.CHALLENGER)).alias("new_alias"),
    )
