"""Zero-shot labelling to broad categories without training.

A label spec is a JSON object (label → description) or a JSON array of labels,
or a DataFrame (label, description, ordinal).  Each row gets the label sharing
the most distinct tokens with its text; ties go to the earlier label in the
spec; a text sharing no token with any label gets NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import COLS, Cols
from ..functions.text import distinct_tokens
from .overlap import best_overlap


def labels_from_spec(spark: SparkSession, spec) -> DataFrame:
    """(label, description, ordinal) from a JSON spec given as text or as a string Column.

    Object form: description matched together with the label.  Array form: the
    label's own words are matched."""
    col: Column = F.lit(spec) if isinstance(spec, str) else spec
    one = spark.range(1).select(col.alias("spec"))
    is_array = F.startswith(F.ltrim(F.col("spec")), F.lit("["))
    arr = one.where(is_array).select(
        F.posexplode(F.from_json("spec", "array<string>")).alias("ordinal", "label")
    ).select("label", F.lit("").alias("description"), "ordinal")
    obj = one.where(~is_array).select(
        F.posexplode(F.map_entries(F.from_json("spec", "map<string,string>"))).alias("ordinal", "e")
    ).select(F.col("e.key").alias("label"), F.col("e.value").alias("description"), "ordinal")
    return arr.unionByName(obj)


def zero_shot(df: DataFrame, labels: DataFrame, cols: Cols = COLS, out: str = "label") -> DataFrame:
    """Best label per row by shared distinct tokens (label text + description)."""
    targets = labels.select(
        F.col("label").alias("name"), F.col("ordinal").alias("ord"),
        distinct_tokens(F.concat_ws(" ", "label", "description")).alias("tokens"),
    )
    best = best_overlap(df, cols.id, distinct_tokens(cols.text), targets)
    return best.select(cols.id, F.col("name").alias(out), "score")
