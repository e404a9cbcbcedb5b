"""Feedback: training set augmented with expert corrections, and the promotion
rule (J3, J4, U2, R5, R7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import COLS, Cols

TRAIN_COLUMNS = (
    "item_id", "vendor_name", "product_description", "unit_price", "currency",
    "vendor_country", "created_date", "code",
)


def kept_rows(labeled: DataFrame, corrections: DataFrame, cols: Cols = COLS) -> DataFrame:
    """Training rows whose id was not corrected."""
    return labeled.join(corrections.select(cols.id), cols.id, "left_anti")


def first_classified(classified: DataFrame, corrections: DataFrame, cols: Cols = COLS) -> DataFrame:
    """One output row per corrected id (the smallest row if an id appears twice).

    The output is cut down to the corrected ids before anything is grouped."""
    keep = [cols.vendor, cols.text, cols.price, cols.currency]
    own = classified.select(cols.id, *keep).join(corrections.select(cols.id), cols.id, "left_semi")
    return own.groupBy(cols.id).agg(F.min(F.struct(*keep)).alias("_r")).select(
        cols.id, *[F.col(f"_r.{c}").alias(c) for c in keep]
    )


def corrected_rows(
    classified: DataFrame,
    corrections: DataFrame,
    latest_only: bool = False,
    cols: Cols = COLS,
    items: DataFrame | None = None,
) -> DataFrame:
    """Corrected items in training shape, label = expert code.

    Corrections for ids absent from the output are dropped.  Fields the output
    table lacks (country, created date) are NULL, or taken from `items` when
    given.  With `latest_only`, one correction per id (latest date, then
    largest code)."""
    c = corrections
    if latest_only:
        c = c.groupBy(cols.id).agg(
            F.max(F.struct("correction_date", "corrected_code")).alias("_c")
        ).select(cols.id, F.col("_c.corrected_code").alias("corrected_code"))
    j = c.select(cols.id, "corrected_code").join(first_classified(classified, corrections, cols), cols.id, "inner")
    if items is not None:
        extra = items.join(corrections.select(cols.id), cols.id, "left_semi").groupBy(cols.id).agg(
            F.min(F.struct("vendor_country", "created_date")).alias("_i")
        ).select(cols.id, F.col("_i.vendor_country").alias("vendor_country"), F.col("_i.created_date").alias("created_date"))
        j = j.join(extra, cols.id, "left")
    else:
        j = j.withColumns(
            {"vendor_country": F.lit(None).cast("string"), "created_date": F.lit(None).cast("date")}
        )
    return j.select(
        cols.id, cols.vendor, cols.text, cols.price, cols.currency,
        "vendor_country", "created_date",
        F.col("corrected_code").alias(cols.label),
    )


def augment(
    labeled: DataFrame,
    classified: DataFrame,
    corrections: DataFrame,
    latest_only: bool = False,
    cols: Cols = COLS,
    items: DataFrame | None = None,
) -> DataFrame:
    """kept ∪ corrected."""
    kept = kept_rows(labeled, corrections, cols).select(*TRAIN_COLUMNS)
    return kept.unionByName(corrected_rows(classified, corrections, latest_only, cols, items))


def augment_report(classified: DataFrame, corrections: DataFrame, cols: Cols = COLS) -> DataFrame:
    """Corrections received, applied, and dropped for an unknown id."""
    known = first_classified(classified, corrections, cols).select(cols.id, F.lit(True).alias("_known"))
    j = corrections.join(known, cols.id, "left")
    return j.agg(
        F.count(F.lit(1)).alias("n_corrections"),
        F.count_if(F.col("_known").isNotNull()).alias("n_applied"),
        F.count_if(F.col("_known").isNull()).alias("n_unknown_id"),
    )


def promotion(new: DataFrame, champion: DataFrame) -> DataFrame:
    """Promote when new accuracy ≥ the Champion's recorded accuracy (missing → 0).

    `new` and `champion` are one-row frames with column `accuracy`."""
    old = champion.agg(F.max("accuracy")).scalar()
    return new.select(
        F.coalesce(old, F.lit(0.0)).alias("old_accuracy"),
        F.col("accuracy").alias("new_accuracy"),
        (F.col("accuracy") >= F.coalesce(old, F.lit(0.0))).alias("promoted"),
    )
