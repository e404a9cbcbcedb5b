"""Table preparation and label reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import COLS, Cols


def specialty_codes(vendors: DataFrame, codes: DataFrame) -> DataFrame:
    """(vendor, code) for codes in one of the vendor's specialty subclasses."""
    v = vendors.select("vendor_name", F.explode(F.array_distinct("specialties")).alias("code_level_2"))
    return v.join(codes.select("code", "code_level_2"), "code_level_2").select("vendor_name", "code")


def other_codes(vendors: DataFrame, codes: DataFrame) -> DataFrame:
    """(vendor, code) for codes outside all of the vendor's specialty subclasses.

    Per vendor, the non-specialty subclasses are found on the vendor's own row
    (subclass list of the taxonomy as a scalar), then joined to codes by subclass."""
    subclasses = codes.agg(F.array_sort(F.collect_set("code_level_2"))).scalar()
    v = vendors.select("vendor_name", "specialties", subclasses.alias("_all")).select(
        "vendor_name",
        F.explode(F.filter("_all", lambda s: ~F.array_contains(F.col("specialties"), s))).alias("code_level_2"),
    )
    return v.join(codes.select("code", "code_level_2"), "code_level_2").select("vendor_name", "code")


def fill_templates(
    items: DataFrame, templates: DataFrame, adjective: str, default: F.Column, cols: Cols = COLS
) -> DataFrame:
    """Description per item from its code's templates with `{adj}` filled in;
    a code without a template uses `default`."""
    j = items.join(templates, cols.label, "left")
    tpl = F.coalesce(F.col("template"), default)
    return j.select(
        cols.id, cols.label, F.col("template_no"),
        F.replace(tpl, F.lit("{adj}"), F.col(adjective)).alias("description"),
    )


def price_band(df: DataFrame, bands: DataFrame, code: str = COLS.label, default=C.DEFAULT_PRICE_BAND) -> DataFrame:
    """Price band of each row's subclass (first 5 characters of the code), with default."""
    b = bands.select(F.col("subclass").alias("_sub"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"))
    j = df.join(b, F.substring(code, 1, 5) == F.col("_sub"), "left")
    return j.withColumns(
        {
            "subclass": F.substring(code, 1, 5),
            "price_lo": F.coalesce(F.col("_lo"), F.lit(default[0])),
            "price_hi": F.coalesce(F.col("_hi"), F.lit(default[1])),
        }
    ).drop("_sub", "_lo", "_hi")


def label_top(df: DataFrame, k: int = 10, label: str = COLS.label) -> DataFrame:
    """The k most frequent labels (ties: smaller label first)."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(label)).limit(k)


def label_summary(df: DataFrame, label: str = COLS.label) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(label).alias("n_labels"))


def code_hierarchy(codes: DataFrame) -> DataFrame:
    """Class (2 characters) and subclass (5 characters) of each code."""
    return codes.select(
        "code", F.substring("code", 1, 2).alias("class_code"), F.substring("code", 1, 5).alias("subclass")
    )


def item_ids(df: DataFrame, key: str, out: str = COLS.id) -> DataFrame:
    """`ITM-` and the key zero-padded to 5 digits (longer keys are kept whole)."""
    return df.select(F.col(key), F.format_string("ITM-%05d", F.col(key)).alias(out))


def date_offset(df: DataFrame, date_col: str, run_date: str, out: str = "days_ago") -> DataFrame:
    """Days between a date and the run date, and the date one year earlier."""
    return df.withColumns(
        {
            out: F.datediff(F.lit(run_date).cast("date"), F.col(date_col)),
            "year_before": F.date_sub(F.col(date_col), 365),
        }
    )
