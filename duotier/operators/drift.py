"""Drift between windows of the output: distances of predictions and of a measure.

For each window (time bucket and model version) and each reference (the window
before it, and the version's first window as baseline) the distances are

* tv: total variation of the predictions, half the sum of absolute differences of shares;
* js: their Jensen-Shannon divergence in nats;
* ks: Kolmogorov-Smirnov distance of the measure, the greatest difference of the shares up to a value.

Counts per (window, value) are the only thing that is taken from the rows; they
add up over parts of a window, so a hot window combines on the map side and is
one row per value.  Exact distances compare whole numbers.  The measure's values
should carry few decimals for that; for any others `sketches` keeps a mergeable
quantile sketch per window as a row, and `sketch_drift` compares those, within
`sketch_error` of the exact distance (99 % of the time, for both sketches)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SKETCH_K = 800
#: A quantile sketch of size k has a rank error of 2.296 / k^0.9021.
ERROR_FACTOR, ERROR_POWER = 2.296, 0.9021
POINTS = 400


def windowed(df: DataFrame, ts: str, version: str, prediction: str, measure: str, every: str = "1 day") -> DataFrame:
    """(bucket, model_version, prediction, measure) of every row."""
    return df.select(
        F.window(ts, every)["start"].cast("date").alias("bucket"),
        F.col(version).alias("model_version"),
        F.col(prediction).alias("prediction"),
        F.col(measure).alias("measure"),
    )


def references(counts: DataFrame) -> DataFrame:
    """(bucket, model_version, reference, ref_bucket) of every comparison; a version's first window has none."""
    each = counts.select("bucket", "model_version").distinct()  # a row per window
    order = Window.partitionBy("model_version").orderBy("bucket")
    named = each.select(
        "*", F.lag("bucket").over(order).alias("previous"), F.min("bucket").over(Window.partitionBy("model_version")).alias("baseline")
    ).where("previous IS NOT NULL")
    pairs = F.array(*[F.struct(F.lit(r).alias("reference"), F.col(r).alias("ref_bucket")) for r in ("previous", "baseline")])
    return named.select("bucket", "model_version", F.explode(pairs).alias("r")).select("bucket", "model_version", "r.*")


KEY = ("bucket", "model_version", "reference")


def paired(counts: DataFrame, refs: DataFrame, value: str) -> DataFrame:
    """(bucket, model_version, reference, `value`, a, b): counts in the window and in its reference."""
    zero = F.lit(0).cast("long")
    own = counts.join(refs, ["bucket", "model_version"]).select(*KEY, value, F.col("n").alias("a"), zero.alias("b"))
    ref = counts.withColumnRenamed("bucket", "ref_bucket").join(refs, ["ref_bucket", "model_version"])
    both = own.unionByName(ref.select(*KEY, value, zero.alias("a"), F.col("n").alias("b")))
    return both.groupBy(*KEY, value).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def _wide(x):
    return F.col(x).cast("decimal(19,0)")


def prediction_drift(rows: DataFrame) -> DataFrame:
    """(bucket, model_version, reference, n, n_ref, tv, js); a missing prediction is a value of its own."""
    counts = rows.groupBy("bucket", "model_version", "prediction").agg(F.count(F.lit(1)).alias("n"))
    pairs = paired(counts, references(counts), "prediction")
    whole = Window.partitionBy(*KEY)  # a row per prediction
    pairs = pairs.withColumns({"_a": F.sum("a").over(whole), "_b": F.sum("b").over(whole)})
    p, q = F.col("a").cast("double") / F.col("_a"), F.col("b").cast("double") / F.col("_b")
    part = lambda x: F.when(x > 0, x * F.log(F.lit(2.0) * x / (p + q))).otherwise(0.0)
    differ = F.abs(_wide("a") * _wide("_b") - _wide("b") * _wide("_a"))
    out = pairs.groupBy(*KEY).agg(
        F.max("_a").alias("n"), F.max("_b").alias("n_ref"), F.sum(differ).alias("_d"), (F.sum(part(p) + part(q)) / 2.0).alias("_js")
    )
    share = F.col("_d").cast("double") / (F.lit(2.0) * F.col("n").cast("double") * F.col("n_ref").cast("double"))
    return out.select(*KEY, "n", "n_ref", F.round(share, 9).alias("tv"), F.round(F.greatest("_js", F.lit(0.0)), 9).alias("js"))


def measure_drift(rows: DataFrame) -> DataFrame:
    """(bucket, model_version, reference, ks) of windows that have measures."""
    known = rows.where(F.col("measure").isNotNull())
    return _greatest_gap(known.groupBy("bucket", "model_version", "measure").agg(F.count(F.lit(1)).alias("n")))


def _greatest_gap(counts: DataFrame) -> DataFrame:
    """ks of each comparison, from (bucket, model_version, measure, n)."""
    pairs = paired(counts, references(counts), "measure")
    upto = Window.partitionBy(*KEY).orderBy("measure").rowsBetween(Window.unboundedPreceding, 0)
    pairs = pairs.withColumns({"_a": F.sum("a").over(upto), "_b": F.sum("b").over(upto)})
    totals = pairs.groupBy(*KEY).agg(F.sum("a").alias("_n"), F.sum("b").alias("_m"))
    joined = pairs.select(*KEY, "_a", "_b").join(totals, list(KEY))
    gap = F.abs(_wide("_a") * _wide("_m") - _wide("_b") * _wide("_n"))
    out = joined.groupBy(*KEY).agg(F.max(gap).alias("_g"), F.max("_n").alias("_n"), F.max("_m").alias("_m"))
    return out.select(*KEY, F.round(F.col("_g").cast("double") / (F.col("_n").cast("double") * F.col("_m").cast("double")), 9).alias("ks"))


def drift(rows: DataFrame) -> DataFrame:
    """All distances of every window to the one before and to the baseline."""
    return prediction_drift(rows).join(measure_drift(rows), list(KEY), "left")


def sketches(rows: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """(bucket, model_version, n, sketch): a quantile sketch of the measure per window, a row to keep and to merge."""
    value = F.col("measure").cast("double")
    return rows.where(value.isNotNull()).groupBy("bucket", "model_version").agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(value, F.lit(k)).alias("sketch")
    )


def merged(parts: DataFrame) -> DataFrame:
    """Kept rows of the same windows, from several runs, as one row per window."""
    return parts.groupBy("bucket", "model_version").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_error(k: int = SKETCH_K, points: int = POINTS) -> float:
    """How far `sketch_drift` may be from the exact distance."""
    return 2 * ERROR_FACTOR / k**ERROR_POWER + 2 / points


def sketch_drift(kept: DataFrame, points: int = POINTS) -> DataFrame:
    """(bucket, model_version, reference, ks) from the sketches: of `points` evenly spaced quantiles of each window."""
    ranks = F.array(*[F.lit((i + 0.5) / points) for i in range(points)])
    values = kept.select("bucket", "model_version", F.explode(F.kll_sketch_get_quantile_double("sketch", ranks)).alias("measure"))
    return _greatest_gap(values.groupBy("bucket", "model_version", "measure").agg(F.count(F.lit(1)).alias("n")))
