"""Incremental scoring: what is scored, which files are written."""

import os

from pyspark.sql import functions as F

from duotier.plans import incremental as I
from duotier.sources import sinks

SCHEMA = "item_id string, vendor_name string, product_description string, unit_price double, currency string"


def _items(spark, n, price=lambda i: 1.0):
    return spark.createDataFrame([(f"i{k}", None if k % 9 == 0 else "v", f"text {k}", price(k), "EUR") for k in range(n)], SCHEMA)


def _files(spark, table):
    top = sinks.table_path(spark, table)
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(top) for f in names if f.endswith(".parquet")}


def _run(spark, items, version, table="inc"):
    seen = []

    def scorer(df):
        seen.extend(r["item_id"] for r in df.select("item_id").collect())
        return df.select("item_id", (F.col("unit_price") * 2).alias("score"), F.lit(version).alias("model"))

    out = I.score_changes(items, scorer, table, version, buckets=8)
    return sorted(seen), {r["item_id"]: (r["score"], r["model"]) for r in out.collect()}


def test_only_changes_are_scored_and_only_their_buckets_written(spark):
    items = _items(spark, 100)
    seen, out = _run(spark, items, "1")
    assert len(seen) == 100 and set(out.values()) == {(2.0, "1")}
    files = _files(spark, "inc")
    seen, out = _run(spark, items, "1")
    assert seen == [] and len(out) == 100 and _files(spark, "inc") == files  # no file touched

    changed = _items(spark, 102, lambda k: 5.0 if k == 7 else 1.0)  # one changed, two new
    seen, out = _run(spark, changed, "1")
    assert seen == ["i100", "i101", "i7"]
    assert len(out) == 102 and out["i7"] == (10.0, "1") and out["i8"] == (2.0, "1")
    after = _files(spark, "inc")
    same = set(files.items()) & set(after.items())
    assert len(same) >= 5  # eight buckets, at most three of them rewritten

    seen, out = _run(spark, changed, "2")  # another model version scores all again
    assert len(seen) == 102 and {m for _, m in out.values()} == {"2"}
    seen, _ = _run(spark, changed.limit(0), "2")
    assert seen == [] and len(_run(spark, changed, "2")[1]) == 102


def test_first_run_on_an_empty_table(spark):
    seen, out = _run(spark, _items(spark, 1).limit(0), "1", "inc_empty")
    assert seen == [] and out == {}
    seen, out = _run(spark, _items(spark, 4), "1", "inc_empty")
    assert len(seen) == 4 and len(out) == 4


def test_null_and_empty_text_differ(spark):
    df = spark.createDataFrame([("a", None, "t", 1.0, "EUR"), ("a", "", "t", 1.0, "EUR")], SCHEMA)
    assert df.select(I.content_digest(I.content())).distinct().count() == 2
