"""Mergeable summaries: bounds hold at every width, and the vocabulary is exact at each."""

from collections import Counter

import pytest
from conftest import SF
from pyspark.sql import functions as F

from duotier.operators import features, heavy
from duotier.sources import adapters as A


@pytest.fixture(scope="module")
def arrays(spark):
    return features.term_array(A.docs(spark, SF["tiny"])).select("_terms").repartition(7).cache()


@pytest.fixture(scope="module")
def true_counts(arrays):
    return Counter(t for r in arrays.collect() for t in r["_terms"] or ())


@pytest.mark.parametrize("width", [1, 10, 200, 5000])
def test_summary_bounds(arrays, true_counts, width):
    error, kept = heavy.summary(arrays, width)
    assert len(kept) <= 2 * width
    assert all(n <= true_counts[t] <= n + error for t, n in kept.items())
    assert all(n <= error for t, n in true_counts.items() if t not in kept)
    assert error * (width + 1) <= sum(true_counts.values())


def test_summary_without_overflow_is_exact(arrays, true_counts):
    assert heavy.summary(arrays, len(true_counts)) == (0, dict(true_counts))


@pytest.mark.parametrize("width", [4, 64, 8192])
def test_vocabulary_is_exact_at_every_width(spark, width):
    docs = A.docs(spark, SF["tiny"])
    want = [tuple(r) for r in features.vocabulary(docs, 40).collect()]
    assert [tuple(r) for r in heavy.vocabulary(docs, 40, width=width).collect()] == want


def test_ties_at_the_end_widen_the_summary(spark):
    rows = [(k, " ".join(f"w{k}x{j}" for j in range(50))) for k in range(40)]
    df = spark.createDataFrame(rows, "item_id long, product_description string")
    got = heavy.vocabulary(df, 10, n=1, width=16).collect()
    words = sorted(w for _, t in rows for w in t.split())
    assert [(r.term, r.freq, r.df) for r in got] == [(w, 1, 1) for w in words[:10]]
    assert heavy.vocabulary(df.limit(0), 10).count() == 0
    few = heavy.vocabulary(df.limit(1), 500, n=1).collect()
    assert len(few) == 50


def test_only_candidates_are_shuffled(spark, arrays):
    plan = heavy.exact_counts(arrays, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    at = [k for k, line in enumerate(plan.splitlines()) if "Exchange hashpartitioning" in line]
    join = [k for k, line in enumerate(plan.splitlines()) if "BroadcastHashJoin" in line]
    assert len(at) == 1 and join and at[0] < join[0]  # the tree is printed from the top: the join comes first


def test_null_and_empty_arrays(spark):
    df = spark.createDataFrame([(["a", "b", "a"],), (None,), ([],), (["a", None],)], "_terms array<string>")
    assert heavy.summary(df, 4) == (0, {"a": 3, "b": 1})
    assert heavy.summary(df.where("false"), 4) == (0, {})
    got = heavy.exact_counts(df.where(F.col("_terms").isNotNull()), ["a"]).collect()
    assert [tuple(r) for r in got] == [("a", 3, 2)]
