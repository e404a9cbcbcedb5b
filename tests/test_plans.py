"""Plan shapes: broadcast joins for bounded sides, top-k as TakeOrderedAndProject,
pushed-down filters and pruned columns at the scan, no per-group window in the split."""

import time

import pytest
from conftest import SF
from pyspark.sql import functions as F

from duotier.config import Cols
from duotier.operators import features
from duotier.plans.queries import QUERIES
from duotier.sources import adapters as A


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fx_join_is_broadcast(spark):
    p = plan(QUERIES["price_eur"](spark, SF["tiny"]))
    assert "BroadcastHashJoin" in p


def test_top_k_is_take_ordered(spark):
    p = plan(QUERIES["label_top10"](spark, SF["tiny"]))
    assert "TakeOrderedAndProject" in p


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = A.table(spark, SF["tiny"], "part").where("p_size > 10").select("p_partkey")
    p = plan(df)
    assert "PushedFilters: [IsNotNull(p_size), GreaterThan(p_size,10)]" in p
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int>" in p


def test_split_windows_are_per_part_and_label(spark):
    lab = A.labeled(spark, SF["tiny"])
    df = features.split_strat(lab, "code", 0.25)
    p = plan(df)
    other = features.split_strat(lab, "code", 0.25, digits=1)
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, other.collect()))
    # row numbers are taken per (label, part of the hash), never per label alone
    assert "windowspecdefinition(code" in p and "_rk_p" in p


def test_lexical_answerer_broadcasts_code_tokens(spark):
    p = plan(QUERIES["llm_answers"](spark, SF["tiny"]))
    assert "BroadcastHashJoin" in p


def test_a_token_of_all_codes_makes_no_pairs(spark):
    from duotier.operators.overlap import best_overlap

    targets = spark.createDataFrame([(f"c{i}", i, ["every", f"own{i}"]) for i in range(50)], "name string, ord int, tokens array<string>")
    rows = spark.createDataFrame([(i, ["every", f"own{i}"] if i < 50 else ["every"] if i < 60 else ["none"]) for i in range(70)], "id int, tok array<string>")
    got = {r.id: (r.name, r.score) for r in best_overlap(rows, "id", F.col("tok"), targets).collect()}
    assert got == {i: (f"c{i}", 2) if i < 50 else ("c0", 1) if i < 60 else (None, None) for i in range(70)}
    each = targets.select(F.explode("tokens").alias("token"))
    joined = rows.select("id", F.explode("tok").alias("token")).join(each.groupBy("token").count().where("count < 50"), "token")
    assert joined.count() == 50


def test_feedback_groups_corrected_ids_only(spark):
    p = plan(QUERIES["augment_report"](spark, SF["tiny"]))
    assert "LeftSemi" in p


@pytest.mark.parametrize("name", ["vocab_topk", "term_freq", "tfidf", "idf", "lines_tfidf", "tfidf_apply"])
def test_texts_are_tokenised_in_one_projection_only(spark, name):
    lines = QUERIES[name](spark, SF["tiny"])._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not [x for x in lines if "Filter" in x.split("(")[0] and "regexp_extract_all" in x]


def test_a_very_long_text_is_tokenised_in_linear_time(spark):
    text = " ".join(f"word{k % 977}" for k in range(20_000))
    df = spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "one"), (5, "the one")], "doc_id long, text string")
    cols = Cols(id="doc_id", text="text")
    begin = time.perf_counter()
    got = features.top_terms(features.terms(df, cols), 3).collect()
    assert time.perf_counter() - begin < 30
    assert [(r.term, r.freq) for r in got] == [("word0", 21), ("word0 word1", 21), ("word1", 21)]
    assert features.terms(df.where("doc_id > 1"), cols).count() == 2
    grams = df.where("doc_id = 1").select(F.size(features.ngrams(F.split("text", " "), 3)).alias("n")).first().n
    assert grams == 20_000 + 19_999 + 19_998


@pytest.mark.parametrize("name", ["lines_code_report", "lines_ledger_answers", "lines_ledger_pending"])
def test_lines_are_derived_once(spark, name):
    """All branches read what was written of the lines; none groups and joins `lineitem` again."""
    files = QUERIES[name](spark, SF["tiny"]).inputFiles()
    assert files and not any("lineitem" in f for f in files)
