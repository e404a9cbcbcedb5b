"""Hand-worked cases: gate boundary, fallbacks, monitoring edges, feedback edges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from duotier import config as C
from duotier.operators import answers, features, gate, merge, monitor, prep, retrain, zero_shot
from duotier.models import registry
from duotier.plans import flows

SCORED = ("item_id string, vendor_name string, product_description string, unit_price double, currency string, "
          "ml_predicted_code string, ml_confidence double")


def scored(spark, rows):
    return spark.createDataFrame(rows, SCORED)


def test_gate_boundary_rounds_half_even_before_comparing(spark):
    df = spark.createDataFrame([("a", 0.84994), ("b", 0.84996), ("c", 0.85), ("d", 0.84985)], "item_id string, raw double")
    r = gate.round_confidence(df, "raw")
    out = {x["item_id"]: x["ml_confidence"] for x in r.collect()}
    assert out == {"a": 0.8499, "b": 0.85, "c": 0.85, "d": 0.8498}
    accepted = {x["item_id"] for x in gate.accept(r.withColumn("ml_predicted_code", F.lit("X"))).collect()}
    routed = {x["item_id"] for x in gate.route(r).collect()}
    assert accepted == {"b", "c"} and routed == {"a", "d"}


def test_unknown_currency_converts_at_one(spark):
    df = spark.createDataFrame([("i", 10.0, "CHF"), ("j", 10.0, "USD")], "item_id string, unit_price double, currency string")
    from duotier.sources.adapters import fx

    out = {r["item_id"]: r["price_eur"] for r in features.price_eur(df, fx(spark)).collect()}
    assert out == {"i": 10.0, "j": 10.0 * 0.92}


@pytest.mark.parametrize("resp", ["not json", "{}", None])
def test_malformed_answer_falls_back_to_model_guess(spark, resp):
    routed = scored(spark, [("i", "v", "t", 1.0, "EUR", "A", 0.5)])
    responses = spark.createDataFrame([("i", resp)], "item_id string, response string")
    r = answers.fallback(routed, answers.parse(responses)).first()
    assert r["final_code"] == "A"
    assert r["classification_method"] == C.METHOD_FALLBACK
    assert r["final_confidence"] == 0.80


def test_agreement_text_false_is_false_and_reason_none_is_null(spark):
    responses = spark.createDataFrame(
        [("i", '{"iso_code":"A","reason":"None","agrees_with_ml":"false"}')], "item_id string, response string"
    )
    p = answers.parse(responses).first()
    assert p["llm_code"] == "A" and p["llm_agrees"] is False
    routed = scored(spark, [("i", "v", "t", 1.0, "EUR", "A", 0.5)])
    r = answers.fallback(routed, answers.parse(responses)).first()
    assert r["llm_reason"] is None and r["classification_method"] == C.METHOD_LLM


def test_full_contract_rejects_wrong_boolean(spark):
    responses = spark.createDataFrame(
        [("i", '{"iso_code":"A","reason":"r","agrees_with_ml":"yes"}'), ("j", '{"iso_code":"A","reason":"r","agrees_with_ml":true}')],
        "item_id string, response string",
    )
    v = {r["item_id"]: r["is_valid"] for r in answers.validate(responses, full=True).collect()}
    assert v == {"i": False, "j": True}


def test_null_vendor_gives_a_prompt(spark):
    routed = scored(spark, [("i", None, "blue bolt", None, None, "A", 0.5)])
    codes = spark.createDataFrame([("A", "bolt blue", "desc")], "code string, name string, description string")
    p = answers.prompts(routed, codes).first()["prompt"]
    assert p is not None and "Sold by: \n" in p and "- A: bolt blue — desc" in p


@pytest.mark.parametrize("conf", [0.99, 0.10])
def test_nothing_or_everything_routed_keeps_every_row(spark, conf):
    s = scored(spark, [(f"i{k}", "v", "t", 1.0, "EUR", "A", conf) for k in range(5)])
    resp = spark.createDataFrame([(f"i{k}", '{"iso_code":"B","reason":"r","agrees_with_ml":false}') for k in range(5)],
                                 "item_id string, response string")
    out = flows.classified_flow(s, resp)
    assert out.count() == 5
    assert out.select("item_id").distinct().count() == 5


def test_empty_output_table_signals(spark):
    empty = spark.createDataFrame([], merge.classified_schema())
    r = monitor.signals(empty).first()
    assert r["avg_confidence"] == 0.0 and r["fallback_pct"] is None and r["override_pct"] == 0.0


def _classified(spark, methods):
    rows = [(f"i{k}", "v", "t", 1.0, "EUR", "A", 0.9, "A", m, 0.9, None, "1", None) for k, m in enumerate(methods)]
    return spark.createDataFrame(rows, merge.classified_schema())


def test_fallback_exactly_25_percent_is_not_drift(spark):
    c = _classified(spark, [C.METHOD_ML, C.METHOD_ML, C.METHOD_ML, C.METHOD_LLM])
    f = monitor.drift_flags(monitor.signals(c)).first()
    assert f["fallback_pct"] == 25.0 and f["volume_drift"] is False


@pytest.mark.parametrize("n_corr,expect,short", [(9, False, 1), (10, True, 0)])
def test_retrain_needs_ten_corrections(spark, n_corr, expect, short):
    c = _classified(spark, [C.METHOD_LLM] * 3 + [C.METHOD_ML])
    corr = spark.createDataFrame([(f"i{k}",) for k in range(n_corr)], "item_id string")
    d = monitor.decision(monitor.drift_flags(monitor.signals(c)), corr).first()
    assert d["retrain"] is expect and d["shortfall"] == short


def test_status_line_digits(spark):
    c = _classified(spark, [C.METHOD_ML, C.METHOD_LLM, C.METHOD_LLM])
    sig = monitor.signals(c)
    corr = spark.createDataFrame([("i0",)], "item_id string")
    line = monitor.status_line(sig, monitor.decision(monitor.drift_flags(sig), corr)).first()["status"]
    assert line == "RETRAIN:NO|AVG_CONF:0.9000|LOW_PCT:66.7|CORRECTIONS:1"


def test_corrections_unknown_id_dropped_and_duplicates_kept(spark):
    c = _classified(spark, [C.METHOD_ML, C.METHOD_LLM])
    corr = spark.createDataFrame(
        [("i0", "A", "B", dt.date(2024, 3, 1), "x"), ("i0", "A", "C", dt.date(2024, 4, 1), "y"), ("zz", "A", "B", dt.date(2024, 3, 1), "x")],
        "item_id string, predicted_code string, corrected_code string, correction_date date, corrector_name string",
    )
    rows = retrain.corrected_rows(c, corr).collect()
    assert sorted(r["code"] for r in rows) == ["B", "C"]
    latest = retrain.corrected_rows(c, corr, latest_only=True).collect()
    assert [r["code"] for r in latest] == ["C"]
    rep = retrain.augment_report(c, corr).first()
    assert (rep["n_corrections"], rep["n_applied"], rep["n_unknown_id"]) == (3, 2, 1)


def test_corrected_rows_can_take_country_and_date_from_items(spark):
    c = _classified(spark, [C.METHOD_ML])
    corr = spark.createDataFrame([("i0", "A", "B", dt.date(2024, 3, 1), "x")],
                                 "item_id string, predicted_code string, corrected_code string, correction_date date, corrector_name string")
    items = spark.createDataFrame([("i0", "NO", dt.date(2024, 1, 5))], "item_id string, vendor_country string, created_date date")
    plain = retrain.corrected_rows(c, corr).first()
    rich = retrain.corrected_rows(c, corr, items=items).first()
    assert plain["vendor_country"] is None and rich["vendor_country"] == "NO"
    assert rich["created_date"] == dt.date(2024, 1, 5)


def test_equal_accuracy_promotes(spark):
    new = spark.createDataFrame([(0.9,)], "accuracy double")
    old = spark.createDataFrame([(0.9,)], "accuracy double")
    assert retrain.promotion(new, old).first()["promoted"] is True
    none = spark.createDataFrame([], "accuracy double")
    p = retrain.promotion(new, none).first()
    assert p["old_accuracy"] == 0.0 and p["promoted"] is True


def test_single_row_class_goes_to_train(spark):
    df = spark.createDataFrame([("a", "X"), ("b", "Y"), ("c", "Y"), ("d", "Y"), ("e", "Y")], "item_id string, code string")
    out = {r["item_id"]: r["is_test"] for r in features.split_strat(df, "code", 0.25).collect()}
    assert out["a"] is False
    assert sum(out[k] for k in "bcde") == 1


def test_tie_of_algorithms_first_wins(spark):
    runs = spark.createDataFrame([(1, 1, "LR", 0.9), (2, 2, "RF", 0.9), (3, 3, "GB", 0.8)],
                                 "version int, ordinal int, algorithm string, accuracy double")
    assert registry.select_best(runs).first()["best_algorithm"] == "LR"


def test_zero_shot_without_overlap_is_null(spark):
    items = spark.createDataFrame([("i", "zzz qqq"), ("j", "knee brace")], "item_id string, product_description string")
    labels = zero_shot.labels_from_spec(spark, '{"Orthoses": "knee brace", "Wound care": "dressings"}')
    out = {r["item_id"]: r["label"] for r in zero_shot.zero_shot(items, labels).collect()}
    assert out == {"i": None, "j": "Orthoses"}
    arr = zero_shot.labels_from_spec(spark, '["brace", "knee"]')
    out = {r["item_id"]: r["label"] for r in zero_shot.zero_shot(items, arr).collect()}
    assert out["j"] == "brace"  # tie: earlier label in the spec wins


def test_long_ids_are_kept_whole(spark):
    df = spark.createDataFrame([(123456,), (7,)], "k long")
    assert sorted(r["item_id"] for r in prep.item_ids(df, "k").collect()) == ["ITM-00007", "ITM-123456"]


def test_zero_price_spread(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 5.0)], "item_id string, price_eur double")
    z = features.price_z(df, features.price_stats(df)).collect()
    assert [r["price_z"] for r in z] == [0.0, 0.0]


def test_lexical_answerer_tie_goes_to_smaller_code(spark):
    routed = scored(spark, [("i", "v", "red widget small", 1.0, "EUR", "B", 0.5), ("j", "v", "nothing here", 1.0, "EUR", "B", 0.5)])
    codes = spark.createDataFrame([("B", "widget small", ""), ("A", "widget red", "")], "code string, name string, description string")
    out = {r["item_id"]: r["response"] for r in answers.lexical_answers(routed, codes).collect()}
    assert out["i"] == '{"iso_code":"A","reason":"2 shared terms","agrees_with_ml":false}'
    assert out["j"] is None


def test_error_mode_never_fails(spark):
    import pandas as pd

    def flaky(prompts):
        if any("bad" in p for p in prompts):
            raise RuntimeError("service error")
        return pd.Series(['{"iso_code":"A","reason":"r","agrees_with_ml":true}'] * len(prompts))

    pr = spark.createDataFrame([("i", "good"), ("j", "bad")], "item_id string, prompt string")
    out = {r["item_id"]: (r["response"], r["error_message"]) for r in answers.answer(pr, flaky, error_mode=True).collect()}
    assert out["i"][0] is not None and out["i"][1] is None
    assert out["j"][0] is None and "service error" in out["j"][1]
    struct = answers.as_result_struct(answers.answer(pr, flaky, error_mode=True))
    assert set(struct.schema["result"].dataType.names) == {"response", "errorMessage"}


def test_unknown_code_validation_option(spark):
    routed = scored(spark, [("i", "v", "t", 1.0, "EUR", "A", 0.5)])
    resp = spark.createDataFrame([("i", '{"iso_code":"ZZ","reason":"r","agrees_with_ml":false}')], "item_id string, response string")
    codes = spark.createDataFrame([("A",), ("B",)], "code string")
    keep = answers.fallback(routed, answers.parse(resp)).first()
    checked = answers.fallback(routed, answers.parse(resp), codes=codes).first()
    assert keep["final_code"] == "ZZ" and checked["final_code"] == "A"
