"""Registered queries: one per operator of the inventory, each `(spark, sf_dir) -> DataFrame`.

Every query reads the given tables (through the adapters) over whole tables.
Model-training queries are in `model_queries.py`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..config import COLS
from ..functions.text import tokens
from ..operators import answers, calibration, contract, drift, evaluate, features, gate, heavy, ledger, merge, monitor, prep, report, retrain, zero_shot
from ..operators.rank import dense_codes
from ..sources import adapters as A
from ..sources import sinks
from . import flows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def reg(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return reg


# --- shared building blocks --------------------------------------------------

def _classified(spark, d) -> DataFrame:
    return flows.classified_flow(A.scored(spark, d), A.responses(spark, d))


def _resolved(spark, d) -> DataFrame:
    return flows.resolved_flow(A.scored(spark, d), A.responses(spark, d))


def _signals(spark, d) -> DataFrame:
    return monitor.signals(_classified(spark, d))


def _decision(spark, d) -> DataFrame:
    return monitor.decision(monitor.drift_flags(_signals(spark, d)), A.corrections(spark, d))


# --- sources, sinks ----------------------------------------------------------

@query("taxonomy")
def q_taxonomy(spark, d):
    return A.codes(spark, d).select("code", "name", "code_level_2", "in_standard", "description")


@query("conform_output")
def q_conform_output(spark, d):
    """Output contract: 13 typed columns, reason text 'None' → NULL."""
    resolved = _resolved(spark, d).withColumn(
        COLS.reason, F.when(F.col("llm_code").isNull(), F.lit("None")).otherwise(F.col(COLS.reason))
    )
    accepted = gate.accept(A.scored(spark, d))
    return merge.merge(accepted, resolved, flows.RUN_TS, flows.MODEL_VERSION)


@query("table_counts")
def q_table_counts(spark, d):
    return sinks.table_counts(
        {
            "codes": A.codes(spark, d),
            "labeled_items": A.labeled(spark, d),
            "new_items": A.scored(spark, d),
            "corrections": A.corrections(spark, d),
        }
    )


# --- projections, gate --------------------------------------------------------

@query("price_eur")
def q_price_eur(spark, d):
    it = A.items(spark, d).select("item_id", "unit_price", "currency")
    return features.price_eur(it, A.fx(spark))


@query("ml_confidence")
def q_ml_confidence(spark, d):
    it = A.items(spark, d).select("item_id", A.raw_confidence("k").alias("raw_confidence"))
    return gate.round_confidence(it, "raw_confidence").withColumn(
        "routed", F.col(COLS.confidence) < F.lit(C.CONFIDENCE_THRESHOLD)
    )


@query("gate_accept")
def q_gate_accept(spark, d):
    return gate.accept(A.scored(spark, d)).select("item_id", COLS.predicted, COLS.confidence)


@query("gate_route")
def q_gate_route(spark, d):
    return gate.route(A.scored(spark, d)).select("item_id", COLS.predicted, COLS.confidence)


@query("accept_branch")
def q_accept_branch(spark, d):
    return gate.accept(A.scored(spark, d)).select(
        "item_id", COLS.final, COLS.method, COLS.final_confidence
    )


@query("gate_report")
def q_gate_report(spark, d):
    return gate.gate_report(A.scored(spark, d))


@query("confidence_bands")
def q_confidence_bands(spark, d):
    return gate.bands(A.scored(spark, d))


@query("confidence_summary")
def q_confidence_summary(spark, d):
    return gate.confidence_summary(A.scored(spark, d), decimals=C.CONFIDENCE_DECIMALS)


@query("code_hierarchy")
def q_code_hierarchy(spark, d):
    return prep.code_hierarchy(A.codes(spark, d))


# --- language-model tier ------------------------------------------------------

@query("reference_block")
def q_reference_block(spark, d):
    return answers.reference_block(A.codes(spark, d))


@query("llm_prompts")
def q_llm_prompts(spark, d):
    return answers.prompts(gate.route(A.scored(spark, d)), A.codes(spark, d)).select("item_id", "prompt")


@query("llm_answers")
def q_llm_answers(spark, d):
    return answers.lexical_answers(gate.route(A.scored(spark, d)), A.codes(spark, d))


@query("llm_validate")
def q_llm_validate(spark, d):
    loose, strict = answers.is_valid(), answers.is_valid(full=True)
    return A.responses(spark, d).select("item_id", loose.alias("valid_code"), strict.alias("valid_full"))


@query("llm_parse")
def q_llm_parse(spark, d):
    return answers.parse(A.responses(spark, d))


@query("llm_branch")
def q_llm_branch(spark, d):
    return _resolved(spark, d).select(
        "item_id", COLS.predicted, "llm_code", COLS.final, COLS.method, COLS.final_confidence, COLS.reason
    )


@query("llm_parse_report")
def q_llm_parse_report(spark, d):
    return answers.parse_report(_resolved(spark, d))


@query("llm_lexical_branch")
def q_llm_lexical_branch(spark, d):
    """Routed rows resolved with the bundled answerer's answers."""
    s = A.scored(spark, d)
    routed = gate.route(s)
    ans = answers.lexical_answers(routed, A.codes(spark, d))
    return answers.fallback(routed, answers.parse(ans)).select(
        "item_id", COLS.final, COLS.method, COLS.final_confidence, COLS.reason
    )


@query("zero_shot")
def q_zero_shot(spark, d):
    """Broad category = noun group of the taxonomy, described by its code names."""
    c = A.codes(spark, d)
    labels = c.groupBy("noun").agg(F.concat_ws(" ", F.array_sort(F.collect_set("adj"))).alias("kinds"))
    labels = labels.select(
        F.concat(F.initcap("noun"), F.lit("s")).alias("label"),
        F.concat(F.lit("parts: "), F.col("noun"), F.lit(" in "), F.col("kinds")).alias("description"),
        "noun",
    )
    labels = dense_codes(labels, "label", "ordinal").join(labels, "label")
    return zero_shot.zero_shot(A.items(spark, d), labels.select("label", "description", "ordinal"))


@query("zero_shot_array")
def q_zero_shot_array(spark, d):
    """Labels-only JSON array spec built from the taxonomy's nouns."""
    c = A.codes(spark, d)
    spec = c.agg(F.to_json(F.array_sort(F.collect_set("noun")))).scalar()
    labels = zero_shot.labels_from_spec(spark, spec)
    return zero_shot.zero_shot(A.items(spark, d), labels)


@query("llm_error_mode")
def q_llm_error_mode(spark, d):
    """Per-row error mode: the answerer raises on rows it cannot answer; the
    query completes and those rows take the fallback."""
    s = A.scored(spark, d)
    routed = gate.route(s)
    pr = answers.prompts(routed, A.codes(spark, d))
    with_stored = pr.join(A.responses(spark, d), "item_id").select(
        "item_id", F.concat("prompt", F.lit("\x1e"), "response").alias("prompt")
    )
    ans = answers.answer(with_stored, _stored_answerer(), error_mode=True)
    parsed = answers.parse(ans.withColumn("had_error", F.col("error_message").isNotNull()), keep=["had_error"])
    return answers.fallback(routed, parsed).select("item_id", COLS.final, COLS.method, "had_error")


def _stored_answerer():
    """Answerer used by `llm_error_mode`: replays the stored response that
    follows the prompt; raises when the stored text is not JSON.  A nested
    function, so that it travels to the workers by value."""

    def answer(prompts):
        import json

        import pandas as pd

        out = []
        for p in prompts:
            stored = p.rsplit("\x1e", 1)[-1]
            json.loads(stored)  # raises on malformed text
            out.append(stored)
        return pd.Series(out)

    return answer


# --- merge, monitor, evaluation -------------------------------------------------

@query("classified_items")
def q_classified_items(spark, d):
    return _classified(spark, d)


@query("method_counts")
def q_method_counts(spark, d):
    return merge.method_counts(_classified(spark, d))


@query("cost_report")
def q_cost_report(spark, d):
    return merge.cost_report(_classified(spark, d))


@query("monitor_signals")
def q_monitor_signals(spark, d):
    return _signals(spark, d).select(
        "n_total", "n_ml", "n_llm", "n_fallback", "avg_confidence", "fallback_pct", "override_pct"
    )


@query("weak_codes")
def q_weak_codes(spark, d):
    return monitor.weak_codes(_classified(spark, d))


@query("drift_flags")
def q_drift_flags(spark, d):
    return monitor.drift_flags(_signals(spark, d))


@query("retrain_decision")
def q_retrain_decision(spark, d):
    return _decision(spark, d).select("conf_drift", "volume_drift", "n_corrections", "retrain", "shortfall")


@query("status_line")
def q_status_line(spark, d):
    return monitor.status_line(_signals(spark, d), _decision(spark, d))


@query("eval_hybrid")
def q_eval_hybrid(spark, d):
    truth = A.scored(spark, d).select("item_id", COLS.truth)
    return evaluate.evaluate(_classified(spark, d), truth)


@query("code_report")
def q_code_report(spark, d):
    """Precision, recall and F1 per code and level of the taxonomy."""
    truth = A.scored(spark, d).select("item_id", COLS.truth)
    return report.per_code(report.confusion(_classified(spark, d), truth))


@query("lines_code_report")
def q_lines_code_report(spark, d):
    """The same over order lines."""
    # what the report and its flow read of the lines, which feed four branches
    s = A.line_scored(spark, d).select("item_id", "k", COLS.predicted, COLS.confidence, COLS.truth)
    s = sinks.written_once(s, "line_scored")
    classified = flows.classified_flow(s, A.stored(s))
    return report.per_code(report.confusion(classified, s.select("item_id", COLS.truth)))


def _by_confidence(scored):
    return calibration.counts(scored, COLS.confidence, F.col(COLS.predicted) == F.col(COLS.truth))


@query("risk_curve")
def q_risk_curve(spark, d):
    """Coverage and risk of a gate at each confidence."""
    return calibration.curve(_by_confidence(A.scored(spark, d)))


@query("lines_risk_curve")
def q_lines_risk_curve(spark, d):
    return calibration.curve(_by_confidence(A.line_scored(spark, d)))


@query("risk_threshold")
def q_risk_threshold(spark, d):
    """Least threshold for each wanted error."""
    return calibration.thresholds(calibration.curve(_by_confidence(A.scored(spark, d))), C.WANTED_ERRORS)


@query("calibrated_confidence")
def q_calibrated_confidence(spark, d):
    """Isotonic share of right guesses per confidence."""
    return calibration.calibrate(_by_confidence(A.scored(spark, d)))


@query("inference_profile")
def q_inference_profile(spark, d):
    ev = A.table(spark, d, "events").select(
        F.col("ts").alias("scored_at"),
        (F.col("user_id") % 3).cast("string").alias("model_version"),
        F.col("event_type").alias("prediction"),
        F.col("value"),
    )
    return monitor.inference_profile(ev, prediction="prediction", measure="value", measure_decimals=2)


def _event_windows(spark, d):
    ev = A.table(spark, d, "events").withColumn("model_version", (F.col("user_id") % 3).cast("string"))
    return drift.windowed(ev, "ts", "model_version", "event_type", "value")


@query("window_drift")
def q_window_drift(spark, d):
    """Distances of every day's predictions and measures to the day before and to the first."""
    return drift.drift(_event_windows(spark, d))


@query("window_drift_sketch")
def q_window_drift_sketch(spark, d):
    """The measure's distance from the kept sketches, to three decimals."""
    kept = drift.sketch_drift(drift.sketches(_event_windows(spark, d)))
    return kept.withColumn("ks", F.round("ks", 3))


@query("classified_profile")
def q_classified_profile(spark, d):
    return monitor.inference_profile(_classified(spark, d), measure_decimals=C.CONFIDENCE_DECIMALS)


# --- feedback -------------------------------------------------------------------

@query("augment_kept")
def q_augment_kept(spark, d):
    return retrain.kept_rows(A.labeled(spark, d), A.corrections(spark, d)).select("item_id", "code")


@query("augment_corrected")
def q_augment_corrected(spark, d):
    return retrain.corrected_rows(_classified(spark, d), A.corrections(spark, d))


@query("augment_latest")
def q_augment_latest(spark, d):
    return retrain.corrected_rows(_classified(spark, d), A.corrections(spark, d), latest_only=True)


@query("augment_report")
def q_augment_report(spark, d):
    return retrain.augment_report(_classified(spark, d), A.corrections(spark, d))


@query("augmented_training")
def q_augmented_training(spark, d):
    return retrain.augment(A.labeled(spark, d), _classified(spark, d), A.corrections(spark, d))


# --- preparation, reports ---------------------------------------------------------

@query("label_top10")
def q_label_top10(spark, d):
    return prep.label_top(A.labeled(spark, d), 10)


@query("label_summary")
def q_label_summary(spark, d):
    return prep.label_summary(A.labeled(spark, d))


@query("vendor_specialty")
def q_vendor_specialty(spark, d):
    return prep.specialty_codes(A.vendors(spark, d), A.codes(spark, d))


@query("vendor_other")
def q_vendor_other(spark, d):
    return prep.other_codes(A.vendors(spark, d), A.codes(spark, d))


@query("price_band")
def q_price_band(spark, d):
    it = A.items(spark, d).select("item_id", "code", "unit_price")
    out = prep.price_band(it, A.bands(spark, d))
    return out.withColumn(
        "in_band", (F.col("unit_price") >= F.col("price_lo")) & (F.col("unit_price") <= F.col("price_hi"))
    )


@query("template_fill")
def q_template_fill(spark, d):
    """Two description templates per code (none for the last subclass → default)."""
    c = A.codes(spark, d)
    last = c.agg(F.max("code_level_2")).scalar()
    t = c.where(F.col("code_level_2") != last)
    templates = t.select(
        "code", F.lit(1).alias("template_no"), F.concat(F.lit("{adj} "), "noun", F.lit(", "), "adj", F.lit(" finish")).alias("template")
    ).unionByName(
        t.select("code", F.lit(2).alias("template_no"), F.concat("name", F.lit(" ({adj} grade)")).alias("template"))
    )
    it = A.table(spark, d, "part").select(
        F.format_string("ITM-%05d", "p_partkey").alias("item_id"),
        F.lower("p_type").alias("adj"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("_a"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("_n"),
    ).join(c.select(F.col("adj").alias("_a"), F.col("noun").alias("_n"), "code"), ["_a", "_n"])
    default = F.concat(F.lit("Catalogue item for "), F.col("code"), F.lit(" ({adj})"))
    return prep.fill_templates(it, templates, "adj", default)


@query("item_ids")
def q_item_ids(spark, d):
    return prep.item_ids(A.table(spark, d, "part"), "p_partkey")


@query("date_offset")
def q_date_offset(spark, d):
    it = A.items(spark, d).select("item_id", "created_date")
    return prep.date_offset(it, "created_date", "2024-06-01")


# --- SQL-native features ------------------------------------------------------------

@query("tokens")
def q_tokens(spark, d):
    return A.items(spark, d).select("item_id", F.posexplode(tokens("product_description")).alias("pos", "token"))


@query("tokens_clean")
def q_tokens_clean(spark, d):
    return A.docs(spark, d).select(
        "item_id", F.posexplode(features.clean_tokens("product_description")).alias("pos", "token")
    )


@query("ngrams")
def q_ngrams(spark, d):
    tok = A.items(spark, d).select("item_id", features.clean_tokens("product_description").alias("t"))
    return tok.select("item_id", F.posexplode(features.ngrams(F.col("t"))).alias("pos", "term"))


@query("vocab_topk")
def q_vocab_topk(spark, d):
    return features.top_terms(features.terms(A.docs(spark, d)), C.VOCAB_SIZE)


@query("vocab_exact_summaries")
def q_vocab_exact_summaries(spark, d):
    """The vocabulary from mergeable summaries and exact counts of their candidates."""
    return heavy.vocabulary(A.docs(spark, d), C.VOCAB_SIZE)


@query("term_freq")
def q_term_freq(spark, d):
    docs = A.docs(spark, d)
    return features.term_freq(docs, features.vocabulary(docs).select("term"))


@query("idf")
def q_idf(spark, d):
    return features.fit_text(A.docs(spark, d)).withColumn("idf", F.round("idf", 9))


@query("tfidf")
def q_tfidf(spark, d):
    docs = A.docs(spark, d)
    return features.tfidf(docs, features.fit_text(docs)).withColumn("weight", F.round("weight", 9))


@query("tfidf_apply")
def q_tfidf_apply(spark, d):
    """Vocabulary fitted on the training items, applied to the routed new items."""
    fitted = features.fit_text(A.labeled(spark, d))
    return features.tfidf(gate.route(A.scored(spark, d)), fitted).withColumn("weight", F.round("weight", 9))


@query("vendor_onehot")
def q_vendor_onehot(spark, d):
    vi = features.vendor_index(A.labeled(spark, d))
    return features.vendor_onehot(A.scored(spark, d), vi)


@query("price_z")
def q_price_z(spark, d):
    fx = A.fx(spark)
    train = features.price_eur(A.labeled(spark, d), fx)
    new = features.price_eur(A.scored(spark, d), fx)
    out = features.price_z(new, features.price_stats(train))
    return out.select("item_id", F.round("price_eur", 9).alias("price_eur"), F.round("price_z", 9).alias("price_z"))


# --- order lines as new items: vendors and words that training has not seen ---

def _line_classified(spark, d) -> DataFrame:
    return flows.classified_flow(A.line_scored(spark, d), A.line_responses(spark, d))


@query("lines_classified")
def q_lines_classified(spark, d):
    """Both tiers over every order line."""
    return _line_classified(spark, d)


@query("lines_signals")
def q_lines_signals(spark, d):
    return monitor.signals(_line_classified(spark, d)).select(
        "n_total", "n_ml", "n_llm", "n_fallback", "avg_confidence", "fallback_pct", "override_pct"
    )


@query("lines_vendor_onehot")
def q_lines_vendor_onehot(spark, d):
    """Training vendors' slots for order lines; a vendor unseen in training has none."""
    return features.vendor_onehot(A.line_scored(spark, d), features.vendor_index(A.labeled(spark, d)))


@query("lines_tfidf")
def q_lines_tfidf(spark, d):
    """Vocabulary of the training items on routed order lines, with words it does not know."""
    fitted = features.fit_text(A.labeled(spark, d))
    return features.tfidf(gate.route(A.line_scored(spark, d)), fitted).withColumn("weight", F.round("weight", 9))


@query("split_strat")
def q_split_strat(spark, d):
    return features.split_strat(A.labeled(spark, d), "code", C.TRAIN_TEST_FRACTION).select("item_id", "code", "is_test")


@query("split_strat_docs")
def q_split_strat_docs(spark, d):
    return features.split_strat(A.docs(spark, d), "code", C.RETRAIN_TEST_FRACTION).select("item_id", "code", "is_test")


@query("label_codes")
def q_label_codes(spark, d):
    lc = features.label_codes(A.labeled(spark, d))
    return A.labeled(spark, d).select("item_id", "code").join(lc, "code")


@query("top_class")
def q_top_class(spark, d):
    e = A.table(spark, d, "embeddings").select("vec_id", "embedding")
    return gate.top_class(e, "embedding").select("vec_id", "best_index", "best_prob")


@query("lines_price_z")
def q_lines_price_z(spark, d):
    """Prices of order lines on the scale of the training items."""
    fx = A.fx(spark)
    stats = features.price_stats(features.price_eur(A.labeled(spark, d), fx))
    out = features.price_z(features.price_eur(A.line_scored(spark, d), fx), stats)
    return out.select("item_id", "price_eur", F.round("price_z", 9).alias("price_z"))


@query("lines_answer_contract")
def q_lines_answer_contract(spark, d):
    """Reason code of every answer under the strict contract."""
    return contract.reasons(A.line_answer_forms(spark, d), A.codes(spark, d))


@query("lines_contract_report")
def q_lines_contract_report(spark, d):
    return contract.report(contract.reasons(A.line_answer_forms(spark, d), A.codes(spark, d)))


#: without vendor and guess, so that lines of one part share their prompt
SHORT_PROMPT = "Code for: {text}"


def _line_ledger(spark, d):
    """Prompts of the routed order lines, and a ledger of a run that answered those with an even key before it
    died; a stored answer that is no JSON is an error there."""
    lines = A.line_scored(spark, d).select("item_id", "k", COLS.text, COLS.predicted, COLS.confidence, COLS.truth)
    routed = sinks.written_once(gate.route(lines), "line_routed")
    prompts = answers.prompts(routed.select("item_id", COLS.predicted, COLS.text), A.codes(spark, d), template=SHORT_PROMPT)
    prompts = sinks.written_once(ledger.with_digest(prompts), "line_prompts")
    done = routed.where(F.col("k") % 2 == 0).select("item_id").join(A.stored(routed), "item_id")
    failed = F.col("response") == "not json"
    entries = prompts.join(done, "item_id").select(
        ledger.DIGEST, F.when(~failed, F.col("response")).alias("response"),
        F.when(failed, F.lit("ValueError: not json")).alias("error_message"),
    )
    return prompts, sinks.written_once(entries, "line_entries")  # a ledger is a table, too


@query("lines_ledger_pending")
def q_lines_ledger_pending(spark, d):
    """What a second start of the run asks: prompts without an answer, each once."""
    return ledger.pending(*_line_ledger(spark, d)).select(ledger.DIGEST, "prompt", "n_items")


@query("lines_ledger_answers")
def q_lines_ledger_answers(spark, d):
    """Every routed line with its prompt's entry of the ledger."""
    return ledger.to_items(*_line_ledger(spark, d))


@query("lines_rescore_plan")
def q_lines_rescore_plan(spark, d):
    """Order lines that a run has to score again: the table of the run before lacks some, had other prices for
    some, and holds some of an older model."""
    from . import incremental as I

    k, price = F.col("k"), F.col(COLS.price)
    now = A.line_scored(spark, d)
    before = now.where(k % 50 != 1).withColumn(COLS.price, F.when(k % 20 == 0, price + 1).otherwise(price))
    manifest = before.select(
        "item_id", I.content_digest(I.content()).alias(I.DIGEST),
        F.when(k % 30 == 7, F.lit("1")).otherwise(F.lit("2")).alias(I.SCORED_BY),
    )
    return I.to_rescore(now, manifest, "2", I.content())


# --- registry over rule models --------------------------------------------------------

def _rule_runs(spark, d) -> DataFrame:
    """Accuracy of three rule models that need no training, in candidate order:
    the stored classifier guess, the lexical answerer, the vendor's most common code."""
    from . import registry_queries as R

    return R.rule_runs(spark, d)


@query("model_runs")
def q_model_runs(spark, d):
    return _rule_runs(spark, d)


@query("select_best")
def q_select_best(spark, d):
    from ..models import registry

    return registry.select_best(_rule_runs(spark, d))


@query("latest_version")
def q_latest_version(spark, d):
    """Numeric maximum of text versions."""
    from ..models import registry
    from . import registry_queries as R

    return registry.latest(R.version_history(spark, d))


@query("alias_upsert")
def q_alias_upsert(spark, d):
    from . import registry_queries as R

    return R.aliases_after(spark, d)


@query("resolve_alias")
def q_resolve_alias(spark, d):
    from ..models import registry
    from . import registry_queries as R

    return registry.resolve(R.aliases_after(spark, d), _rule_runs(spark, d), C.CHAMPION)


@query("promotion")
def q_promotion(spark, d):
    from . import registry_queries as R

    return R.promotion_check(spark, d)


def all_queries() -> dict[str, Query]:
    from . import model_queries  # noqa: F401  (registers the model-training queries)

    return dict(QUERIES)

