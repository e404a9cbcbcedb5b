"""DuckDB SQL equal to each registered query (the correctness oracle).

The parquet tables are views named after the tables.  Every statement starts
with the adapter views below, written independently of the Spark code (plain
window functions where Spark uses the distributed rank).
"""

from __future__ import annotations

from .. import config as C
from ..operators.features import english_stop_words

PAT = r"'[\p{L}\p{N}_]{2,}'"
T = C.CONFIDENCE_THRESHOLD
RUN_TS = "TIMESTAMP '2024-06-01 00:00:00'"


def _dbl(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _tok(text: str) -> str:
    return f"regexp_extract_all(lower({text}), {PAT})"


def _stop_list() -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in english_stop_words()) + "]"


def _clean(text: str) -> str:
    return f"list_filter({_tok(text)}, lambda x: NOT list_contains({_stop_list()}, x))"


def _ngrams(t: str) -> str:
    return (
        f"list_concat({t}, CASE WHEN len({t}) >= 2 THEN "
        f"list_transform(range(1, len({t})), lambda i: {t}[i] || ' ' || {t}[i + 1]) ELSE [] END)"
    )


def _fixed(num: str, den: str, digits: int) -> str:
    scale = 10**digits
    q = f"((({num}) * {2 * scale} + ({den})) // (2 * ({den})))"
    return f"(CAST({q} // {scale} AS VARCHAR) || '.' || lpad(CAST({q} % {scale} AS VARCHAR), {digits}, '0'))"


FX_VALUES = ", ".join(f"('{c}', {_dbl(r)})" for c, r in C.FX_TO_EUR)

BASE = f"""
codes_v AS (
  SELECT concat('06 ', nr, ' ', ar) AS code, concat(noun, ' ', adj) AS name, concat('06 ', nr) AS code_level_2,
         TRUE AS in_standard, concat('Catalogue entry for ', noun, ' of kind ', adj) AS description, adj, noun
  FROM (SELECT adj, noun,
               lpad(CAST(3 * dense_rank() OVER (ORDER BY noun) AS VARCHAR), 2, '0') AS nr,
               lpad(CAST(3 * dense_rank() OVER (ORDER BY adj) AS VARCHAR), 2, '0') AS ar
        FROM (SELECT DISTINCT split_part(p_name, ' ', 1) AS adj, split_part(p_name, ' ', 2) AS noun FROM part) w) r
),
items_v AS (
  SELECT printf('ITM-%05d', p.p_partkey) AS item_id, p.p_brand AS vendor_name,
         concat(p.p_name, ' ', lower(p.p_type)) AS product_description,
         CAST(p.p_retailprice AS DOUBLE) AS unit_price,
         split_part('EUR,USD,ISK,SEK,NOK,DKK,GBP,CHF', ',', CAST(p.p_size % 8 + 1 AS INTEGER)) AS currency,
         n.n_name AS vendor_country, CAST('2024-01-01' AS DATE) + p.p_size AS created_date,
         c.code AS code, p.p_partkey AS k
  FROM part p JOIN nation n ON n.n_nationkey = p.p_partkey % 25
  JOIN codes_v c ON c.adj = split_part(p.p_name, ' ', 1) AND c.noun = split_part(p.p_name, ' ', 2)
),
scored_v AS (
  SELECT item_id, vendor_name, product_description, unit_price, currency, k,
         CASE WHEN k % 7 = 0 THEN (SELECT min(code) FROM codes_v) ELSE code END AS ml_predicted_code,
         round_even({_dbl(0.4)} + {_dbl(0.6)} * ((k * 7919 + 13) % 99991) / {_dbl(99991.0)}, 4) AS ml_confidence,
         code AS truth_code
  FROM items_v
),
routed_v AS (SELECT * FROM scored_v WHERE ml_confidence < {_dbl(T)}),
resp_v AS (
  SELECT item_id,
         CASE WHEN k % 11 = 0 THEN 'not json'
              WHEN k % 13 = 0 THEN '{{"reason":"no code"}}'
              ELSE concat('{{"iso_code":"', truth_code, '","reason":"name match","agrees_with_ml":',
                          CASE WHEN truth_code = ml_predicted_code THEN 'true' ELSE 'false' END, '}}') END AS response
  FROM routed_v
),
parsed_v AS (
  SELECT item_id,
         CASE WHEN json_valid(response) THEN response->>'$.iso_code' END AS llm_code,
         CASE WHEN json_valid(response) THEN response->>'$.reason' END AS llm_reason,
         TRY_CAST(CASE WHEN json_valid(response) THEN response->>'$.agrees_with_ml' END AS BOOLEAN) AS llm_agrees
  FROM resp_v
),
resolved_v AS (
  SELECT r.item_id, r.vendor_name, r.product_description, r.unit_price, r.currency, r.ml_predicted_code,
         r.ml_confidence, p.llm_code, p.llm_agrees,
         coalesce(p.llm_code, r.ml_predicted_code) AS final_code,
         CASE WHEN p.llm_code IS NOT NULL THEN 'llm_fallback' ELSE 'ml_classifier_fallback' END AS classification_method,
         {_dbl(C.ROUTED_CONFIDENCE)} AS final_confidence,
         nullif(p.llm_reason, 'None') AS llm_reason
  FROM routed_v r LEFT JOIN parsed_v p USING (item_id)
),
classified_v AS (
  SELECT item_id, vendor_name, product_description, unit_price, currency, ml_predicted_code, ml_confidence,
         ml_predicted_code AS final_code, 'ml_classifier' AS classification_method, ml_confidence AS final_confidence,
         {RUN_TS} AS scored_at, '1' AS model_version, CAST(NULL AS VARCHAR) AS llm_reason
  FROM scored_v WHERE ml_confidence >= {_dbl(T)}
  UNION ALL
  SELECT item_id, vendor_name, product_description, unit_price, currency, ml_predicted_code, ml_confidence,
         final_code, classification_method, final_confidence, {RUN_TS}, '1', llm_reason
  FROM resolved_v
),
corr_v AS (
  SELECT item_id, ml_predicted_code AS predicted_code, truth_code AS corrected_code,
         CAST('2024-03-01' AS DATE) AS correction_date, 'expert_a' AS corrector_name FROM scored_v WHERE k % 50 = 0
  UNION ALL
  SELECT item_id, ml_predicted_code, (SELECT max(code) FROM codes_v), CAST('2024-04-01' AS DATE), 'expert_b'
  FROM scored_v WHERE k = 50
  UNION ALL
  SELECT 'ITM-UNKNOWN', '06 03 03', '06 03 06', CAST('2024-03-02' AS DATE), 'expert_a'
),
labeled_v AS (
  SELECT item_id, vendor_name, product_description, unit_price, currency, vendor_country, created_date, code FROM items_v
),
fx_v AS (SELECT * FROM (VALUES {FX_VALUES}) t(currency, to_eur)),
bands_v AS (
  SELECT code_level_2 AS subclass,
         CAST(CAST(substr(code_level_2, 4, 2) AS INTEGER) * 10 AS DOUBLE) AS lo,
         CAST(CAST(substr(code_level_2, 4, 2) AS INTEGER) * 100 AS DOUBLE) AS hi
  FROM (SELECT DISTINCT code_level_2 FROM codes_v) s
  WHERE code_level_2 <> (SELECT max(code_level_2) FROM codes_v)
),
vendors_v AS (
  SELECT p_brand AS vendor_name,
         ['06 ' || lpad(CAST(((CAST(split_part(p_brand, '#', 2) AS INTEGER)) % 8 + 1) * 3 AS VARCHAR), 2, '0'),
          '06 ' || lpad(CAST(((CAST(split_part(p_brand, '#', 2) AS INTEGER) + 3) % 8 + 1) * 3 AS VARCHAR), 2, '0')]
           AS specialties
  FROM (SELECT DISTINCT p_brand FROM part) b
),
docs_v AS (
  SELECT doc_id AS item_id, source AS vendor_name, text AS product_description,
         CAST(n_chars AS DOUBLE) AS unit_price, 'EUR' AS currency, lang AS code
  FROM documents
)"""


def _q(body: str, extra: str = "") -> str:
    return f"WITH {BASE}{(',' + extra) if extra else ''}\n{body}"


def _exact_avg(col: str, cond: str | None = None, decimals: int = 4) -> str:
    scale = 10**decimals
    v = f"CAST(round({col} * {float(scale)!r}) AS BIGINT)"
    if cond:
        return (
            f"CAST(sum(CASE WHEN {cond} THEN {v} END) AS DOUBLE) / "
            f"nullif(count(*) FILTER (WHERE ({cond}) AND {col} IS NOT NULL) * {scale}, 0)"
        )
    return f"CAST(sum({v}) AS DOUBLE) / nullif(count({col}) * {scale}, 0)"


def _ratio(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) / nullif({den}, 0)"


SIGNALS = f"""
signals_v AS (
  SELECT count(*) AS n_total,
         count(*) FILTER (WHERE classification_method = 'ml_classifier') AS n_ml,
         count(*) FILTER (WHERE classification_method = 'llm_fallback') AS n_llm,
         count(*) FILTER (WHERE classification_method = 'ml_classifier_fallback') AS n_fallback,
         coalesce({_exact_avg('ml_confidence', "classification_method = 'ml_classifier'")}, 0.0) AS avg_confidence,
         {_ratio("100 * count(*) FILTER (WHERE classification_method IS DISTINCT FROM 'ml_classifier')", 'count(*)')} AS fallback_pct,
         coalesce({_ratio("100 * count(*) FILTER (WHERE classification_method = 'llm_fallback' AND final_code IS DISTINCT FROM ml_predicted_code)", "count(*) FILTER (WHERE classification_method = 'llm_fallback')")}, 0.0) AS override_pct,
         sum(CASE WHEN classification_method = 'ml_classifier' THEN CAST(round(ml_confidence * 10000.0) AS BIGINT) END) AS conf_sum_e4,
         count(*) FILTER (WHERE classification_method = 'ml_classifier' AND ml_confidence IS NOT NULL) AS conf_n,
         count(*) FILTER (WHERE classification_method IS DISTINCT FROM 'ml_classifier') AS n_not_ml
  FROM classified_v
),
flags_v AS (
  SELECT avg_confidence, fallback_pct, override_pct,
         avg_confidence < {_dbl(C.AVG_CONFIDENCE_FLOOR)} AS conf_drift,
         coalesce(fallback_pct > {_dbl(C.FALLBACK_PCT_CEILING)}, FALSE) AS volume_drift,
         coalesce(override_pct > {_dbl(C.OVERRIDE_PCT_CEILING)}, FALSE) AS override_alarm
  FROM signals_v
),
decision_v AS (
  SELECT *, (SELECT count(*) FROM corr_v) AS n_corrections,
         (conf_drift OR volume_drift) AND (SELECT count(*) FROM corr_v) >= {C.MIN_CORRECTIONS} AS retrain,
         greatest({C.MIN_CORRECTIONS} - (SELECT count(*) FROM corr_v), 0) AS shortfall
  FROM flags_v
)"""


def _lexical(src: str) -> str:
    """Lexical answers (item_id, response) for the rows of view `src`."""
    return f"""
lx_it AS (SELECT DISTINCT item_id, ml_predicted_code, token
          FROM (SELECT item_id, ml_predicted_code, unnest({_tok('product_description')}) AS token FROM {src}) x),
lx_ct AS (SELECT DISTINCT code, token
          FROM (SELECT code, unnest({_tok("concat_ws(' ', name, description)")}) AS token FROM codes_v) x),
lx_sc AS (SELECT i.item_id, i.ml_predicted_code, c.code, count(*) AS score
          FROM lx_it i JOIN lx_ct c USING (token) GROUP BY ALL),
lx_best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, code) AS rn FROM lx_sc) b
            WHERE rn = 1),
lx_ans AS (
  SELECT s.item_id,
         CASE WHEN b.code IS NOT NULL THEN concat('{{"iso_code":"', b.code, '","reason":"', CAST(b.score AS VARCHAR),
              ' shared terms","agrees_with_ml":', CASE WHEN b.code = b.ml_predicted_code THEN 'true' ELSE 'false' END, '}}')
         END AS response
  FROM {src} s LEFT JOIN lx_best b USING (item_id)
)"""


def _zero_shot(labels: str) -> str:
    """Best label per item for a label view (label, description, ordinal)."""
    return f"""
zs_lt AS (SELECT DISTINCT label, ordinal, token
          FROM (SELECT label, ordinal, unnest({_tok("concat_ws(' ', label, description)")}) AS token FROM {labels}) x),
zs_rt AS (SELECT DISTINCT item_id, token FROM (SELECT item_id, unnest({_tok('product_description')}) AS token FROM items_v) x),
zs_sc AS (SELECT r.item_id, l.label, l.ordinal, count(*) AS score FROM zs_rt r JOIN zs_lt l USING (token) GROUP BY ALL),
zs_best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, ordinal) AS rn FROM zs_sc) b
            WHERE rn = 1)"""


def _terms(src: str) -> str:
    t = _clean("product_description")
    return f"""
tm_tok AS (SELECT item_id, {t} AS t FROM {src}),
tm AS (SELECT item_id, unnest({_ngrams('t')}) AS term FROM tm_tok)"""


TFIDF_DOCS = f"""{_terms('docs_v')},
vocab AS (SELECT term, count(*) AS freq FROM tm GROUP BY term ORDER BY freq DESC, term LIMIT {C.VOCAB_SIZE}),
tf AS (SELECT item_id, term, count(*) AS tf FROM tm WHERE term IN (SELECT term FROM vocab) GROUP BY item_id, term),
idf AS (SELECT term, count(*) AS df,
               ln((1.0::DOUBLE + (SELECT count(*) FROM docs_v)) / (1.0::DOUBLE + count(*))) + 1.0::DOUBLE AS idf
        FROM tf GROUP BY term)"""


def _rule_runs() -> str:
    return f"""{_lexical('scored_v')},
r_counts AS (SELECT vendor_name, code, count(*) AS n FROM labeled_v GROUP BY ALL),
r_top AS (SELECT vendor_name, code AS majority_code FROM (
            SELECT *, row_number() OVER (PARTITION BY vendor_name ORDER BY n DESC, code) AS rn FROM r_counts) x WHERE rn = 1),
r_raw AS (
  SELECT 1 AS version, 1 AS ordinal, 'stored_guess' AS algorithm, count(*) AS n,
         count(*) FILTER (WHERE coalesce(ml_predicted_code = truth_code, FALSE)) AS n_correct FROM scored_v
  UNION ALL
  SELECT 2, 2, 'lexical', count(*),
         count(*) FILTER (WHERE coalesce(CASE WHEN json_valid(l.response) THEN l.response->>'$.iso_code' END = s.truth_code, FALSE))
  FROM scored_v s LEFT JOIN lx_ans l USING (item_id)
  UNION ALL
  SELECT 3, 3, 'vendor_majority', count(*), count(*) FILTER (WHERE coalesce(t.majority_code = s.truth_code, FALSE))
  FROM scored_v s LEFT JOIN r_top t USING (vendor_name)
),
runs AS (SELECT version, ordinal, algorithm, n, n_correct, {_ratio('n_correct', 'n')} AS accuracy FROM r_raw),
history AS (SELECT DISTINCT CAST(k % 12 + 1 AS VARCHAR) AS version FROM scored_v),
best AS (SELECT algorithm AS best_algorithm, version AS best_version FROM runs ORDER BY accuracy DESC, ordinal LIMIT 1),
aliases AS (
  SELECT 'Champion' AS alias, CAST((SELECT best_version FROM best) AS INTEGER) AS version
  UNION ALL
  SELECT 'Challenger', (SELECT max(CAST(version AS INTEGER)) FROM history)
)"""


SQL: dict[str, str] = {}

SQL["taxonomy"] = _q("SELECT code, name, code_level_2, in_standard, description FROM codes_v")
SQL["conform_output"] = _q(
    """SELECT * REPLACE (CASE WHEN classification_method = 'ml_classifier_fallback' THEN NULL ELSE llm_reason END AS llm_reason)
FROM classified_v"""
)
SQL["table_counts"] = _q(
    """SELECT 'codes' AS table_name, count(*) AS n_rows FROM codes_v
UNION ALL SELECT 'labeled_items', count(*) FROM labeled_v
UNION ALL SELECT 'new_items', count(*) FROM scored_v
UNION ALL SELECT 'corrections', count(*) FROM corr_v"""
)
SQL["price_eur"] = _q(
    f"""SELECT i.item_id, i.unit_price, i.currency, i.unit_price * coalesce(f.to_eur, {_dbl(C.UNKNOWN_FX_RATE)}) AS price_eur
FROM items_v i LEFT JOIN fx_v f ON i.currency = f.currency"""
)
_RAW = f"({_dbl(0.4)} + {_dbl(0.6)} * ((k * 7919 + 13) % 99991) / {_dbl(99991.0)})"
SQL["ml_confidence"] = _q(
    f"""SELECT item_id, {_RAW} AS raw_confidence, round_even({_RAW}, 4) AS ml_confidence,
       round_even({_RAW}, 4) < {_dbl(T)} AS routed FROM items_v"""
)
SQL["gate_accept"] = _q(f"SELECT item_id, ml_predicted_code, ml_confidence FROM scored_v WHERE ml_confidence >= {_dbl(T)}")
SQL["gate_route"] = _q("SELECT item_id, ml_predicted_code, ml_confidence FROM routed_v")
SQL["accept_branch"] = _q(
    f"""SELECT item_id, ml_predicted_code AS final_code, 'ml_classifier' AS classification_method,
       ml_confidence AS final_confidence FROM scored_v WHERE ml_confidence >= {_dbl(T)}"""
)
SQL["gate_report"] = _q(
    f"""SELECT count(*) AS n_total, count(*) FILTER (WHERE ml_confidence >= {_dbl(T)}) AS n_accepted,
       count(*) FILTER (WHERE ml_confidence < {_dbl(T)}) AS n_routed,
       {_ratio(f'100 * count(*) FILTER (WHERE ml_confidence >= {_dbl(T)})', 'count(*)')} AS pct_accepted,
       {_ratio(f'100 * count(*) FILTER (WHERE ml_confidence < {_dbl(T)})', 'count(*)')} AS pct_routed
FROM scored_v"""
)


def _band_case(col: str) -> str:
    parts = []
    for o, _l, lo, hi, _a in C.CONFIDENCE_BANDS:
        cond = []
        if lo is not None:
            cond.append(f"{col} >= {_dbl(lo)}")
        if hi is not None:
            cond.append(f"{col} < {_dbl(hi)}")
        parts.append(f"WHEN {' AND '.join(cond)} THEN {o}")
    return "CASE " + " ".join(parts) + " END"


_BANDS = ", ".join(f"({o}, '{label}', '{action}')" for o, label, _lo, _hi, action in C.CONFIDENCE_BANDS)
SQL["confidence_bands"] = _q(
    f"""SELECT b.band_order, b.band, coalesce(c.n, 0) AS n,
       {_ratio('100 * coalesce(c.n, 0)', 'sum(coalesce(c.n, 0)) OVER ()')} AS pct, b.action
FROM (VALUES {_BANDS}) b(band_order, band, action)
LEFT JOIN (SELECT {_band_case('ml_confidence')} AS band_order, count(*) AS n FROM scored_v GROUP BY 1) c USING (band_order)"""
)
SQL["confidence_summary"] = _q(
    f"""SELECT count(*) AS n, {_exact_avg('ml_confidence')} AS mean_confidence,
       count(*) FILTER (WHERE ml_confidence < {_dbl(T)}) AS n_below,
       {_ratio(f'100 * count(*) FILTER (WHERE ml_confidence < {_dbl(T)})', 'count(*)')} AS pct_below
FROM scored_v"""
)
SQL["code_hierarchy"] = _q("SELECT code, substr(code, 1, 2) AS class_code, substr(code, 1, 5) AS subclass FROM codes_v")

_LINE = "concat('- ', code, ': ', coalesce(name, ''), ' — ', coalesce(description, ''))"
BLOCK = f"block_v AS (SELECT string_agg({_LINE}, chr(10) ORDER BY code) AS reference FROM codes_v)"
SQL["reference_block"] = _q("SELECT reference FROM block_v", BLOCK)
SQL["llm_prompts"] = _q(
    """SELECT r.item_id, concat('Pick the one code that fits a purchase line.', chr(10), chr(10), 'Codes:', chr(10),
  (SELECT string_agg(concat('- ', code, ': ', name, ' — ', description), chr(10) ORDER BY code) FROM codes_v), chr(10), chr(10),
  'Line: ', coalesce(r.product_description, ''), chr(10), 'Sold by: ', coalesce(r.vendor_name, ''), chr(10),
  'Paid: ', coalesce(CAST(CAST(r.unit_price AS DECIMAL(18,2)) AS VARCHAR), ''), ' ', coalesce(r.currency, ''), chr(10),
  'A classifier guessed ', coalesce(r.ml_predicted_code, ''), ' and is ',
  coalesce(CAST(round(CAST(r.ml_confidence AS DECIMAL(8,4)), 2) AS VARCHAR), ''), ' sure.', chr(10), chr(10),
  'Reply in JSON: iso_code, reason, agrees_with_ml.') AS prompt
FROM routed_v r"""
)
SQL["llm_answers"] = _q("SELECT item_id, response FROM lx_ans", _lexical("routed_v"))
SQL["llm_validate"] = _q(
    """SELECT item_id,
       coalesce(CASE WHEN json_valid(response) THEN (response->>'$.iso_code') IS NOT NULL END, FALSE) AS valid_code,
       coalesce(CASE WHEN json_valid(response) THEN (response->>'$.iso_code') IS NOT NULL
                     AND (response->>'$.reason') IS NOT NULL
                     AND json_type(response, '$.agrees_with_ml') = 'BOOLEAN' END, FALSE) AS valid_full
FROM resp_v"""
)
SQL["llm_parse"] = _q("SELECT item_id, llm_code, llm_reason, llm_agrees FROM parsed_v")
SQL["llm_branch"] = _q(
    """SELECT item_id, ml_predicted_code, llm_code, final_code, classification_method, final_confidence, llm_reason
FROM resolved_v"""
)
SQL["llm_parse_report"] = _q(
    """SELECT count(*) AS n_routed, count(*) FILTER (WHERE llm_code IS NOT NULL) AS n_parsed, count(*) FILTER (WHERE llm_code IS NULL) AS n_failed,
       count(*) FILTER (WHERE llm_code IS NOT NULL AND coalesce(llm_agrees, FALSE)) AS n_agreed,
       count(*) FILTER (WHERE llm_code IS NOT NULL AND NOT coalesce(llm_agrees, FALSE)) AS n_overrode
FROM resolved_v"""
)
SQL["llm_lexical_branch"] = _q(
    f"""SELECT r.item_id, coalesce(p.code, r.ml_predicted_code) AS final_code,
       CASE WHEN p.code IS NOT NULL THEN 'llm_fallback' ELSE 'ml_classifier_fallback' END AS classification_method,
       {_dbl(C.ROUTED_CONFIDENCE)} AS final_confidence, nullif(p.reason, 'None') AS llm_reason
FROM routed_v r LEFT JOIN (SELECT item_id, response->>'$.iso_code' AS code, response->>'$.reason' AS reason FROM lx_ans) p
USING (item_id)""",
    _lexical("routed_v"),
)
SQL["zero_shot"] = _q(
    "SELECT i.item_id, b.label, b.score FROM items_v i LEFT JOIN zs_best b USING (item_id)",
    """zs_lab0 AS (SELECT upper(noun[1]) || lower(noun[2:]) || 's' AS label,
                   'parts: ' || noun || ' in ' || string_agg(DISTINCT adj, ' ' ORDER BY adj) AS description
            FROM codes_v GROUP BY noun),
zs_lab AS (SELECT label, description, dense_rank() OVER (ORDER BY label) AS ordinal FROM zs_lab0),"""
    + _zero_shot("zs_lab"),
)
SQL["zero_shot_array"] = _q(
    "SELECT i.item_id, b.label, b.score FROM items_v i LEFT JOIN zs_best b USING (item_id)",
    """zs_lab AS (SELECT noun AS label, '' AS description, CAST(dense_rank() OVER (ORDER BY noun) - 1 AS INTEGER) AS ordinal
            FROM (SELECT DISTINCT noun FROM codes_v) x),"""
    + _zero_shot("zs_lab"),
)
SQL["llm_error_mode"] = _q(
    """SELECT r.item_id,
       coalesce(CASE WHEN json_valid(s.response) THEN s.response->>'$.iso_code' END, r.ml_predicted_code) AS final_code,
       CASE WHEN json_valid(s.response) AND (s.response->>'$.iso_code') IS NOT NULL
            THEN 'llm_fallback' ELSE 'ml_classifier_fallback' END AS classification_method,
       NOT json_valid(s.response) AS had_error
FROM routed_v r JOIN resp_v s USING (item_id)"""
)
SQL["classified_items"] = _q("SELECT * FROM classified_v")
SQL["method_counts"] = _q(
    """SELECT classification_method, coalesce(c.n, 0) AS n
FROM (VALUES ('ml_classifier'), ('llm_fallback'), ('ml_classifier_fallback')) m(classification_method)
FULL JOIN (SELECT classification_method, count(*) AS n FROM classified_v GROUP BY 1) c USING (classification_method)"""
)
_ML, _LLM = _dbl(C.COST_ML_PER_ITEM), _dbl(C.COST_LLM_PER_ITEM)
SQL["cost_report"] = _q(
    f"""SELECT n_items, n_routed, round(n_items * {_ML}, 6) AS cost_ml, round(n_routed * {_LLM}, 6) AS cost_llm,
       round(n_items * {_ML} + n_routed * {_LLM}, 6) AS cost_total, round(n_items * {_LLM}, 6) AS cost_all_llm,
       {_ratio('(n_items - n_routed) * 100', 'n_items')} AS pct_llm_calls_saved
FROM (SELECT count(*) AS n_items, count(*) FILTER (WHERE classification_method <> 'ml_classifier') AS n_routed FROM classified_v) x"""
)
SQL["monitor_signals"] = _q(
    "SELECT n_total, n_ml, n_llm, n_fallback, avg_confidence, fallback_pct, override_pct FROM signals_v", SIGNALS
)
SQL["weak_codes"] = _q(
    f"""SELECT final_code, count(ml_confidence) AS n, {_exact_avg('ml_confidence')} AS mean_confidence
FROM classified_v GROUP BY final_code
HAVING {_exact_avg('ml_confidence')} < {_dbl(C.WEAK_CODE_FLOOR)}
ORDER BY mean_confidence, final_code"""
)
SQL["drift_flags"] = _q("SELECT * FROM flags_v", SIGNALS)
SQL["retrain_decision"] = _q(
    "SELECT conf_drift, volume_drift, n_corrections, retrain, shortfall FROM decision_v", SIGNALS
)
SQL["status_line"] = _q(
    f"""SELECT d.retrain,
       CASE WHEN d.retrain THEN 'RETRAIN:YES' ELSE 'RETRAIN:NO' END
       || '|AVG_CONF:' || CASE WHEN s.conf_n > 0 THEN {_fixed('s.conf_sum_e4', 's.conf_n * 10000', 4)} ELSE '0.0000' END
       || '|LOW_PCT:' || CASE WHEN s.n_total > 0 THEN {_fixed('s.n_not_ml * 100', 's.n_total', 1)} ELSE 'nan' END
       || '|CORRECTIONS:' || CAST(d.n_corrections AS VARCHAR) AS status
FROM signals_v s, decision_v d""",
    SIGNALS,
)
SQL["eval_hybrid"] = _q(
    f"""SELECT count(*) AS n,
       {_ratio('count(*) FILTER (WHERE coalesce(c.final_code = t.truth_code, FALSE))', 'count(*)')} AS accuracy,
       count(*) FILTER (WHERE classification_method = 'ml_classifier') AS n_ml,
       {_ratio("count(*) FILTER (WHERE classification_method = 'ml_classifier' AND coalesce(c.final_code = t.truth_code, FALSE))", "count(*) FILTER (WHERE classification_method = 'ml_classifier')")} AS ml_accuracy,
       count(*) FILTER (WHERE classification_method = 'llm_fallback') AS n_llm,
       {_ratio("count(*) FILTER (WHERE classification_method = 'llm_fallback' AND coalesce(c.final_code = t.truth_code, FALSE))", "count(*) FILTER (WHERE classification_method = 'llm_fallback')")} AS llm_accuracy,
       count(*) FILTER (WHERE classification_method = 'llm_fallback' AND c.final_code <> c.ml_predicted_code) AS n_reclassified
FROM classified_v c LEFT JOIN (SELECT item_id, truth_code FROM scored_v) t USING (item_id)"""
)
_CODE_REPORT = f"""pairs_v AS (
  SELECT t.truth_code AS t, c.final_code AS f FROM classified_v c LEFT JOIN (SELECT item_id, truth_code FROM scored_v) t USING (item_id)),
cut_v AS (SELECT l.level, CASE l.level WHEN 1 THEN substr(t, 1, 2) WHEN 2 THEN substr(t, 1, 5) ELSE t END AS t,
                 CASE l.level WHEN 1 THEN substr(f, 1, 2) WHEN 2 THEN substr(f, 1, 5) ELSE f END AS f
          FROM pairs_v, (VALUES (1), (2), (3)) l(level)),
both_v AS (SELECT level, t AS code, count(*) AS support, 0 AS predicted, count(*) FILTER (WHERE t = f) AS hits FROM cut_v WHERE t IS NOT NULL GROUP BY ALL
           UNION ALL SELECT level, f, 0, count(*), 0 FROM cut_v WHERE f IS NOT NULL GROUP BY ALL)"""
SQL["code_report"] = _q(
    f"""SELECT level, code, support, predicted, n_correct, {_ratio('n_correct', 'predicted')} AS precision,
       {_ratio('n_correct', 'support')} AS recall, {_ratio('2 * n_correct', 'support + predicted')} AS f1
FROM (SELECT level, code, CAST(sum(support) AS BIGINT) AS support, CAST(sum(predicted) AS BIGINT) AS predicted,
             CAST(sum(hits) AS BIGINT) AS n_correct FROM both_v GROUP BY level, code) x""",
    _CODE_REPORT,
)
_BY_CONFIDENCE = """byc AS (SELECT ml_confidence AS confidence, count(*) AS n, count(*) FILTER (WHERE ml_predicted_code = truth_code) AS n_correct
         FROM scored_v WHERE ml_confidence IS NOT NULL GROUP BY ml_confidence),
run AS (SELECT confidence, CAST(sum(n) OVER w AS BIGINT) AS n_accepted, CAST(sum(n - n_correct) OVER w AS BIGINT) AS n_wrong,
               CAST((SELECT sum(n) FROM byc) AS BIGINT) AS total FROM byc WINDOW w AS (ORDER BY confidence DESC))"""
SQL["risk_curve"] = _q(
    f"""SELECT confidence, n_accepted, n_wrong, {_ratio('n_accepted', 'total')} AS coverage, {_ratio('n_wrong', 'n_accepted')} AS risk FROM run""",
    _BY_CONFIDENCE,
)
SQL["risk_threshold"] = _q(
    f"""SELECT w.e AS wanted_error, r.confidence AS threshold, r.n_accepted, {_ratio('r.n_accepted', 'r.total')} AS coverage,
       {_ratio('r.n_wrong', 'r.n_accepted')} AS risk
FROM (VALUES {', '.join(f'({_dbl(e)})' for e in C.WANTED_ERRORS)}) w(e)
LEFT JOIN (SELECT e.e, min(confidence) AS least FROM run, (VALUES {', '.join(f'({_dbl(e)})' for e in C.WANTED_ERRORS)}) e(e)
           WHERE {_ratio('n_wrong', 'n_accepted')} <= e.e GROUP BY e.e) m ON m.e = w.e
LEFT JOIN run r ON r.confidence = m.least""",
    _BY_CONFIDENCE,
)
# greatest, over all beginnings, of the least mean, over all ends, of a stretch that holds the value
SQL["calibrated_confidence"] = _q(
    """SELECT b.confidence, b.n, b.n_correct, m.calibrated FROM byc b JOIN (
  SELECT k AS i, max(least) AS calibrated FROM (
    SELECT p.k AS j, q.k AS k,
           min(CAST(q.ok - p.ok + p.own_ok AS DOUBLE) / CAST(q.n - p.n + p.own_n AS DOUBLE))
             OVER (PARTITION BY p.k ORDER BY q.k DESC) AS least
    FROM pre p JOIN pre q ON p.k <= q.k) x
  GROUP BY k) m ON m.i = (SELECT k FROM pre WHERE pre.confidence = b.confidence)""",
    _BY_CONFIDENCE
    + """,
pre AS (SELECT confidence, row_number() OVER (ORDER BY confidence) AS k, n AS own_n, n_correct AS own_ok,
               sum(n) OVER (ORDER BY confidence) AS n, sum(n_correct) OVER (ORDER BY confidence) AS ok FROM byc)""",
)
SQL["inference_profile"] = _q(
    f"""SELECT CAST(time_bucket(INTERVAL '1 day', ts) AS DATE) AS bucket, CAST(user_id % 3 AS VARCHAR) AS model_version,
       count(*) AS n, count(DISTINCT event_type) AS n_predictions,
       {_ratio('count(*) FILTER (WHERE event_type IS NULL)', 'count(*)')} AS null_rate,
       {_exact_avg('value', decimals=2)} AS mean_measure
FROM events GROUP BY ALL"""
)
SQL["window_drift"] = _q(
    """SELECT p.bucket, p.model_version, p.reference, p.n, p.n_ref, p.tv, p.js, k.ks
FROM pd p LEFT JOIN kd k USING (bucket, model_version, reference)""",
    """ev AS (SELECT CAST(time_bucket(INTERVAL '1 day', ts) AS DATE) AS bucket, CAST(user_id % 3 AS VARCHAR) AS model_version,
       event_type AS prediction, value AS measure FROM events),
refs(kind, bucket, model_version, reference, ref_bucket) AS (
  SELECT kind, bucket, model_version, unnest(['previous', 'baseline']), unnest([previous, baseline]) FROM (
    SELECT *, lag(bucket) OVER (PARTITION BY kind, model_version ORDER BY bucket) AS previous,
           min(bucket) OVER (PARTITION BY kind, model_version) AS baseline
    FROM (SELECT DISTINCT 'p' AS kind, bucket, model_version FROM ev
          UNION ALL SELECT DISTINCT 'm', bucket, model_version FROM ev WHERE measure IS NOT NULL) w) x
  WHERE previous IS NOT NULL),
pc AS (SELECT r.bucket, r.model_version, r.reference, e.prediction, count(*) FILTER (WHERE e.bucket = r.bucket) AS a,
              count(*) FILTER (WHERE e.bucket = r.ref_bucket) AS b
       FROM refs r JOIN ev e ON e.model_version = r.model_version AND e.bucket IN (r.bucket, r.ref_bucket) WHERE r.kind = 'p' GROUP BY ALL),
pt AS (SELECT *, sum(a) OVER w AS ta, sum(b) OVER w AS tb FROM pc WINDOW w AS (PARTITION BY bucket, model_version, reference)),
pd AS (SELECT bucket, model_version, reference, CAST(max(ta) AS BIGINT) AS n, CAST(max(tb) AS BIGINT) AS n_ref,
              round(CAST(sum(abs(a * tb - b * ta)) AS DOUBLE) / (2.0::DOUBLE * max(ta) * max(tb)), 9) AS tv,
              round(greatest(sum(CASE WHEN a > 0 THEN (a::DOUBLE / ta) * ln(2.0::DOUBLE * (a::DOUBLE / ta) / (a::DOUBLE / ta + b::DOUBLE / tb)) ELSE 0 END
                  + CASE WHEN b > 0 THEN (b::DOUBLE / tb) * ln(2.0::DOUBLE * (b::DOUBLE / tb) / (a::DOUBLE / ta + b::DOUBLE / tb)) ELSE 0 END) / 2.0::DOUBLE,
                  0.0::DOUBLE), 9) AS js
       FROM pt GROUP BY ALL),
mc AS (SELECT r.bucket, r.model_version, r.reference, e.measure, count(*) FILTER (WHERE e.bucket = r.bucket) AS a,
              count(*) FILTER (WHERE e.bucket = r.ref_bucket) AS b
       FROM refs r JOIN ev e ON e.model_version = r.model_version AND e.bucket IN (r.bucket, r.ref_bucket)
       WHERE r.kind = 'm' AND e.measure IS NOT NULL GROUP BY ALL),
mt AS (SELECT bucket, model_version, reference, sum(a) OVER w AS ca, sum(b) OVER w AS cb,
              sum(a) OVER t AS ta, sum(b) OVER t AS tb
       FROM mc WINDOW w AS (PARTITION BY bucket, model_version, reference ORDER BY measure), t AS (PARTITION BY bucket, model_version, reference)),
kd AS (SELECT bucket, model_version, reference,
              round(CAST(max(abs(ca * tb - cb * ta)) AS DOUBLE) / (CAST(max(ta) AS DOUBLE) * CAST(max(tb) AS DOUBLE)), 9) AS ks FROM mt GROUP BY ALL)""",
)
SQL["classified_profile"] = _q(
    f"""SELECT CAST(time_bucket(INTERVAL '1 day', scored_at) AS DATE) AS bucket, model_version,
       count(*) AS n, count(DISTINCT final_code) AS n_predictions,
       {_ratio('count(*) FILTER (WHERE final_code IS NULL)', 'count(*)')} AS null_rate,
       {_exact_avg('final_confidence')} AS mean_measure
FROM classified_v GROUP BY ALL"""
)

FIRST_CLASSIFIED = """fc AS (SELECT DISTINCT ON (item_id) item_id, vendor_name, product_description, unit_price, currency
       FROM classified_v ORDER BY item_id, vendor_name, product_description, unit_price, currency)"""
_CORR_SELECT = """SELECT c.item_id, f.vendor_name, f.product_description, f.unit_price, f.currency,
       CAST(NULL AS VARCHAR) AS vendor_country, CAST(NULL AS DATE) AS created_date, c.corrected_code AS code"""
SQL["augment_kept"] = _q(
    "SELECT item_id, code FROM labeled_v l WHERE NOT EXISTS (SELECT 1 FROM corr_v c WHERE c.item_id = l.item_id)"
)
SQL["augment_corrected"] = _q(f"{_CORR_SELECT}\nFROM corr_v c JOIN fc f USING (item_id)", FIRST_CLASSIFIED)
SQL["augment_latest"] = _q(
    f"""{_CORR_SELECT}
FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY correction_date DESC, corrected_code DESC) AS rn
                     FROM corr_v) x WHERE rn = 1) c
JOIN fc f USING (item_id)""",
    FIRST_CLASSIFIED,
)
SQL["augment_report"] = _q(
    """SELECT count(*) AS n_corrections, count(*) FILTER (WHERE f.item_id IS NOT NULL) AS n_applied, count(*) FILTER (WHERE f.item_id IS NULL) AS n_unknown_id
FROM corr_v c LEFT JOIN fc f USING (item_id)""",
    FIRST_CLASSIFIED,
)
SQL["augmented_training"] = _q(
    f"""SELECT item_id, vendor_name, product_description, unit_price, currency, vendor_country, created_date, code
FROM labeled_v l WHERE NOT EXISTS (SELECT 1 FROM corr_v c WHERE c.item_id = l.item_id)
UNION ALL
{_CORR_SELECT}
FROM corr_v c JOIN fc f USING (item_id)""",
    FIRST_CLASSIFIED,
)
SQL["label_top10"] = _q("SELECT code, count(*) AS n FROM labeled_v GROUP BY code ORDER BY n DESC, code LIMIT 10")
SQL["label_summary"] = _q("SELECT count(*) AS n_rows, count(DISTINCT code) AS n_labels FROM labeled_v")
SQL["vendor_specialty"] = _q(
    """SELECT v.vendor_name, c.code
FROM (SELECT DISTINCT vendor_name, unnest(specialties) AS code_level_2 FROM vendors_v) v JOIN codes_v c USING (code_level_2)"""
)
SQL["vendor_other"] = _q(
    "SELECT v.vendor_name, c.code FROM vendors_v v JOIN codes_v c ON NOT list_contains(v.specialties, c.code_level_2)"
)
SQL["price_band"] = _q(
    f"""SELECT item_id, code, unit_price, subclass, price_lo, price_hi,
       unit_price >= price_lo AND unit_price <= price_hi AS in_band
FROM (SELECT i.item_id, i.code, i.unit_price, substr(i.code, 1, 5) AS subclass,
             coalesce(b.lo, {_dbl(C.DEFAULT_PRICE_BAND[0])}) AS price_lo, coalesce(b.hi, {_dbl(C.DEFAULT_PRICE_BAND[1])}) AS price_hi
      FROM items_v i LEFT JOIN bands_v b ON substr(i.code, 1, 5) = b.subclass) x"""
)
SQL["template_fill"] = _q(
    """SELECT it.item_id, it.code, t.template_no,
       replace(coalesce(t.template, 'Catalogue item for ' || it.code || ' ({adj})'), '{adj}', it.adj) AS description
FROM it LEFT JOIN tpl t USING (code)""",
    """tpl AS (
  SELECT code, 1 AS template_no, '{adj} ' || noun || ', ' || adj || ' finish' AS template FROM codes_v
  WHERE code_level_2 <> (SELECT max(code_level_2) FROM codes_v)
  UNION ALL
  SELECT code, 2, name || ' ({adj} grade)' FROM codes_v WHERE code_level_2 <> (SELECT max(code_level_2) FROM codes_v)
),
it AS (SELECT printf('ITM-%05d', p.p_partkey) AS item_id, lower(p.p_type) AS adj, c.code
       FROM part p JOIN codes_v c ON c.adj = split_part(p.p_name, ' ', 1) AND c.noun = split_part(p.p_name, ' ', 2))""",
)
SQL["item_ids"] = _q("SELECT p_partkey, printf('ITM-%05d', p_partkey) AS item_id FROM part")
SQL["date_offset"] = _q(
    """SELECT item_id, created_date, CAST(date_diff('day', created_date, DATE '2024-06-01') AS INTEGER) AS days_ago,
       created_date - 365 AS year_before FROM items_v"""
)
SQL["tokens"] = _q(
    f"""SELECT item_id, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS pos, unnest(t) AS token
FROM (SELECT item_id, {_tok('product_description')} AS t FROM items_v) x"""
)
SQL["tokens_clean"] = _q(
    f"""SELECT item_id, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS pos, unnest(t) AS token
FROM (SELECT item_id, {_clean('product_description')} AS t FROM docs_v) x"""
)
SQL["ngrams"] = _q(
    f"""SELECT item_id, CAST(generate_subscripts(g, 1) - 1 AS INTEGER) AS pos, unnest(g) AS term
FROM (SELECT item_id, {_ngrams('t')} AS g FROM (SELECT item_id, {_clean('product_description')} AS t FROM items_v) a) x"""
)
SQL["vocab_topk"] = _q("SELECT term, freq FROM vocab", TFIDF_DOCS)
SQL["vocab_exact_summaries"] = _q("SELECT v.term, v.freq, i.df FROM vocab v JOIN idf i USING (term)", TFIDF_DOCS)
SQL["term_freq"] = _q("SELECT item_id, term, tf FROM tf", TFIDF_DOCS)
SQL["idf"] = _q("SELECT term, df, round(idf, 9) AS idf FROM idf", TFIDF_DOCS)
SQL["tfidf"] = _q(
    """SELECT item_id, term, tf,
       round(tf * idf / sqrt(sum((tf * idf) * (tf * idf)) OVER (PARTITION BY item_id)), 9) AS weight
FROM tf JOIN idf USING (term)""",
    TFIDF_DOCS,
)
SQL["tfidf_apply"] = _q(
    f"""SELECT item_id, term, tf,
       round(tf * idf / sqrt(sum((tf * idf) * (tf * idf)) OVER (PARTITION BY item_id)), 9) AS weight
FROM (SELECT item_id, term, count(*) AS tf FROM ap WHERE term IN (SELECT term FROM vocab) GROUP BY item_id, term) t
JOIN idf USING (term)""",
    f"""{_terms('labeled_v')},
vocab AS (SELECT term, count(*) AS freq FROM tm GROUP BY term ORDER BY freq DESC, term LIMIT {C.VOCAB_SIZE}),
tf0 AS (SELECT item_id, term, count(*) AS tf FROM tm WHERE term IN (SELECT term FROM vocab) GROUP BY item_id, term),
idf AS (SELECT term, ln((1.0::DOUBLE + (SELECT count(*) FROM labeled_v)) / (1.0::DOUBLE + count(*))) + 1.0::DOUBLE AS idf
        FROM tf0 GROUP BY term),
ap_tok AS (SELECT item_id, {_clean('product_description')} AS t FROM routed_v),
ap AS (SELECT item_id, unnest({_ngrams('t')}) AS term FROM ap_tok)""",
)
SQL["vendor_onehot"] = _q(
    """SELECT s.item_id, v.vendor_index, CAST(1.0 AS DOUBLE) AS value
FROM scored_v s JOIN (SELECT vendor_name, dense_rank() OVER (ORDER BY vendor_name) - 1 AS vendor_index
                      FROM (SELECT DISTINCT vendor_name FROM labeled_v) x) v USING (vendor_name)"""
)
SQL["price_z"] = _q(
    f"""SELECT s.item_id, round(s.price_eur, 9) AS price_eur,
       round((s.price_eur - st.mean) / st.scale, 9) AS price_z
FROM pe_new s, (SELECT avg(price_eur) AS mean, CASE WHEN stddev_pop(price_eur) = 0 THEN 1.0::DOUBLE ELSE stddev_pop(price_eur) END AS scale
               FROM pe_train) st""",
    f"""pe_train AS (SELECT l.*, l.unit_price * coalesce(f.to_eur, {_dbl(1.0)}) AS price_eur FROM labeled_v l LEFT JOIN fx_v f USING (currency)),
pe_new AS (SELECT s.*, s.unit_price * coalesce(f.to_eur, {_dbl(1.0)}) AS price_eur FROM scored_v s LEFT JOIN fx_v f USING (currency))""",
)


def _split(src: str, frac: float, id_expr: str) -> str:
    return _q(
        f"""SELECT item_id, code,
       row_number() OVER (PARTITION BY code ORDER BY md5('{C.SEED}' || {id_expr}), item_id)
         <= round({frac!r} * count(*) OVER (PARTITION BY code)) AS is_test
FROM {src}"""
    )


SQL["split_strat"] = _split("labeled_v", C.TRAIN_TEST_FRACTION, "item_id")
SQL["split_strat_docs"] = _split("docs_v", C.RETRAIN_TEST_FRACTION, "CAST(item_id AS VARCHAR)")
SQL["label_codes"] = _q(
    """SELECT l.item_id, l.code, c.label_index FROM labeled_v l
JOIN (SELECT code, CAST(dense_rank() OVER (ORDER BY code) - 1 AS DOUBLE) AS label_index FROM (SELECT DISTINCT code FROM labeled_v) x) c
USING (code)"""
)
SQL["top_class"] = _q(
    """SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS best_index,
       CAST(list_max(embedding) AS DOUBLE) AS best_prob FROM embeddings"""
)
SQL["model_runs"] = _q("SELECT * FROM runs", _rule_runs())
SQL["select_best"] = _q(
    "SELECT best_algorithm, best_version, (SELECT max(accuracy) FROM runs) AS best_accuracy FROM best", _rule_runs()
)
SQL["latest_version"] = _q("SELECT max(CAST(version AS INTEGER)) AS latest_version FROM history", _rule_runs())
SQL["alias_upsert"] = _q("SELECT alias, version FROM aliases", _rule_runs())
SQL["resolve_alias"] = _q(
    "SELECT r.version, a.alias, r.ordinal, r.algorithm, r.n, r.n_correct, r.accuracy FROM aliases a JOIN runs r USING (version) WHERE a.alias = 'Champion'",
    _rule_runs(),
)
SQL["promotion"] = _q(
    """SELECT coalesce(o.accuracy, 0.0) AS old_accuracy, n.accuracy AS new_accuracy,
       n.accuracy >= coalesce(o.accuracy, 0.0) AS promoted,
       CASE WHEN n.accuracy >= coalesce(o.accuracy, 0.0) THEN 'Champion' ELSE 'Challenger' END AS new_alias
FROM (SELECT accuracy FROM runs WHERE version = (SELECT max(version) FROM runs)) n,
     (SELECT max(accuracy) AS accuracy FROM runs WHERE version = 1) o""",
    _rule_runs(),
)

# --- order lines as new items -----------------------------------------------------

LINES = """lines_v AS (
  SELECT 'LN-' || CAST(l_orderkey * 1048576 + l_partkey AS VARCHAR) AS item_id,
         CASE WHEN l_suppkey % 10 = 0 THEN 'Supplier ' || CAST(l_suppkey AS VARCHAR) ELSE p_brand END AS vendor_name,
         concat(p_name, ' ', lower(p_type), ' flag', lower(l_returnflag)) AS product_description,
         CAST(l_extendedprice AS DOUBLE) / CAST(l_quantity AS DOUBLE) AS unit_price,
         split_part('EUR,USD,ISK,SEK,NOK,DKK,GBP,CHF', ',', CAST(p_size % 8 + 1 AS INTEGER)) AS currency,
         c.code AS code, l_orderkey * 1048576 + l_partkey AS k
  FROM (SELECT l_orderkey, l_partkey, min(l_suppkey) AS l_suppkey, min(l_quantity) AS l_quantity,
               min(l_extendedprice) AS l_extendedprice, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY ALL) l
  JOIN part ON l_partkey = p_partkey
  JOIN codes_v c ON c.adj = split_part(p_name, ' ', 1) AND c.noun = split_part(p_name, ' ', 2)
),
"""


def _for_lines(sql: str) -> str:
    """The same statement with order lines in place of the items of `part` as what is scored."""
    before, after = sql.split("scored_v AS (", 1)
    source, rest = after.split("FROM items_v", 1)
    return f"{before}{LINES}scored_v AS ({source}FROM lines_v{rest}"


SQL["lines_classified"] = _for_lines(SQL["classified_items"])
SQL["lines_signals"] = _for_lines(SQL["monitor_signals"])
SQL["lines_vendor_onehot"] = _for_lines(SQL["vendor_onehot"])
SQL["lines_tfidf"] = _for_lines(SQL["tfidf_apply"])
SQL["lines_code_report"] = _for_lines(SQL["code_report"])
SQL["lines_risk_curve"] = _for_lines(SQL["risk_curve"])
SQL["lines_price_z"] = _for_lines(SQL["price_z"]).replace("round(s.price_eur, 9)", "s.price_eur")

_FORM = """'{"iso_code":"' || truth_code || '"""
_FORMS = [
    "'not json'", """'["06 03 03"]'""",
    _FORM + """","reason":"a","agrees_with_ml":true,"reason":"b"}'""",
    _FORM + """","agrees_with_ml":true}'""",
    _FORM + """","reason":"a","agrees_with_ml":true,"score":0.5,"also":{"x":[1]}}'""",
    _FORM + """","reason":"a","agrees_with_ml":"yes"}'""",
    _FORM + """","reason":null,"agrees_with_ml":true}'""",
    """'{"iso_code":"99 99 99","reason":"name match","agrees_with_ml":true}'""",
    """'{"iso_code":" ","reason":"name match","agrees_with_ml":true}'""",
    _FORM + """","reason":"name match","agrees_with_ml":true} as asked'""",
    "''",
]
_GOOD_FORM = _FORM + """","reason":"name match","agrees_with_ml":true}'"""
_FIELDS = {"iso_code": "VARCHAR", "reason": "VARCHAR", "agrees_with_ml": "BOOLEAN"}


def _first_field(condition: str) -> str:
    return "coalesce(" + ", ".join(
        "CASE WHEN " + condition.format(f=f, t=t) + f" THEN '{f}' END" for f, t in _FIELDS.items()) + ")"


CONTRACT = f"""forms AS (
  SELECT item_id, CASE {" ".join(f"WHEN k % 16 = {i} THEN {x}" for i, x in enumerate(_FORMS))}
                       WHEN k % 16 > {len(_FORMS)} THEN {_GOOD_FORM} END AS response
  FROM routed_v),
valid AS (SELECT *, CASE WHEN json_valid(response) THEN response END AS json FROM forms),
named AS (SELECT *, CASE WHEN json_type(json) = 'OBJECT' THEN json_keys(json) END AS names FROM valid),
faults AS (
  SELECT *, list_min(list_filter(names, lambda n: len(list_filter(names, lambda o: o = n)) > 1)) AS repeated,
         {_first_field("NOT list_contains(names, '{f}')")} AS missing,
         list_min(list_filter(names, lambda n: n NOT IN ({", ".join(f"'{f}'" for f in _FIELDS)}))) AS unknown,
         {_first_field("json_type(json, '$.{f}') = 'NULL'")} AS empty,
         {_first_field("json_type(json, '$.{f}') <> '{t}'")} AS wrong
  FROM named),
judged AS (
  SELECT item_id, CASE WHEN response IS NULL OR trim(response) = '' THEN 'no_answer' WHEN repeated IS NOT NULL THEN 'duplicate_field'
    WHEN json IS NULL THEN 'not_json' WHEN names IS NULL THEN 'not_object' WHEN missing IS NOT NULL THEN 'missing_field'
    WHEN unknown IS NOT NULL THEN 'unknown_field' WHEN empty IS NOT NULL THEN 'null_field' WHEN wrong IS NOT NULL THEN 'wrong_type'
    WHEN trim(json->>'$.iso_code') = '' THEN 'empty_code'
    WHEN (json->>'$.iso_code') NOT IN (SELECT code FROM codes_v) THEN 'unknown_code' ELSE 'ok' END AS reason,
    repeated, missing, unknown, empty, wrong
  FROM faults),
contract_v AS (
  SELECT item_id, reason, CASE reason WHEN 'duplicate_field' THEN repeated WHEN 'missing_field' THEN missing
    WHEN 'unknown_field' THEN unknown WHEN 'null_field' THEN empty WHEN 'wrong_type' THEN wrong
    WHEN 'empty_code' THEN 'iso_code' WHEN 'unknown_code' THEN 'iso_code' END AS field
  FROM judged)"""
SQL["lines_answer_contract"] = _for_lines(_q("SELECT * FROM contract_v", CONTRACT))
SQL["lines_contract_report"] = _for_lines(
    _q("SELECT reason, field, count(*) AS n_answers FROM contract_v GROUP BY reason, field", CONTRACT))

LEDGER = """pr AS (SELECT item_id, k, 'Code for: ' || coalesce(product_description, '') AS prompt,
                 sha256('Code for: ' || coalesce(product_description, '')) AS prompt_digest FROM routed_v),
le AS (SELECT prompt_digest, CASE WHEN response <> 'not json' THEN response END AS response,
              CASE WHEN response = 'not json' THEN 'ValueError: not json' END AS error_message
       FROM pr JOIN resp_v USING (item_id) WHERE k % 2 = 0),
settled AS (SELECT prompt_digest, min(response) AS response, CASE WHEN count(response) = 0 THEN min(error_message) END AS error_message
            FROM le GROUP BY prompt_digest)"""
SQL["lines_ledger_pending"] = _for_lines(_q(
    """SELECT prompt_digest, min(prompt) AS prompt, count(*) AS n_items FROM pr
WHERE prompt_digest NOT IN (SELECT prompt_digest FROM le WHERE response IS NOT NULL) GROUP BY prompt_digest""", LEDGER))
SQL["lines_ledger_answers"] = _for_lines(_q(
    "SELECT item_id, prompt_digest, response, error_message FROM pr LEFT JOIN settled USING (prompt_digest)", LEDGER))
SQL["lines_rescore_plan"] = _for_lines(_q(
    """SELECT item_id, CASE WHEN k % 50 = 1 THEN 'new' WHEN k % 20 = 0 THEN 'changed' ELSE 'version' END AS why
FROM scored_v WHERE k % 50 = 1 OR k % 20 = 0 OR k % 30 = 7"""))
