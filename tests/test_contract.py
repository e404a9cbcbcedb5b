"""Reason codes of the strict answer contract, one hand-made answer per case."""

import pytest

from duotier.operators import contract

GOOD = '{"iso_code":"A","reason":"r","agrees_with_ml":true}'
CASES = [
    (GOOD, "ok", None),
    ("  " + GOOD + "\n", "ok", None),
    (None, "no_answer", None),
    (" ", "no_answer", None),
    ("nope", "not_json", None),
    (GOOD[:-1], "not_json", None),
    (GOOD + " thanks", "not_json", None),
    (GOOD + GOOD, "not_json", None),
    (GOOD + "," + GOOD, "not_json", None),
    (GOOD + "],[1", "not_json", None),
    (GOOD + "}", "not_json", None),
    ("```json\n" + GOOD + "\n```", "not_json", None),
    ("null", "not_object", None),
    ("[" + GOOD + "]", "not_object", None),
    ('"A"', "not_object", None),
    ("{}", "missing_field", "iso_code"),
    ('{"iso_code":"A","agrees_with_ml":true}', "missing_field", "reason"),
    ('{"iso_code":"A","iso_code":"A","reason":"r","agrees_with_ml":true}', "duplicate_field", "iso_code"),
    (GOOD[:-1] + ',"x":1,"b":{}}', "unknown_field", "b"),
    (GOOD.replace('"r"', "null"), "null_field", "reason"),
    (GOOD.replace("true", '"true"'), "wrong_type", "agrees_with_ml"),
    (GOOD.replace("true", "1"), "wrong_type", "agrees_with_ml"),
    (GOOD.replace('"r"', '["r"]'), "wrong_type", "reason"),
    (GOOD.replace('"A"', "6"), "wrong_type", "iso_code"),
    (GOOD.replace('"A"', '""'), "empty_code", "iso_code"),
    (GOOD.replace('"A"', '"Z"'), "unknown_code", "iso_code"),
]


@pytest.fixture(scope="module")
def judged(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "item_id int, response string")
    codes = spark.createDataFrame([("A",), ("A",), ("B",)], "code string")
    return df, contract.reasons(df, codes)


def test_reason_and_field_of_each_case(judged):
    out = {r["item_id"]: (r["reason"], r["field"]) for r in judged[1].collect()}
    assert [(CASES[i][0], *out[i]) for i in range(len(CASES))] == CASES and len(out) == len(CASES)


def test_without_codes_any_code_is_accepted_and_report_adds_up(spark, judged):
    df, strict = judged
    free = contract.reasons(df)
    assert free.where("reason = 'unknown_code'").count() == 0 and free.where("reason = 'ok'").count() == 3
    assert contract.report(strict).agg({"n_answers": "sum"}).first()[0] == len(CASES)
    assert contract.reasons(df.limit(0)).count() == 0
