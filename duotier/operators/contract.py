"""Strict answer contract: why an answer is not what was asked for.

`from_json` gives the same NULL for a missing field, a wrong type and broken
text, and drops unknown or repeated fields in silence.  Here the answer is read
as a VARIANT, whose own types are compared, and each answer gets the first
reason that applies:

`no_answer`        NULL or blank
`duplicate_field`  a name stands twice in the object
`not_json`         no JSON value, or text before or after it
`not_object`       another JSON value
`missing_field`    a field of the contract is not there
`unknown_field`    a field is there that the contract has not
`null_field`       a field is null
`wrong_type`       a field has another type
`empty_code`       the code is blank
`unknown_code`     the code is not one of `codes`, where these are given
`ok`               none of these

`field` names the first field concerned, in the contract's order (unknown and
repeated ones by name).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import COLS

#: field → type, as `schema_of_variant` names it
CONTRACT = {"iso_code": "STRING", "reason": "STRING", "agrees_with_ml": "BOOLEAN"}


def _only_value(text: Column) -> Column:
    """`{"v": text}` as a VARIANT, NULL unless `text` is one JSON value and nothing else.

    The parser stops after the first value, so text that follows is found by
    putting brackets round it: what closes one kind early breaks the other."""
    boxed = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    return F.when(listed.isNotNull(), boxed)


def reasons(
    responses: DataFrame,
    codes: DataFrame | None = None,
    contract: dict[str, str] = CONTRACT,
    code_field: str = "iso_code",
    id_col: str = COLS.id,
) -> DataFrame:
    """(id, reason, field) per answer, row by row; `codes` adds one join on the code."""
    names = list(contract)
    text, v, keys = F.col("response"), F.col("_v"), F.col("_keys")
    df = responses.select(id_col, "response")
    df = df.withColumns({"_v": _only_value(text), "_keys": F.json_object_keys(text)})
    at = {f: F.try_variant_get(v, f"$.v['{f}']", "variant") for f in names}
    df = df.withColumns({f"_t_{f}": F.schema_of_variant(at[f]) for f in names})
    df = df.withColumn("_code", F.try_variant_get(v, f"$.v['{code_field}']", "string"))
    kind = {f: F.col(f"_t_{f}") for f in names}

    def first(conditions: dict) -> Column:
        """The first name whose condition holds, else NULL."""
        return F.coalesce(*[F.when(c, F.lit(f)) for f, c in conditions.items()])

    repeated = F.array_min(F.filter(keys, lambda k: F.size(F.filter(keys, lambda o: o == k)) > 1))
    unknown = F.array_min(F.array_except(keys, F.array(*map(F.lit, names))))
    missing = first({f: ~F.array_contains(keys, f) for f in names})
    null = first({f: kind[f] == "VOID" for f in names})
    wrong = first({f: kind[f] != t for f, t in contract.items()})
    blank = lambda c: F.trim(c) == ""
    checks = [  # reason, whether it applies, field
        ("no_answer", text.isNull() | blank(text), None),
        ("duplicate_field", repeated.isNotNull(), repeated),
        ("not_json", v.isNull(), None),
        ("not_object", keys.isNull(), None),
        ("missing_field", missing.isNotNull(), missing),
        ("unknown_field", unknown.isNotNull(), unknown),
        ("null_field", null.isNotNull(), null),
        ("wrong_type", wrong.isNotNull(), wrong),
        ("empty_code", blank(F.col("_code")), F.lit(code_field)),
    ]
    if codes is not None:
        known = codes.select(F.col("code").alias("_known")).distinct()
        df = df.join(known, F.col("_code") == F.col("_known"), "left")
        checks.append(("unknown_code", F.col("_known").isNull(), F.lit(code_field)))
    verdict = F.lit(None).cast("struct<reason:string,field:string>")
    for reason, applies, field in reversed([*checks, ("ok", F.lit(True), None)]):
        field = F.lit(None).cast("string") if field is None else field
        verdict = F.when(applies, F.struct(F.lit(reason).alias("reason"), field.alias("field"))).otherwise(verdict)
    return df.select(id_col, verdict.alias("_r")).select(id_col, "_r.reason", "_r.field")


def report(judged: DataFrame) -> DataFrame:
    """Answers per reason and field."""
    return judged.groupBy("reason", "field").agg(F.count(F.lit(1)).alias("n_answers"))
