"""Column helpers against exact Python arithmetic."""

import random
from decimal import ROUND_HALF_UP, Decimal

from duotier.functions.text import exact_ratio, fixed_text, money_text, tokens


def test_fixed_text_is_exact_half_up(spark):
    rnd = random.Random(11)
    pairs = [(rnd.randint(0, 10**9), rnd.randint(1, 10**6)) for _ in range(400)] + [(1, 8), (5, 2), (1, 3), (2, 3), (0, 7)]
    df = spark.createDataFrame(pairs, "num long, den long")
    got = df.select("num", "den", fixed_text("num", "den", 4).alias("t4"), fixed_text("num", "den", 1).alias("t1")).collect()
    for r in got:
        q = Decimal(r["num"]) / Decimal(r["den"])
        assert r["t4"] == str(q.quantize(Decimal("0.0001"), rounding=ROUND_HALF_UP))
        assert r["t1"] == str(q.quantize(Decimal("0.1"), rounding=ROUND_HALF_UP))


def test_exact_ratio_is_one_division_and_null_on_zero(spark):
    df = spark.createDataFrame([(1, 3), (2, 0), (10, 4)], "a long, b long")
    got = [r[0] for r in df.select(exact_ratio("a", "b")).collect()]
    assert got == [1 / 3, None, 2.5]


def test_money_text_has_two_decimals_without_exponent(spark):
    df = spark.createDataFrame([(12345678.9,), (900.1,), (0.5,)], "p double")
    assert [r[0] for r in df.select(money_text("p")).collect()] == ["12345678.90", "900.10", "0.50"]


def test_tokens_are_lowercase_words_of_two_or_more(spark):
    df = spark.createDataFrame([("Hé llo, Wörld_x 12 a B",)], "t string")
    assert df.select(tokens("t")).first()[0] == ["hé", "llo", "wörld_x", "12"]
