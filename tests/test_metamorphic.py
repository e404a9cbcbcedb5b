"""Metamorphic properties of the gate and merge."""

from conftest import SF
from pyspark.sql import functions as F

from duotier.operators import gate
from duotier.plans import flows
from duotier.sources import adapters as A


def test_accepted_plus_routed_is_input_and_each_item_once(spark):
    s = A.scored(spark, SF["tiny"])
    n = s.count()
    assert gate.accept(s).count() + gate.route(s).count() == n
    out = flows.classified_flow(s, A.responses(spark, SF["tiny"]))
    assert out.count() == n and out.select("item_id").distinct().count() == n


def test_raising_threshold_never_adds_accepted_rows(spark):
    s = A.scored(spark, SF["tiny"])
    counts = [gate.accept(s, t).count() for t in (0.5, 0.7, 0.85, 0.95)]
    assert counts == sorted(counts, reverse=True)


def test_permuting_partitions_changes_nothing(spark):
    s = A.scored(spark, SF["tiny"])
    r = A.responses(spark, SF["tiny"])
    a = sorted(map(tuple, flows.classified_flow(s, r).collect()))
    b = sorted(map(tuple, flows.classified_flow(s.repartition(5, F.rand(3)), r.repartition(3)).collect()))
    assert a == b


def test_gate_rounding_matches_decimal_half_even_on_ties(spark):
    import random
    from decimal import ROUND_HALF_EVEN, Decimal

    rnd = random.Random(5)
    vals = [round(rnd.randint(40000, 99999) / 100000, 5) for _ in range(500)] + [0.84985, 0.84995, 0.84975, 0.85005]
    df = spark.createDataFrame([(f"i{k}", v) for k, v in enumerate(vals)], "item_id string, raw double")
    got = {r["item_id"]: r["ml_confidence"] for r in gate.round_confidence(df, "raw").collect()}
    for k, v in enumerate(vals):
        want = float(Decimal(repr(v)).quantize(Decimal("0.0001"), rounding=ROUND_HALF_EVEN))
        assert got[f"i{k}"] == want
    routed = gate.route(gate.round_confidence(df, "raw").withColumn("ml_predicted_code", F.lit("X")))
    accepted = gate.accept(gate.round_confidence(df, "raw").withColumn("ml_predicted_code", F.lit("X")))
    assert routed.count() + accepted.count() == len(vals)
