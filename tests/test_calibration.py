"""Curve, threshold and pooling against plain loops, at every number of ranges; the report against counting."""

from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from duotier.operators import calibration as K
from duotier.operators import report as R


def frame(spark, rows):
    return spark.createDataFrame(rows, "c double, ok boolean")


def grouped(rows):
    out = {}
    for c, ok in rows:
        if c is not None and c == c:
            n, good = out.get(c, (0, 0))
            out[c] = (n + 1, good + bool(ok))
    return sorted((c, n, good) for c, (n, good) in out.items())


def pooled(values):
    """Isotonic shares by their definition: greatest least mean."""
    out = []
    for i in range(len(values)):
        means = []
        for j in range(i + 1):
            stretch = [Fraction(sum(v[2] for v in values[j : k + 1]), sum(v[1] for v in values[j : k + 1])) for k in range(i, len(values))]
            means.append(min(stretch))
        out.append(max(means))
    return out


def check(spark, rows, ranges):
    values = grouped(rows)
    per = K.counts(frame(spark, rows), "c", F.col("ok"))
    assert sorted(map(tuple, per.collect())) == values
    total = sum(v[1] for v in values)
    want = []
    for c, _, _ in values:
        n = sum(v[1] for v in values if v[0] >= c)
        wrong = n - sum(v[2] for v in values if v[0] >= c)
        want.append((c, n, wrong, n / total, wrong / n))
    curve = K.curve(per, ranges)
    assert sorted(map(tuple, curve.collect())) == want
    got = sorted(map(tuple, K.calibrate(per, ranges).collect()))
    assert [r[:3] for r in got] == values
    assert [r[3] for r in got] == [float(x) for x in pooled(values)]
    wanted = [0.0, 0.3, 1.0]
    for r in K.thresholds(curve, wanted).collect():
        least = min((w for w in want if w[4] <= r.wanted_error), default=None)
        assert (r.threshold, r.n_accepted) == ((least[0], least[1]) if least else (None, None))


@pytest.mark.parametrize("ranges", [1, 2, 7, 64])
def test_any_number_of_ranges(spark, ranges):
    rows = [(((k * 37) % 50) / 50, (k * k) % 7 > (k % 50) % 4) for k in range(230)] + [(0.5, False)] * 90 + [(None, True), (float("nan"), True), (0.9, None)]
    check(spark, rows, ranges)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 12).map(lambda x: x / 12), st.booleans()), min_size=1, max_size=60))
def test_random_rows(spark, rows):
    check(spark, rows, 5)


def test_empty(spark):
    per = K.counts(frame(spark, []), "c", F.col("ok"))
    assert K.curve(per).count() == 0 and K.calibrate(per).count() == 0
    assert [tuple(r) for r in K.thresholds(K.curve(per), [0.1]).collect()] == [(0.1, None, None, None, None)]


def test_curve_windows_stay_in_ranges(spark):
    per = K.counts(frame(spark, [(k / 100, True) for k in range(100)]), "c", F.col("ok"))
    plan = K.curve(per)._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(_range" in plan and "BroadcastHashJoin" in plan


def test_report_of_hand_made_rows(spark):
    rows = [("a", "06 03 03", "06 03 03"), ("b", "06 03 03", "06 03 06"), ("c", "06 06 03", "06 03 03"), ("d", "07 01 01", None), ("e", None, "06 03 03"), ("f", "06 03 03", "06 03 03")]
    df = spark.createDataFrame(rows, "item_id string, truth_code string, final_code string")
    got = {(r.level, r.code): tuple(r)[2:] for r in R.per_code(R.confusion(df.drop("truth_code"), df)).collect()}
    assert got[3, "06 03 03"] == (3, 4, 2, 0.5, 2 / 3, 4 / 7)
    assert got[3, "06 03 06"] == (0, 1, 0, 0.0, None, 0.0)
    assert got[3, "06 06 03"] == (1, 0, 0, None, 0.0, 0.0)
    assert got[2, "06 03"] == (3, 5, 3, 0.6, 1.0, 0.75)
    assert got[1, "06"] == (4, 5, 4, 0.8, 1.0, 8 / 9)
    assert got[1, "07"] == (1, 0, 0, None, 0.0, 0.0)
    assert len(got) == 2 + 3 + 4
