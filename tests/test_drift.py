"""Distances of hand-made windows, parts of a window, and sketches within their error."""

import math

from conftest import SF
from pyspark.sql import functions as F

from duotier.operators import drift as D
from duotier.plans.queries import _event_windows

ROWS = [
    ("2024-01-01", "1", "a", 1.0), ("2024-01-01", "1", "a", 2.0), ("2024-01-01", "1", "b", 3.0), ("2024-01-01", "1", "b", 4.0),
    ("2024-01-02", "1", "a", 1.0), ("2024-01-02", "1", "c", 4.0), ("2024-01-02", "1", None, None), ("2024-01-02", "1", None, 5.0),
    ("2024-01-04", "1", "a", 1.0), ("2024-01-04", "1", "b", 3.0),
    ("2024-01-02", "2", "z", 7.0), ("2024-01-05", "2", "z", None),
]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "day string, v string, prediction string, measure double")
    return D.windowed(df.withColumn("ts", F.to_timestamp("day")), "ts", "v", "prediction", "measure")


def test_hand_made_windows(spark):
    got = {(str(r.bucket), r.model_version, r.reference): r for r in D.drift(frame(spark, ROWS)).collect()}
    assert set(got) == {(d, v, r) for d, v in (("2024-01-02", "1"), ("2024-01-04", "1"), ("2024-01-05", "2")) for r in ("previous", "baseline")}
    second = got["2024-01-02", "1", "previous"]
    assert (second.n, second.n_ref) == (4, 4) and second.tv == 0.75
    share = lambda p, q: (p * math.log(2 * p / (p + q)) if p else 0) + (q * math.log(2 * q / (p + q)) if q else 0)
    assert abs(second.js - (share(0.25, 0.5) + share(0.25, 0) + share(0.5, 0) + share(0, 0.5)) / 2) < 1e-9
    assert abs(second.ks - 5 / 12) < 1e-9  # up to 3: all but one of four against one of three
    assert got["2024-01-04", "1", "baseline"].tv == 0.0 and got["2024-01-04", "1", "baseline"].js == 0.0
    assert got["2024-01-04", "1", "baseline"].ks == 0.25
    last = got["2024-01-05", "2", "previous"]
    assert last.tv == 0.0 and last.ks is None
    assert D.drift(frame(spark, [])).count() == 0


def test_order_and_partitions_do_not_matter(spark):
    want = sorted(map(str, D.drift(frame(spark, ROWS)).collect()))
    assert sorted(map(str, D.drift(frame(spark, ROWS[::-1]).repartition(7)).collect())) == want


def test_sketches_are_within_their_error(spark):
    rows = _event_windows(spark, SF["small"])
    exact = {tuple(r)[:3]: r.ks for r in D.measure_drift(rows).collect()}
    for k, points in ((D.SKETCH_K, D.POINTS), (200, 100)):
        got = {tuple(r)[:3]: r.ks for r in D.sketch_drift(D.sketches(rows, k), points).collect()}
        assert set(got) == set(exact)
        assert max(abs(got[w] - exact[w]) for w in got) <= D.sketch_error(k, points)
    halves = [D.sketches(rows.where(F.col("measure").cast("int") % 2 == k)) for k in (0, 1)]
    whole = D.merged(halves[0].unionByName(halves[1]))
    got = {tuple(r)[:3]: r.ks for r in D.sketch_drift(whole).collect()}
    assert max(abs(got[w] - exact[w]) for w in got) <= D.sketch_error()
