import collections
from fractions import Fraction

import pytest
from duotier.llm import mixing as M
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import edge


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=9))
def test_every_block_is_in_its_window_and_lags_stay_below_one(slots):
    period = sum(slots)
    plan = M.schedule(slots)
    assert sorted(s for _, _, s, _, _ in plan) == list(range(period))
    got = [0] * len(slots)
    for k, i, slot, release, deadline in plan:
        assert i == got[k] and release == i * period // slots[k] and deadline == -(-(i + 1) * period // slots[k])
        assert release <= slot < deadline
        got[k] += 1
        for s, n in enumerate(slots):
            assert abs(got[s] * period - (slot + 1) * n) < period
    assert got == slots


@given(st.lists(st.floats(0.001, 1000), min_size=1, max_size=20))
def test_quotas(weights):
    q = M.quotas(weights, 1000)
    assert sum(q) == 1000 and min(q) >= 1
    assert all(abs(n - 1 - w / sum(weights) * (1000 - len(q))) < 1 for n, w in zip(q, weights))


def plain_starts(rows):
    """Size before each row in its source, by brute force over the operator's own order."""
    out, done = [], collections.Counter()
    for key, source, size in sorted(rows, key=lambda r: r[0]):
        out.append((source, done[source], size))
        done[source] += size
    return collections.Counter(out)


@pytest.mark.parametrize("per_bucket", [1, 20_000])
def test_edge_rows(spark, monkeypatch, per_bucket):
    monkeypatch.setattr(M, "ROWS_PER_BUCKET", per_bucket)
    df = edge.docs(spark)
    got = M.mix(df, block=50).collect()
    assert collections.Counter(tuple(r[: len(df.columns)]) for r in got) == collections.Counter(map(tuple, df.collect()))
    sizes = collections.Counter((r.source, r.mix_start, len(r.text or "")) for r in got)
    for source in {r.source for r in got}:
        at = 0  # rows of a source lie end to end
        for (_, start, size), n in sorted((x for x in sizes.items() if x[0][0] == source), key=lambda x: x[0][1:]):
            assert start == at and (n == 1 or size == 0)
            at += size * n
    for r in got:
        assert r.mix_block == r.mix_start // 50 and r.mix_release <= r.mix_slot < r.mix_deadline
    slots = {(r.mix_slot, r.source, r.mix_block) for r in got}
    assert len({s for s, _, _ in slots}) == len(slots)


def test_weights_hold_until_a_source_ends(spark):
    rows = [(i, "x" * 10, s) for i, s in enumerate(["a"] * 400 + ["b"] * 300 + ["c"] * 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = M.mix(df, {"a": 1.0, "b": 2.0, "c": 5.0}, block=50, period=80).collect()
    n = {"a": 1.0 / 8, "b": 2.0 / 8, "c": 5.0 / 8}
    blocks = {(r.source, r.mix_block, r.mix_slot) for r in got}
    ends = min(max(slot for s, _, slot in blocks if s == x) for x in n)
    for t in range(1, ends + 1):
        for s, share in n.items():
            assert abs(sum(x == s and slot < t for x, _, slot in blocks) - t * share) < 1 + 2 * t / 80


def test_mixed_order_keeps_rows_and_columns(spark):
    df = edge.docs(spark).withColumn("mix_slot", F.lit(5))
    out = M.in_mixed_order(df)
    assert out.columns == df.columns and out.count() == df.count()
    few = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    order = [r.doc_id for r in M.in_mixed_order(few).collect()]
    want = [r.doc_id for r in sorted(M.mix(few).collect(), key=lambda r: (r.mix_slot, r.mix_start))]
    assert order == want


def test_empty(spark):
    assert M.mix(edge.docs(spark, empty=True)).collect() == []
    assert M.in_mixed_order(edge.docs(spark, empty=True)).collect() == []


def test_deviation_from_the_weights_stays_below_one_block():
    for shares in ([0.3333 ** 0.7] + [(0.6667 / 19) ** 0.7] * 19, [1.0, 1e-4, 0.37, 0.2], [1 / (k + 1) for k in range(300)]):
        slots, blocks = M.fractions(shares), 20_000
        w = [Fraction(x) / sum(map(Fraction, shares)) for x in shares]
        assert [Fraction(n, sum(slots)) for n in slots] == w
        plan = M.schedule(slots, [int(blocks * x) + 1 for x in w])
        got = [0] * len(w)
        for k, i, slot, release, deadline in plan:
            assert i == got[k] and release == i // w[k] and deadline == -(-(i + 1) // w[k])
            assert release <= slot < deadline
            got[k] += 1
        assert len({p[2] for p in plan}) == len(plan) and got == [int(blocks * x) + 1 for x in w]


def test_twenty_sources_keep_the_default_weights(spark):
    sizes = {f"s{k:02}": 6000 if not k else 630 for k in range(20)}
    rows = [(i, "x" * 10, s) for i, (s, n) in enumerate((s, n) for s, n in sizes.items() for _ in range(n))]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = M.mix(df, block=10).select("source", "mix_slot").collect()
    total = sum(n**0.7 for n in sizes.values())
    slots = {s: sorted(r.mix_slot for r in got if r.source == s) for s in sizes}
    ends = min(v[-1] for v in slots.values())
    for s, n in sizes.items():
        share = n**0.7 / total
        for i, slot in enumerate(slots[s]):
            if slot < ends:
                assert abs(i - slot * share) < 1 + 1e-6 and abs(i + 1 - (slot + 1) * share) < 1 + 1e-6


def test_order_is_the_same_at_every_number_of_buckets(spark, monkeypatch):
    df = spark.createDataFrame([(i, "x" * (i % 7 + 1), "a") for i in range(200)], "doc_id long, text string, source string")
    starts = []
    for per_bucket in (1, 20, 20_000):
        monkeypatch.setattr(M, "ROWS_PER_BUCKET", per_bucket)
        starts.append({r.doc_id: r.mix_start for r in M.mix(df).collect()})
    assert starts[0] == starts[1] == starts[2]


def test_inner_names_as_columns(spark):
    df = edge.named(edge.docs(spark))
    got = M.in_mixed_order(df)
    assert edge.intact(got, df.columns) and got.count() == len(edge.ROWS)
    mixed = M.mix(df)
    assert mixed.count() == len(edge.ROWS) and set(mixed.columns) == set(df.columns) | set(M.OWN)
