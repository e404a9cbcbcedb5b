import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st

from duotier.llm import periodic
from duotier.llm.queries import QUERIES

import edge


def brute(words):
    """Every stretch of equal words at every distance."""
    n, got = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                got.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((a, b - a, q) for (a, b), q in got.items()), key=lambda r: (r[0], r[2]))


def contract(doc_id, text):
    """One row of op13, word by word."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest(),
    )


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 7)), max_size=8), min_size=1, max_size=4))
def test_runs_equal_those_of_all_distances(texts):
    words = [[w for part, times in t for w in part * times] for t in texts]
    ids = np.array([w for t in words for w in t], np.int64)
    assert periodic.runs_of(ids, np.cumsum([len(t) for t in words])) == [brute(t) for t in words]


@pytest.mark.parametrize("period", [1, 2, 3, 127, 128, 129, 300, 1000])
def test_long_periods_take_several_transforms(period):
    rng = np.random.default_rng(period)
    own = rng.integers(0, 1 << 40, period)
    x = np.concatenate([rng.integers(1 << 41, 1 << 42, 77), np.resize(own, 5 * period + 7), rng.integers(1 << 41, 1 << 42, 99)])
    want = [(77, 5 * period + 7, period)]
    assert periodic.runs_of(x, np.array([len(x)])) == [want]


def test_numbers_equal_modulo_the_prime_are_not_equal():
    x = np.arange(12) % 2 + np.arange(12) * periodic.PRIME
    assert periodic.runs_of(x, np.array([12])) == [[]]


def test_one_repeated_word_is_linear_work():
    assert periodic.runs_of(np.zeros(300_000, np.int64), np.array([300_000])) == [[(0, 300_000, 1)]]


def test_transform_is_a_cyclic_correlation():
    rng = np.random.default_rng(5)
    for size in (2, 8, 64, 256):
        t = periodic.transform(size)
        a, b = rng.integers(0, periodic.PRIME, size), rng.integers(0, periodic.PRIME, size)
        got = t.inverse(periodic.reduced(t.apply(a[None].astype(float), t.block) * t.apply(b[None].astype(float), t.forward)))
        want = [sum(int(a[j]) * int(b[(j + k) % size]) for j in range(size)) % periodic.PRIME for k in range(size)]
        assert [int(v) % periodic.PRIME for v in np.rint(periodic.reduced(got))[0]] == want


def test_planted_periods_are_those_of_the_rule(spark):
    words = [f"w{k}" for k in range(57)]
    df = spark.range(400).selectExpr("id AS doc_id", f"'{' '.join(words)}' AS text").union(edge.docs(spark).select("doc_id", "text"))
    got = {(r.doc_id, r.text) for r in periodic.with_repeats(df).collect()}
    changed = 0
    for doc_id in range(400):
        h = zlib.crc32(str(doc_id).encode())
        want = words
        if h % 10 == 0:
            g = h // 10
            a = g % 57
            p = 1 + (57 - a) // (3 + g % 8)
            want = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            changed += 1
        assert (doc_id, " ".join(want)) in got
    assert changed > 20


def test_query_equals_the_contract(spark):
    docs = spark.read.parquet(f"{SF['tiny']}/documents.parquet")
    want = sorted(contract(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 20_000)
    short = docs.where("length(coalesce(text, '')) < 20000")
    assert sorted(map(tuple, periodic.digests(periodic.find(periodic.with_repeats(short))).collect())) == want
    assert sum(r[1] > 0 for r in want) > 5
    assert QUERIES["op13_periodic"](spark, SF["tiny"]).count() == docs.count()


def test_edge_cases(spark):
    def key(r):
        return tuple((v is not None, v) for v in r)

    rows = [(r.doc_id, r.text) for r in edge.docs(spark).collect() if r.text != edge.LONG]
    more = [(20, "a a a a a"), (21, "a a a a a a"), (22, "a b " * 4), (23, "a b a b a b a"), (24, "x a a a a a a y\n" * 5), (25, "Ä ä " * 9)]
    df = edge.docs(spark).where("doc_id IS NULL OR doc_id <> 5").select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    got = sorted(map(tuple, periodic.digests(periodic.find(periodic.with_repeats(df))).collect()), key=key)
    assert got == sorted((contract(*r) for r in rows + more), key=key)
    long = periodic.find(edge.docs(spark).where("doc_id = 5")).first()
    assert [tuple(r) for r in long.runs] == [(0, 24_000, 6)] and long.collapsed == "lorem ipsum dolor sit amet consectetur"
    none = periodic.digests(periodic.find(periodic.with_repeats(edge.docs(spark, empty=True))))
    assert none.count() == 0 and len(none.columns) == 8
