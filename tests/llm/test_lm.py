import collections
import math

import pytest
from duotier.llm import lm as L

import edge


def plain(rows):
    train, pairs, tokens = collections.Counter(), collections.Counter(), []
    for doc_id, text in rows:
        w = (text or "").encode().lower().split() + [b"\n"]
        tokens.append(w)
        if not L.is_held_out(doc_id):
            train.update(w)
            pairs.update(zip([b"\t", *w], w))
    n, v = sum(train.values()), len(train)
    once, twice = (sum(c == k for c in train.values()) for k in (1, 2))
    d = once / (once + 2 * twice) if once and twice else 0.5
    out = []
    for (doc_id, _), w in zip(rows, tokens):
        score, state = 0.0, b"\t"
        for x in w:
            p = (train[x] - d) / n if train[x] else d * v / n if n else 1.0
            seen = train[b"\n"] if state == b"\t" else train[state]
            score += math.log10((pairs[state, x] + L.MU * p) / (seen + L.MU))
            state = x
        base = sum(math.log10((train[x] + 1) / (n + v + 1)) for x in w)
        out.append((doc_id, L.is_held_out(doc_id), len(w), sum(train[x] > 0 for x in w), n, base, score))
    return out


def check(got, want):
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    got, want = sorted((tuple(r) for r in got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


@pytest.mark.parametrize("size", [30, 1_000_000])
def test_edge_rows_match_brute_force(spark, size):
    check(L.score(edge.docs(spark), size).collect(), plain([r[:2] for r in edge.ROWS]))


def test_given_tables_and_held_out_gain(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = L.score(df, 20_000).collect()
    check(got, plain([(r.doc_id, r.text) for r in df.collect()]))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_arcs_of_a_state_add_up_to_one():
    import numpy as np

    words = np.array([3, 2, 0, 5, 1])  # training counts; number 0 is the end, number 2 unknown
    a = L.Automaton(words, (11, 4, 1, 1))
    pair = np.array([1, 0, 0, 3, 1])  # after word 3, seen 5 times
    arcs = 10 ** a.weights(np.full(5, 3), np.arange(5), pair)
    assert arcs.sum() == pytest.approx(1.0)


def test_without_training_rows_and_empty(spark):
    held = next(i for i in range(100) if L.is_held_out(i))
    df = spark.createDataFrame([(held, "a b"), (held, None)], "doc_id long, text string")
    check(L.score(df).collect(), plain([(held, "a b"), (held, None)]))
    assert L.score(edge.docs(spark, empty=True)).collect() == []
