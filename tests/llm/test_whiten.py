import math

import numpy as np
import pytest
from conftest import SF
from duotier.llm import whiten as W
from duotier.llm.queries import QUERIES


def plain(rows, components=16):
    """{(vec_id, component): row} by a dense eigendecomposition, and the number of vectors that take part."""
    ok = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dims = max((len(v) for _, v in ok), default=0)
    xs = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v] + [1_000_000] * (dims - len(v))) for i, v in ok]
    fit = np.array(sorted({tuple(x) for _, x in xs}), dtype=object)
    n, s = len(fit), fit.sum(axis=0)
    centred = (n * fit - s).astype(float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    out = []
    for i, x in xs:
        off = n * np.array(x, dtype=object) - s
        z = (off.astype(float) / n) @ vectors[:, order] / np.sqrt(values[order])
        out += [(i, k + 1, n, int((off * off).sum()), z[k], values[order[k]] / values.sum()) for k in range(len(order))]
    return out


def compare(got, want):
    def key(r):
        return (r[0] is not None, r[0] or 0, r[1], r[3], abs(r[4]))

    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    g, w = np.array([r[4] for r in got]), np.array([r[4] for r in want])
    component = np.array([r[1] for r in got])
    for c in np.unique(component):
        a, b = g[component == c], w[component == c]
        sign = np.sign(a @ b)
        assert np.abs(a - sign * b).max() < 1e-8
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-10, atol=0)
    assert len({r[6] for r in got}) == 1 and got[0][6] < 1e-9


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "y") for i, v in rows], "vec_id long, embedding array<float>, label int, x string")


def test_query_equals_a_dense_decomposition(spark):
    want = plain([(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF['tiny']}/embeddings.parquet").collect()])
    compare(QUERIES["op12_whitening"](spark, SF["tiny"]).collect(), want)


def test_edge_cases(spark):
    rng = np.random.default_rng(3)
    rows = [(k, [float(np.float32(c)) for c in rng.normal(size=5) * [5, 3, 2, 1, 0.5]]) for k in range(60)]
    rows += [(61, None), (62, [1.0, None, 0.0, 0.0, 0.0]), (63, [math.nan, 1.0, 1.0, 1.0, 1.0]), (64, [math.inf] * 5)]
    rows += [(3, rows[3][1]), (None, rows[4][1]), (70, [0.5, 0.25]), (71, []), (72, rows[5][1])] + [(80, [0.0] * 5)] * 30
    compare(W.whiten(frame(spark, rows)).collect(), plain(rows))
    few = W.whiten(frame(spark, rows), components=2)
    assert few.columns == "vec_id component n deviation whitened explained identity_error".split()
    compare(few.collect(), plain(rows, 2))


def test_directions_without_variance_are_no_components(spark):
    rng = np.random.default_rng(4)
    rows = [(k, [float(a), float(b), float(a), 2.0, float(a + b)]) for k, (a, b) in enumerate(rng.integers(-9, 9, (40, 2)))]
    got = W.whiten(frame(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2} and got[0].identity_error < 1e-9
    assert abs(sum({r.component: r.explained for r in got}.values()) - 1) < 1e-12
    assert W.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert W.whiten(frame(spark, [(1, None), (2, [])])).count() == 0
    assert W.whiten(frame(spark, [])).count() == 0


def test_equal_eigenvalues_are_all_found(spark):
    rows = [(2 * k + (s > 0), [s * 3.0 if i == k else 0.0 for i in range(6)]) for k in range(6) for s in (-1, 1)]
    got = W.whiten(frame(spark, rows)).collect()
    assert {r.component for r in got} == set(range(1, 7))
    assert np.allclose([r.explained for r in got], 1 / 6, rtol=1e-12)
    assert got[0].identity_error < 1e-9


def test_deviations_are_exact_beyond_doubles(spark):
    model = W.Whitening(3, [10, -7], np.eye(2), np.ones(2), 1.0)
    assert model.deviations(np.array([[1 << 20, -5], [0, 0]])) == [(3 * (1 << 20) - 10) ** 2 + 64, 149]
    big = W.Whitening(10**9, [0, 1], np.eye(2), np.ones(2), 1.0)
    assert big.deviations(np.array([[2, 1], [10**6, 0]])) == [4 * 10**18 + (10**9 - 1) ** 2, None]


def test_lanczos_vectors_stay_orthogonal(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 24)) @ np.diag(10.0 ** -np.linspace(0, 3, 24)) * 1e5
    rows = W.whole_vectors(frame(spark, [(k, v.tolist()) for k, v in enumerate(x)]))
    table = W.blocks(rows, 24)
    n, sums = W.column_sums(table, 24)
    vs, b = W.bidiagonalise(table, np.array(sums) / n)
    assert np.abs(vs.T @ vs - np.eye(24)).max() < 1e-13
    a = np.floor(64 * np.float32(x).astype(float)) - np.array(sums) / n
    assert np.allclose(np.linalg.svd(b, compute_uv=False), np.linalg.svd(a, compute_uv=False), rtol=1e-9)
    assert np.count_nonzero(b) == 47


@pytest.mark.parametrize("part", [1, 5])
def test_blocks_do_not_change_the_sums(spark, part, monkeypatch):
    rows = W.whole_vectors(spark.read.parquet(f"{SF['tiny']}/embeddings.parquet"))
    want = W.column_sums(W.blocks(rows, 64), 64)
    assert W.column_sums(W.blocks(rows.repartition(part), 64), 64) == want
