import math

import numpy as np
import pytest
from conftest import SF
from duotier.llm import lattice as L
from duotier.llm.queries import QUERIES


def plain(rows, least=0.98):
    """(vec_id, n_links, component_id, kept) of every row, from all pairs."""
    ok = [
        k for k, (_, v, label) in enumerate(rows)
        if label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v) and any(v)
    ]
    unit = {k: np.array(rows[k][1], float) / np.linalg.norm(np.array(rows[k][1], float)) for k in ok}
    near = {k: [] for k in range(len(rows))}
    for label in {rows[k][2] for k in ok}:
        for size in {len(rows[k][1]) for k in ok}:
            own = [k for k in ok if rows[k][2] == label and len(rows[k][1]) == size]
            if own:
                u = np.array([unit[k] for k in own])
                linked = u @ u.T >= least
                for a, k in enumerate(own):
                    near[k] = [own[b] for b in np.flatnonzero(linked[a]) if b != a]
    out = []
    for k in near:
        seen, todo = {k}, [k]
        while todo:
            for m in near[todo.pop()]:
                if m not in seen:
                    seen.add(m)
                    todo.append(m)
        root = min((rows[m][0] for m in seen if rows[m][0] is not None), default=None)
        out.append((rows[k][0], len(near[k]), root, rows[k][0] == root))
    return out


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is not None, v or 0) for v in r))


def frame(spark, rows, element="float"):
    return spark.createDataFrame([(*r, 1, "z") for r in rows], f"vec_id long, embedding array<{element}>, label int, key int, v string")


def near_copies(rng, dims=64, groups=40):
    """Groups of vectors around a centre, some of whose pairs lie on either side of the threshold."""
    rows = []
    for g in range(groups):
        centre = rng.normal(size=dims)
        for _ in range(int(rng.integers(1, 12))):
            v = centre + rng.normal(size=dims) * rng.choice([0.02, 0.06, 0.1, 0.13])
            rows.append((len(rows), [float(np.float32(c)) for c in v], int(g % 3)))
    return rows


def test_points_are_the_nearest_of_the_lattice():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 8)) * 2
    found = L.nearest_point(x)
    assert (np.abs(2 * found - np.rint(2 * found)) == 0).all() and (found.sum(axis=1) % 2 == 0).all()
    assert all(len({c % 1 for c in p}) == 1 for p in found.tolist())
    # no neighbour is nearer: E8's cells have the 240 walls of its minimal vectors alone
    own = ((x - found) ** 2).sum(axis=1)
    other = ((x[:, None] - found[:, None] - L.ROOTS[None]) ** 2).sum(axis=2).min(axis=1)
    assert (own <= other + 1e-12).all()
    assert len(L.ROOTS) == 240 and np.allclose((L.ROOTS**2).sum(axis=1), 2)


def test_cells_do_not_depend_on_the_batch():
    rng = np.random.default_rng(2)
    u = L.units(rng.normal(size=(300, 64)))
    label = rng.integers(0, 9, 300)
    every = L.cell_keys(u, label)
    for k in (0, 7, 299):
        assert (L.cell_keys(u[k : k + 1], label[k : k + 1])[0] == every[k]).all()
    assert (L.cell_keys(u, label + 1) != every).all()


def test_recall_at_the_threshold_and_selectivity():
    rng = np.random.default_rng(3)
    n = 4000
    u = L.units(rng.normal(size=(n, 64)))
    side = rng.normal(size=(n, 64))
    side = L.units(side - (side * u).sum(axis=1, keepdims=True) * u)
    other = 0.98 * u + math.sqrt(1 - 0.98**2) * side
    label = np.zeros(n, np.int64)
    a, b = L.cell_keys(u, label), L.cell_keys(L.units(other), label)
    most = np.uint64(0xFFFFFFFFFFFFFFFF)
    meet = L.first_meeting(np.concatenate([a, b]), np.arange(n), n + np.arange(n)) != most
    assert meet.mean() > 0.997
    assert (L.first_meeting(a, np.arange(n), np.roll(np.arange(n), 1)) != most).mean() < 0.002


@pytest.mark.parametrize("group", [4, 1024])
def test_links_and_components_equal_all_pairs(spark, group):
    rng = np.random.default_rng(group)
    rows = near_copies(rng)
    hot = rows[0][1]
    for k in range(150):  # one cell of many, in blocks where groups are small
        v = np.array(hot) + rng.normal(size=64) * 0.04
        rows.append((1000 + k, [float(np.float32(c)) for c in v], 0))
    rows += [(2000 + k, hot, 0) for k in range(60)] + [(3000, hot, 1), (3001, hot, 1)]
    got = order(L.near_duplicates(frame(spark, rows), group=group).collect())
    want = order(plain(rows))
    wrong = [g for g, w in zip(got, want) if g != w]
    assert len(got) == len(want) and sum(g[1] for g in got) >= 0.999 * sum(w[1] for w in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want)) and len(wrong) <= 2


def test_query_on_the_given_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF['tiny']}/embeddings.parquet").collect()]
    assert order(QUERIES["op11_lattice"](spark, SF["tiny"]).collect()) == order(plain(rows))


def test_edge_cases(spark):
    rows = [
        (1, [1.0, 2.0, 3.0], 1), (2, [1.0, 2.0, 3.0], 1), (3, [1.0, 2.0, 3.0], 2), (4, [1.0, 2.0, 3.0], None),
        (5, [0.0, 0.0, 0.0], 1), (6, None, 1), (7, [], 1), (8, [1.0, None, 3.0], 1), (9, [math.nan, 2.0, 3.0], 1),
        (10, [math.inf, 2.0, 3.0], 1), (11, [2.0, 4.0, 6.0], 1), (12, [-1.0, -2.0, -3.0], 1), (12, [-1.0, -2.0, -3.0], 1),
        (None, [1.0, 2.0, 3.1], 1), (None, [5.0, 0.0, 0.0], 7), (None, [5.0, 0.0, 0.1], 7), (None, None, None),
        (13, [1.0, 2.0, 3.0, 0.0], 1), (14, [1.0], 1), (15, [3.0], 1), (16, [-2.0], 1), (17, [1e-30, 0.0, 0.0], 7),
    ]
    assert order(L.near_duplicates(frame(spark, rows)).collect()) == order(plain(rows))
    wide = [(k, v and [c and c * 1e200 if c and abs(c) < 1e9 else c for c in v], label) for k, v, label in rows]
    assert order(L.near_duplicates(frame(spark, wide, "double")).collect()) == order(
        [(r[0], *q[1:]) for r, q in zip(wide, plain(rows))]
    )
    assert L.near_duplicates(frame(spark, [])).count() == 0
    names = frame(spark, rows[:3]).withColumnRenamed("label", "x").selectExpr("vec_id", "embedding", "concat('l', x) AS label", "key AS cid", "v")
    assert order(L.near_duplicates(names).collect()) == order(plain(rows[:3]))


def test_a_pair_at_the_threshold_links(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [49.0, math.sqrt(99.0)], 1), (3, [3.0, 4.0], 1), (4, [4.0, 3.0], 1)]
    got = {r.vec_id: r.n_links for r in L.near_duplicates(frame(spark, rows, "double"), min_cosine=0.96).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1}  # 24 / 25 is the threshold itself
