import math

import duckdb
import pytest
from duotier.llm import oracle
from duotier.llm import topk as T


def plain(rows, k=20, every=20):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ok.setdefault((i, tuple(math.floor(64 * x) for x in v)), None)
    out = set()
    for i, q in ok:
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i)[:k]
            out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(best)}
    return out


ROWS = [(i, [math.sin(i * 7 + j) * (1 + i % 3) for j in range(8)]) for i in range(150)]
ROWS += [(200 + i, ROWS[20][1]) for i in range(60)]  # copies: ties, and more than k of them
ROWS += [(20, ROWS[20][1]), (300, None), (320, [1.0, None]), (340, [float("nan")] * 8), (341, [float("inf")] * 8)]
ROWS += [(360, []), (None, [1.0] * 8), (380, [0.5, -0.5]), (400, [-0.001] * 8)]


@pytest.mark.parametrize("bits", [1, 3])
def test_matches_brute_force(spark, bits):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in ROWS], "vec_id long, embedding array<float>, cid string, score int")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert {tuple(r) for r in T.top_k(df, cell_bits=bits).collect()} == plain(rows)


def test_matches_oracle(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{d}/embeddings.parquet')")
    got = T.top_k(spark.read.parquet(f"{d}/embeddings.parquet")).collect()
    assert {tuple(r) for r in got} == set(con.execute(oracle.SQL["op7_topk"]).fetchall())


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**22 + i), float(-(2**21) + i)]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {tuple(r) for r in T.top_k(df).collect()} == plain(rows)


def test_empty(spark):
    assert T.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
