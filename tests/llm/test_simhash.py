import numpy as np
import pytest
import xxhash
from duotier.llm import simhash as S
from pyspark.sql import functions as F

import edge


def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def plain_components(ids, fps, bits=3):
    label = {i: i for i in range(len(fps))}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                label[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [least.get(root(i)) for i in range(len(fps))]


def test_edge_rows_match_brute_force(spark):
    df = edge.docs(spark)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in S.near_duplicates(df).collect()), key=str)
    rows = [(r[0], plain_fingerprint(r[1])) for r in edge.ROWS]
    comp = plain_components([d for d, _ in rows], [f for _, f in rows])
    assert got == sorted(((d, f"{f:016x}", c) for (d, f), c in zip(rows, comp)), key=str)


def test_empty_table(spark):
    assert S.near_duplicates(edge.docs(spark, empty=True)).collect() == []
    assert S.representatives(edge.docs(spark, empty=True)).collect() == []


def chains(n, rng):
    """Fingerprints in walks of up to 3 changed bits, so that components are long chains."""
    out = []
    x = 0
    for k in range(n):
        if k % 40 == 0:
            x = int(rng.integers(0, 1 << 63))
        for b in rng.choice(64, int(rng.integers(0, 5)), replace=False):
            x ^= 1 << int(b)
        out.append(x)
    return out


@pytest.mark.parametrize("group", [4, 2048])
def test_links_join_what_brute_force_joins(spark, group):
    fps = sorted(set(chains(1200, np.random.default_rng(3))))
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    links = S.links(df, 3, group)
    for r in links.limit(2000).collect():
        a, b = (int(np.int64(x).view(np.uint64)) for x in (r.a, r.b))
        assert a != b
    roots = {r.v: r.root for r in S.components(links).collect()}
    got = [roots.get(f, f) for f in signed]
    want = plain_components(list(range(len(fps))), fps)
    assert len(set(got)) == len(set(want))
    assert len(set(zip(got, want))) == len(set(want))


def test_one_dense_group_has_linear_links(spark):
    rng = np.random.default_rng(5)
    base = int(rng.integers(0, 1 << 62))
    fps = {base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 63, (1500, 2))}
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    links = S.links(df, 3, 64)
    assert links.count() < 200 * len(fps)
    got = {r.root for r in S.components(links).collect()}
    assert len(got) == 1


def test_representatives_keep_one_row_per_component(spark):
    df = edge.docs(spark)
    rows = S.representatives(df)
    assert rows.columns == df.columns
    fps = [plain_fingerprint(r[1]) for r in edge.ROWS]
    members = {}
    for k, c in enumerate(plain_components(list(range(len(fps))), fps)):
        members.setdefault(c, []).append(edge.ROWS[k][0])
    least = [min((d for d in ids if d is not None), default=None) for ids in members.values()]
    assert sorted(str(r.doc_id) for r in rows.collect()) == sorted(map(str, least))


def test_given_tables(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = df.select("doc_id", "text").collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    want = {(r.doc_id, f"{f:016x}", c) for r, f, c in zip(rows, fps, plain_components([r.doc_id for r in rows], fps))}
    assert {tuple(r) for r in S.near_duplicates(df).collect()} == want
    longer = S.near_duplicates(df.withColumn("text", F.concat("text", F.lit(""))), shingle=5)
    assert longer.count() == len(rows)


def test_inner_names_as_columns(spark):
    df = edge.named(edge.docs(spark))
    assert S.near_duplicates(df).count() == len(edge.ROWS)
    got = S.representatives(df)
    assert edge.intact(got, df.columns) and got.count() == S.representatives(edge.docs(spark)).count()


def test_chains_are_tested_in_groups_of_any_size():
    rng = S.np.random.default_rng(4)
    fp = rng.integers(0, 1 << 62, 200).astype(S.np.uint64)
    fp[100:] = fp[:100] ^ S.np.uint64(1 << 40)  # one bit in the sixth segment
    for start in range(S.RING):
        label = S.group_links(fp, start, S.MAX_BITS)
        linked = S.chain_ok(fp[:100] ^ fp[100:], start, S.MAX_BITS)
        assert ((label[100:] == S.np.arange(100)) == linked).all()


def test_nothing_that_grows_is_broadcast(spark):
    """Tables of fingerprints look small as files; none of them may pass through the driver."""
    df = edge.docs(spark)
    for got in (S.near_duplicates(df), S.representatives(df), S.links(S.fingerprints(df))):
        got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan and "Broadcast" not in plan
