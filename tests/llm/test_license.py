import collections

import numpy as np
import xxhash
from duotier.llm import license as L

import edge


def plain(rows):
    """Every window of every size against every template, by exact shingles."""
    index = L.Index(L.TEMPLATES, xxhash.xxh64_intdigest)
    out = []
    for doc_id, text in rows:
        w = L.words((text or "").encode())
        runs = list(zip(*(w[k:] for k in range(L.SHINGLE))))
        found = []
        for t, need in enumerate(index.shingles):
            half = L.HALF << index.levels[t]
            for at in range(0, len(runs), half):
                there = need.intersection(runs[at : at + 2 * half])
                if there and len(there) / len(need) >= L.CONTAINED:
                    where = at + next(k for k, r in enumerate(runs[at : at + 2 * half]) if r in there)
                    found.append((where, len(there) / len(need), index.names[t]))
        best = {}
        for where, share, _ in found:
            best[where] = max(best.get(where, 0), share)
        for name in {x[2] for x in found}:
            own = {(p, s) for p, s, n in found if n == name and s == best[p]}
            if own:
                out.append((doc_id, name, len({p for p, _ in own}), min(own)[0], max(s for _, s in own)))
    return collections.Counter(out)


def scanned(df):
    return collections.Counter(map(tuple, L.scan(df).collect()))


def test_edge_rows(spark):
    got = scanned(edge.docs(spark))
    assert got == plain([r[:2] for r in edge.ROWS])
    assert [(d, n) for d, n, *_ in got] == [(None, "MIT")]
    assert L.scan(edge.docs(spark, empty=True)).collect() == []


def test_every_notice_is_found_wherever_it_stands(spark):
    rng = np.random.default_rng(1)
    rows, want = [], []
    for name, texts in L.TEMPLATES.items():
        for text in texts:
            for k in range(12):
                noise = [" ".join(f"n{rng.integers(0, 900)}" for _ in range(int(rng.integers(0, 150)))) for _ in range(2)]
                rows.append((len(rows), f"{noise[0]} {text.upper() if k % 2 else text}. {noise[1]}"))
                want.append(name)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = collections.defaultdict(set)
    for doc_id, name, *_ in L.scan(df).collect():
        found[doc_id].add(name)
    for (doc_id, _), name in zip(rows, want):
        assert name in found[doc_id] or f"{name}-header" in found[doc_id]


def test_changed_words_and_plain_texts(spark):
    text = L.TEMPLATES["MIT"][1].split()
    near = [*text[:20], "any", *text[21:]]
    far = [w if k % 4 else "other" for k, w in enumerate(text)]
    rows = [(1, " ".join(near)), (2, " ".join(far)), (3, "the license of the driver is in the drawer of the old table")]
    got = L.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.doc_id, r.license) for r in got] == [(1, "MIT")] and 0.8 <= got[0].containment < 1


def test_given_tables(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert scanned(df) == plain([(r.doc_id, r.text) for r in df.collect()])


def test_bands_keep_the_promised_chance():
    index = L.Index(L.TEMPLATES, xxhash.xxh64_intdigest)
    for t, need in enumerate(index.shingles):
        n, w = len(need), L.HALF << (index.levels[t] + 1)
        m = -(-L.CONTAINED * n // 1)
        assert n <= w / 2 and (1 - m / (w + n - m)) ** index.bands(t) <= L.MISS * 1.0001
