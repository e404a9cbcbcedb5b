import re

import xxhash
from duotier.llm import shards
from duotier.llm import spans as S

import edge


def digest(data, seed):
    return xxhash.xxh64_intdigest(data, seed)


def plain(rows):
    """Texts without the sentences of spans (compared as words, not hashes) that have an earlier place."""
    first, out = {}, []
    ordered = sorted({(d, t) for d, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    spans = {}
    for key in ordered:
        cut = S.sentences(key[1].encode())
        spans[key] = [(tuple(x[2] for x in cut[i : j + 1]), i, j) for _, i, j in S.spans(key[1].encode(), digest)]
        for words, i, _ in spans[key]:
            first.setdefault(words, (key, i))
    for d, t in rows:
        if t is None:
            out.append((d, 0, None))
            continue
        cut = S.sentences(t.encode())
        gone = {k for w, i, j in spans[d, t] if first[w] != ((d, t), i) for k in range(i, j + 1)}
        out.append((d, len(gone), b"".join(t.encode()[c[0] : c[1]] for k, c in enumerate(cut) if k not in gone).decode() if gone else t))
    return out


def check(got, want):
    order = lambda r: (str(r[0]), r[1], str(r[2]))
    assert sorted(((r.doc_id, r.n_removed, r.text) for r in got), key=order) == sorted(want, key=order)


PASSAGE = "Nobody had seen the old clock stop before. It stood in the hall for years. At noon it rang no more, they said."


def test_edge_rows(spark):
    rows = [r[:2] for r in edge.ROWS if r[0] != 6] + [r[:2] for r in edge.ROWS if r[0] == 6][:2]
    df = edge.docs(spark).filter("doc_id is null or doc_id <> 6 or text like 'The%'")
    check(S.deduplicate(df).collect(), plain(rows))
    assert S.deduplicate(edge.docs(spark, empty=True)).collect() == []


def test_passages_go_but_for_the_first(spark):
    rows = [(i, f"Opening words number {i} differ {i * 7}. {PASSAGE} Closing of the text {i} is {i * 13} again.") for i in range(1, 40)]
    rows += [(99, f"no stop before it {PASSAGE}")]
    got = {r.doc_id: r for r in S.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].n_removed == 0 and got[1].n_repeated == 3 and got[1].text == rows[0][1]
    for i in range(2, 40):
        assert got[i].n_removed == 3 and got[i].text == f"Opening words number {i} differ {i * 7}. Closing of the text {i} is {i * 13} again."
    assert "clock" in got[99].text and "noon" not in got[99].text
    check(got.values(), plain(rows))


def test_long_passage_without_stops_is_cut_alike(spark):
    passage = " ".join(f"w{k * 37 % 101}" for k in range(90))
    rows = [(i, f"{' '.join(f'x{i}y{k}' for k in range(40))} {passage} {' '.join(f'z{i}y{k}' for k in range(30))}") for i in range(5)]
    got = {r.doc_id: r for r in S.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].n_removed == 0
    for i in range(1, 5):
        assert len(set(passage.split()) & set(got[i].text.split())) < 45 and f"x{i}y3" in got[i].text
    check(got.values(), plain(rows))


def test_sentences_cover_the_text():
    for _, text, *_ in edge.ROWS:
        cut = S.sentences((text or "").encode())
        assert [w for c in cut for w in c[2].split(b" ")] == re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
        assert all(a[1] == b[0] or not text.encode()[a[1] : b[0]].strip() for a, b in zip(cut, cut[1:]))


def test_given_tables(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(S.deduplicate(df).collect(), plain([(r.doc_id, r.text) for r in df.collect()]))


def all_runs(rows):
    """Texts without the sentences of any run of enough sentences and words, of any length, that has an earlier place."""
    first, cuts = {}, {r: S.sentences(r[1].encode()) for r in sorted(rows)}
    runs = {
        r: [(tuple(x[2] for x in cut[i : j + 1]), i, j) for i in range(len(cut)) for j in range(i + 1, len(cut)) if sum(x[3] for x in cut[i : j + 1]) >= S.MIN_WORDS]
        for r, cut in cuts.items()
    }
    for r in cuts:
        for words, i, _ in runs[r]:
            first.setdefault(words, (r, i))
    out = []
    for r, cut in cuts.items():
        gone = {k for w, i, j in runs[r] if first[w] != (r, i) for k in range(i, j + 1)}
        out.append((r[0], len(gone), b"".join(r[1].encode()[c[0] : c[1]] for k, c in enumerate(cut) if k not in gone).decode()))
    return out


def test_all_runs_of_copies_and_planted_passages_go(spark):
    tail = "Twelve words stand in this one sentence so that it ends well. Then two. And one."
    plain = " ".join(f"w{k * 37 % 101}" for k in range(55))
    rows = [(1, f"{PASSAGE} {tail}"), (2, f"{PASSAGE} {tail}"), (3, f"An own beginning. {tail} Some words after it.")]
    rows += [(10 + k, " ".join([*(f"x{k}y{n}" for n in range(30 + k)), plain, *(f"z{k}y{n}" for n in range(30))])) for k in range(4)]
    rows += [(20, "A b. C d. E f g h i j k l. M n. O p."), (21, "Q r. C d. E f g h i j k l. M n. O p."), (22, "M n. O p. Q r.")]
    got = {r.doc_id: r for r in S.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[2].text == "" and "Then two" not in got[3].text and "And one" not in got[3].text
    for k in range(1, 4):
        assert not set(plain.split()) & set(got[10 + k].text.split()) and got[10 + k].n_removed == 55
    check(got.values(), all_runs(rows))


def test_results_do_not_depend_on_batches_and_shards(spark, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    again = df.select("doc_id", "text").where("doc_id % 3 = 0").union(df.selectExpr("doc_id + 1", "text").where("doc_id % 4 = 0"))
    df = df.select("doc_id", "text").union(again).union(edge.docs(spark).select("doc_id", "text")).repartition(5)
    order = lambda r: tuple((v is not None, v) for v in r)
    want = sorted(map(tuple, S.deduplicate(df).collect()), key=order)
    monkeypatch.setattr(S, "BATCH", 20_000)
    monkeypatch.setattr(shards, "SHARD_KEYS", 500)
    assert sorted(map(tuple, S.deduplicate(df).drop("n_repeated").collect()), key=order) == [(*r[:2], *r[3:]) for r in want]
