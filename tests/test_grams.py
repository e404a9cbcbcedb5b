"""Counts of terms inside the tasks against plain loops: ties, repeated and null ids, small batches, no exploded terms."""

from collections import Counter

import pytest
from duotier.config import Cols
from duotier.operators import features, heavy

COLS = Cols(id="doc_id", text="text")


def frame(spark):
    words = ["red", "bolt", "gear", "nut", "axle", "cog"]
    rows = [(k % 23 if k % 5 else None, " ".join(words[(k * j + j * j) % 6] for j in range(k % 9))) for k in range(90)]
    return spark.createDataFrame([*rows, (99, None), (98, "the of"), (97, "x")], "doc_id long, text string")


def terms_of(text, n):
    tok = [t for t in (text or "").split() if len(t) > 1 and t not in features.ENGLISH_STOP_WORDS]
    return [" ".join(tok[i : i + size]) for size in range(1, n + 1) for i in range(len(tok) - size + 1)]


def plain(rows, n, k):
    freq, df = Counter(), Counter()
    for r in rows:
        freq.update(terms_of(r.text, n))
        df.update(set(terms_of(r.text, n)))
    return [(t, c, df[t]) for t, c in sorted(freq.items(), key=lambda x: (-x[1], x[0]))[:k]]


@pytest.mark.parametrize("n", [1, 2, 3])
@pytest.mark.parametrize("k, ties", [(3, 4), (3, 8192), (20, 8192), (500, 8192)])
def test_vocabulary_equals_a_plain_count(spark, monkeypatch, n, k, ties):
    monkeypatch.setattr(features, "TIES", ties)
    df = frame(spark).repartition(4)
    want = plain(df.collect(), n, k)
    assert [tuple(r) for r in features.vocabulary(df, k, COLS, n=n).collect()] == want
    assert [tuple(r) for r in heavy.vocabulary(df, k, COLS, n=n, width=8).collect()] == want


def test_rows_of_one_id_are_counted_together(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    df = frame(spark)
    vocab = features.fit_text(df, 12, COLS)
    idf = {r.term: r.idf for r in vocab.collect()}
    want = Counter((r.doc_id, t) for r in df.collect() for t in terms_of(r.text, 2) if t in idf)
    try:
        for size in ("1", "3", before):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            got = features.term_freq(df, vocab.select("term", "idf"), COLS).collect()
            assert {(r.doc_id, r.term): r.tf for r in got} == want and len(got) == len(want)
            assert all(r.idf == idf[r.term] for r in got)
            for r in features.tfidf(df, vocab, COLS).collect():
                norm = sum((n * idf[t]) ** 2 for (i, t), n in want.items() if i == r.doc_id) ** 0.5
                assert abs(r.weight - r.tf * idf[r.term] / norm) < 1e-12
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_empty_and_no_vocabulary(spark):
    df = frame(spark)
    none = features.vocabulary(df.limit(0), 5, COLS)
    assert none.count() == 0 and features.term_freq(df, none.select("term"), COLS).count() == 0


def test_no_term_is_exploded_or_sorted(spark):
    """A term of a row is never a row of its own in an exchange, sort or window."""
    df = frame(spark)
    for got in (features.vocabulary(df, 5, COLS), features.tfidf(df, features.fit_text(df, 5, COLS), COLS)):
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Generate" not in plan and "Window" not in plan
