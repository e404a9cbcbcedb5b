import hashlib
import re

from duotier.llm import pii as P
from hypothesis import given, settings
from hypothesis import strategies as st

import edge

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(s):
    return re.sub("[^0-9]", "", s)


def luhn(s):
    return sum(int(c) if k % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for k, c in enumerate(reversed(s))) % 10 == 0


def plain(t):
    return [
        [m.span() for m in EMAIL.finditer(t)],
        [m.span() for m in IP.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))],
        [m.span() for m in CARD.finditer(t) if 16 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))],
        [m.span() for m in PHONE.finditer(t) if 8 <= len(digits(m.group())) <= 15],
    ]


PARTS = ["a", "x.y", "@", "@", ".", "-", "mail.example.com", "1", "12", "255", "256", "007", ".", ".", "+", "+1 ", "(555) ",
         "555-1234", "4539148803436467", " ", "  ", "4539 1488 0343 6467", "é", "\n", "٣", "%"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join))
def test_base_spans_match_the_patterns(text):
    assert P.base_spans(text) == plain(text)


def test_base_spans_of_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000, "1." * 150_000, "a@" * 150_000, "+1 " * 100_000, "- " * 150_000):
        assert P.base_spans(text)[0] == []


def test_edge_rows(spark):
    got = P.personal_data(edge.docs(spark)).collect()
    want = []
    for doc_id, text, *_ in edge.ROWS:
        base = plain(text or "")
        joined = ",".join(f"{k}:{s}:{e}" for k, spans in zip(P.KINDS, base) for s, e in spans)
        want.append((doc_id, *map(len, base), hashlib.sha256(joined.encode()).hexdigest()))
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r[:6]) for r in got), key=key) == sorted(want, key=key)
    assert P.personal_data(edge.docs(spark, empty=True)).collect() == []


NOISE = "and then the long road went on for days"


def planted(spark, n=120):
    rows, extra = [], []
    for i in range(n):
        card = next(c for c in (f"45391488{i:04d}{k:04d}" for k in range(10)) if luhn(c))
        secret = hashlib.sha1(str(i).encode()).hexdigest()
        texts = [
            (f"{NOISE} user.{i}@mail{i % 9}.example.com {NOISE}", None),
            (f"{NOISE} 10.{i % 250}.3.{i % 99} {NOISE}", None),
            (f"{NOISE} {card} {NOISE}", None),
            (f"{NOISE} +1 (212) 555-{i:04d} {NOISE}", None),
            (f'{NOISE} token = "{secret}" {NOISE}', f"secret:{len(NOISE) + 10}:{len(NOISE) + 50}"),
            (f"{NOISE} +1 (212) 555-{i:04d} {card} {NOISE}", f"card:{len(NOISE) + 19}:{len(NOISE) + 35}"),
            (f"{NOISE} version {i}.2 of 1{i} parts {NOISE}", ""),
        ]
        for text, want in texts:
            rows.append((len(rows), text))
            extra.append(want)
    return spark.createDataFrame(rows, "doc_id long, text string"), rows, extra


def test_the_method_adds_what_patterns_miss_and_nothing_clean(spark):
    df, rows, extra = planted(spark)
    got = {r.doc_id: r for r in P.personal_data(df).collect()}
    for (doc_id, text), want in zip(rows, extra):
        spans = got[doc_id].spans
        base = ",".join(f"{k}:{s}:{e}" for k, x in zip(P.KINDS, plain(text)) for s, e in x)
        assert all(x in spans.split(",") for x in base.split(",") if x)
        if want is None:
            assert spans == base
        elif want:
            assert want in spans.split(",")
        else:
            assert spans == ""


def test_redaction_replaces_spans_and_keeps_the_rest(spark):
    df, rows, _ = planted(spark, 30)
    model = P.fit(df)
    out = {r.doc_id: r.text for r in P.redact(df, model).collect()}
    assert out[0] == f"{NOISE} <EMAIL> {NOISE}" and out[4] == f'{NOISE} token = "<SECRET>" {NOISE}' and out[6] == rows[6][1]
    kept = P.redact(edge.docs(spark), model)
    assert kept.columns == edge.docs(spark).columns and kept.filter("text is null").count() == 2


def test_expectation_maximisation_finds_the_good_labelers():
    import numpy as np

    rng = np.random.default_rng(4)
    truth = rng.random(4000) < 0.4
    right = (0.95, 0.9, 0.85, 0.55, 0.8)
    v = np.stack([np.where(rng.random(4000) < p, truth, ~truth) for p in right], axis=1) * 2 - 1
    p = P.reliabilities(v, np.ones(4000))
    assert ((p > 0.5) == truth).mean() > 0.96
