import collections
import itertools
import random

from duotier.llm import packing as P


def gains(a, b, size):
    """Whether b, the fuller, can gain by a move, one for one, two for one or one for two: all of them, one by one."""
    free = size - sum(b)
    ones = lambda p: list(set(p))
    twos = lambda p: list({x + y for x, y in itertools.combinations(p, 2)})
    pairs = [(ones(a), [0, *ones(b)]), (twos(a), ones(b)), (ones(a), twos(b))]
    return any(0 < x - y <= free for give, take in pairs for x in give for y in take)


def test_search_ends_only_when_no_two_underfull_patterns_gain():
    rnd = random.Random(7)
    for low, high, n in ((500, 1999, 400), (300, 2047, 300), (1, 400, 500)):
        counts = collections.Counter(rnd.randint(low, high) for _ in range(n))
        last = P.local_search(P.best_fit(dict(counts), 2048), 2048)
        held = collections.Counter()
        for p, m in last.items():
            for x in p:
                held[x] += m
        assert held == counts
        under = sorted((sum(p), p) for p in last if sum(p) < 2048)
        for (_, a), (_, b) in itertools.combinations_with_replacement(under, 2):
            assert not ((a != b or last[a] > 1) and gains(a, b, 2048)), (a, b)


def test_dealt_holds_every_sequence_and_spreads_them():
    patterns = collections.Counter({(9, k): 1 for k in range(1, 9)} | {(8, 8): 1000, (7,): 37, (6, 5): 256, (4,): 257})
    for chunks in (1, 16, 256):
        got = collections.Counter()
        for p, n in P.dealt(patterns, chunks):
            assert n > 0
            got[p] += n
            assert chunks == 1 or n <= -(-patterns[p] // chunks) + 1
        assert got == patterns


def test_sequences_of_the_pipeline_follow_the_weights(spark, monkeypatch):
    import corpus_pipeline as C
    from duotier.llm import mixing

    sizes = {"a": 6000, "b": 2000, "c": 1000}
    rnd = random.Random(3)
    # many pieces of each length, as in a large corpus: only then can sequences follow the order
    rows = [(i, " ".join(rnd.choice(["one", "two", "red", "sky"]) for _ in range(rnd.randrange(40, 900, 40))), s, "en") for i, s in enumerate(s for s, n in sizes.items() for _ in range(n // 4))]
    monkeypatch.setattr(mixing.mix, "__defaults__", (None, None, 5000, None, mixing.TEMPERATURE))  # many blocks
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    share = {s: 0.0 for s in sizes}
    for _, text, s, _ in rows:
        share[s] += len(text)
    chars = dict(share)
    share = {s: x**mixing.TEMPERATURE for s, x in share.items()}
    share = {s: x / sum(share.values()) for s, x in share.items()}
    # until the first source runs out, that is the one with the fewest characters for its weight
    whole = min(chars[s] / share[s] for s in sizes) / sum(chars.values())
    source = {r[0]: r[2] for r in rows}
    packed = C.packed(spark, docs, "").collect()
    n = max(r.sequence_id for r in packed) + 1
    assert {r.sequence_id for r in packed} == set(range(n))
    for part in (0.25, 0.5, 0.75, 0.95):
        got = collections.Counter()
        for r in packed:
            if r.sequence_id < part * whole * n:
                got[source[r.doc_id]] += r.length
        for s, w in share.items():
            assert abs(got[s] / sum(got.values()) - w) < 0.03, (part, s, got, share)
