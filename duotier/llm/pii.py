"""Personal data: fixed patterns, and weak supervision for what they miss.

Base spans (email, ip, card, phone) follow their patterns, leftmost and without
overlaps per kind, and always stay.  The method adds spans: looser candidates
(also of kind `secret`: keys, tokens, passwords) get a vote of each labeler
(pattern, checksum or shape, gazetteer, context words, boundaries; +1, 0, -1).
Expectation-maximisation over the votes of the whole corpus estimates each
labeler's reliability and each candidate's probability; those probabilities
train a logistic span classifier on votes and shape, and a candidate it rates
at `MIN_PROBABILITY` or more becomes a span if it overlaps no other.

Only counts of (kind, votes, shape) patterns leave the workers, at most
5 * 3**5 * 8 * 8 of them whatever the corpus holds.

Defined cases: null text is empty and has no spans; a null doc_id keeps its
row; repeated rows are treated alike; very long runs of digits or letters are
scanned in linear time; an empty table gives an empty result; columns other
than doc_id and text are only passed through by `redact`."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, rows_to_batches, small_batches

KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = 4
MIN_PROBABILITY = 0.8
ROUNDS = 30

# Gazetteers of the labelers.
DOMAINS = frozenset("com org net edu gov io de fr es it nl uk us eu info".split())
CARD_PREFIXES = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "30", "36", "38")
PHONE_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 54 55 61 62 81 82 86 90 91".split())
KEY_PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "sk_", "pk_", "xox", "AIza", "ya29")
CUES = {
    "email": re.compile(r"(?i)e-?mail|contact|write to|mailto"),
    "ip": re.compile(r"(?i)\bip\b|host|address|server"),
    "card": re.compile(r"(?i)card|visa|master|amex|credit|payment"),
    "phone": re.compile(r"(?i)phone|tel|call|mobile|fax"),
    "secret": re.compile(r"(?i)token|passw|secret|key|credential"),
}
AGAINST = re.compile(r"(?i)version|isbn|issn|license|sha-?\d|commit|page|doi|\bno\.")

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)+")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
PLUS = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
CARD = re.compile(r"(?<![0-9])(?:[0-9]{13,19}+|[0-9]{4}(?:[ -][0-9]{4}){3})(?![0-9])")
PHONE = re.compile(r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])|(?<![0-9])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])")
SECRET = re.compile(r"(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{16,}+")
NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return (odd + even) % 10 == 0


def emails(t: str) -> list[tuple[int, int]]:
    """From each @: the run of name characters before it and the domain after it."""
    out, free, at = [], 0, t.find("@")
    while at >= 0:
        begin = at
        while begin > free and (t[begin - 1].isascii() and (t[begin - 1].isalnum() or t[begin - 1] in "._%+-")):
            begin -= 1
        m = DOMAIN.match(t, at + 1) if begin < at else None
        if m:
            out.append((begin, m.end()))
        free = m.end() if m else at + 1
        at = t.find("@", free)
    return out


def addresses(t: str) -> list[tuple[int, int]]:
    """Every four parts of a chain of dotted numbers, from its left; all at most 255."""
    out = []
    for m in DOTTED.finditer(t):
        parts = m.group().split(".")
        begin = m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = begin + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                out.append((begin, end))
            begin = end + 1
    return out


def base_spans(t: str) -> list[list[tuple[int, int]]]:
    """Spans of the base kinds, in their order."""
    out: list[list[tuple[int, int]]] = [[], [], [], []]
    if "@" in t:
        out[0] = emails(t)
    if not DIGITS.search(t):
        # no chain of two digits: nothing of the other kinds but single digits with dots
        if not DOTTED.search(t) and "+" not in t:
            return out
    out[1] = addresses(t)
    for m in DIGITS.finditer(t):
        if m.end() - m.start() >= 16:
            d = NOT_DIGIT.sub("", m.group())
            if 16 <= len(d) <= 19 and luhn(d):
                out[2].append(m.span())
    if "+" in t:
        for m in PLUS.finditer(t):
            if 8 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
                out[3].append(m.span())
    return out


def candidates(t: str, base: list[list[tuple[int, int]]]) -> list[tuple[int, int, int]]:
    """(kind, start, end) of everything that may be personal: base spans and looser finds."""
    found = {(k, *span) for k, spans in enumerate(base) for span in spans}
    if DIGITS.search(t):
        found.update((2, *m.span()) for m in CARD.finditer(t))
        found.update((3, *m.span()) for m in PHONE.finditer(t))
        for m in SECRET.finditer(t):
            s = m.group()
            if any(c.isdigit() for c in s) and any(c.isalpha() for c in s):
                found.add((4, *m.span()))
    return sorted(found)


def votes(t: str, kind: int, start: int, end: int) -> tuple[tuple[int, ...], int, int]:
    """A vote of each labeler, then the shape: buckets of length and of digits (0 to 7)."""
    s = t[start:end]
    digits = NOT_DIGIT.sub("", s)
    pattern = checksum = gazetteer = -1
    if kind == 0:
        pattern = 1 if DOMAIN.search(s) else -1
        checksum = 1 if len(s) <= 254 and ".." not in s else -1
        gazetteer = 1 if s.rsplit(".", 1)[-1].lower() in DOMAINS else 0
    elif kind == 1:
        pattern = 1
        checksum = 1 if not re.search(r"(?:^|\.)0[0-9]", s) else -1
        gazetteer = -1 if s.startswith(("0.", "255.")) else 0
    elif kind == 2:
        pattern = 1 if len(digits) in (15, 16) else 0 if len(digits) == 19 else -1
        checksum = 1 if luhn(digits) else -1
        gazetteer = 1 if digits.startswith(CARD_PREFIXES) else -1
    elif kind == 3:
        pattern = 1 if PHONE.fullmatch(s) else -1
        checksum = 1 if 8 <= len(digits) <= 13 else -1
        gazetteer = 1 if not s.startswith("+") or any(digits[:k] in PHONE_CODES for k in (1, 2)) else -1
    else:
        checksum = 1 if re.fullmatch(r"[0-9a-f]{16,}|[0-9A-F]{16,}|[A-Z0-9]{16,}", s) else 0
        mixed = sum(bool(re.search(c, s)) for c in ("[a-z]", "[A-Z]", "[0-9]"))
        pattern = 1 if checksum == 1 or mixed == 3 and "/" not in s else -1
        gazetteer = 1 if s.startswith(KEY_PREFIXES) else 0
    before = t[max(0, start - 24) : start]
    context = 1 if CUES[KINDS[kind]].search(before) else -1 if AGAINST.search(before) else 0
    left, right = t[start - 1 : start], t[end : end + 1]
    loose = left.isalnum() or right.isalnum() or left == "." and kind in (1, 2) or right == "@"
    more = right == "." and t[end + 1 : end + 2].isdigit()
    return (pattern, checksum, gazetteer, context, -1 if loose or more else 1), min(7, len(s) // 6), min(7, len(digits) // 3)


def pattern_counts(docs: DataFrame) -> DataFrame:
    """(pattern, n): how often each (kind, votes, shape) occurs among the candidates of all documents."""
    schema = pa.schema([("pattern", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for raw in b.column("text").to_pylist():
                t = raw.decode()
                seen.update(pattern(t, *c) for c in candidates(t, base_spans(t)))
        yield from rows_to_batches(iter(seen.items()), schema)

    return as_bytes(docs).mapInArrow(run, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n"))


def pattern(t: str, kind: int, start: int, end: int) -> str:
    v, length, digits = votes(t, kind, start, end)
    return " ".join(map(str, (kind, *v, length, digits)))


def reliabilities(v: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Probability of each vote pattern to be real: EM over labelers that err independently, given the truth."""
    p = 1 / (1 + np.exp(-v.sum(axis=1).astype(float)))  # the majority starts it off
    for _ in range(ROUNDS):
        w = np.stack([n * (1 - p), n * p])
        logs = np.log((w.sum(axis=1) + 1) / (n.sum() + 2))[:, None] * np.ones(len(v))
        for j in range(v.shape[1]):
            tally = np.stack([w[:, v[:, j] == x].sum(axis=1) for x in (-1, 0, 1)], axis=1) + 0.5
            rate = np.log(tally / tally.sum(axis=1, keepdims=True))
            logs += rate[:, v[:, j] + 1]
        p = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
    return p


def inputs(v: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """Classifier inputs: a constant, each vote for and against, and the shape."""
    return np.concatenate([np.ones((len(v), 1)), v == 1, v == -1, shape / 7.0], axis=1).astype(float)


def train(patterns: list[tuple[str, int]]) -> dict[int, np.ndarray]:
    """Weights of the logistic span classifier per kind, fitted to the EM probabilities."""
    rows = sorted((tuple(map(int, p.split())), n) for p, n in patterns)
    out = {}
    for kind in range(len(KINDS)):
        own = [(r, n) for r, n in rows if r[0] == kind]
        if not own:
            continue
        a, n = np.array([r for r, _ in own]), np.array([n for _, n in own], float)
        v = a[:, 1:6]
        p, x = reliabilities(v, n), inputs(v, a[:, 6:8])
        w, share = np.zeros(x.shape[1]), n / n.sum()
        for _ in range(50):  # Newton steps with a small ridge
            q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            grad = x.T @ (share * (q - p)) + 1e-3 * w
            hess = (x * (share * np.maximum(q * (1 - q), 1e-4))[:, None]).T @ x + 1e-3 * np.eye(len(w))
            w = w - np.clip(np.linalg.solve(hess, grad), -2, 2)
        out[kind] = w
    return out


def fit(docs: DataFrame) -> dict[int, np.ndarray]:
    """Classifier for these documents; the driver gets pattern counts only."""
    return train([(r.pattern, r.n) for r in pattern_counts(docs).collect()])


def all_spans(t: str, base: list[list[tuple[int, int]]], model: dict[int, np.ndarray]) -> list[tuple[int, int, int]]:
    """Base spans and what the classifier adds, by kind and start."""
    out = [(k, *span) for k, spans in enumerate(base) for span in spans]
    have, taken, rated = set(out), sorted(s[1:] for s in out), []
    for c in candidates(t, base):
        if c not in have and c[0] in model:
            v, length, digits = votes(t, *c)
            x = inputs(np.array([v]), np.array([[length, digits]]))[0] @ model[c[0]]
            rated.append((-float(1 / (1 + np.exp(-np.clip(x, -30, 30)))), c))
    for p, c in sorted(rated):
        if -p >= MIN_PROBABILITY and all(e <= c[1] or c[2] <= s for s, e in taken):
            out.append(c)
            taken.append(c[1:])
    return sorted(out)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def personal_data(docs: DataFrame, model: dict[int, np.ndarray] | None = None) -> DataFrame:
    """One row per document: base counts, digest of the base spans, and all spans (code points, end exclusive)."""
    model = fit(docs) if model is None else model
    names = [f"n_{k}" for k in KINDS[:BASE_KINDS]]
    schema = pa.schema(
        [("doc_id", pa.int64())] + [(c, pa.int64()) for c in names] + [("base_sha256", pa.string()), ("spans", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                for doc_id, raw in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                    t = raw.decode()
                    base = base_spans(t)
                    plain = joined([(k, *span) for k, spans in enumerate(base) for span in spans])
                    yield (
                        doc_id, *map(len, base), hashlib.sha256(plain.encode()).hexdigest(),
                        joined(all_spans(t, base, model)),
                    )

        yield from rows_to_batches(rows(), schema)

    out = "doc_id long, " + ", ".join(f"{c} long" for c in names) + ", base_sha256 string, spans string"
    return as_bytes(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(run, out)


def redact(docs: DataFrame, model: dict[int, np.ndarray] | None = None, text: str = "text") -> DataFrame:
    """The same rows and columns; each span in the text gives way to its kind in angle brackets."""
    model = fit(docs) if model is None else model
    at = docs.columns.index(text)
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = []
            for t in b.column(at).to_pylist():
                if t:
                    spans = sorted((s, e, k) for k, s, e in all_spans(t, base_spans(t), model))
                    pieces, done = [], 0
                    for s, e, k in spans:
                        if e > done:  # base spans of two kinds may overlap
                            pieces += [t[done : max(s, done)], f"<{KINDS[k].upper()}>"]
                            done = e
                    t = "".join([*pieces, t[done:]])
                new.append(t)
            yield b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
