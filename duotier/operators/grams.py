"""Counts of words and n-grams of token arrays, summed up per Arrow batch inside the tasks.

Tokens become numbers once per batch; an n-gram is a pair of numbers (its first n - 1 tokens, its last one), and
only what is counted becomes text again.  Tokens hold no space, so an n-gram's text names its tokens."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# workers need not have the repository: this module's functions are pickled by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

COUNTS = "term string, freq long, df long"


def _tokens(column: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """Row of each token, and the tokens."""
    return pc.list_parent_indices(column).to_numpy().astype(np.int64), column.flatten()


def _numbers(found: pa.Array) -> np.ndarray:
    return pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _counted(rows: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each number below `size`: how often it occurs, and in how many rows."""
    once = np.unique(rows * size + at)
    return np.bincount(at, minlength=size), np.bincount(once % size, minlength=size)


def _batch(terms: pa.Array, freq: np.ndarray, df: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([terms, pa.array(freq, pa.int64()), pa.array(df, pa.int64())], names=["term", "freq", "df"])


def words():
    """Token arrays to (term, freq, df) of single tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, flat = _tokens(b.column(0))
            if len(flat):
                coded = flat.dictionary_encode()
                yield _batch(coded.dictionary.cast(pa.string()), *_counted(rows, _numbers(coded.indices), len(coded.dictionary)))

    return run


def among(terms: list[str]):
    """Term arrays to (term, freq, df) of the given terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(terms, pa.string())
        for b in batches:
            rows, flat = _tokens(b.column(0))
            at = _numbers(pc.index_in(flat.cast(pa.string()), value_set=known))
            freq, df = _counted(rows[at >= 0], at[at >= 0], max(len(terms), 1))
            some = np.flatnonzero(freq)
            if len(some):
                yield _batch(known.take(pa.array(some)), freq[some], df[some])

    return run


def longer(frequent: list[str], n: int):
    """Token arrays to (term, freq, df) of all 2- to n-grams whose tokens are all among `frequent`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(frequent, pa.string())
        for b in batches:
            rows, flat = _tokens(b.column(0))
            word = _numbers(pc.index_in(flat.cast(pa.string()), value_set=known))
            at, code = np.flatnonzero(word >= 0), word[word >= 0]  # place of the first token, number of the gram
            for size in range(2, n + 1):
                ends = at + size - 1
                ok = ends < len(word)
                at, code, ends = at[ok], code[ok], ends[ok]
                ok = (word[ends] >= 0) & (rows[at] == rows[ends])
                at, code, ends = at[ok], code[ok], ends[ok]
                if not len(at):
                    break
                _, first, code = np.unique(code * len(frequent) + word[ends], return_index=True, return_inverse=True)
                parts = [known.take(pa.array(word[at[first] + j])) for j in range(size)]
                yield _batch(pc.binary_join_element_wise(*parts, " "), *_counted(rows[at], code, len(first)))

    return run


class Index:
    """Numbers of given terms, found among token arrays."""

    def __init__(self, terms: list[str]):
        split = [t.split(" ") for t in terms]
        self.words = sorted({w for s in split for w in s})
        place = {w: i for i, w in enumerate(self.words)}
        node_term, steps = [-1] * len(self.words), [{}]
        for i, s in enumerate(split):
            node = place[s[0]]
            for depth, w in enumerate(s[1:]):
                if depth + 1 == len(steps):
                    steps.append({})
                key = node * len(self.words) + place[w]
                if key not in steps[depth + 1]:
                    steps[depth + 1][key] = len(node_term)
                    node_term.append(-1)
                node = steps[depth + 1][key]
            node_term[node] = i
        self.term = np.array(node_term, np.int64)
        self.steps = [(np.array(sorted(s), np.int64), np.array([s[k] for k in sorted(s)], np.int64)) for s in steps[1:]]

    def find(self, column: pa.ListArray, known: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(row, term) of every occurrence. known: `words` as an array."""
        rows, flat = _tokens(column)
        word = _numbers(pc.index_in(flat.cast(pa.string()), value_set=known))
        at = np.flatnonzero(word >= 0)
        node = word[at]
        hits = [(at, self.term[node])]
        for size, (keys, children) in enumerate(self.steps, start=2):
            ends = at + size - 1
            ok = ends < len(word)
            at, node, ends = at[ok], node[ok], ends[ok]
            ok = (word[ends] >= 0) & (rows[at] == rows[ends])
            at, node, ends = at[ok], node[ok], ends[ok]
            key = node * len(self.words) + word[ends]
            place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            ok = keys[place] == key
            at, node = at[ok], children[place[ok]]
            hits.append((at, self.term[node]))
        at, term = (np.concatenate(v) for v in zip(*hits))
        return rows[at[term >= 0]], term[term >= 0]


def per_id(terms: list[str], idf: list[float] | None, schema: pa.Schema):
    """(id, token array), rows of one id side by side, to (id, term, tf) of the given terms, with an L2-normalised
    weight tf * idf if `idf` is given."""
    index = Index(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, names, size = pa.array(index.words, pa.string()), pa.array(terms, pa.string()), max(len(terms), 1)
        factor = None if idf is None else np.array(idf, float)

        def rows_of(ids: pa.Array, key: np.ndarray, tf: np.ndarray) -> pa.RecordBatch:
            own, term = key // size, key % size
            cols = [ids.take(pa.array(own)), names.take(pa.array(term)), pa.array(tf, pa.int64())]
            if factor is not None:
                w = tf * factor[term]
                cols.append(pa.array(w / np.sqrt(np.bincount(own, weights=w * w))[own] if len(w) else w))
            return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, schema)], schema=schema)

        held_id, held = None, None  # the last id may go on in the next batch: its terms and their counts
        for b in batches:
            if not b.num_rows:
                continue
            coded = b.column(0).dictionary_encode(null_encoding="encode")
            ids, of_row = coded.dictionary, _numbers(coded.indices)
            rows, term = index.find(b.column(1), known)
            key, tf = np.unique(of_row[rows] * size + term, return_counts=True)
            if held is not None:
                if ids[0].equals(held_id):
                    key, at = np.unique(np.concatenate([held[0], key]), return_inverse=True)
                    tf = np.bincount(at, weights=np.concatenate([held[1], tf]), minlength=len(key)).astype(np.int64)
                else:
                    yield rows_of(pa.array([held_id.as_py()], ids.type), *held)
            last = of_row[-1]
            tail = key // size == last
            held_id, held = ids[int(last)], (key[tail] % size, tf[tail])
            yield rows_of(ids, key[~tail], tf[~tail])
        if held is not None:
            yield rows_of(pa.array([held_id.as_py()], schema.field(0).type), *held)

    return run
