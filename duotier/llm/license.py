"""License scans: MinHash bands over overlapping text windows retrieve templates, exact containment verifies them.

Texts and templates become words (lower-case letters and digits; other ASCII
characters separate), and shingles of five words.  A template of n shingles is
looked for with windows of the smallest size w = 4, 8, 16, ... with n <= w / 2,
laid every w / 2 shingles: a whole copy lies inside one of them.  A window that
holds the share `CONTAINED` of the n shingles, i.e. at least m of them, has a
similarity of m / (w + n - m) or more to the template; from its own bound each
template gets so many bands of one minimum hash that the chance to meet in none
stays below `MISS`.  A retrieved window is verified with the exact set of its
shingles; of several licenses verified at one place the best contained stands.

Minimum hashes of windows come from those of half windows, size by size, so all
sizes cost one pass.  The template index is a parameter (a few notices):
bounded, sent to each task.

Defined cases: a null or empty text matches nothing; a null doc_id keeps its
matches; repeated rows give the same matches each; a text shorter than a
window is one window; an empty table gives an empty result; columns other than
doc_id and text are not read."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, rows_to_batches

SHINGLE = 5
CONTAINED = 0.8
MISS = 1e-6
#: Half of the smallest window, in shingles; each further size is twice as large.
HALF = 2
#: Words of several texts that are hashed together.
GROUP_WORDS = 200_000

# Notices that licenses ask to be put into a work, by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0"],
    "Apache-2.0-header": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3"],
    "GPL-3.0-header": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3"],
    "MIT": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain"],
}

#: Every ASCII character but letters and digits separates words.
PLAIN = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.lower().translate(PLAIN).split()


def shingle_hashes(w: np.ndarray) -> np.ndarray:
    """64-bit hashes of all runs of SHINGLE word hashes."""
    n = len(w) - SHINGLE + 1
    if n < 1:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        h = (h ^ w[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def multipliers(n: int) -> np.ndarray:
    """Odd numbers, one per minimum hash."""
    return np.random.RandomState(7).randint(0, 1 << 31, n, dtype=np.int64).astype(np.uint32) * np.uint32(2) + np.uint32(1)


def folded(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(32))).astype(np.uint32)


class Band:
    """The minimum hashes of one band's templates, with a small table that rules out most others."""

    def __init__(self, keys: list[tuple[int, int]]):
        self.templates: dict[int, list[int]] = {}
        self.table = np.zeros(4096, bool)
        for value, t in keys:
            self.templates.setdefault(value, []).append(t)
            self.table[value >> 20] = True

    def matches(self, window: np.ndarray) -> Iterator[tuple[int, int]]:
        for w in np.flatnonzero(self.table[window >> np.uint32(20)]).tolist():
            for t in self.templates.get(int(window[w]), ()):
                yield w, t


class Index:
    """Templates by window size, with their bands and exact shingles."""

    def __init__(self, templates: dict[str, list[str]], hasher):
        self.names: list[str] = []
        self.shingles: list[frozenset[tuple[bytes, ...]]] = []
        self.levels: list[int] = []  # the window of a template is HALF * 2 ** (level + 1) shingles
        hashes = []
        for name, texts in sorted(templates.items()):
            for text in texts:
                w = words(text.encode())
                if len(w) >= SHINGLE:
                    self.names.append(name)
                    self.shingles.append(frozenset(zip(*(w[k:] for k in range(SHINGLE)))))
                    self.levels.append(max(0, math.ceil(math.log2(len(self.shingles[-1]) / HALF))))
                    hashes.append(folded(shingle_hashes(np.array([hasher(x, 0) for x in w], np.uint64))))
        n_bands = [self.bands(t) for t in range(len(self.names))]
        self.mult = multipliers(max(n_bands, default=0))
        self.tables: list[dict[int, Band]] = []  # per hash: level -> band
        for k, m in enumerate(self.mult):
            keys: dict[int, list[tuple[int, int]]] = {}
            for t, h in enumerate(hashes):
                if k < n_bands[t]:
                    keys.setdefault(self.levels[t], []).append((int((h * m).min()), t))
            self.tables.append({level: Band(x) for level, x in keys.items()})

    def bands(self, t: int) -> int:
        """Bands that keep the chance to miss a verified window of template t below MISS."""
        n, w = len(self.shingles[t]), HALF << (self.levels[t] + 1)
        m = math.ceil(CONTAINED * n)
        return math.ceil(math.log(MISS) / math.log1p(-m / (w + n - m)))

    def retrieved(self, h: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text, template, first, last shingle) of windows that share a band; h: the texts' shingles, one after another.

        Each text begins a new half window, so no window crosses two texts."""
        top = max(self.levels, default=-1)
        begins, counts, steps = np.cumsum(lengths) - lengths, -(-lengths // HALF), []
        unit, stride = begins, HALF  # of each level: where its half windows begin among those of the level below
        for _ in range(top + 1):
            text = np.repeat(np.arange(len(lengths)), counts)
            nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
            follows = np.flatnonzero(text[1:] == text[:-1])
            steps.append((np.repeat(unit, counts) + nth * stride, text, nth, follows))
            unit, stride = np.cumsum(counts) - counts, 2
            counts = -(-counts // 2)
        seen = set()
        for m, bands in zip(self.mult, self.tables):
            low = h * m
            for level in range(max(bands, default=-1) + 1):
                at, _, _, follows = steps[level]
                low = np.minimum.reduceat(low, at)
                if level in bands:
                    window = low.copy()
                    window[follows] = np.minimum(low[follows], low[follows + 1])
                    seen.update((level, *x) for x in bands[level].matches(window))
        for level, w, t in sorted(seen):
            _, text, nth, _ = steps[level]
            half = HALF << level
            first = int(nth[w]) * half
            yield int(text[w]), t, first, min(first + 2 * half, int(lengths[text[w]]))


def scan(docs: DataFrame, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per document and license found: doc_id, license, n_places, first_word, containment (of the best place)."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("license", pa.string()), ("n_places", pa.int64()), ("first_word", pa.int64()), ("containment", pa.float64())]
    )
    chosen = dict(TEMPLATES if templates is None else templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        index = Index(chosen, xxhash.xxh64_intdigest)
        known: dict[bytes, int] = {}

        def hashes(ws: list[bytes]) -> np.ndarray:
            known.update((w, xxhash.xxh64_intdigest(w, 0)) for w in set(ws).difference(known))
            return np.fromiter(map(known.__getitem__, ws), np.uint64, len(ws))

        def group(ids: list, texts: list[list[bytes]]):
            own = [folded(shingle_hashes(hashes(w))) for w in texts]
            verified: dict[int, list[tuple[int, float, str]]] = {}
            for d, t, first, last in index.retrieved(np.concatenate(own), np.array([len(x) for x in own])):
                w = texts[d][first : last + SHINGLE - 1]
                runs = list(zip(*(w[k:] for k in range(SHINGLE))))
                there = index.shingles[t].intersection(runs)
                share = len(there) / len(index.shingles[t])
                if share >= CONTAINED:
                    where = first + next(k for k, run in enumerate(runs) if run in there)
                    verified.setdefault(d, []).append((where, share, index.names[t]))
            for d, found in sorted(verified.items()):
                best: dict[int, float] = {}
                for where, share, _ in found:
                    best[where] = max(best.get(where, 0.0), share)
                for name in sorted({x[2] for x in found}):
                    own_places = {(w, s) for w, s, n in found if n == name and s == best[w]}
                    if own_places:
                        yield ids[d], name, len({w for w, _ in own_places}), min(own_places)[0], max(s for _, s in own_places)

        def rows():
            ids, texts, n = [], [], 0
            for b in batches:
                for doc_id, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                    w = words(t)
                    if len(w) >= SHINGLE:
                        ids.append(doc_id)
                        texts.append(w)
                        n += len(w)
                    if n > GROUP_WORDS:
                        yield from group(ids, texts)
                        ids, texts, n = [], [], 0
                        if len(known) > 500_000:
                            known.clear()
            if texts:
                yield from group(ids, texts)

        yield from rows_to_batches(rows(), schema)

    out = "doc_id long, license string, n_places long, first_word long, containment double"
    return as_bytes(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(run, out)
