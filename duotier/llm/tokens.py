"""Token ids of whole texts with a public tokenizer, a word at a time from a cache.

The tokenizer's matches never cross white space, so a text's ids are the ids of
its words in order; each distinct word is encoded once per worker and kept.  A
word is cut further between a letter or digit and a plain punctuation mark,
where a match always ends.  Pieces of letters alone are one match each, whose
last id is of a word's end: many are encoded as one text and told apart by
these ids.  A text that holds a special token's opening is encoded whole."""

from __future__ import annotations

import re
import sys
import types
from array import array

import numpy as np

TOKENIZER = "word_bpe_49k.json"
MARKS = b".,!?%$&#*|"
CUT = re.compile(rb"(?:(?<=[A-Za-z0-9])|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]))(?=[.,!?%$&#*|])")
SPECIAL = b"<|"
#: Words and pieces in each of a worker's two generations: the older one goes when the younger is full.
CACHE = 600_000
WORD_END = "</w>"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def worker_encoder(path: str, cache: int = CACHE) -> WordEncoder:
    """The encoder of this worker process: its tasks share what they have learned."""
    kept = sys.modules.setdefault("duotier_llm_worker", types.ModuleType("duotier_llm_worker")).__dict__
    if (path, cache) not in kept:
        kept[path, cache] = WordEncoder(path, cache)
    return kept[path, cache]


class WordEncoder:
    """Encodes UTF-8 texts into little-endian unsigned 32-bit ids."""

    def __init__(self, path: str, cache: int = CACHE):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # for lower-case ASCII letters the normalizer does nothing and a word is one match
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.ends = np.zeros(1 + max(self.tokenizer.get_vocab().values()), bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(WORD_END)]] = True
        self.words: dict[bytes, bytes] = {}  # pieces are words, too
        self.older: dict[bytes, bytes] = {}
        self.cache = cache

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text."""
        if len(self.words) > self.cache:
            self.older, self.words = self.words, {}
        split = [None if SPECIAL in t else t.lower().split() for t in texts]
        self.learn(self.unknown(set().union(*(w for w in split if w))))
        get = self.words.__getitem__
        return [
            self.whole(t) if words is None else b"".join(map(get, words)) for t, words in zip(texts, split)
        ]

    def unknown(self, words: set[bytes]) -> set[bytes]:
        """Words not in the cache; those of the older generation move to the younger."""
        new = words.difference(self.words)
        known = {w: self.older[w] for w in new if w in self.older}
        self.words.update(known)
        return new.difference(known)

    def learn(self, words: set[bytes]) -> None:
        letters, others, cut = set(), set(), []
        for w in words:
            core = w.rstrip(MARKS)
            if core.isalpha():
                letters.add(core)
                if len(core) < len(w):
                    others.add(w[len(core) :])
                    cut.append((w, core, w[len(core) :]))
            else:
                own = CUT.sub(b" ", w).split(b" ")
                others.update(own)
                if len(own) > 1:
                    cut.append((w, *own))
        self.encode_letters(self.plain, list(self.unknown(letters)))
        texts = self.unknown(others)
        self.encode_letters(self.tokenizer, [t for t in texts if t.decode().isalpha()])
        self.encode_each([t for t in texts if t not in self.words])
        get = self.words.__getitem__
        self.words.update((w, b"".join(map(get, own))) for w, *own in cut)

    def encode_letters(self, tokenizer, pieces: list[bytes]) -> None:
        """Pieces of letters alone, many as one text."""
        for at in range(0, len(pieces), 2000):
            part = pieces[at : at + 2000]
            got = tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids
            ids = np.array(got, "<u4")
            stops = 4 * (np.flatnonzero(self.ends[ids]) + 1)
            if len(stops) != len(part):  # a letter that the normalizer takes apart
                self.encode_each(part)
                continue
            raw, begin = ids.tobytes(), 0
            for p, stop in zip(part, stops.tolist()):
                self.words[p] = raw[begin:stop]
                begin = stop

    def encode_each(self, pieces: list[bytes]) -> None:
        for at in range(0, len(pieces), 10_000):
            part = pieces[at : at + 10_000]
            got = self.tokenizer.encode_batch_fast([p.decode() for p in part], add_special_tokens=False)
            self.words.update((p, array("I", e.ids).tobytes()) for p, e in zip(part, got))

    def whole(self, text: bytes) -> bytes:
        ids = self.tokenizer.encode(text.decode(), add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()
