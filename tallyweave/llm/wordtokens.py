"""Token ids of many texts at once, for a tokenizer that treats each word by itself.

The tokenizer lower-cases, drops white space and splits text into letter runs,
single digits, runs of other signs and a few contractions, each of which it
encodes alone. So a batch is split here with array operations, and the
tokenizers library encodes each different word once.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from functools import cached_property

import numpy as np

from tallyweave.llm import textops

#: Texts with any other character, or with a special token, go to the library whole.
_PLAIN = re.compile("[^\\x00-\\u012f\\u0131-\\u017f]")

#: Letters that follow an apostrophe in a contraction. Fixed values of the vocabulary's pattern.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

_SPACE, _LETTER, _NUMBER, _OTHER = range(4)

#: Different words of which a worker remembers the ids; beyond, it begins anew.
REMEMBERED_WORDS = 600_000

#: New words that the library encodes in one call, which bounds its objects.
_AT_ONCE = 8_192


def _classes() -> np.ndarray:
    kinds = np.full(0x180, _OTHER, np.uint8)
    for c in range(0x180):
        major = unicodedata.category(chr(c))[0]
        kinds[c] = _LETTER if major == "L" else _NUMBER if major == "N" else _OTHER
    kinds[[*range(9, 14), 0x20, 0x85, 0xA0]] = _SPACE
    return kinds


class WordTokenizer:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks use the cores
        from tokenizers import Tokenizer

        self.path = path
        with open(path) as f:
            parts = json.load(f)
        self.special = [t["content"] for t in parts["added_tokens"]]
        # words come lower-cased and split, so only the byte alphabet and the merges remain to be done
        parts |= {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}}
        self.merges = Tokenizer.from_str(json.dumps(parts))
        self.classes = _classes()
        self.codes = textops.mix(np.arange(1, 0x181, dtype=np.uint64))
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted hashes of known words
        self.at = np.zeros(0, np.int64)  # where each one's ids begin
        self.count = np.zeros(0, np.int64)
        self.pool = np.zeros(0, "<u4")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as the library gives them without special tokens added."""
        plain = [not (_PLAIN.search(t) or any(x in t for x in self.special)) for t in texts]
        fast = self._encode_plain([t for t, p in zip(texts, plain, strict=True) if p])
        rest = [t for t, p in zip(texts, plain, strict=True) if not p]
        slow = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False) if rest else []
        fast, slow = iter(fast), iter(slow)
        return [next(fast) if p else np.asarray(next(slow).ids, "<u4") for p in plain]

    @cached_property
    def tokenizer(self):
        """The whole tokenizer, for texts that need it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def split(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the words in an array of lower-case code points."""
        kind = np.full(len(text) + 2, _SPACE, np.uint8)
        kind[1:-1] = self.classes[text]
        new = (kind[1:] != kind[:-1]) | (kind[1:] == _NUMBER)
        starts = new & (kind[1:] != _SPACE)
        mark = np.flatnonzero(text == 0x27)
        mark = mark[(kind[mark] != _OTHER) & (kind[mark + 2] == _LETTER)]
        padded = np.append(text, [0, 0, 0])
        for letters in CONTRACTIONS:
            hit = mark
            for i, c in enumerate(letters):
                hit = hit[padded[hit + 1 + i] == ord(c)]
            starts[hit + 1] = False
            after = hit + 1 + len(letters)
            starts[after[kind[after + 1] == _LETTER]] = True
            mark = np.setdiff1d(mark, hit, assume_unique=True)
        at = np.flatnonzero(starts)
        solid = np.flatnonzero(kind[1:-1] != _SPACE)
        # a word ends where the next begins, or at the white space before that
        nxt = np.append(at[1:], len(text))
        ends = solid[np.searchsorted(solid, nxt) - 1] + 1 if len(at) else at
        return at, ends

    def _encode_plain(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        joined = "\n".join(texts).lower()
        text = np.frombuffer(joined.encode("utf-16-le"), "<u2")
        starts, ends = self.split(text)
        first = np.cumsum([0] + [len(t) + 1 for t in texts])
        first = np.searchsorted(starts, first)
        keys = textops.Sums(self.codes[text]).hash(starts, ends) + (ends - starts).astype(np.uint64) if len(starts) else np.zeros(0, np.uint64)
        distinct, where, inverse = np.unique(keys, return_index=True, return_inverse=True)
        place = self._known(distinct, lambda miss: [joined[s:e] for s, e in zip(starts[where[miss]].tolist(), ends[where[miss]].tolist(), strict=True)])[inverse]
        n = self.count[place]
        total = np.concatenate(([0], np.cumsum(n)))
        ids = self.pool[np.repeat(self.at[place] - total[:-1], n) + np.arange(total[-1])]
        cuts = total[first]
        return [ids[s:e] for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def _known(self, distinct: np.ndarray, words) -> np.ndarray:
        """Where each hash stands among the known words, after the library has encoded the new ones."""
        if len(self.keys) > REMEMBERED_WORDS:
            self._forget()
        at = np.searchsorted(self.keys, distinct)
        have = np.zeros(len(distinct), bool)
        have[at < len(self.keys)] = self.keys[at[at < len(self.keys)]] == distinct[at < len(self.keys)]
        miss = np.flatnonzero(~have)
        if not len(miss):
            return at
        new, ids = words(miss), []
        for k in range(0, len(new), _AT_ONCE):
            ids += [np.array(e.ids, "<u4") for e in self.merges.encode_batch_fast(new[k : k + _AT_ONCE], add_special_tokens=False)]
        n = np.array([len(x) for x in ids], np.int64)
        begin = len(self.pool) + np.concatenate(([0], np.cumsum(n)[:-1]))
        self.pool = np.concatenate([self.pool, *ids])
        order = np.searchsorted(self.keys, distinct[miss])
        self.at, self.count = np.insert(self.at, order, begin), np.insert(self.count, order, n)
        self.keys = np.insert(self.keys, order, distinct[miss])
        return np.searchsorted(self.keys, distinct)
