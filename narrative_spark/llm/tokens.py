"""Token ids of whole texts, with the tokenizer run once for each distinct unit of text.

The word BPE splits text into letter runs, single digits and runs of other signs, drops white space and
ends each unit by a token that carries an end-of-word mark. Ids of a unit don't depend on its neighbours,
so a bounded table of units already seen replaces most calls. Words with signs whose split depends on
more than the byte class (apostrophes, "<", control signs, letters outside Latin-1) go to the
tokenizer whole, as they stand between white space.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from narrative_spark.llm import bytetext

MAX_UNITS = 600_000
_SPACE, _LETTER, _DIGIT, _SIGN = 0, 1, 2, 3
_CLASS = np.full(256, _SIGN, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[ord("a") : ord("z") + 1] = _CLASS[ord("A") : ord("Z") + 1] = _CLASS[128:] = _LETTER
_ODD = np.zeros(256, bool)
_ODD[[*range(9), *range(14, 32), 127, ord("'"), ord("<")]] = True
#: Bytes of Latin-1 letters: lead byte and the two signs among them that are no letters.
_LEAD, _NOT_LETTERS = 0xC3, (0x97, 0xB7)
_LOADED: dict[tuple[str, bool], UnitTokenizer] = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class UnitTokenizer:
    """ids of whole texts; specials_as_text: the special tokens' strings in a text are ordinary text."""

    def __init__(self, path: str, specials_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.inner = Tokenizer.from_file(path)
        self.inner.encode_special_tokens = specials_as_text
        vocab = self.inner.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.clear()

    @classmethod
    def loaded(cls, path: str, specials_as_text: bool = False) -> UnitTokenizer:
        """One for each worker process."""
        if (path, specials_as_text) not in _LOADED:
            _LOADED[path, specials_as_text] = cls(path, specials_as_text)
        return _LOADED[path, specials_as_text]

    def clear(self, units: int = 0) -> None:
        """Forget all units; the table is at least twice as large as what it will hold."""
        self.mask = max(1 << 21, 1 << (2 * units).bit_length()) - 1
        self.keys, self.slots = np.zeros(self.mask + 1, np.uint64), np.zeros(self.mask + 1, np.int32)
        self.first, self.count, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Index of each hash in the table, -1 where it is missing."""
        found = np.full(len(h), -1, np.int64)
        left, at = np.arange(len(h)), (h & np.uint64(self.mask)).astype(np.int64)
        while len(left):
            keys = self.keys[at]
            hit = keys == h[left]
            found[left[hit]] = self.slots[at[hit]]
            on = ~hit & (keys != 0)
            left, at = left[on], (at[on] + 1) & self.mask
        return found

    def _put(self, h: np.ndarray, index: np.ndarray) -> None:
        left, at = np.arange(len(h)), (h & np.uint64(self.mask)).astype(np.int64)
        while len(left):
            free = self.keys[at] == 0
            self.keys[at[free]] = h[left[free]]  # of several for one slot, the last stays
            mine = self.keys[at] == h[left]
            self.slots[at[mine]] = index[left[mine]]
            left, at = left[~mine], (at[~mine] + 1) & self.mask

    def _learn(self, h: np.ndarray, units: list[str], whole: np.ndarray) -> None:
        ids: list[np.ndarray] = [np.zeros(0, np.int32)] * len(units)
        for some in (np.flatnonzero(~whole)[i : i + 4000] for i in range(0, int((~whole).sum()), 4000)):
            runs = [some[i : i + 100] for i in range(0, len(some), 100)]
            for run, e in zip(runs, self.inner.encode_batch_fast([" ".join(units[k] for k in run) for run in runs], add_special_tokens=False), strict=True):
                got = np.array(e.ids, np.int32)
                for k, part in zip(run, np.split(got, np.flatnonzero(self.ends[got])[:-1] + 1), strict=True):
                    ids[k] = part
        odd = np.flatnonzero(whole)
        for k, e in zip(odd, self.inner.encode_batch_fast([units[k] for k in odd], add_special_tokens=False), strict=True):
            ids[k] = np.array(e.ids, np.int32)
        base, sizes = len(self.first), np.array([len(x) for x in ids], np.int64)
        self.first = np.concatenate([self.first, len(self.pool) + np.cumsum(sizes) - sizes])
        self.count = np.concatenate([self.count, sizes])
        self.pool = np.concatenate([self.pool, *ids])
        self._put(h, np.arange(base, base + len(h), dtype=np.int32))

    def encode(self, data: np.ndarray, doc_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text's ids)."""
        n = len(data)
        kind = _CLASS[data]
        edge = np.zeros(n + 1, bool)
        edge[1:n] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        edge[0] = edge[n] = True
        edge[doc_bytes] = True
        odd = _ODD[data]
        high = np.flatnonzero(data >= 128)
        if len(high):
            lead = data[high] == _LEAD
            after = np.minimum(high + 1, n - 1)
            fine = np.where(lead, ~np.isin(data[after], _NOT_LETTERS), (data[high] < 0xC0) & (data[np.maximum(high - 1, 0)] == _LEAD))
            odd[high[~fine]] = True
        if odd.any():  # words with odd signs stay whole
            gap = kind == _SPACE
            word_edge = np.zeros(n + 1, bool)
            word_edge[1:n] = gap[1:] != gap[:-1]
            word_edge[0] = word_edge[n] = True
            word_edge[doc_bytes] = True
            word = np.cumsum(word_edge[:-1]) - 1
            bad = np.zeros(word[-1] + 1, bool)
            bad[word[odd]] = True
            inner = bad[word]
            edge[:-1] &= ~inner | word_edge[:-1]
        else:
            inner = odd
        places = np.flatnonzero(edge)
        start, end = places[:-1], places[1:]
        solid = kind[start] != _SPACE
        start, end = start[solid], end[solid]
        powers, inverse = bytetext._powers(n + 1)
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(bytetext._CODES[data] * powers[:n], out=prefix[1:])
        h = bytetext.mix((prefix[end] - prefix[start]) * inverse[start]) | np.uint64(1)
        found = self._find(h)
        if (missing := np.flatnonzero(found < 0)).size:
            new, at = np.unique(h[missing], return_index=True)
            at = missing[at]
            if len(self.first) + len(new) > MAX_UNITS:
                new, at = np.unique(h, return_index=True)
                self.clear(len(new))
            raw = data.tobytes()
            self._learn(new, [raw[start[k] : end[k]].decode() for k in at], inner[start[at]])
            found = self._find(h) if len(self.first) == len(new) else np.where(found < 0, self._find(h), found)
        sizes = self.count[found]
        total = np.concatenate(([0], np.cumsum(sizes)))
        ids = self.pool[np.repeat(self.first[found] - total[:-1], sizes) + np.arange(total[-1])]
        return ids, total[np.searchsorted(start, doc_bytes)]

    def texts(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(index of the first text, ids, offsets) for runs of whole texts."""
        for first, data, doc_bytes in bytetext.chunks(column):
            yield first, *self.encode(data, doc_bytes)
