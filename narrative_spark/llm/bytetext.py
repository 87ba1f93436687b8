"""Vectorised word and n-gram hashes over the UTF-8 bytes of whole Arrow string columns.

A prefix sum of byte codes times powers of an odd multiplier gives the 64-bit hash of any byte range
with two look-ups, so that words, byte n-grams and word shingles need no Python loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_P = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}
_CODES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: Word bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z.
ALNUM = np.zeros(256, bool)
ALNUM[ord("0") : ord("9") + 1] = ALNUM[ord("a") : ord("z") + 1] = ALNUM[ord("A") : ord("Z") + 1] = True
ALNUM[128:] = True
#: Word bytes of [^\x20\x09-\x0D]+.
SOLID = np.ones(256, bool)
SOLID[[9, 10, 11, 12, 13, 32]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**i and P**-i modulo 2**64 for i below n."""
    if not _POWERS or len(_POWERS["p"]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for key, base in (("p", _P), ("i", pow(_P, -1, 2**64))):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _POWERS[key] = np.multiply.accumulate(out)
    return _POWERS["p"][:n], _POWERS["i"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of h over the word."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


@dataclass
class Words:
    """Words of a run of texts. doc_words[d]:doc_words[d + 1] are the words of text d; start, end are byte places in data."""

    data: np.ndarray
    doc_bytes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    doc_words: np.ndarray
    prefix: np.ndarray

    def span_hash(self, at: np.ndarray, to: np.ndarray) -> np.ndarray:
        """Hash of the byte ranges at:to."""
        return mix((self.prefix[to] - self.prefix[at]) * _powers(len(self.prefix))[1][at])

    def code_points(self, doc: int, places: np.ndarray) -> np.ndarray:
        """Byte places inside text doc as code point places of that text."""
        own = self.data[self.doc_bytes[doc] : self.doc_bytes[doc + 1]]
        count = np.concatenate(([0], np.cumsum((own & 0xC0) != 0x80)))
        return count[places - self.doc_bytes[doc]]


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, bytes, offsets) for runs of whole texts of about size bytes; null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        last = min(last, len(texts))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words_of(data: np.ndarray, doc_bytes: np.ndarray, inside: np.ndarray, lower: bool) -> Words:
    """Split texts into maximal runs of the byte class inside; no run crosses a text's end."""
    if lower:
        data = LOWER[data]
    n = len(data)
    powers, inverse = _powers(n + 1)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODES[data] * powers[:n], out=prefix[1:])
    solid = inside[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    ends = np.zeros(n + 1, bool)
    ends[1:n] = solid[:-1] & ~solid[1:]
    if n:
        ends[n] = solid[-1]
    edges = doc_bytes[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    joined = edges[solid[edges] & solid[edges - 1]]
    begins[joined] = ends[joined] = True
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    hashes = mix((prefix[end] - prefix[start]) * inverse[start])
    return Words(data, doc_bytes, start, end, hashes, np.searchsorted(start, doc_bytes), prefix)


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of width words, index of its text); a shorter text with words gives one shorter run."""
    h, edges = words.hash, words.doc_words
    count = np.diff(edges)
    doc = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(h)) - edges[:-1][doc]
    full = place + width <= count[doc]
    at = np.flatnonzero(full | (place == 0))
    out = np.zeros(len(at), np.uint64)
    left = np.minimum(count[doc[at]] - place[at], width)
    step = 1
    for j in range(width):
        ok = j < left
        src = np.minimum(at + j, max(len(h) - 1, 0))
        out += np.where(ok, h[src] * np.uint64(step), np.uint64(0))
        step = step * 0xD6E8FEB86659FD93 % 2**64
    return mix(out), doc[at]
