"""Vectorised word, line and shingle arithmetic over Arrow string columns.

A batch is cut into runs of whole texts of about ``CHUNK`` bytes, so memory
stays bounded by the chunk (or by the longest single text) and not by the
batch.  Words are maximal runs of bytes other than ASCII white space
(``[^\\x20\\x09-\\x0D]+``).  Word, line and shingle identities are 64-bit hashes
of their bytes: two different ones inside one text agree with probability
about 2**-64 per pair.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
SHINGLE = 5

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1          # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift): spreads every input bit."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95))
_WEIGHT = mix(np.arange(11, 11 + 4 * SHINGLE, dtype=_U)) | _U(1)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, dtype=_U), np.full(n, _INVERSE, dtype=_U)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def string_array(column) -> pa.Array:
    """One contiguous array without nulls (null becomes the empty text)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    return pc.fill_null(column, "")


def raw(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the n + 1 offsets of the texts in them."""
    a = string_array(column)
    if len(a) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(a.type)
    at = np.frombuffer(a.buffers()[1], dtype=np.int64 if wide else np.int32)
    at = at[a.offset:a.offset + len(a) + 1].astype(np.int64)
    data = a.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[at[0]:at[-1]], at - at[0]


@dataclass
class Words:
    """Words of a run of texts.  ``doc`` counts from 0 inside the run."""

    first: int             # index of the run's first text in the batch
    n: int                 # texts in the run
    data: np.ndarray       # bytes
    at: np.ndarray         # n + 1 offsets
    start: np.ndarray      # first byte of each word
    end: np.ndarray        # byte after each word
    doc: np.ndarray        # text of each word
    space: np.ndarray      # white-space byte?
    prefix: np.ndarray     # running byte hash, one longer than data
    down: np.ndarray       # inverse powers

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Position-free hash of each byte range."""
        if len(self.data) == 0:
            return np.zeros(len(start), _U)
        h = (self.prefix[end] - self.prefix[start]) * self.down[start]
        return mix(h + (end - start).astype(_U) * _U(0xA24BAED4963EE407))

    def per_doc(self, doc: np.ndarray, weights=None) -> np.ndarray:
        return np.bincount(doc, weights=weights, minlength=self.n)

    def bytes_of(self) -> np.ndarray:
        """Text of each byte."""
        return np.repeat(np.arange(self.n), np.diff(self.at))


def runs(column, chunk: int = CHUNK):
    """Cut a batch into runs of whole texts and find their words."""
    data, at = raw(column)
    n, i = len(at) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + chunk, side="right")) - 1)
        yield _words(i, data[at[i]:at[j]], at[i:j + 1] - at[i])
        i = j


def _words(first: int, data: np.ndarray, at: np.ndarray) -> Words:
    size = len(data)
    up, down = _powers(max(2 * CHUNK, 1 << int(size + 1).bit_length()))
    space = _SPACE[data]
    prefix = np.zeros(size + 1, _U)
    np.cumsum(_BYTE[data] * up[:size], out=prefix[1:])
    edge = np.zeros(size + 1, bool)
    edge[at] = True
    after = np.ones(size, bool)            # white space or a text's begin before it
    before = np.ones(size, bool)           # white space or a text's end after it
    if size:
        after[1:] = space[:-1]
        after |= edge[:-1]
        before[:-1] = space[1:]
        before |= edge[1:]
    start = np.flatnonzero(~space & after)
    end = np.flatnonzero(~space & before) + 1
    doc = np.searchsorted(at, start, side="right") - 1
    return Words(first, len(at) - 1, data, at, start, end, doc, space, prefix, down)


def windows(w: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word and hash of every window of ``size`` words that
    lies inside one text."""
    h = w.hashes(w.start, w.end)
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    total = np.zeros(n, _U)
    for j in range(size):
        total += h[j:n + j] * _weight(j)
    at = np.flatnonzero(w.doc[:n] == w.doc[size - 1:])
    return at, mix(total[at])


def _weight(j: int) -> np.uint64:
    return _WEIGHT[j] if j < len(_WEIGHT) else mix(np.array([j + 11], _U))[0] | _U(1)


def shingles(w: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every shingle, repeated ones too.  A text of 1 to
    ``size`` - 1 words is one shingle; a text without words has none."""
    at, h = windows(w, size)
    count = w.per_doc(w.doc)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short) == 0:
        return w.doc[at], h
    begin = np.searchsorted(w.doc, short)
    own = w.hashes(w.start, w.end)
    total = np.zeros(len(short), _U)
    for j in range(size - 1):
        has = count[short] > j
        total[has] += own[begin[has] + j] * _weight(j)
    doc = np.concatenate([w.doc[at], short])
    h = np.concatenate([h, mix(total + _U(0x632BE59BD9B4E019))])
    order = np.argsort(doc, kind="stable")
    return doc[order], h[order]


def weighted(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, hash) in ascending order and how often each occurs."""
    if len(h) == 0:
        return doc, h, np.zeros(0, np.int64)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return doc[at], h[at], np.diff(np.append(at, len(h)))
