"""Words of Arrow text columns as numpy arrays, with 64-bit hashes; runs of words have polynomial
(Rabin-Karp) hashes over those. A word's bytes are summed with a random odd factor per position, not
with powers of a base: modulo 2**64 powers of any base give equal sums to some long words of two
letters (the Thue-Morse word and its complement).

Shared by the operators that hash words or word windows. Everything here works on one slice
of a partition at a time, so memory is bounded by the slice size, not by the partition: a
slice holds whole texts up to ``SLICE_BYTES`` (one longer text is a slice of its own).

Words are maximal runs of bytes that are not in ``separators``; with the default these are
the words ``[^\\x20\\x09-\\x0D]+``. UTF-8 continuation bytes never fall in the ASCII range, so
working on bytes equals working on code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18

# Odd multipliers of the two polynomial hashes (bytes in a word, words in a window) and the
# finalizer's constants (splitmix64).
_BYTE_BASE = 0x9E3779B97F4A7C15 | 3
_WORD_BASE = 0xD1342543DE82EF95
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """base**i and base**-i modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inv = base & _MASK, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    @staticmethod
    def _grow(base: int, n: int) -> np.ndarray:
        out = np.ones(1, np.uint64)
        while len(out) < n:
            out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
        return out

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = self._grow(self.base, n), self._grow(self.inv, n)
        return self.up[:n], self.down[:n]


class _Factors:
    """A random odd factor for each byte position of a word, grown on demand."""

    def __init__(self):
        self.values = np.zeros(0, np.uint64)

    def get(self, n: int) -> np.ndarray:
        if len(self.values) < n:
            i = np.arange(max(n, 2 * len(self.values), 64), dtype=np.uint64)
            self.values = mix(i * np.uint64(_BYTE_BASE) + np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
        return self.values


_bytes, _words, _factors = _Powers(_BYTE_BASE), _Powers(_WORD_BASE), _Factors()
_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def separator_table(separators) -> np.ndarray:
    """Lookup table of separator bytes, from an iterable of byte values."""
    out = np.zeros(256, bool)
    out[list(separators)] = True
    return out


class Words:
    """The words of some texts. ``start``/``end`` are byte offsets into ``data``, ``doc`` the
    text's index within the slice, ``first[i]:first[i+1]`` the words of text i and
    ``hash`` one 64-bit hash per word (after lower-casing A-Z, if asked for)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool, space: np.ndarray):
        n, size = len(offsets) - 1, len(data)
        self.data, self.n_docs, self._total = data, n, None
        word = ~space[data]
        begins = np.zeros(size + 1, bool)
        begins[offsets] = True  # a text's first byte, and one past the last byte
        start, end = word.copy(), word
        if size:
            start[1:] &= ~word[:-1] | begins[1:-1]
            end = word.copy()
            end[:-1] &= ~word[1:] | begins[1:-1]
        self.start = np.flatnonzero(start)
        self.end = np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(n), self.count)
        table = _TABLE
        if lower:
            table = _TABLE.copy()
            table[0x41:0x5B] = _TABLE[0x61:0x7B]
        length = self.end - self.start
        if len(length):
            begin = np.cumsum(length) - length  # of each word among the bytes of words
            byte = np.arange(begin[-1] + length[-1])
            at = byte - np.repeat(begin, length)
            value = table[data[byte + np.repeat(self.start - begin, length)]] * _factors.get(int(length.max()))[at]
            self.hash = mix(np.add.reduceat(value, begin) + length.astype(np.uint64))
        else:
            self.hash = np.zeros(0, np.uint64)

    def text(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()

    def _sums(self) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.hash)
        up, down = _words.get(n + 1)
        if self._total is None:
            self._total = np.zeros(n + 1, np.uint64)
            np.cumsum(self.hash * up[:n], out=self._total[1:])
        return self._total, down

    def run_hash(self, at: np.ndarray, k: int) -> np.ndarray:
        """Hash of the ``k`` words from each word index in ``at``."""
        total, down = self._sums()
        return mix((total[at + k] - total[at]) * down[at])

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, doc, pos) of every run of ``k`` words inside one text; ``pos`` counts words
        from the start of the text."""
        n = len(self.hash)
        if n < k:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.doc[: n - k + 1] == self.doc[k - 1 :])
        doc = self.doc[at]
        return self.run_hash(at, k), doc, at - self.first[doc]


def slices(texts: pa.Array, lower: bool = False, space: np.ndarray = _SPACE, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(from, to, words) over consecutive rows of a string array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, side="right")) - 1)
        yield a, b, Words(data[off[a] : off[b]], off[a : b + 1] - off[a], lower, space)
        a = b
