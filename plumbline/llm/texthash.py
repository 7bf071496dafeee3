"""Hashes of the words and shingles of many texts at once, over the bytes of an Arrow column.

A word is a longest run of bytes other than blank and the five control characters from tab to
carriage return; A-Z count as a-z.  Bytes are turned into random 64-bit numbers, running sums of
them times powers of an odd base give every word's hash in one pass, whatever its length, and
positions never depend on how texts are batched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

_BASE = 0x9E3779B97F4A7C15 | 1
_SPAN = 1 << 19  # bytes hashed at a time
_LONG = 1 << 16  # longer words are hashed one by one

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: A-Z as a-z and every other ASCII character that is neither letter nor digit as a blank.
ALNUM = np.where((_LOWER < 128) & ~np.isin(_LOWER, np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789", dtype=np.uint8)), 32, _LOWER).astype(np.uint8)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_VALUE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)


def _powers(base: int) -> np.ndarray:
    out = np.full(_SPAN + _LONG + 1, base % 2**64, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_BASE)
_DOWN = _powers(pow(_BASE, -1, 2**64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over the whole number."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Words:
    """Where the words of a run of texts lie, and their hashes."""

    def __init__(self, data: np.ndarray, edges: np.ndarray, table: np.ndarray = _LOWER):
        """``data``: the bytes; ``edges``: where each text begins, and the end of the last; ``table``: what each byte counts as."""
        self.raw, self.edges = data, edges
        self.data = data = np.take(table, data)
        inner = ~np.take(_BLANK, data)
        opens = inner.copy()
        opens[1:] &= ~inner[:-1]
        cuts = edges[:-1][edges[:-1] < edges[-1]]
        opens[cuts] = inner[cuts]
        self.starts = np.flatnonzero(opens)
        closes = inner
        closes[:-1] &= ~(inner[1:] & ~opens[1:])
        self.ends = np.flatnonzero(closes) + 1
        #: the first word of each text, and the number of all
        self.bounds = np.searchsorted(self.starts, edges)
        self.hashes = self._hashed()

    def _hashed(self) -> np.ndarray:
        out = np.empty(len(self.starts), dtype=np.uint64)
        at = 0
        long = np.append(np.flatnonzero(self.ends - self.starts > _LONG), len(out))
        while at < len(out):
            base = self.starts[at]
            first = long[np.searchsorted(long, at)]
            to = min(max(at + 1, int(np.searchsorted(self.ends, base + _SPAN, "right"))), max(first, at + 1))
            if at == first:
                word = self.data[base : self.ends[at]]
                out[at] = xxhash.xxh64_intdigest(np.ascontiguousarray(word), seed=7)
                at += 1
                continue
            part = np.take(_VALUE, self.data[base : self.ends[to - 1]]) * _UP[: self.ends[to - 1] - base]
            sums = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(part, out=sums[1:])
            s, e = self.starts[at:to] - base, self.ends[at:to] - base
            out[at:to] = (sums[e] - sums[s]) * _DOWN[s]
            at = to
        return mixed(out + (self.ends - self.starts).astype(np.uint64))

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``width`` words of each text, in order, and where each text's begin.

        A text of fewer words has one: the run of all of them; a text without words has none.
        """
        n, counts = len(self.hashes), np.diff(self.bounds)
        full = np.zeros(max(0, n - width + 1), dtype=np.uint64)
        for k in range(width):
            full = full * np.uint64(_BASE) + self.hashes[k : k + len(full)]
        full = mixed(full + np.uint64(width))
        owner = np.repeat(np.arange(len(counts)), counts)
        whole = owner[: len(full)] == owner[width - 1 :] if len(full) else np.zeros(0, dtype=bool)
        sizes = np.maximum(counts - width + 1, np.minimum(counts, 1))
        edges = np.zeros(len(counts) + 1, dtype=np.int64)
        np.cumsum(sizes, out=edges[1:])
        out = np.empty(edges[-1], dtype=np.uint64)
        long = counts >= width
        spots = np.ones(len(out), dtype=bool)
        for i in np.flatnonzero(~long & (counts > 0)):
            value = np.uint64(0)
            with np.errstate(over="ignore"):
                for h in self.hashes[self.bounds[i] : self.bounds[i + 1]]:
                    value = value * np.uint64(_BASE) + h
            out[edges[i]] = mixed(np.array([value + np.uint64(counts[i])], dtype=np.uint64))[0]
            spots[edges[i]] = False
        out[spots] = full[whole]
        return out, edges


def words_of(texts: pa.Array, most: int = 1 << 20, table: np.ndarray = _LOWER):
    """Yields (first row, ``Words``) for runs of rows of about ``most`` bytes, or one longer row."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    texts = texts.fill_null(b"")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    edges = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(texts):
        to = max(row + 1, int(np.searchsorted(edges, edges[row] + most, "right")) - 1)
        yield row, Words(data[edges[row] : edges[to]], edges[row : to + 1] - edges[row], table)
        row = to
