"""Words of whole texts as numpy arrays, for Arrow batches inside tasks.

A word is a run of characters other than space and U+0009 to U+000D. These
separators are ASCII, so words are cut on the UTF-8 bytes without decoding.
Every function works on a whole batch of texts at once; work arrays that grow
with the bytes are made for at most ``SEGMENT_BYTES`` at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SEGMENT_BYTES = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240611))
BYTE_KEYS = _rng.integers(1, 2**64, size=256, dtype=np.uint64, endpoint=False)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACES = _rng.integers(1, 2**64, size=64, dtype=np.uint64, endpoint=False) | np.uint64(1)

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


@dataclass
class Words:
    """Words of a batch: byte spans in ``data``; ``first[d]:first[d+1]`` are
    the words of text ``d``, whose bytes are ``at[d]:at[d+1]``."""

    data: np.ndarray
    at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after the other, and where each begins."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    n = len(texts)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + n + 1] if offsets else np.zeros(n + 1, np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def split_words(texts: pa.Array, lower: bool = False) -> Words:
    data, at = text_bytes(texts)
    if lower:
        data = LOWER[data]
    inside = ~IS_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    # A text's first byte begins a word and its last one ends a word, whatever
    # stands beside it in the batch.
    full = at[:-1][np.diff(at) > 0]
    begins[full] = inside[full]
    last = at[1:][np.diff(at) > 0] - 1
    ends[last] = inside[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(data, at, start, end, np.searchsorted(start, at))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span (spans in order, none overlapping)."""
    out = np.zeros(len(start), dtype=np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + SEGMENT_BYTES, side="right")))
        size = end[i:j] - start[i:j]
        before = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(before, size)
        terms = BYTE_KEYS[data[np.repeat(start[i:j], size) + place]]
        terms *= _powers(int(size.max(initial=1)))[place]
        full = size > 0
        if full.any():
            out[i:j][full] = np.add.reduceat(terms, before[full])
        out[i:j] = mix(out[i:j] + size.astype(np.uint64) * _PLACES[63])
        i = j
    return out


_POWERS = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        steps = np.full(max(n, 4096), _BASE, dtype=np.uint64)
        steps[0] = 1
        _POWERS = np.multiply.accumulate(steps)
    return _POWERS


def word_hashes(w: Words) -> np.ndarray:
    return span_hashes(w.data, w.start, w.end)


def windows(w: Words, hashes: np.ndarray, size: int, short: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of ``size`` words, and the index of the first
    run of each text (n + 1 numbers). With ``short``, a text that has fewer
    words, but at least one, has its whole sequence as its only run."""
    count = np.diff(w.first)
    runs = np.maximum(count - size + 1, 0)
    if short:
        runs = np.where((count > 0) & (count < size), 1, runs)
    first = np.concatenate([[0], np.cumsum(runs)])
    begin = np.arange(first[-1]) - np.repeat(first[:-1], runs) + np.repeat(w.first[:-1], runs)
    length = np.repeat(np.minimum(count, size), runs)
    out = length.astype(np.uint64) * _PLACES[size]
    for k in range(size):
        here = np.minimum(begin + k, max(len(hashes) - 1, 0))
        out += np.where(k < length, hashes[here] * _PLACES[k], np.uint64(0)) if len(hashes) else np.uint64(0)
    return mix(out), first


def slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``SEGMENT_BYTES`` of text; a longer
    text stands alone."""
    for batch in batches:
        _, at = text_bytes(batch.column(batch.schema.get_field_index(text)))
        i, n = 0, batch.num_rows
        while i < n:
            j = max(i + 1, int(np.searchsorted(at, at[i] + SEGMENT_BYTES, side="right")) - 1)
            yield batch.slice(i, j - i)
            i = j
