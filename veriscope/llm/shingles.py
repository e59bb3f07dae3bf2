"""Word shingles of many texts at once, as 64-bit hashes (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes of text handled at a time inside a batch.
SLICE = 1 << 20
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    word = np.zeros(256, bool)
    word[48:58] = word[97:123] = word[128:] = True       # the bytes of common.WORD
    return lower, word


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of words of every text) of texts that end at ``ends`` in ``data``."""
    lower, word = _tables()
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(ends), "i8")
    data = lower[data]
    inside = word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = ends[:-1][ends[:-1] < len(data)]
    first[cuts] = inside[cuts]                            # a text's first byte never continues a word
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(ends), "i8")
    at = np.flatnonzero(inside)
    begin = np.searchsorted(at, starts)
    place = np.arange(len(at)) - np.repeat(begin, np.diff(begin, append=len(at)))
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(place.max()), MULTIPLIER)]), dtype=np.uint64)
    hashes = mix(np.add.reduceat((data[at].astype(np.uint64) + np.uint64(1)) * powers[place], begin))
    upto = np.searchsorted(starts, ends)
    return hashes, np.diff(upto, prepend=0)


def shingle_sets(texts: pa.Array, size: int = 5):
    """Yields, for each text, its sorted distinct shingle hashes.

    A text of fewer words, but not none, is one shingle; a text without words has none."""
    data, offsets = _buffers(texts)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SLICE)))
        hi = min(hi, len(texts))
        ws, counts = word_hashes(data[offsets[lo]:offsets[hi]], offsets[lo + 1:hi + 1] - offsets[lo])
        grams = ws.copy()
        for k in range(1, size):
            if len(ws) > k:
                grams[:len(ws) - k] = grams[:len(ws) - k] * MULTIPLIER + ws[k:]
        grams = mix(grams)
        at = 0
        for n in counts.tolist():
            if n >= size:
                yield np.unique(grams[at:at + n - size + 1])
            elif n:
                one = np.uint64(n)
                with np.errstate(over="ignore"):
                    for w in ws[at:at + n]:
                        one = one * MULTIPLIER + w
                yield mix(np.array([one], np.uint64))
            else:
                yield np.empty(0, np.uint64)
            at += n
        lo = hi


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; nulls are empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, "i8")[texts.offset:texts.offset + len(texts) + 1]
    return (np.frombuffer(data, "u1") if data is not None else np.empty(0, "u1")), offsets
