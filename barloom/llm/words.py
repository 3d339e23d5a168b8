"""Word hashes of many texts at once, in numpy: the base of the operators on word n-grams.

A word is a maximal run of bytes other than blank, tab, line feed, vertical tab, form feed and
carriage return; A-Z count as a-z. Words and n-grams are known by 64-bit hashes, so two different
ones are taken for equal with a chance of about 1 in 10^19 per pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text whose words are hashed together; each takes some fifty bytes of memory.
WORD_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers, so that all bits depend on all."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def powers(n: int) -> np.ndarray:
    """1, B, B^2, ... (n numbers) modulo 2^64."""
    out = np.full(max(n, 1), _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)[:n]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes one text after the other, and the offset of each text (one more at the end); null is empty."""
    filled = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(filled.buffers()[1], np.int64, len(filled) + 1, filled.offset * 8)
    data = filled.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start byte, end byte) of each word of the texts laid end to end, and each text's offset in the words."""
    data, offsets = text_bytes(texts)
    space = np.ones(len(data) + 1, bool)
    space[:-1] = _SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets[:-1][np.diff(offsets) > 0]] = True
    inside = ~space
    starts = np.flatnonzero(inside[:-1] & (edge[:-1] | np.concatenate([[True], space[:-2]]))) if len(data) else np.zeros(0, np.int64)
    after = np.ones(len(data) + 1, bool)
    after[:-1] = space[1:] | edge[1:]
    if len(data):
        after[len(data) - 1] = True
    ends = np.flatnonzero(inside & after) + 1
    hashes = np.zeros(len(starts), np.uint64)
    if len(starts):
        # prefix sums of byte * B^position, taken back to position 0 by the inverse power of the start
        sums = np.zeros(len(data) + 1, np.uint64)
        step = 1 << 20
        power = powers(step + 1)
        scale, total = np.ones(1, np.uint64), np.zeros(1, np.uint64)
        low = _LOWER[data].astype(np.uint64) + np.uint64(1)
        for k in range(0, len(data), step):
            part = low[k : k + step] * (power[: min(step, len(data) - k)] * scale)
            np.cumsum(part, out=part)
            sums[k + 1 : k + 1 + len(part)] = part + total
            total = sums[k + len(part)][None]
            scale = scale * power[step : step + 1]
        back = np.full(len(data) + 1, _INVERSE, np.uint64)
        back[0] = 1
        back = np.multiply.accumulate(back)
        hashes = mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return hashes, starts, ends, np.searchsorted(starts, offsets)


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of `n` words; of the whole sequence where it is shorter; none for no words."""
    if not len(words):
        return words
    n = min(n, len(words))
    out = words[: len(words) - n + 1] * np.uint64(0x9E3779B97F4A7C15)
    for k in range(1, n):
        out = mixed(out) + words[k : len(words) - n + 1 + k] * np.uint64(0xC2B2AE3D27D4EB4F + 2 * k)
    return mixed(out + np.uint64(n))
