"""Re-Pair grammar compression of id sequences, in numpy.

A frame holds up to about a million ids. Frequent adjacent pairs are replaced by nonterminals, the
most frequent first, in rounds: one round replaces many pairs that do not overlap. The frame stores
the rules and how many ids each expands to, so any range is decoded by expanding only the symbols
that overlap it.

Layout, little-endian: magic, 6 unsigned 32-bit numbers (ids, terminals, rules, rounds, symbols,
bytes per symbol), rules per round, terminal ids, left sides, right sides, expansion lengths (all
unsigned 32-bit), then the symbols. Symbol s < terminals is that terminal, else rule s - terminals.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"RPR1"
_TABLE_BITS = 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def laid(flat: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs numbered `which` of `flat`, one after the other; run k is `lengths[k]` long."""
    each = lengths[which]
    stops = np.cumsum(each)
    at = np.repeat((np.cumsum(lengths) - lengths)[which] - (stops - each), each)
    at += np.arange(len(at))
    return flat[at]


def _round(a: np.ndarray, first: int, most_rules: int, min_count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Replace frequent pairs of `a` by symbols from `first`; (new sequence, left sides, right sides).

    Pairs are counted in a table by their hash. Where two pairs share an entry only one of them is
    a candidate in this round; its count is then taken exactly.
    """
    key = a[:-1].astype(np.uint64) << np.uint64(32) | a[1:].astype(np.uint64)
    entry = (key * _ODD >> np.uint64(64 - _TABLE_BITS)).astype(np.int32)
    count = np.bincount(entry, minlength=1 << _TABLE_BITS)
    often = np.flatnonzero(count >= min_count)
    if len(often) > most_rules:
        often = often[np.argpartition(-count[often], most_rules)[:most_rules]]
    slot = np.full(1 << _TABLE_BITS, -1, np.int32)
    slot[often] = np.arange(len(often), dtype=np.int32)
    at = np.flatnonzero(slot[entry] >= 0)
    which, found = slot[entry[at]], key[at]
    pair = np.zeros(len(often), np.uint64)
    pair[which] = found
    same = pair[which] == found
    at, which = at[same], which[same]
    weight = np.zeros(len(a) + 1, np.int32)
    weight[at + 1] = np.bincount(which, minlength=len(often)).astype(np.int32)[which]
    # of overlapping pairs the more frequent one is replaced, of equal ones the left one
    here = weight[at + 1]
    chosen = (here > weight[at]) & (here >= np.append(weight, 0)[at + 2])
    at, which = at[chosen], which[chosen]
    used = np.bincount(which, minlength=len(often))
    kept = np.flatnonzero(used >= min_count)
    number = np.full(len(often), -1, np.int64)
    number[kept] = first + np.arange(len(kept))
    fine = number[which] >= 0
    at, which = at[fine], which[fine]
    a = a.copy()
    a[at] = number[which]
    stay = np.ones(len(a), bool)
    stay[at + 1] = False
    sides = pair[kept]
    return a[stay], (sides >> np.uint64(32)).astype(np.uint32), (sides & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def compress(ids: np.ndarray, rounds: int = 8, most_rules: int = 4096, min_count: int = 8, min_gain: float = 0.02) -> bytes:
    """One frame; rounds end early when one shortens the sequence by less than `min_gain`. No ids: an empty frame."""
    ids = np.asarray(ids, np.uint32)
    if len(ids) and int(ids.max()) < 1 << 22:
        terminals = np.flatnonzero(np.bincount(ids)).astype(np.uint32)
        index = np.zeros(int(ids.max()) + 1, np.uint32)
        index[terminals] = np.arange(len(terminals), dtype=np.uint32)
        a = index[ids]
    else:
        terminals, a = np.unique(ids, return_inverse=True)
        a = a.astype(np.uint32)
    lefts, rights, sizes = [], [], []
    lengths = np.ones(len(terminals), np.uint32)
    for _ in range(rounds):
        if len(a) < 2:
            break
        before = len(a)
        a, left, right = _round(a, len(lengths), most_rules, min_count)
        if not len(left):
            break
        lefts.append(left), rights.append(right), sizes.append(len(left))
        lengths = np.concatenate([lengths, lengths[left] + lengths[right]])
        if len(a) > (1 - min_gain) * before:
            break
    width = 2 if len(lengths) <= 1 << 16 else 4
    numbers = [len(ids), len(terminals), sum(sizes), len(sizes), len(a), width]
    parts = [np.array(sizes), terminals, *lefts, *rights, lengths[len(terminals) :]]
    return MAGIC + struct.pack("<6I", *numbers) + b"".join(np.asarray(x).astype("<u4").tobytes() for x in parts) + a.astype(f"<u{width}").tobytes()


class Frame:
    """A frame that can be read from any place: `frame.read(start, stop)`, `len(frame)`."""

    def __init__(self, data: bytes) -> None:
        if data[:4] != MAGIC:
            raise ValueError("not a frame")
        self.n, terminals, rules, rounds, symbols, width = struct.unpack_from("<6I", data, 4)
        at = 28

        def take(count: int, kind: str = "<u4") -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        sizes, values, left, right, expansions = take(rounds), take(terminals), take(rules), take(rules), take(rules)
        self.symbols = take(symbols, f"<u{width}")
        self.lengths = np.concatenate([np.ones(terminals, np.int64), expansions.astype(np.int64)])
        self.flat, done = values, 0
        for size in sizes.tolist():  # rules of a round use symbols of earlier rounds only
            sides = np.stack([left[done : done + size], right[done : done + size]], 1).ravel()
            self.flat = np.concatenate([self.flat, laid(self.flat, self.lengths[: terminals + done], sides)])
            done += size
        self.stops: np.ndarray | None = None

    def __len__(self) -> int:
        return self.n

    def read(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids start..stop; only the symbols that reach into this range are expanded."""
        stop = self.n if stop is None else min(stop, self.n)
        if start <= 0 and stop == self.n:
            return laid(self.flat, self.lengths, self.symbols)
        if start >= stop:
            return np.zeros(0, np.uint32)
        if self.stops is None:
            self.stops = np.cumsum(self.lengths[self.symbols])
        a, b = np.searchsorted(self.stops, [start, stop - 1], "right")
        skipped = start - (int(self.stops[a - 1]) if a else 0)
        return laid(self.flat, self.lengths, self.symbols[a : b + 1])[skipped : skipped + stop - start]
