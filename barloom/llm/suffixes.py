"""Anchors of texts, and the sparse suffix array of the places that share an anchor.

Anchors: in every window of `width` bytes the `GRAM`-byte string with the smallest hash (the
leftmost of equal ones) is the window's anchor. Equal windows have equal anchors at equal offsets,
so two equal strings of `width` bytes always meet under one anchor hash.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np

from barloom.llm.words import mixed

GRAM = 32
#: Bytes that are looked at together; each takes some hundred bytes of memory.
SLICE = 256 << 10


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position, by doubling."""
    h = data.astype(np.uint64) + np.uint64(1)
    size, base = 1, 0x9E3779B97F4A7C15
    while size < GRAM:
        h = h[: len(h) - size] * np.uint64(base) + h[size:]
        base = base * base % (1 << 64)
        size *= 2
    return mixed(h)


def _smallest(values: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each `w` neighbouring values, by prefix and suffix minima of blocks."""
    n = len(values)
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, w)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - w + 1], forward[w - 1 : n])


def anchors(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, position, first window, last window) of each anchor of texts laid end to end.

    Positions count from the start of the text. The windows whose anchor it is are a run of starts.
    """
    w, marks = width - GRAM + 1, np.uint64((1 << 40) - 1) << np.uint64(24)
    out: list[tuple[np.ndarray, ...]] = []
    total = int(offsets[-1])
    for low in range(0, max(total - width + 1, 0), SLICE):  # windows that start in low .. low + SLICE
        part = data[low : min(low + SLICE + width - 1, total)]
        h = gram_hashes(part)
        least = _smallest(h & marks | np.arange(len(h), dtype=np.uint64), w)
        at = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
        starts = np.arange(len(at)) + low
        text = np.searchsorted(offsets, starts, "right") - 1
        fine = starts + width <= offsets[text + 1]
        starts, text, at = starts[fine], text[fine], at[fine]
        if not len(starts):
            continue
        new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])]))
        last = np.append(new[1:], len(starts)) - 1
        out.append((text[new], h[at[new]], at[new] + low, starts[new], starts[last]))
    if not out:
        return tuple(np.zeros(0, np.uint64 if k == 1 else np.int64) for k in range(5))
    text, h, at, first, last = (np.concatenate(x) for x in zip(*out, strict=True))
    # an anchor on both sides of a slice border is one anchor
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])]))
    last = last[np.append(new[1:], len(at)) - 1]
    text, h, at, first = text[new], h[new], at[new], first[new]
    return text, h, at - offsets[text], first - offsets[text], last - offsets[text]


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def intervals(order: list[int], shared: list[int]) -> Iterator[tuple[int, list[list[int]]]]:
    """(depth, the members of each child) of every node of the tree of sorted strings.

    `shared` has the common prefix of each string with the next one.
    """
    stack: list[tuple[int, list[list[int]]]] = [(-1, [])]
    for member, depth in zip(order, [*shared, -1], strict=True):
        child = [member]
        while stack[-1][0] > depth:
            d, children = stack.pop()
            children.append(child)
            yield d, children
            child = [x for c in children for x in c]
        if stack[-1][0] == depth:
            stack[-1][1].append(child)
        else:
            stack.append((depth, [child]))


def all_repeats(left: list[bytes], right: list[bytes], bounds: list[tuple[int, int]], width: int) -> Iterator[tuple[list[int], int, int]]:
    """(members, l, r): every maximal repeat of l bytes before and r bytes from an anchor, with all items that hold it.

    A node of the tree of `right` has depth r; among its members, each node of the tree of `left` with
    members of two children differs on both sides, so its string is maximal, and it has all holders of
    it. l lies within `bounds` of an item: strings that start elsewhere belong to another anchor.
    """
    order = sorted(range(len(right)), key=right.__getitem__)
    place = {item: k for k, item in enumerate(sorted(range(len(left)), key=left.__getitem__))}
    furthest = max((high for _, high in bounds), default=0)
    for r, children in intervals(order, [common_prefix(right[a], right[b]) for a, b in zip(order, order[1:])]):
        if r + furthest < width:
            continue
        child_of = {item: k for k, c in enumerate(children) for item in c}
        members = sorted(child_of, key=place.__getitem__)
        for l, parts in intervals(members, [common_prefix(left[a], left[b]) for a, b in zip(members, members[1:])]):  # noqa: E741
            held = [x for p in parts for x in p]
            low, high = bounds[held[0]]
            if l + r >= width and low <= l <= high and len({child_of[x] for x in held}) > 1:
                yield held, l, r


def repeats(left: list[bytes], right: list[bytes], width: int) -> Iterator[tuple[int, int, int]]:
    """(item, l, r): the l bytes before and r bytes from an anchor also stand at another item, l + r >= width.

    `left` holds the bytes before the anchor, reversed. The items are sorted by `right`: a suffix
    array with the common prefixes of neighbours. A stack scan closes its intervals from the deepest
    to the widest. A closing interval of depth r joins two groups, each in order of the bytes to the
    left; a joined item and its neighbours there have the longest common left extension l, beyond
    which their bytes differ, so l + r is a maximal repeat. Any other pair of the interval shares
    no more to the left than one of these, so every pair's common string lies in a reported one.
    """
    order = sorted(range(len(right)), key=right.__getitem__)
    place = {item: k for k, item in enumerate(sorted(range(len(left)), key=left.__getitem__))}
    at_place = sorted(place, key=place.__getitem__)
    stack: list[tuple[list[int], int]] = []  # (places in the left order, common prefix with what follows)

    def join(a: list[int], b: list[int], r: int) -> Iterator[tuple[int, int, int]]:
        if len(a) < len(b):
            a, b = b, a
        for x in b:
            k = bisect_left(a, x)
            for y in a[max(k - 1, 0) : k + 1]:
                length = common_prefix(left[at_place[x]], left[at_place[y]])
                if length + r >= width:
                    yield at_place[x], length, r
                    yield at_place[y], length, r
            a.insert(k, x)
        stack.append((a, -1))

    for k, item in enumerate(order):
        if stack:
            depth = common_prefix(right[order[k - 1]], right[item])
            while len(stack) > 1 and stack[-2][1] >= depth:
                (b, _), (a, r) = stack.pop(), stack.pop()
                yield from join(a, b, r)
            stack[-1] = (stack[-1][0], depth)
        stack.append(([place[item]], -1))
    while len(stack) > 1:
        (b, _), (a, r) = stack.pop(), stack.pop()
        yield from join(a, b, r)
