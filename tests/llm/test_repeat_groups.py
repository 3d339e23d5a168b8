"""Maximal repeats with all their occurrences, against brute force."""

import random
from collections import Counter, defaultdict

import pytest

from barloom.llm.suffix_dedup import maximal_repeats
from barloom.llm.suffixes import common_prefix
from tests.llm.test_duplicates import mosaic


def brute_groups(texts, width):
    """String -> its occurrences (text, start), for every maximal repeat of at least `width` bytes."""
    data = [t.encode() for t in texts]
    suffixes = sorted((d[s:], k, s) for k, d in enumerate(data) for s in range(len(d) - width + 1))
    shared = [common_prefix(a[0], b[0]) for a, b in zip(suffixes, suffixes[1:])]
    groups = {}
    for i, depth in enumerate(shared):
        if depth < width or suffixes[i][0][:depth] in groups:
            continue
        low, high = i, i + 1
        while low and shared[low - 1] >= depth:
            low -= 1
        while high < len(shared) and shared[high] >= depth:
            high += 1
        held = [(k, s) for _, k, s in suffixes[low : high + 1]]
        before = {data[k][s - 1] if s else (k, s) for k, s in held}
        groups[suffixes[i][0][:depth]] = held if len(before) > 1 else None
    return {w: sorted(held) for w, held in groups.items() if held}


def check(spark, documents, texts, width, group):
    got = defaultdict(list)
    strings = defaultdict(set)
    for r in maximal_repeats(documents(list(enumerate(texts))), width=width, group=group).collect():
        string = texts[r["doc_id"]].encode()[r["start"] : r["start"] + r["length"]]
        got[string].append((r["doc_id"], r["start"]))
        strings[r["repeat_id"]].add(string)
    want = brute_groups(texts, width)
    assert {w: sorted(x) for w, x in got.items()} == want
    assert len(strings) == len(want) and all(len(x) == 1 for x in strings.values())
    return Counter(len(x) for x in want.values())


@pytest.mark.parametrize("group", [50_000, 3])
def test_a_part_of_a_passage_elsewhere(spark, documents, group):
    """Passage in two texts, its middle also in a third and, with more to the left, in a fourth and fifth."""
    rng = random.Random(1)
    p = "".join(rng.choice("abcdefgh ") for _ in range(450))
    q = p[120:300]
    texts = ["A " + p + " one", "B " + p + " two", "C " + q + " three", "D" + p[80:250] + "x", "E" + p[80:240] + "y"]
    sizes = check(spark, documents, texts, 64, group)
    assert sizes[2] and sizes[3] and sizes[5]


@pytest.mark.parametrize(("width", "group"), [(64, 50_000), (64, 3), (100, 50_000)])
def test_groups_equal_brute_force(spark, documents, width, group):
    texts = [*mosaic(width + 3, 14), "z" * 150, "same text " * 20, "same text " * 20]
    texts += ["before " + texts[0], texts[0], texts[0]]
    check(spark, documents, texts, width, group)
