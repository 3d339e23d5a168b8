"""Jaccard components, connected components and repeated strings against brute force."""

import hashlib
import random
import re
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from barloom.llm import jaccard_join, suffix_dedup
from barloom.llm.components import connected_components
from barloom.llm.frames import table
from barloom.llm.jaccard_join import _first_regions, jaccard_components
from barloom.llm.suffix_dedup import maximal_repeats, without_repeats
from barloom.llm.suffixes import anchors
from barloom.llm.words import word_hashes


def shingle_set(text):
    words = [bytes(b + 32 if 65 <= b <= 90 else b for b in x) for x in re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode())]
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def brute_components(rows):
    """(id, size, smallest id of the component) of each row, in order."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for k, (d, _) in enumerate(rows):
        if d is not None:
            least[root(k)].append(d)
    return [(d, len(sets[k]), (min(least[root(k)], default=None) if sets[k] else d)) for k, (d, _) in enumerate(rows)]


def near_copies(seed, families, members, words=60, edits=8):
    """Families of texts with up to `edits` words changed, so that some pairs lie near the border."""
    rng = random.Random(seed)
    rows = []
    for _ in range(families):
        base = [f"w{rng.randrange(3000)}" for _ in range(words)]
        for _ in range(members):
            own = list(base)
            for _ in range(rng.randrange(edits)):
                own[rng.randrange(words)] = f"e{rng.randrange(9999)}"
            rows.append(" ".join(own))
    return rows


def as_rows(frame):
    key = lambda r: tuple((x is not None, x) for x in r)
    return sorted((tuple(r) for r in frame.collect()), key=key)


EDGES = [(100, None), (101, ""), (102, "one two"), (103, "ONE two"), (103, "one two"), (104, " \t\n"), (None, "one two"), (None, "only here"), (105, "x " * 3000), (106, "X " * 2000)]


@pytest.mark.parametrize("leaf", [512, 6])
def test_components_equal_brute_force(spark, documents, monkeypatch, leaf):
    rows = [(k, t) for k, t in enumerate(near_copies(3, 4, 14) + near_copies(5, 2, 25, words=30, edits=12))] + EDGES
    for rounds in (3, 0):
        monkeypatch.setattr(jaccard_join, "ROUNDS", rounds)
        monkeypatch.setattr(jaccard_join, "BLOCKS", 1 if rounds else 16)
        got = as_rows(jaccard_components(documents(rows, "n_shingles"), leaf=leaf, frequent=0.2 if rounds else 0.001))
        assert got == sorted(brute_components(rows), key=lambda r: tuple((x is not None, x) for x in r))


def test_sets_without_an_id_are_members_and_bridges(spark, documents, monkeypatch):
    monkeypatch.setattr(jaccard_join, "GROUP_MEMBERS", 300)  # groups are cut by their members, too
    base = [f"w{k}" for k in range(80)]
    ends = [" ".join(["a", "b", "c"][: k % 4] + base[k // 4 :]) for k in range(0, 48, 4)]
    rows = [(k if k in (0, 11) else None, t) for k, t in enumerate(ends)] + [(7, t) for t in near_copies(4, 1, 6)] + [(None, t) for t in near_copies(6, 1, 6)]
    got = as_rows(jaccard_components(documents(rows), leaf=8, frequent=0.9))
    assert got == sorted(brute_components(rows), key=lambda r: tuple((x is not None, x) for x in r))
    assert [r[2] for r in got if r[0] == 11] == [0]  # linked through sets that have no id


def test_components_of_documents(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()]
    assert as_rows(jaccard_components(table(spark, sf, "documents"))) == sorted(brute_components(rows))
    assert jaccard_components(table(spark, sf, "documents").limit(0)).count() == 0


def test_ids_may_be_joined_by_shuffle(spark, documents, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SENT_IDS", 0)
    rows = list(enumerate(near_copies(9, 2, 8)))
    assert as_rows(jaccard_components(documents(rows))) == sorted(brute_components(rows))


def test_connected_components(spark):
    rng = random.Random(1)
    links = [(k, k + 1) for k in range(50)] + [(200, k) for k in range(201, 260)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)] + [(5, 5), (None, 3)]
    got = dict(as_rows(connected_components(spark.createDataFrame(links, "a long, b long"))))
    label = {x: x for pair in links for x in pair if x is not None}
    for _ in range(200):
        for a, b in links:
            if a is not None:
                label[a] = label[b] = min(label[a], label[b])
    assert got == {x: v for x, v in label.items() if any(x in p and p[0] != p[1] and None not in p for p in links)}


def test_word_hashes_follow_words():
    texts = ["A b\tc", None, "", "a  B", "é a", " c", "a\x0bb"]
    hashes, starts, ends, offsets = word_hashes(pa.array(texts))
    words = [x for t in texts for x in (t or "").lower().split()]
    assert np.diff(offsets).tolist() == [3, 0, 0, 2, 2, 1, 2]
    assert len(set(zip(words, hashes.tolist(), strict=True))) == len(set(words)) == len(set(hashes.tolist()))
    assert (ends > starts).all()


def brute_repeats(texts, width):
    data = [(t or "").encode() for t in texts]
    seen = defaultdict(int)
    for d in data:
        for s in range(len(d) - width + 1):
            seen[d[s : s + width]] += 1
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for s in range(len(d) - width + 1):
            if seen[d[s : s + width]] > 1:
                gone[s : s + width] = True
        kept = bytes(b for b, g in zip(d, gone, strict=False) if not g)
        runs = int((gone[1:-1] & ~gone[:-2]).sum() + gone[0]) if len(d) else 0
        out.append((len(d), len(d) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return out


def mosaic(seed, count):
    """Texts that share passages of many lengths, nested and overlapping, with periodic parts and odd characters."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randrange(30, 400)))
    pool = [word() for _ in range(8)]
    texts = []
    for _ in range(count):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            p = rng.choice(pool)
            a = rng.randrange(len(p))
            parts.append(rng.choice([p, p[a:], p[:a], word(), "ab" * rng.randrange(200), p + p]))
        texts.append("".join(parts))
    return texts


@pytest.mark.parametrize(("width", "group"), [(64, 50_000), (100, 50_000), (64, 3)])
def test_removed_bytes_equal_brute_force(spark, documents, width, group):
    texts = [*mosaic(width, 40), None, "", "short", "z" * 500, "same text " * 20, "same text " * 20]
    rows = [(k if k % 9 else None, t) for k, t in enumerate(texts)] + [(1, texts[1]), (2, texts[3])]
    got = without_repeats(documents(rows, "n_bytes"), width=width, group=group).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    want = [(d, *w) for (d, _), w in zip(rows, brute_repeats([t for _, t in rows], width), strict=True)]
    assert as_rows(got) == sorted(want, key=lambda r: tuple((x is not None, x) for x in r))


def test_repeat_groups_hold_equal_strings(spark, documents):
    rows = list(enumerate(mosaic(4, 30)))
    found = maximal_repeats(documents(rows), width=64).collect()
    text = {d: t.encode() for d, t in rows}
    groups = defaultdict(set)
    for r in found:
        groups[r["repeat_id"]].add(text[r["doc_id"]][r["start"] : r["start"] + r["length"]])
    assert groups and all(len(x) == 1 for x in groups.values())
    covered = {d: np.zeros(len(t), bool) for d, t in text.items()}
    for r in found:
        covered[r["doc_id"]][r["start"] : r["start"] + r["length"]] = True
    assert [int(covered[d].sum()) for d, _ in rows] == [x[1] for x in brute_repeats([t for _, t in rows], 64)]


def test_documents_and_slices(spark, sf, monkeypatch):
    docs = table(spark, sf, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = without_repeats(docs, width=400).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert as_rows(got) == sorted((d, *w) for (d, _), w in zip(rows, brute_repeats([t for _, t in rows], 400), strict=True))
    assert without_repeats(docs.limit(0)).count() == 0
    from barloom.llm import suffixes
    from barloom.llm.words import text_bytes

    data, offsets = text_bytes(pa.array([t for _, t in rows[:40]]))
    whole = suffixes.anchors(data, offsets, 400)
    monkeypatch.setattr(suffixes, "SLICE", 701)
    assert all((a == b).all() for a, b in zip(whole, suffixes.anchors(data, offsets, 400), strict=True))
    assert suffix_dedup.GROUP > 0


def test_first_regions_only_hold_places_that_linked_sets_can_share(spark):
    # of 100 n-grams the first 15 are early, of 80 the first 12
    rows = [(1, 100, 20, 1), (2, 100, 20, 1), (3, 100, 14, 2), (4, 100, 14, 2), (5, 80, 11, 3), (6, 100, 20, 3), (7, 80, 15, 4), (8, 100, 3, 4), (9, 70, 0, 5), (10, 100, 0, 5)]
    found = _first_regions(spark.createDataFrame(rows, "node bigint, n bigint, at int, region bigint"), 75).collect()
    assert sorted((r["region"], r["node"], r["n"]) for r in found) == [(2, 3, 100), (2, 4, 100), (3, 5, 80), (3, 6, 100)]


def test_first_regions_hold_every_linked_pair(spark):
    pick, sets = random.Random(11), {}
    for group in range(30):
        base = pick.sample(range(10_000), pick.randint(1, 60))
        for _ in range(4):
            kept = [x for x in base if pick.random() > 0.08]
            sets[len(sets)] = sorted({*kept, *pick.sample(range(10_000), pick.randint(0, 4))})
    rows = [(k, len(x), at, gram) for k, x in sets.items() if x for at, gram in enumerate(x[: len(x) - -(-75 * len(x) // 100) + 1])]
    regions = {}
    for r in _first_regions(spark.createDataFrame(rows, "node bigint, n bigint, at int, region bigint"), 75).collect():
        regions.setdefault(r["region"], set()).add(r["node"])
    linked = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len({*sets[a]} & {*sets[b]}) >= 75 * len({*sets[a]} | {*sets[b]})]
    assert len(linked) > 40 and all(any({a, b} <= x for x in regions.values()) for a, b in linked)


def test_anchors_take_bounded_memory():
    data = np.random.default_rng(1).integers(97, 123, 3 << 20, dtype=np.uint8)
    tracemalloc.start()
    anchors(data, np.arange(0, len(data) + 1, 4096), 400)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20
