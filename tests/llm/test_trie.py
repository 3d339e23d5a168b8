"""Prefix trie and tree contraction against direct computation."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from barloom.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, pos long, node string, part int"


def brute(rows):
    """The rows of the trie by walking every rebuilt conversation."""
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    full = {}
    for c, mine in turns.items():
        base = c - c % 5
        h = zlib.crc32(str(c).encode()) % 9
        full[c] = mine if base == c else turns.get(base, [])[:h] + mine[h:]
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, seq in full.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
            if d:
                kids[tuple(seq[: d - 1])].add(tuple(seq[:d]))
        ends[tuple(seq)].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, who in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += (len(who) - 1) * len(node[-1][1].encode()) if node else 0
    digest = lambda node: hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
    return sorted((min(w), len(n), min(members[n[:-1]]) if n else None, len(w), len(kids[n]), leaves[n], saved[n], digest(n)) for n, w in members.items())


def query(frame):
    conv = F.col("conv_id")
    turns = trie.rebuilt(trie.numbered_turns(frame), conv - conv % 5, F.crc32(conv.cast("string").cast("binary")) % 9, most=8)
    return trie.conversation_trie(turns)


def result(frame):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in query(frame).select(names).collect()), key=lambda r: (r[0], r[1]))


def test_equals_walk(spark):
    pick = random.Random(3)
    rows = [(c, t, pick.choice(["user", "assistant", None]), pick.choice(["hé", "", None, "yes", "long " * 40]), 9, "n", 1) for c in range(40) if c % 15 for t in range(pick.randint(0, 12))]
    rows += [(100, None, "user", "first", 0, "", 0), (100, None, "user", "again", 0, "", 0), (100, 0, None, None, 0, "", 0)]  # null turns come first
    rows += [(101, 1, "b", "tie", 0, "", 0), (101, 1, "a", "tie", 0, "", 0), (101, 1, "a", "tie", 0, "", 0)]  # ties and a repeated row
    rows += [(None, 1, "user", "no conversation", 0, "", 0)]
    rows += [(203, 0, "user", "absent base", 0, "", 0)]  # its first 8 turns come from nowhere
    rows += [(300, 0, "user", "x" * 300_000, 0, "", 0)]
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_empty(spark):
    assert result(spark.createDataFrame([], SCHEMA)) == []


def test_blocks_and_many_ends(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK_IDS", 4)
    rows = [(c * 5, t, "user", "same", 0, "", 0) for c in range(60) for t in range(1 + c % 2)]
    rows += [(1000, t, "user", str(t), 0, "", 0) for t in range(90)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert result(frame) == brute(rows)
    turns = trie.numbered_turns(frame).where("conv_id = 1000")
    small, large = (sorted(map(tuple, trie.trie_nodes(turns, block).collect())) for block in (7, 1000))
    assert small == large and len(small) == 91


@pytest.mark.parametrize("shape", ["chain", "star", "random", "forest"])
def test_subtree_totals(spark, shape):
    n, pick = 300, random.Random(5)
    up = {0: None}
    for k in range(1, n):
        up[k] = {"chain": k - 1, "star": 0, "random": pick.randint(max(0, k - 6), k - 1), "forest": None if k % 50 == 0 else k - 1}[shape]
    want = dict.fromkeys(up, 0)
    for k in up:
        at = k
        while at is not None:
            want[at] += k
            at = up[at]
    frame = spark.createDataFrame([(k, p, k, 7) for k, p in up.items()], "id long, parent long, x long, n long")
    got = {r["id"]: r["x"] for r in trie.subtree_totals(frame, ["id"], ["parent"], ["x"]).collect()}
    assert got == want


def test_a_circle_is_refused(spark):
    frame = spark.createDataFrame([(1, 2, 1), (2, 3, 1), (3, 1, 1)], "id long, parent long, x long")
    with pytest.raises(ValueError):
        trie.subtree_totals(frame, ["id"], ["parent"], ["x"])
