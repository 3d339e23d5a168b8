"""Hard negatives against direct computation in whole numbers."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from barloom.llm import hard_negatives as hard

SCHEMA = "vec_id long, embedding array<double>, label int, rank int, row long"


def brute(rows, scale=256):
    """Whole numbers of every size: no arithmetic of fixed width."""
    fine = [(i, [math.floor(scale * x) for x in v], (l + 1) % 10 if i % 7 == 0 else l) for i, v, l, *_ in rows if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for k, (i, a, own) in enumerate(fine):
        if i % 100:
            continue
        ranked = sorted((-min(max(sum(x * y for x, y in zip(a, b)), -(2**63)), 2**63 - 1), j, l) for n, (j, b, l) in enumerate(fine) if n != k)
        for s, j, _ in [x for x in ranked if x[2] == own][:5]:
            good = [(t, m) for t, m, l in ranked if l != own and 80 * -s <= 100 * -t <= 100 * -s]
            out |= {(i, j, r, m, -s, -t) for r, (t, m) in enumerate(good[:5], 1)}
    return sorted(out)


def mined(frame, **sizes):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard.hard_negatives(frame, F.col("vec_id") % 100 == 0, label=label, **sizes)
    return sorted(tuple(r) for r in found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def made(n, size, seed, spread=0.3):
    pick = random.Random(seed)
    centres = [[pick.gauss(0, 1) for _ in range(size)] for _ in range(4)]
    return [(i, [x + pick.gauss(0, spread) for x in centres[i % 4]], pick.randint(0, 2), 1, 1) for i in range(n)]


def test_equals_brute_force(spark):
    rows = made(700, 12, 1)
    same = [0.5] * 12
    rows += [(1000 + i, same, i % 3, 1, 1) for i in range(400)]  # one vector that many rows repeat; among them anchors
    rows += [(2000, None, 1, 1, 1), (2001, [None, 1.0], 1, 1, 1), (2002, [math.nan], 1, 1, 1), (2003, [math.inf], 1, 1, 1), (2004, [1.0], None, 1, 1), (None, same, 1, 1, 1)]
    rows += [(2100, [0.0] * 12, 1, 1, 1), (2200, [], 1, 1, 1), (2300, [1.0, 2.0], 1, 1, 1)]  # zero, empty and short vectors
    rows += [(2400, [-x for x in same], 1, 1, 1)]
    rows += rows[:3] * 2  # repeated rows, an anchor with them
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = brute(rows)
    assert len(want) > 100
    assert mined(frame) == want
    assert mined(frame, anchors=3, slice_rows=50) == want


def test_few_rows_and_large_numbers(spark):
    rows = [(0, [1e12, 1e12], 1, 1, 1), (1, [1e12, 1e12], 1, 1, 1), (2, [9e11, 9e11], 2, 1, 1), (100, [1e300, -1e300], 4, 1, 1), (3, [1e300, -1e300], 4, 1, 1), (4, [3.0, 1.0], 4, 1, 1)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    assert mined(spark.createDataFrame(rows[:1], SCHEMA)) == []
    assert mined(spark.createDataFrame([], SCHEMA)) == []


def test_bounds_leave_most_unscored():
    """Near anchors: a child's scores are known from its parent's, but for a few."""
    turn = np.random.default_rng(2)
    centres = 256 * turn.standard_normal((8, 16))
    anchors = np.floor(np.repeat(centres, 20, 0) + turn.standard_normal((160, 16)))
    rows = np.floor(256 * turn.standard_normal((3000, 16)))
    order, parents, lengths = hard.spanning_tree(anchors)
    assert sorted(order.tolist()) == list(range(160)) and all(p < k for k, p in enumerate(parents))
    whole, hit = anchors[order], {}
    tops = [int((rows @ a).max()) for a in whole]

    def wanted(k, low, high):
        exact = rows @ whole[k]
        assert (low <= exact).all() and (exact <= high).all()
        return (high >= 0.8 * tops[k]) & (low <= tops[k])

    scored = hard.walk(whole, parents, lengths, rows, wanted, lambda k, places, exact: hit.update({k: (places, exact)}))
    for k, a in enumerate(whole):
        exact = rows @ a
        inside = np.flatnonzero((exact >= 0.8 * tops[k]) & (exact <= tops[k]))
        assert set(inside) <= set(hit[k][0].tolist())
        assert (hit[k][1] == exact[hit[k][0]]).all()
    assert scored < 0.3 * len(rows) * len(anchors)
