"""Exponentially weighted mean as a distributed scan of linear steps.

For a valid x whose previous valid value lies g rows back, with w = (1 - a)^g,
`y = (w * y_prev + a * x) / (w + a)`; the first valid x starts the mean, a null row repeats it.
Each row is thus a step y = c * y_prev + d. Steps compose, so a run of rows (a block) has one
factor P and one offset L, and `y = L + P * y_at_block_start`. Inside a block, P is a running
product and L = P * sum(d / P): two window functions, no Python, linear work. Block ends chain
through a short list per group, and in a split panel segment ends chain through a table with
one row per segment.

P must stay above the smallest double, so a block is short enough for the fastest decay
(see `_block_rows`), and a single step that forgets nearly everything keeps 1e-40 of its past,
far below the precision of a double.
"""

from __future__ import annotations

import math
from dataclasses import replace
from typing import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.panel import BLOCK, BLOCK_ROWS, ROW, SEGMENT, UNTIL, Panel

MIN_FACTOR = 1e-40
RUN = 128  # segments whose states are chained in one list
MAX_DECAY = math.log(1e240)  # natural log of the decay one block may build up


def span_alpha(span: float) -> float:
    return 2.0 / (span + 1.0)


def _block_rows(alphas: list[float]) -> int:
    fastest = max(alphas)
    if fastest >= 1.0:
        return 1
    return max(1, min(BLOCK_ROWS, int(MAX_DECAY / -math.log1p(-fastest))))


def ewm_mean(panel: Panel, means: Mapping[str, tuple[str, float]]) -> Panel:
    """Add new column -> (input column, alpha); all means share one pass."""
    keep = panel.frame.columns
    inputs = sorted({c for c, _ in means.values()})
    back, ahead = panel.looks(inputs)
    valid = {c: panel.right(F.col(c).cast("double"), back) for c in inputs}

    # 1. rows since the last valid value, per input column
    if panel.split:
        panel = panel.carry({f"_seen_{c}": F.max(panel.passed(F.when(valid[c].isNotNull(), F.col(ROW)), back)) for c in inputs}, "max")
    seen = {c: F.max(F.when(valid[c].isNotNull(), F.col(ROW))).over(panel.before) for c in inputs}
    if panel.split:
        seen = {c: F.coalesce(e, F.col(f"_seen_{c}")) for c, e in seen.items()}
    panel = panel._add({f"_gap_{c}": F.col(ROW) - e for c, e in seen.items()})

    # 2. one linear step per row and mean
    rows = _block_rows([a for _, a in means.values()])
    block = BLOCK
    if rows < BLOCK_ROWS:
        block = "_fine"
        panel = panel._add({block: F.floor((F.col(ROW) - 1) / F.lit(rows)).cast("long")})
    steps: dict[str, Column] = {}
    for name, (c, alpha) in means.items():
        factor, offset = _step(valid[c], F.col(f"_gap_{c}"), alpha)
        steps |= {f"_c_{name}": factor, f"_d_{name}": offset}
    panel = panel._add(steps)

    # 3. running composition inside each block
    in_block = Window.partitionBy(*panel.group, block)
    running = in_block.orderBy(ROW).rowsBetween(Window.unboundedPreceding, 0)
    panel = panel._add({f"_p_{n}": F.product(F.col(f"_c_{n}")).over(running) for n in means})
    panel = panel._add({f"_s_{n}": F.sum(F.col(f"_d_{n}") / F.col(f"_p_{n}")).over(running) for n in means})
    panel = panel._add({f"_l_{n}": F.col(f"_p_{n}") * F.col(f"_s_{n}") for n in means})

    # 4. state at the start of each block
    if panel.split:
        panel = _segment_starts(panel, list(means), block, back)
    start = {n: F.col(f"_k_{n}") if panel.split else F.lit(0.0) for n in means}
    state = [F.col(f"_{part}_{n}") for n in means for part in ("p", "l")]
    full_blocks = F.collect_list(F.when(F.col(ROW) % rows == 0, F.struct(F.col(block).alias("b"), *state)))
    whole = Window.partitionBy(*panel.group)
    panel = panel._add({"_ends": full_blocks.over(whole), "_first": F.min(ROW).over(whole)})
    earlier = F.filter(F.sort_array("_ends"), lambda e: e["b"] < F.col(block))
    entering = {n: _fold(earlier, n, start[n]) for n in means}
    if panel.split:
        # many blocks per segment: fold once per block, on its first row
        opens = (F.col(ROW) % rows == 1 % rows) | (F.col(ROW) == F.col("_first"))
        packed = F.struct(*[e.alias(n) for n, e in entering.items()])
        panel = panel._add({"_start": F.max(F.when(opens, packed)).over(in_block)})
        entering = {n: F.col("_start")[n] for n in means}
    else:
        # a daily series has a few dozen blocks at most, usually one: a fold per row costs less
        # than another window
        entering = {n: F.when(F.size("_ends") == 0, 0.0).otherwise(e) for n, e in entering.items()}

    # 5. value of every row
    values = {}
    for name, (c, _) in means.items():
        known = F.col(f"_gap_{c}").isNotNull() | valid[c].isNotNull()
        values[name] = F.when(known, F.col(f"_l_{name}") + entering[name] * F.col(f"_p_{name}"))
    reach = {**panel.reach, **{n: (back, ahead) for n in means}} if panel.split else panel.reach
    out = [f"_out_{n}" for n in panel.leaving if f"_out_{n}" not in keep]
    return replace(panel, frame=panel.frame.withColumns(values).select(*keep, *means, *out), reach=reach)


def _step(x: Column, gap: Column, alpha: float) -> tuple[Column, Column]:
    weight = F.pow(F.lit(1.0 - alpha), gap)
    return (
        F.when(x.isNull() | gap.isNull(), 1.0)
        .when(gap == 1, max(1.0 - alpha, MIN_FACTOR))
        .otherwise(F.greatest(weight / (weight + alpha), F.lit(MIN_FACTOR))),
        F.when(x.isNull(), 0.0)
        .when(gap.isNull(), x)
        .when(gap == 1, x * alpha)
        .otherwise(x * alpha / (weight + alpha)),
    )


def _fold(ends: Column, name: str, start: Column) -> Column:
    return F.aggregate(ends, start.cast("double"), lambda y, e: e[f"_l_{name}"] + e[f"_p_{name}"] * y)


def _decay(ends: Column, name: str) -> Column:
    return F.aggregate(ends, F.lit(1.0), lambda p, e: p * e[f"_p_{name}"])


def _segment_starts(panel: Panel, names: list[str], block: str, back: int) -> Panel:
    """Join the state entering each segment (columns `_k_*`)."""
    state = F.struct(*[F.col(f"_{part}_{n}").alias(f"_{part}_{n}") for n in names for part in ("p", "l")])
    if panel.resuming:
        counts = F.when(F.col(ROW) <= F.col(UNTIL) + back, F.col(ROW))
        in_block, whole = Window.partitionBy(*panel.group, block), Window.partitionBy(*panel.group)
        panel = panel._add({"_last": F.max(counts).over(in_block)})
        end = F.when(F.col(ROW) == F.col("_last"), F.struct(F.col(block).alias("b"), *[F.col(f"_{part}_{n}") for n in names for part in ("p", "l")]))
        panel = panel._add({"_passed": F.sort_array(F.collect_list(end).over(whole))})
        entering = {f"_k_{n}": F.coalesce(panel.state_in(f"_k_{n}").cast("double"), F.lit(0.0)) for n in names}
        return panel.with_state(entering, {f"_k_{n}": _fold(F.col("_passed"), n, entering[f"_k_{n}"]) for n in names})
    passed = panel.frame.filter(F.col(ROW) <= F.col(UNTIL) + back)
    ends = passed.groupBy(*panel.group, block).agg(F.max_by(state, F.col(ROW)).alias("e"))
    fields = [F.col(f"e._{part}_{n}").alias(f"_{part}_{n}") for n in names for part in ("p", "l")]
    listed = ends.groupBy(*panel.group).agg(
        F.sort_array(F.collect_list(F.struct(F.col(block).alias("b"), *fields))).alias("ends")
    )
    totals = listed.select(
        *panel.group,
        *[_fold(F.col("ends"), n, F.lit(0.0)).alias(f"_l_{n}") for n in names],
        *[_decay(F.col("ends"), n).alias(f"_p_{n}") for n in names],
    )

    return replace(panel, frame=panel.frame.join(_chained(totals, panel.key, names), panel.group, "left"))


def _chained(totals: DataFrame, key: str, names: list[str]) -> DataFrame:
    """The mean that enters each segment (columns `_k_*`), from the segments' factors and offsets.

    In two levels: segments of a run of RUN are folded over those before them in the run, runs over the runs before. A
    list holds at most RUN segments, or the runs of one key.
    """
    parts = [f"_{part}_{n}" for n in names for part in ("p", "l")]
    runs = totals.withColumn("_run", F.floor(F.col(SEGMENT) / F.lit(RUN)))
    in_run = Window.partitionBy(key, "_run").orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    inner = runs.withColumn("_before", F.collect_list(F.struct(*parts)).over(in_run))
    inner = inner.select(key, "_run", SEGMENT, *[_fold(F.col("_before"), n, F.lit(0.0)).alias(f"_i_{n}") for n in names], *[_decay(F.col("_before"), n).alias(f"_j_{n}") for n in names])
    whole = runs.groupBy(key, "_run").agg(F.sort_array(F.collect_list(F.struct(SEGMENT, *parts))).alias("_all"))
    whole = whole.select(key, "_run", *[_fold(F.col("_all"), n, F.lit(0.0)).alias(f"_l_{n}") for n in names], *[_decay(F.col("_all"), n).alias(f"_p_{n}") for n in names])
    over_runs = Window.partitionBy(key).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    outer = whole.withColumn("_before", F.collect_list(F.struct(*parts)).over(over_runs))
    outer = outer.select(key, "_run", *[_fold(F.col("_before"), n, F.lit(0.0)).alias(f"_o_{n}") for n in names])
    return inner.join(outer, [key, "_run"]).select(key, SEGMENT, *[(F.col(f"_i_{n}") + F.col(f"_j_{n}") * F.col(f"_o_{n}")).alias(f"_k_{n}") for n in names])
