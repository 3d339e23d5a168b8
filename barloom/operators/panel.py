"""Ordered panels: many series in one long table, with groups of bounded size.

Row-ordered operators need the rows of one series next to each other. A series must not
become one endless task, so a panel is one of two kinds:

* **Calendar panel** - the order column is a DATE and (key, date) is unique. One series then
  has at most 366 rows a year whatever the size of the table, which is a proven bound, and a
  window over the key is one sort inside one hash exchange.
* **Split panel** - any other order (timestamps, several columns). Rows are counted per
  (key, time bucket) and numbered; the number cuts each long series into segments of
  equal size. Rolling frames reach back through a halo of rows copied from the
  segment before, and running state (last value, running sum, exponential mean) enters each
  segment through a small per-segment carry table. One key may hold any share of the table.

Both kinds offer the same operators, so features are written once.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from functools import cached_property
from typing import Callable, Mapping, Sequence

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.nulls import ratio

ROW = "_row"      # 1-based position in the whole series
BLOCK = "_block"  # fixed-size run of rows, the unit of the exponential mean
SEGMENT = "_segment"
CORE = "_core"    # false on rows copied in as a halo
FROM = "_from"    # the segment's rows, halo included, come after this row
UNTIL = "_until"  # and its part of the running state ends here: the next segment's halo follows
FAR = 2**62       # before and after all rows
BLOCK_ROWS = 1024
MAX_SEGMENT_ROWS = 64 * BLOCK_ROWS  # keeps the list of block ends of a segment short


@dataclass(frozen=True)
class Panel:
    frame: DataFrame
    key: str
    order: tuple[str, ...]
    split: bool = False
    halo: int = 0
    ahead: int = 0
    # derived column -> rows it looks (back, ahead), summed over the chain of frames it comes from
    reach: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    # a resumed panel: names of running values of the rows before it (columns `_in_*`) and after it (`_out_*`)
    resuming: bool = False
    entering: tuple[str, ...] = ()
    leaving: tuple[str, ...] = ()

    # ---- construction -------------------------------------------------------------

    @classmethod
    def of(
        cls,
        frame: DataFrame,
        key: str = "Ticker",
        order: str | Sequence[str] = "Date",
        fill: Mapping[str, str] | None = None,
        halo: int = 256,
        rows_per_segment: int | None = None,
        bucket_seconds: int = 3_600,
        ahead: int = 0,
    ) -> "Panel":
        """Build a panel; `fill` maps new column -> column to carry forward over nulls.

        The key is never NULL. A calendar panel expects one row per (key, date); collapse repeats
        with `joins.one_per_key` first.

        `halo` is the longest reach of any chain of rolling frames that follows, `ahead` that of
        `lead`. A series is cut by row number, so a segment has its own rows, at most `halo` copied
        from before and `ahead` from behind. Rows are numbered within time buckets, which are sorted
        as one group: `bucket_seconds` should hold far fewer rows of one key than memory. By
        default a series of n rows gets segments of 8 * sqrt(n) rows, but at least four times the
        reach and at most 64 blocks; the carry table has one row per segment. The reach of every
        derived column is summed over its chain, and a chain longer than the halo raises.
        """
        order = (order,) if isinstance(order, str) else tuple(order)
        fill = dict(fill or {})
        if len(order) == 1 and isinstance(frame.schema[order[0]].dataType, T.DateType):
            return cls._calendar(frame, key, order, fill)
        return cls._split(frame, key, order, fill, halo, ahead, rows_per_segment, bucket_seconds)

    @classmethod
    def _calendar(cls, frame: DataFrame, key: str, order: tuple[str, ...], fill: dict[str, str]) -> "Panel":
        series = Window.partitionBy(key).orderBy(*order)
        so_far = series.rowsBetween(Window.unboundedPreceding, 0)
        numbered = frame.withColumns(
            {ROW: F.row_number().over(series).cast("long")}
            | {new: F.last(F.col(c), ignorenulls=True).over(so_far) for new, c in fill.items()}
        )
        return cls(_with_block(numbered), key, order)

    @classmethod
    def _split(cls, frame, key, order, fill, halo, ahead, rows_per_segment, bucket_seconds) -> "Panel":
        reach = max(halo, ahead)
        if rows_per_segment and rows_per_segment < reach:
            raise ValueError(f"segments of {rows_per_segment} rows are shorter than the reach of {reach} rows")
        bucket = F.floor(F.unix_micros(F.col(order[0]).cast("timestamp")) / F.lit(bucket_seconds * 1_000_000))
        # rows without a time sort first, so they share the earliest bucket
        bucketed = frame.withColumn("_bucket", F.coalesce(bucket.cast("long"), F.lit(-(2**62))))

        # Small table: one row per (key, bucket) that exists, counted before the shuffle.
        by_time = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
        counts = bucketed.groupBy(key, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
        size = F.greatest(F.lit(4 * reach), F.least(F.ceil(8 * F.sqrt("_total")), F.lit(MAX_SEGMENT_ROWS)), F.lit(1))
        if rows_per_segment:
            size = F.lit(rows_per_segment)
        cuts = (
            counts.withColumns(
                {"_end": F.sum("_n").over(by_time), "_total": F.sum("_n").over(Window.partitionBy(key))}
            )
            .withColumn("_size", size.cast("long"))
            .select(key, "_bucket", (F.col("_end") - F.col("_n")).alias("_before"), "_total", "_size")
        )
        in_bucket = Window.partitionBy(key, "_bucket").orderBy(*order)
        placed = (
            bucketed.join(cuts, [key, "_bucket"])
            .withColumn(ROW, F.col("_before") + F.row_number().over(in_bucket))
            # by row number, so that no segment is longer than the size, however full a bucket is
            .withColumn(SEGMENT, F.floor((F.col(ROW) - 1) / F.col("_size")))
        )
        uncut = placed.withColumns({CORE: F.lit(True), FROM: F.lit(-FAR), UNTIL: F.lit(FAR)})
        placed = cls(uncut, key, order, split=True).forward_fill(fill).frame.drop("_bucket", "_before", CORE, FROM, UNTIL)

        # a row is copied into the next segment if that reaches back to it, and likewise ahead
        start = F.col(SEGMENT) * F.col("_size")
        behind = (F.col(ROW) > start + F.col("_size") - halo) & (start + F.col("_size") < F.col("_total"))
        targets = F.array(
            F.col(SEGMENT), F.when(behind, F.col(SEGMENT) + 1), F.when((F.col(SEGMENT) > 0) & (F.col(ROW) <= start + ahead), F.col(SEGMENT) - 1)
        )
        spread = placed.select("*", F.explode(F.array_compact(targets)).alias("_target"))
        first = F.col("_target") * F.col("_size") - halo
        spread = spread.withColumns({
            CORE: F.col(SEGMENT) == F.col("_target"),
            FROM: F.when(F.col("_target") == 0, F.lit(-FAR)).otherwise(first).cast("long"),
            UNTIL: (first + F.col("_size")).cast("long"),
        }).drop(SEGMENT, "_size", "_total")
        spread = spread.withColumnRenamed("_target", SEGMENT)
        return cls(_with_block(spread), key, order, split=True, halo=halo, ahead=ahead)

    @classmethod
    def resumed(
        cls, frame: DataFrame, state: DataFrame | None, key: str = "Ticker", order: str = "Date", fill: Mapping[str, str] | None = None, halo: int = 256
    ) -> "Panel":
        """A panel of new rows behind a stored state (see `operators.state`), or of a first history without one.

        It is one segment of a split panel: the state's last rows are its halo, and the running state of all rows before
        enters it. Only for a DATE order with unique (key, date), as in a calendar panel: one group holds the new rows of one key
        and `halo` stored ones.
        """
        if not isinstance(frame.schema[order].dataType, T.DateType):
            raise ValueError("a resumed panel needs a DATE order")
        series = Window.partitionBy(key).orderBy(order)
        numbered = frame.withColumns({ROW: F.row_number().over(series).cast("long"), CORE: F.lit(True)})
        names: tuple[str, ...] = ()
        if state is None:
            rows = numbered.withColumn("_known", F.lit(0).cast("long"))
        else:
            names = tuple(c for c in state.columns if c not in (key, "rows", "last", "tail"))
            # one row per key on the other side: all that a delivery needs of the state in one join
            delivered = numbered.groupBy(key).agg(F.collect_list(F.struct(ROW, CORE, *[c for c in frame.columns if c != key])).alias("_new"))
            both = delivered.join(state, key, "left")
            known = F.coalesce("rows", F.lit(0).cast("long"))
            fields = [ROW, CORE, *[c for c in frame.columns if c != key]]
            old = F.transform("tail", lambda t: F.struct(*[F.lit(False).alias(CORE) if c == CORE else t[c].alias(c) for c in fields]))
            new = F.transform("_new", lambda t: F.struct(*[(known + t[c]).alias(c) if c == ROW else t[c].alias(c) for c in fields]))
            every = F.concat(F.coalesce(old, F.filter(new, lambda _: F.lit(False))), new)
            rows = both.select(key, known.alias("_known"), *[F.col(n).alias(f"_in_{n}") for n in names], F.explode(every).alias("_r"))
            rows = rows.select(key, "_known", *[f"_in_{n}" for n in names], "_r.*")
        rows = rows.withColumns({
            SEGMENT: F.lit(1).cast("long"),
            FROM: F.when(F.col("_known") == 0, F.lit(-FAR)).otherwise(F.col("_known") - halo).cast("long"),
            UNTIL: F.max(ROW).over(Window.partitionBy(key)) - halo,
        }).drop("_known")
        panel = cls(_with_block(rows), key, (order,), split=True, halo=halo, resuming=True, entering=names)
        return panel.forward_fill(dict(fill or {}))

    # ---- windows ------------------------------------------------------------------

    @property
    def group(self) -> list[str]:
        return [self.key, SEGMENT] if self.split and not self.resuming else [self.key]

    @cached_property
    def series(self) -> WindowSpec:
        # (block, row) is the time order; naming the block lets one sort serve the block
        # windows of the exponential mean too.
        order = [BLOCK, ROW] if BLOCK in self.frame.columns else [ROW]
        return Window.partitionBy(*self.group).orderBy(*order)

    @cached_property
    def so_far(self) -> WindowSpec:
        return self.series.rowsBetween(Window.unboundedPreceding, 0)

    @property
    def before(self) -> WindowSpec:
        return self.series.rowsBetween(Window.unboundedPreceding, -1)

    def trailing(self, n: int) -> WindowSpec:
        return self.series.rowsBetween(-(n - 1), 0)

    # ---- expressions ----------------------------------------------------------------

    def lag(self, c: str | Column, k: int = 1) -> Column:
        self.check_reach(k)
        return F.lag(c, k).over(self.series)

    def lead(self, c: str | Column, k: int = 1) -> Column:
        if self.split and k > self.ahead:
            raise ValueError(f"looking {k} rows ahead needs a panel built with ahead={k}")
        return F.lead(c, k).over(self.series)

    def diff(self, c: str, k: int = 1) -> Column:
        return F.col(c) - self.lag(c, k)

    def change(self, padded: str, k: int) -> Column:
        """Relative change over k rows of a column already carried forward over nulls."""
        return ratio(F.col(padded), self.lag(padded, k)) - 1

    def latest(self, condition: Column) -> Column:
        """Position of the latest row so far on which the condition held."""
        return F.max(F.when(condition, F.col(ROW))).over(self.so_far)

    def check_reach(self, n: int) -> None:
        if self.split and n > self.halo:
            raise ValueError(f"a frame of {n} rows needs a halo of at least {n} rows")

    def rolling(self, fn: Callable[[Column], Column], c: str, n: int) -> Column:
        """Aggregate of the last n rows, NULL unless all n values are present.

        The latest missing row decides completeness for every n at one update a row, where a
        count over the frame would visit n rows.
        """
        self.check_reach(n)
        complete = F.col(ROW) - F.coalesce(self.latest(F.col(c).isNull()), F.lit(0)) >= n
        return F.when(complete, fn(F.col(c)).over(self.trailing(n)))

    # ---- frame changes ----------------------------------------------------------------

    def with_columns(self, columns: Mapping[str, Column]) -> "Panel":
        if not self.split:
            return self._add(columns)
        looks = {n: _reach(c, self.reach) for n, c in columns.items()}
        for name, (back, ahead) in looks.items():
            if back > self.halo or ahead > self.ahead:
                raise ValueError(
                    f"{name} looks {back} rows back and {ahead} ahead over its chain of frames; "
                    f"the panel has halo={self.halo}, ahead={self.ahead}"
                )
        return replace(self._add(columns), reach={**self.reach, **looks})

    def _add(self, columns: Mapping[str, Column]) -> "Panel":
        return replace(self, frame=self.frame.withColumns(dict(columns)))

    def drop(self, *columns: str) -> "Panel":
        return replace(self, frame=self.frame.drop(*columns))

    def result(self) -> DataFrame:
        """The plain frame: halo rows and helper columns removed."""
        frame = self.frame.filter(CORE) if self.split else self.frame
        return frame.drop(ROW, BLOCK, SEGMENT, CORE, FROM, UNTIL, *[f"_in_{n}" for n in self.entering], *[f"_out_{n}" for n in self.leaving])

    # ---- running state ------------------------------------------------------------------

    # State is computed on all rows of a segment, copies included, so frames over it are right. It
    # enters before the first copied row on which the input is right (`back` rows after the first),
    # and a segment passes on the rows up to where it enters the next: each row counts once.

    def looks(self, columns: Sequence[str]) -> tuple[int, int]:
        known = [self.reach.get(c, (0, 0)) for c in columns] or [(0, 0)]
        return max(b for b, _ in known), max(a for _, a in known)

    def right(self, c: str | Column, back: int) -> Column:
        """The value, NULL on the copied rows where an input that looks `back` rows is not right."""
        c = F.col(c) if isinstance(c, str) else c
        return F.when(F.col(ROW) > F.col(FROM) + back, c) if self.split else c

    def passed(self, c: Column, back: int) -> Column:
        """The value on the rows that this segment passes on to the next."""
        return F.when((F.col(ROW) > F.col(FROM) + back) & (F.col(ROW) <= F.col(UNTIL) + back), c)

    def carry(self, summaries: Mapping[str, Column], combine: str) -> "Panel":
        """Join, for each segment, its predecessors' summaries, combined by `max`, `sum` or `last` (the last non-null).

        `summaries` are aggregates over one segment. The carry table has one row per segment,
        and the join key is the partitioning the panel already has. In a resumed panel the values are there already.
        """
        if self.resuming:
            whole = Window.partitionBy(*self.group)
            pair = {
                "max": lambda old, new: F.greatest(old, new), "last": lambda old, new: F.coalesce(new, old),
                "sum": lambda old, new: F.when(old.isNull(), new).when(new.isNull(), old).otherwise(old + new),
            }[combine]
            entering = {n: self.state_in(n) for n in summaries}
            return self.with_state(entering, {n: pair(entering[n], e.over(whole)) if self.entering else e.over(whole) for n, e in summaries.items()})
        per_segment = self.frame.groupBy(*self.group).agg(*[e.alias(n) for n, e in summaries.items()])
        earlier = Window.partitionBy(self.key).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
        over = {"max": F.max, "sum": F.sum, "last": lambda x: F.last(x, ignorenulls=True)}[combine]
        table = per_segment.select(*self.group, *[over(F.col(n)).over(earlier).alias(n) for n in summaries])
        return replace(self, frame=self.frame.join(table, self.group, "left"))

    def state_in(self, name: str) -> Column:
        """A running value of all rows before a resumed panel."""
        if self.entering and name not in self.entering:
            raise ValueError(f"the state was begun without {name}")
        return F.col(f"_in_{name}") if self.entering else F.lit(None)

    def with_state(self, entering: Mapping[str, Column], leaving: Mapping[str, Column]) -> "Panel":
        """In a resumed panel, add running values as they enter it, and as they leave it (one value per key)."""
        panel = self._add({**entering, **{f"_out_{n}": e for n, e in leaving.items()}})
        return replace(panel, leaving=(*self.leaving, *leaving))


    def forward_fill(self, fill: Mapping[str, str]) -> "Panel":
        """new column -> last non-null value of a column up to the row."""
        if not fill:
            return self
        if not self.split:
            return self._add({n: F.last(F.col(c), ignorenulls=True).over(self.so_far) for n, c in fill.items()})
        looks = {n: self.looks([c]) for n, c in fill.items()}
        carried = self.carry(
            {
                f"_c_{n}": F.max_by(F.col(c), self.passed(F.when(F.col(c).isNotNull(), F.col(ROW)), looks[n][0]))
                for n, c in fill.items()
            },
            "last",
        )
        filled = {
            n: F.coalesce(F.last(self.right(c, looks[n][0]), ignorenulls=True).over(carried.so_far), F.col(f"_c_{n}"))
            for n, c in fill.items()
        }
        return replace(carried._add(filled).drop(*[f"_c_{n}" for n in fill]), reach={**self.reach, **looks})

    def running_sum(self, columns: Mapping[str, str]) -> "Panel":
        """new column -> sum from the start of the series; null rows stay null and are skipped."""
        if not self.split:
            return self._add(
                {n: F.when(F.col(c).isNotNull(), F.sum(c).over(self.so_far)) for n, c in columns.items()}
            )
        looks = {n: self.looks([c]) for n, c in columns.items()}
        carried = self.carry(
            {f"_c_{n}": F.sum(self.passed(F.col(c), looks[n][0])) for n, c in columns.items()}, "sum"
        )
        sums = {}
        for n, c in columns.items():
            value = self.right(c, looks[n][0])
            total = F.sum(value).over(carried.so_far) + F.coalesce(F.col(f"_c_{n}"), F.lit(0.0))
            sums[n] = F.when(value.isNotNull(), total)
        return replace(carried._add(sums).drop(*[f"_c_{n}" for n in columns]), reach={**self.reach, **looks})


def _with_block(frame: DataFrame, rows: int = BLOCK_ROWS) -> DataFrame:
    return frame.withColumn(BLOCK, F.floor((F.col(ROW) - 1) / F.lit(rows)).cast("long"))


def _reach(column: Column, known: Mapping[str, tuple[int, int]]) -> tuple[int, int]:
    """Rows (back, ahead) that an expression looks at, those of the columns it reads included."""
    jvm = column._jc.node()  # the tree is read in one call, as JSON in prefix order
    converter = getattr(SparkContext._jvm, "org.apache.spark.sql.classic.ColumnNodeToExpressionConverter$")
    nodes = iter(json.loads(getattr(converter, "MODULE$").apply(jvm).toJSON()))

    def tree() -> tuple[dict, list]:
        node = next(nodes)
        return node, [tree() for _ in range(node["num-children"])]

    def kind(node: dict) -> str:
        return node["class"].rsplit(".", 1)[-1]

    def rows(part: tuple[dict, list]) -> int:
        return int(part[0].get("value") or 0) if kind(part[0]) == "Literal" else 0

    def look(part: tuple[dict, list]) -> tuple[int, int]:
        node, children = part
        if kind(node) == "UnresolvedAttribute":
            name = node["nameParts"][1:-1]
            return known.get(name) or known.get(name.split(", ")[0], (0, 0))
        if kind(node) == "WindowExpression":
            back, ahead = look(children[0])
            function, arguments = children[0]
            name = function.get("nameParts", "")[1:-1]
            low = high = 0
            if name in ("lag", "lead"):
                high = rows(arguments[1]) * (1 if name == "lead" else -1)
                low = high
            elif kind(children[1][1][-1][0]) == "SpecifiedWindowFrame":
                low, high = (rows(x) for x in children[1][1][-1][1])
            return back + max(-low, 0), ahead + max(high, 0)
        below = [look(x) for x in children] or [(0, 0)]
        return max(b for b, _ in below), max(a for _, a in below)

    return look(tree())
