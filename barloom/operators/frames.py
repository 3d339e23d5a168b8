"""Collects the window columns several operators ask for, so that one window node serves them.

Each request registers a plainly named window column (once, however many features use it) and
answers with a row-level expression over it. `apply` adds the windows, then the expressions.
Few distinct frames also means few generated classes, which is what short runs pay for.
"""

from __future__ import annotations

from functools import lru_cache, reduce
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.operators.panel import ROW, Panel

#: A frame of at least so many rows is put together from shorter ones, as Spark visits every row of a frame again for each row.
LONG_ROWS, PART_ROWS = 40, (20, 10)
#: The same for variances and covariances, whose updates cost more than the added columns.
JOINT_ROWS = (10, 20)


class Frames:
    def __init__(self, panel: Panel):
        self.panel = panel
        self.windows: dict[str, Column] = {}
        self.later: dict[str, Column] = {}  # windows over those
        self._trailing = lru_cache(None)(panel.trailing)

    def _add(self, name: str, make: Callable[[], Column]) -> Column:
        if name not in self.windows:
            self.windows[name] = make()
        return F.col(name)

    def lag(self, c: str, k: int = 1) -> Column:
        return self._add(f"_lag{k}_{c}", lambda: self.panel.lag(c, k))

    def change(self, padded: str, k: int) -> Column:
        return F.try_divide(F.col(padded), self.lag(padded, k)) - 1

    def _full(self, name: str, present: Column, n: int, value: Column) -> Column:
        latest_bad = self._add(f"_bad_{name}", lambda: self.panel.latest(~present))
        self.panel.check_reach(n)
        return F.when(F.col(ROW) - F.coalesce(latest_bad, F.lit(0)) >= n, value)

    def _part(self, n: int, sizes: Sequence[int] = PART_ROWS) -> int:
        """Rows of the short frames that a long one consists of; 0: it is looked at whole."""
        return next((m for m in sizes if n >= LONG_ROWS and n % m == 0), 0)

    def _earlier(self, name: str, part: int, n: int) -> list[Column]:
        """A window column at the rows where the short frames before the last one end."""
        for k in range(part, n, part):
            self.later.setdefault(f"_at{k}{name}", self.panel.lag(name, k))
        return [F.col(f"_at{k}{name}") for k in range(part, n, part)]

    def _parts(self, name: str, make: Callable[[], Column], part: int, n: int) -> list[Column]:
        """An aggregate of each of the short frames that a long one consists of, the latest first."""
        return [self._add(name, lambda: make().over(self._trailing(part))), *self._earlier(name, part, n)]

    def _joint(self, a: str, b: str, part: int, n: int) -> Column:
        """Sample covariance of a full frame: that inside its short frames and that of their means.

        Means count from the latest one, so that equal values give exactly 0.
        """
        inside = self._parts(f"_cov{part}_{a}_{b}", lambda: F.covar_pop(a, b) if a != b else F.var_pop(a), part, n)
        sums = {c: self._parts(f"_sum{part}_{c}", lambda c=c: F.sum(c), part, n) for c in dict.fromkeys((a, b))}
        x, y = ([(s - sums[c][0]) / F.lit(part) for s in sums[c][1:]] for c in (a, b))
        mean = lambda values: reduce(Column.__add__, values) / F.lit(n // part)
        return (mean(inside) + mean([p * q for p, q in zip(x, y)]) - mean(x) * mean(y)) * F.lit(n / (n - 1))

    def rolling(self, fn: str, c: str, n: int) -> Column:
        """`fn` names an aggregate function, e.g. sum, min, stddev_samp."""
        agg = getattr(F, fn)
        part = self._part(n) if fn == "sum" else self._part(n, JOINT_ROWS) if fn == "var_samp" else 0
        if part and fn == "sum":
            value = reduce(Column.__add__, self._parts(f"_sum{part}_{c}", lambda: F.sum(c), part, n))
        elif part:
            value = self._joint(c, c, part, n)
        else:
            value = self._add(f"_{fn}{n}_{c}", lambda: agg(F.col(c)).over(self._trailing(n)))
        return self._full(c, F.col(c).isNotNull(), n, value)

    def mean(self, c: str, n: int) -> Column:
        return self.rolling("sum", c, n) / F.lit(n)

    def cov(self, a: str, b: str, n: int) -> Column:
        part = self._part(n, JOINT_ROWS)
        value = self._joint(a, b, part, n) if part else self._add(f"_cov{n}_{a}_{b}", lambda: F.covar_samp(a, b).over(self._trailing(n)))
        return self._full(f"{a}_{b}", F.col(a).isNotNull() & F.col(b).isNotNull(), n, value)

    def _values(self, c: str, n: int) -> Column:
        return self._add(f"_list{n}_{c}", lambda: F.collect_list(c).over(self._trailing(n)))

    def mad(self, c: str, n: int) -> Column:
        """Mean absolute distance from the frame mean; the list holds n values at most."""
        values, mean = self._values(c, n), F.col(f"_sum{n}_{c}") / F.lit(n)
        self.rolling("sum", c, n)
        total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + F.abs(x - mean))
        return self._full(c, F.col(c).isNotNull(), n, total / F.lit(n))

    def values(self, c: str, n: int, fn: Callable[[Column], Column]) -> Column:
        """Any function of a full frame, written over the array of its n values (in row order)."""
        return self._full(c, F.col(c).isNotNull(), n, fn(self._values(c, n)))

    def quantile(self, c: str, q: float, n: int) -> Column:
        """Linearly interpolated quantile, from a sorted list of n values."""
        ranked = F.sort_array(self._values(c, n))
        low = min(int(q * (n - 1)), n - 2)
        share = q * (n - 1) - low
        a, b = F.get(ranked, F.lit(low)), F.get(ranked, F.lit(low + 1))
        return self._full(c, F.col(c).isNotNull(), n, a + (b - a) * F.lit(share))

    def apply(self, outputs: Mapping[str, Column]) -> Panel:
        panel = self.panel.with_columns(self.windows)
        return (panel.with_columns(self.later) if self.later else panel).with_columns(outputs)
