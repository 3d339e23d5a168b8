"""Joins whose small side has a size that can be proven from its type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def calendar_side(frame: DataFrame, date: str = "Date") -> DataFrame:
    """Broadcast hint for a frame that is unique per DATE (366 rows a year at most).

    With any other order type the frame may grow without limit, so no hint is given and the
    adaptive planner decides from the measured size.
    """
    return F.broadcast(frame) if isinstance(frame.schema[date].dataType, T.DateType) else frame


def join_on_date(rows: DataFrame, per_date: DataFrame, date: str = "Date") -> DataFrame:
    """Left equi join of many rows to one row per date; rows without a match keep NULLs."""
    return rows.join(calendar_side(per_date, date), date, "left")


def one_per_key(frame: DataFrame, *keys: str) -> DataFrame:
    """Collapse repeated keys so that a later join cannot multiply rows."""
    others = [c for c in frame.columns if c not in keys]
    return frame.groupBy(*keys).agg(F.max(F.struct(*others)).alias("_v")).select(*keys, "_v.*")
