"""Scoring of fundamental snapshots, whole or from a high-water mark."""

from __future__ import annotations

import datetime as dt
from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions import scoring

EPOCH = dt.date(1970, 1, 1)


def scored(raw: DataFrame, units: Mapping[str, float] | None = None) -> DataFrame:
    """All input columns, three categories and the score; exact duplicates collapse.

    Duplicates are dropped before the derived columns are computed (they are functions of the
    row), so each distinct row is scored once.
    """
    return raw.distinct().withColumns(
        {
            "Market_Cap_Category": scoring.market_cap_category(F.col("Market_Cap")),
            "Valuation_Category": scoring.valuation_category(F.col("Trailing_PE")),
            "Liquidity_Health": scoring.liquidity_health(F.col("Current_Ratio")),
            "Fundamental_Score": scoring.fundamental_score(units),
        }
    )


def since_high_water(raw: DataFrame, target: DataFrame | None, date: str = "Extraction_Date") -> DataFrame:
    """Rows from the target's newest day on (inclusive); everything while there is no target.

    The mark is a scalar subquery, so it prunes partitions of the source at run time and no
    value passes through the driver.
    """
    if target is None:
        return raw
    mark = target.agg(F.coalesce(F.max(date), F.lit(EPOCH)).alias("mark")).scalar()
    return raw.filter(F.col(date) >= mark)


def latest_per_key(raw: DataFrame, order: str, *keys: str) -> DataFrame:
    """Keep the row with the greatest `order` per key (latest load wins)."""
    others = [c for c in raw.columns if c not in keys]
    best = raw.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(order)).alias("_v"))
    return best.select(*keys, "_v.*").select(*raw.columns)
