"""Landed responses."""

from pyspark.sql import functions as F

from barloom.catalog import sources
from barloom.sources import tables


def test_a_body_does_not_grow_with_the_table(spark, monkeypatch):
    newest = spark.range(1, 1001).select(
        F.concat(F.lit("S"), "id").alias("Ticker"), *[F.lit(None).cast("double").alias(c) for c in sources.payload.FIELDS]
    )
    monkeypatch.setattr(tables, "fundamentals", lambda spark, sf: newest)
    monkeypatch.setattr(sources.readers, "latest_day", lambda frame, date: frame)
    bodies = sources.responses(spark, "").select((F.size(F.split("body", '"S[0-9]+":')) - 1).alias("n")).collect()
    assert max(r["n"] for r in bodies) <= 25
    assert sum(r["n"] for r in bodies) == 1000 * len(sources.payload.MODULES)
