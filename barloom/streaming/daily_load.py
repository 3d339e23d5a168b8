"""Incremental load of landed files with Structured Streaming.

Each run picks up the files that arrived since the last one (`availableNow`), remembers them in
its checkpoint and rewrites only the keys they hold, so late files repair their own day and a
replayed micro-batch changes nothing. Run it from any scheduler; it ends when it has caught up.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from barloom.sinks.tables import replace_days, replace_keys


def load_landed(
    spark: SparkSession,
    landed: str,
    schema: T.StructType,
    table: str,
    checkpoint: str,
    keys: Sequence[str] = ("Date", "Ticker"),
    date: str = "Date",
    fmt: str = "parquet",
    whole_days: bool = False,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start the load; `awaitTermination()` on the result waits until all files are in.

    `whole_days` replaces all rows of a day instead of single keys (for sources that always
    deliver complete days).
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    stream = reader.load(landed)

    def write(batch: DataFrame, _: int) -> None:
        batch = prepare(batch) if prepare else batch
        if whole_days:
            replace_days(batch, table, date)
        else:
            replace_keys(batch, table, keys, date)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
