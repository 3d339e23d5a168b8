"""What the operators share: reading, intermediate tables in the shared folder, Arrow mapping."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import barloom
from barloom.session import remove, shared_dir

#: Most bytes of rows that Spark hands to a Python worker at once.
ARROW_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders that the running calls of `tidy` functions have made, innermost call last.
_made: list[set[str]] = []


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The rows written once to the shared folder and read again: short lineage that survives lost executors.

    Inside a `tidy` function the folder goes when the function's result is written, or earlier by `drop_stored`.
    """
    path = shared_dir(frame.sparkSession, purpose)
    if _made:
        _made[-1].add(path)
    frame.write.parquet(path)
    out = frame.sparkSession.read.schema(frame.schema).parquet(path)
    out.stored_at = path
    return out


def drop_stored(*frames: DataFrame | None) -> None:
    """Delete the folders of frames that `stored` or a `tidy` function gave to the running `tidy` function; they must not be read again."""
    for frame in frames:
        path = frame and vars(frame).get("stored_at")
        if _made and path in _made[-1]:
            remove(frame.sparkSession, path)
            _made[-1].discard(path)


def tidy(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The function's result is written to the shared folder; then every folder that `stored` made on the way is deleted."""

    @functools.wraps(function)
    def run(*args, **kwargs) -> DataFrame:
        _made.append(set())
        try:
            frame = function(*args, **kwargs)
            path = shared_dir(frame.sparkSession, function.__name__)
            frame.write.parquet(path)
        finally:
            for folder in _made.pop():
                remove(SparkSession.getActiveSession(), folder)
        if _made:
            _made[-1].add(path)
        out = frame.sparkSession.read.schema(frame.schema).parquet(path)
        out.stored_at = path
        return out

    return run


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where it is not installed but on the driver's path."""
    root, known = str(Path(barloom.__file__).resolve().parents[1]), spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(x for x in (known.get("PYTHONPATH", ""), root) if x)


def arrow_map(frame: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """`mapInArrow` with batches bounded by bytes, so that a run of long texts does not fill a worker."""
    importable(frame.sparkSession)
    frame.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return frame.mapInArrow(function, schema)


def batch_of(**columns) -> pa.RecordBatch:
    """A record batch from named numpy or Arrow arrays."""
    return pa.RecordBatch.from_arrays([x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x) for x in columns.values()], names=list(columns))
