"""Token-id files: Re-Pair compressed blocks of whole documents in ascending order of id.

A file is a Parquet data set with one row per block: shard, block (number in the shard), documents,
tokens, doc_ids, doc_tokens and frames (binary, see `grammar`). A shard is a range of ids; blocks
close at the first document end behind `block_tokens` ids, frames hold at most `frame_tokens`.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.llm.frames import arrow_map, batch_of
from barloom.llm.grammar import Frame, compress
from barloom.llm.packing import document_ids

#: Text bytes that a shard is meant to hold.
SHARD_BYTES = 32 << 20


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, shard_bytes: int = SHARD_BYTES, block_tokens: int = 1 << 22, frame_tokens: int = 1 << 20,
    id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Encode every row, append `end_id`, and write blocks below `path`.

    Rows are dealt to shards by range of (id, hash of the text), so a repeated id does not fill one
    shard; repeated ids lie next to each other in order of that hash, null ids first. Null texts
    are empty. The number of shards follows the bytes of text.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes), docs.sparkSession.sparkContext.defaultParallelism)
    order = ["id", "_h"]
    rows = rows.withColumn("_h", F.xxhash64("text")).repartitionByRange(shards, *order).sortWithinPartitions(*order).select("id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block = TaskContext.get().partitionId(), 0
        names: list = []
        counts: list[int] = []
        frames: list[bytes] = []
        held: list[np.ndarray] = []
        waiting = 0

        def close_frames(all_of_it: bool) -> None:
            nonlocal waiting
            if waiting >= frame_tokens or all_of_it and waiting:
                ids = np.concatenate(held)
                stop = len(ids) if all_of_it else len(ids) // frame_tokens * frame_tokens
                frames.extend(compress(ids[k : k + frame_tokens]) for k in range(0, stop, frame_tokens))
                held[:] = [ids[stop:]]
                waiting = len(ids) - stop

        def close_block() -> pa.RecordBatch:
            close_frames(True)
            held.clear()
            out = batch_of(
                shard=[shard], block=[block], documents=[len(names)], tokens=[sum(counts)],
                doc_ids=pa.array([names], pa.list_(pa_kind)), doc_tokens=pa.array([counts], pa.list_(pa.int64())), frames=pa.array([list(frames)], pa.list_(pa.binary())),
            )
            names.clear(), counts.clear(), frames.clear()
            return out

        for name, ids in document_ids(batches, tokenizer, end_id):
            names.append(name), counts.append(len(ids)), held.append(ids)
            waiting += len(ids)
            close_frames(False)
            if len(frames) * frame_tokens + waiting >= block_tokens:
                yield close_block()
                block += 1
                waiting = 0
        if names:
            yield close_block()

    kind = docs.schema[id_col].dataType.simpleString()
    pa_kind = pa.int64() if kind in ("bigint", "int", "smallint", "tinyint") else pa.string()
    if pa_kind == pa.int64() and kind != "bigint":
        raise TypeError(f"{id_col} must be a bigint or string column")
    schema = f"shard bigint, block bigint, documents bigint, tokens bigint, doc_ids array<{kind}>, doc_tokens array<bigint>, frames array<binary>"
    arrow_map(rows, encode, schema).write.parquet(path)


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """One row per document from the files: id, start (ids of all documents before it), n_tokens, ids_crc32 and, on request, ids.

    Blocks are decoded where they are read. The start of a block comes from the token numbers of
    the blocks alone: totals per shard, then a running sum within each.
    """
    blocks = spark.read.parquet(path)
    sizes = blocks.select("shard", "block", "tokens")
    shards = sizes.groupBy("shard").agg(F.sum("tokens").alias("_all"))
    before = lambda *by: Window.partitionBy(*by) if by else Window.partitionBy()
    earlier = (Window.unboundedPreceding, -1)
    shard_starts = shards.select("shard", F.coalesce(F.sum("_all").over(before().orderBy("shard").rowsBetween(*earlier)), F.lit(0)).alias("_shard_start"))
    within = F.coalesce(F.sum("tokens").over(before("shard").orderBy("block").rowsBetween(*earlier)), F.lit(0))
    starts = sizes.select("shard", "block", within.alias("_in_shard")).join(shard_starts, "shard")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                names, counts = batch.column("doc_ids")[row].values, np.asarray(batch.column("doc_tokens")[row].values)
                stops = np.cumsum(counts)
                crcs = np.zeros(len(counts), np.int64)
                parts: list[np.ndarray] = []
                begin = 0
                for data in batch.column("frames")[row].values:
                    ids = Frame(data.as_py()).read().astype("<u4")
                    end = begin + len(ids)
                    for k in range(int(np.searchsorted(stops, begin, "right")), int(np.searchsorted(stops, end, "left")) + 1):
                        if k < len(stops):
                            a, b = max(begin, int(stops[k] - counts[k])), min(end, int(stops[k]))
                            crcs[k] = zlib.crc32(ids[a - begin : b - begin].tobytes(), int(crcs[k]))
                    begin = end
                    if keep_ids:
                        parts.append(ids.astype(np.int32))
                n = len(counts)
                out = {"id": names, "shard": pa.array(np.full(n, batch.column("shard")[row].as_py())), "block": pa.array(np.full(n, batch.column("block")[row].as_py())), "at": stops - counts, "n_tokens": counts, "ids_crc32": crcs}
                if keep_ids:
                    out["ids"] = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stops]), pa.int32()), pa.array(np.concatenate(parts)))
                yield batch_of(**out)

    schema = f"id {kind}, shard bigint, block bigint, at bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * keep_ids
    rows = arrow_map(blocks.select("shard", "block", "doc_ids", "doc_tokens", "frames"), decode, schema).join(starts, ["shard", "block"])
    start = F.col("_shard_start") + F.col("_in_shard") + F.col("at")
    return rows.select(F.col("id").alias(id_col), start.alias("start"), "n_tokens", "ids_crc32", *(["ids"] if keep_ids else []))
