"""Packing of token sequences: shortest-pack-first over the histogram of piece lengths.

Documents are tokenised and cut into pieces of at most `length` ids. Only the histogram of piece
lengths (at most `length` numbers) reaches the driver. There lengths are placed longest first into
the emptiest pack that has room, for all packs of one filling pattern at once. Patterns return to
the pieces by rank: the r-th piece of a length takes the r-th place that the patterns hold for it.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.frames import arrow_map, batch_of, stored
from barloom.llm.vocabulary import BATCH_BYTES, by_bytes, byte_lengths, encoder, pieces_of

#: Pieces of one length that are ranked in one group.
RANK_ROWS = 100_000


def document_ids(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int) -> Iterator[tuple[object, np.ndarray]]:
    """(id, token ids with `end_id` behind) of each row; long texts are encoded part by part."""
    words = encoder(tokenizer)
    end = np.array([end_id], np.uint32)
    for batch in batches:
        for part in by_bytes(batch, "text"):
            names, texts = part.column("id").to_pylist(), part.column("text")
            if len(names) == 1 and byte_lengths(texts)[0] > BATCH_BYTES:
                yield names[0], np.concatenate([*(words.encode(pa.array([x]))[0] for x in pieces_of(texts[0].as_py(), BATCH_BYTES)), end])
            else:
                ids, offsets = words.encode(texts)
                for k, name in enumerate(names):
                    yield name, np.append(ids[offsets[k] : offsets[k + 1]], end)


def token_pieces(
    docs: DataFrame, tokenizer: str, length: int = 4096, end_id: int = 2, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces of at most `length` ids: id, start, length, ids_crc32, doc_tokens and, on request, the ids themselves.

    A null or empty text is the one piece that holds `end_id`. Null ids and repeated rows are kept.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            out = dict(zip(("id", "start", "length", "ids_crc32", "doc_tokens"), (pa.array(x, pa.int64()) if k or kind == "bigint" else pa.array(x) for k, x in enumerate(columns)), strict=True))
            if keep_ids:
                ends = np.cumsum([0, *map(len, held)])
                out["ids"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(held).astype(np.int32)))
            rows.clear(), held.clear()
            return batch_of(**out)

        for name, ids in document_ids(batches, tokenizer, end_id):
            for start in range(0, len(ids), length):
                part = ids[start : start + length]
                rows.append((name, start, len(part), zlib.crc32(part.astype("<u4").tobytes()), len(ids)))
                size += len(part) if keep_ids else 1
                if keep_ids:
                    held.append(part)
            if size >= 500_000:
                yield flush()
                size = 0
        if rows:
            yield flush()

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids array<int>" * keep_ids
    return arrow_map(rows, cut, schema).withColumnRenamed("id", id_col)


def filling_patterns(histogram: dict[int, int], capacity: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """(number of packs, ((length, copies), ...)) for every filling pattern.

    Longest length first, each piece into the emptiest pack with room; a new pack is opened only
    where none has room. Equal packs are one entry, so the work follows the number of distinct
    lengths. At most two patterns arise per length, with at most sqrt(2 * capacity) runs each.
    """
    open_packs: dict[int, list[list]] = defaultdict(list)  # room -> [packs, runs]
    full: list[tuple[int, tuple[tuple[int, int], ...]]] = []

    def put(room: int, packs: int, runs: tuple) -> None:
        if packs and room:
            open_packs[room].append([packs, runs])
        elif packs:
            full.append((packs, runs))

    def extended(runs: tuple, length: int) -> tuple:
        return (*runs[:-1], (length, runs[-1][1] + 1)) if runs[-1][0] == length else (*runs, (length, 1))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max(open_packs, default=0)
            if room < length:
                copies = capacity // length
                put(capacity - copies * length, left // copies, ((length, copies),))
                rest = left % copies
                put(capacity - rest * length, 1 if rest else 0, ((length, rest),))
                break
            packs, runs = open_packs[room].pop()
            if not open_packs[room]:
                del open_packs[room]
            used = min(left, packs)
            put(room, packs - used, runs)
            put(room - length, used, extended(runs, length))
            left -= used
    return full + [(packs, runs) for room in sorted(open_packs) for packs, runs in open_packs[room]]


def _places(patterns: list[tuple[int, tuple[tuple[int, int], ...]]]) -> np.ndarray:
    """Rows (length, first rank, packs, first sequence, offset), sorted: the places of each length in order of rank."""
    taken: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for packs, runs in patterns:
        offset = 0
        for length, copies in runs:
            rows.append((length, taken[length], packs, sequence, offset))
            taken[length] += packs * copies
            offset += length * copies
        sequence += packs
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = 4096, id_col: str = "doc_id", rank_rows: int = RANK_ROWS) -> DataFrame:
    """`pieces` (with start and length, as `token_pieces` gives them) with sequence_id and offset added.

    Pieces of one length are interchangeable, so ties need no rule; they are ranked within salted
    groups of about `rank_rows`, and a count per group gives the first rank of each. A frequent
    length is thereby spread. The pieces are written to the shared folder, since they are read
    twice. Every length must lie in 1..capacity. An empty table gives an empty result.
    """
    pieces = stored(pieces, "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    if any(not 1 <= n <= capacity for n in histogram):
        raise ValueError(f"a piece is not of 1 to {capacity} ids")
    places = _places(filling_patterns(histogram, capacity))
    salts = -(-max(histogram.values(), default=1) // rank_rows)
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(id_col, "start", "ids_crc32"), F.lit(salts)))
    counts = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy("length", "_salt").orderBy(id_col, "start", "ids_crc32")
    ranked = salted.withColumn("_row", F.row_number().over(within)).join(firsts, ["length", "_salt"])
    ranked = ranked.select(*pieces.columns, (F.col("_first") + F.col("_row") - 1).alias("_rank"))

    kept = list(pieces.columns)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = places[:, 0] << 44 | places[:, 1]
        for batch in batches:
            rank = np.asarray(batch.column("_rank"))
            length = np.asarray(batch.column("length"))
            k = np.searchsorted(keys, length << 44 | rank, "right") - 1
            copy, pack_no = np.divmod(rank - places[k, 1], places[k, 2])
            columns = {c: batch.column(c) for c in kept}
            yield batch_of(**columns, sequence_id=places[k, 3] + pack_no, offset=places[k, 4] + copy * length)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return arrow_map(ranked, place, f"{schema}, sequence_id bigint, offset bigint")


def sequences(placed: DataFrame, capacity: int = 4096, pad_id: int = 0) -> DataFrame:
    """The packed sequences themselves (sequence_id, ids, n_ids), padded with `pad_id`; `placed` must hold ids.

    A group is one sequence of at most `capacity` ids.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    ids = F.flatten(F.transform(parts, lambda x: x["ids"]))
    rows = placed.groupBy("sequence_id").agg(ids.alias("ids"))
    return rows.select("sequence_id", F.concat("ids", F.array_repeat(F.lit(pad_id), F.lit(capacity) - F.size("ids"))).alias("ids"), F.size("ids").alias("n_ids"))
