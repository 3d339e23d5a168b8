"""Nearest neighbours by inner product: randomly rotated one-bit codes, error bounds, exact reranking.

A vector less the mean of all is rotated by a fixed random rotation; its signs are its code, and two
numbers correct the estimate: the length and the inner product of the unit vector with its code. A
query is rotated and rounded to 4 bits per component, so an estimate is four AND-and-count steps on
packed bits. The estimate's error is bounded with high probability; every vector whose upper bound
reaches the score of the k-th best found is scored exactly on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.frames import arrow_map, batch_of, importable, stored

#: Vectors of a block, and queries that meet a block at once.
BLOCK, QUERIES = 8192, 2048
#: Width of the error bound in standard errors.
WIDTH = 1.9
_QUERY_BITS = 4


def rotation(size: int, seed: int = 20) -> np.ndarray:
    """A random rotation of `size` dimensions, the same for the same seed."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def encoded(vectors: np.ndarray, mean: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes as rows of unsigned 64-bit words, lengths of the rests, inner products of unit rest and code)."""
    rest = vectors - mean
    length = np.sqrt((rest * rest).sum(1))
    padded = np.zeros((len(rest), len(turn)))
    padded[:, : rest.shape[1]] = rest / np.where(length > 0, length, 1)[:, None]
    turned = padded @ turn
    bits = turned > 0
    fit = np.abs(turned).sum(1) / np.sqrt(len(turn))
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64), length, fit


def estimates(codes: np.ndarray, length: np.ndarray, fit: np.ndarray, query: np.ndarray, mean: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimates of <rest, query rest> for all codes, and the width of their error bounds."""
    size = len(turn)
    rest = np.zeros(size)
    rest[: len(query)] = query - mean
    turned = rest @ turn
    low, steps = turned.min(), (1 << _QUERY_BITS) - 1
    step = max((turned.max() - low) / steps, 1e-300)
    levels = np.clip(np.floor((turned - low) / step + 0.5), 0, steps).astype(np.uint8)
    dot = np.zeros(len(codes))
    for bit in range(_QUERY_BITS):
        plane = np.packbits(levels >> bit & 1, bitorder="little").view(np.uint64)
        dot += (1 << bit) * np.bitwise_count(codes & plane).sum(1, dtype=np.int64)
    ones = np.bitwise_count(codes).sum(1, dtype=np.int64)
    # sum over dimensions of sign * (low + step * level), with sign = 2 * bit - 1
    signed = 2 * (low * ones + step * dot) - (low * size + step * int(levels.sum(dtype=np.int64)))
    fit = np.maximum(fit, 1e-9)
    norm = float(np.sqrt((rest * rest).sum()))
    bound = length * norm * (np.sqrt(np.maximum(1 - fit * fit, 0)) / fit * WIDTH / np.sqrt(max(size - 1, 1)) + step / max(norm, 1e-300) / np.maximum(fit, 1e-9) * 0.5)
    return length * signed / np.sqrt(size) / fit, bound


def _valid(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK, queries: int = QUERIES
) -> DataFrame:
    """query_id, rank (from 1), `id_col` and score of the `k` nearest found of each query, by inner product in double precision.

    Queries are the rows for which `is_query` holds; candidates are all rows of another id. The
    query set meets all rows in blocks of bounded size; a block gives at most `k` rows per query.
    Ties go to the smaller id. Null or zero vectors, vectors with null or non-finite components and
    rows with a null id take no part; nor do vectors whose number of components is not the most
    frequent one (of equally frequent ones the larger). A repeated query id is asked once, with the
    first of its vectors in order; a repeated candidate row is a candidate each time. Fewer
    candidates than `k`: all. Without rows the result is empty. Other columns are not read.
    """
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("asked"))
    rows = rows.where(F.col("id").isNotNull() & _valid(F.col("v")))
    sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    schema = f"query_id bigint, rank int, {id_col} bigint, score double"
    if not sizes:
        return vectors.sparkSession.createDataFrame([], schema)
    size, total = sizes[0]["size"], sizes[0]["n"]
    rows = rows.where(F.size("v") == size)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size)
        for batch in batches:
            out += _matrix(batch.column("v")).sum(0)
        yield batch_of(place=np.arange(size), total=out)

    added = arrow_map(rows.select("v"), sums, "place bigint, total double").groupBy("place").agg(F.sum("total").alias("total")).collect()  # a row per component
    mean = np.zeros(size)
    for row in added:
        mean[row["place"]] = row["total"] / total
    turn = rotation(-(-size // 64) * 64)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, length, fit = encoded(_matrix(batch.column("v")), mean, turn)
            yield batch_of(id=batch.column("id"), v=batch.column("v"), asked=batch.column("asked"), code=pa.array([x.tobytes() for x in codes], pa.binary()), length=length, fit=fit)

    indexed = stored(arrow_map(rows, index, "id bigint, v array<double>, asked boolean, code binary, length double, fit double"), "one-bit-index")
    asked = indexed.where("asked").groupBy("id").agg(F.min("v").alias("v"))
    blocks, parts = -(-total // block), max(1, -(-asked.count() // queries))
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    candidates = indexed.select("id", "v", "code", "length", "fit", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).alias("block")).withColumn("part", spread(parts))
    questions = asked.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts))).withColumn("block", spread(blocks))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = np.asarray(left.column("id").combine_chunks(), np.int64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(ids) and right.num_rows:
            original = _matrix(left.column("v"))
            codes = np.frombuffer(b"".join(left.column("code").to_pylist()), np.uint64).reshape(len(ids), -1)
            length, fit = np.asarray(left.column("length")), np.asarray(left.column("fit"))
            base = original @ mean
            for name, query in zip(right.column("id").to_pylist(), _matrix(right.column("v")), strict=True):
                guess, bound = estimates(codes, length, fit, query, mean, turn)
                guess += base + float(query @ mean) - float(mean @ mean)
                guess[ids == name] = -np.inf
                first = np.argpartition(-guess, min(2 * k, len(guess) - 1))[: 2 * k + 1] if len(guess) > 2 * k else np.arange(len(guess))
                first = first[ids[first] != name]
                exact = np.sort((original[first] * query).sum(1))[::-1]
                least = exact[k - 1] if len(exact) >= k else -np.inf
                near = np.flatnonzero((guess + bound >= least) & (ids != name))
                near = np.union1d(near, first)
                score = (original[near] * query).sum(1)
                best = np.lexsort((ids[near], -score))[:k]
                found.append((np.full(len(best), name), ids[near][best], score[best]))
        columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table({"query_id": columns[0], id_col: columns[1], "score": columns[2]})

    importable(vectors.sparkSession)
    hits = candidates.groupBy("block", "part").cogroup(questions.groupBy("block", "part")).applyInArrow(search, f"query_id bigint, {id_col} bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), id_col)
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", id_col, "score")
