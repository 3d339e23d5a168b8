"""Hard negatives by inner product: bounds along a spanning tree of the anchors, exact scores only inside windows.

Anchors are dealt into blocks of near ones, and each block gets a spanning tree whose root is the zero
vector (all scores 0): every anchor hangs on the nearest anchor already in the tree, at a bounded
depth. If |a - p| is an edge's length, the score of candidate x at a lies within |a - p| * |x| of its score, or
of its bounds, at p. So one walk down the tree bounds all scores of a slice of candidates; only candidates
whose bounds meet the anchor's window are scored, and their exact scores tighten the bounds below.

First walk: window from the last positive found so far upwards, candidates of the anchor's label. Second
walk: windows [share * positive score, positive score], candidates of other labels. Anchors are the stated
query set: each block meets all candidates, in slices of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.frames import arrow_map, batch_of, drop_stored, stored, tidy

#: Most anchors of a block, candidates of a slice, slices that meet a block in one task, and depth of a tree.
ANCHORS, SLICE, SLICES, DEPTH = 4096, 16_384, 64, 48
#: Candidates that are bounded and scored at once.
CHUNK = 4096
_SLICE = "slice bigint, n int, size int, kind string, ids binary, labels binary, asked binary, whole binary"
_BLOCK = "block bigint, first bigint, size int, kind string, rows binary, ids binary, labels binary, parents binary, lengths binary, whole binary"


def _packed(values: np.ndarray) -> tuple[str, bytes]:
    """Whole numbers (held as doubles) in the smallest type that holds them."""
    most = np.abs(values).max(initial=0)
    kind = "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<f8"
    return kind, values.astype(kind).tobytes()


def scores(anchor: np.ndarray, rows: np.ndarray, most: float) -> np.ndarray:
    """Exact inner products as 64-bit integers; beyond 64 bits the nearest such integer.

    `most` is the largest product of absolute components; below 2**53 in sum, doubles are exact.
    """
    if most * max(1, rows.shape[1]) < 2**53:
        return (rows @ anchor).astype(np.int64)
    own = [int(x) for x in anchor]
    sums = [sum(a * int(b) for a, b in zip(own, row, strict=True)) for row in rows]
    return np.array([min(max(s, -(2**63)), 2**63 - 1) for s in sums], np.int64)


def spanning_tree(vectors: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent in that order or -1 for the zero vector, edge length): parents come before children, the walk is depth first."""
    n = len(vectors)
    norms = (vectors * vectors).sum(1)
    norms = np.where(np.isfinite(norms), norms, 1e300)
    near, parent, level = norms.copy(), np.full(n, -1), np.zeros(n, np.int64)
    free = np.ones(n, bool)
    children: dict[int, list[int]] = {}
    for _ in range(n):
        k = int(np.argmin(np.where(free, near, np.inf)))
        free[k] = False
        level[k] = 1 + (level[parent[k]] if parent[k] >= 0 else 0)
        children.setdefault(int(parent[k]), []).append(k)
        if level[k] < depth:
            gap = np.maximum(np.nan_to_num(norms + norms[k] - 2 * (vectors @ vectors[k]), nan=1e300, posinf=1e300), 0)
            closer = free & (gap < near)
            near[closer], parent[closer] = gap[closer], k
    order, todo = [], children.get(-1, [])[::-1]
    while todo:
        k = todo.pop()
        order.append(k)
        todo += children.get(k, [])[::-1]
    order = np.array(order, np.int64)
    place = np.empty(n + 1, np.int64)
    place[order], place[n] = np.arange(n), -1
    upper = np.where(parent[order] >= 0, place[parent[order]], -1)
    edge = vectors[order] - np.where((parent[order] >= 0)[:, None], vectors[parent[order]], 0)
    return order, upper, np.sqrt((edge * edge).sum(1))


def walk(
    anchors: np.ndarray, parents: np.ndarray, lengths: np.ndarray, rows: np.ndarray, wanted: Callable[[int, np.ndarray, np.ndarray], np.ndarray],
    found: Callable[[int, np.ndarray, np.ndarray], None],
) -> int:
    """Down the tree for one chunk of candidates; the number of exact scores.

    `wanted(k, low, high)` tells which candidates anchor k may need, given bounds of their scores; `found(k,
    places, scores)` takes these candidates' exact scores. Bounds are kept along the current path only.
    """
    norms = np.sqrt((rows * rows).sum(1))
    # beyond rounding of the products that the bounds are made of
    slack = 1e-9 * norms
    zero = np.zeros(len(rows))
    path: list[tuple[int, np.ndarray, np.ndarray]] = []
    most, scored = np.abs(anchors).max(initial=0) * np.abs(rows).max(initial=0), 0
    for k in range(len(anchors)):
        while path and path[-1][0] != parents[k]:
            path.pop()
        _, low, high = path[-1] if path else (-1, zero, zero)
        reach = lengths[k] * norms * (1 + 1e-9) + slack * (lengths[k] + 1)
        low, high = np.nan_to_num(low - reach, nan=-np.inf, neginf=-np.inf), np.nan_to_num(high + reach, nan=np.inf, posinf=np.inf)
        places = np.flatnonzero(wanted(k, low, high))
        if len(places):
            exact = scores(anchors[k], rows if 2 * len(places) > len(rows) else rows[places], most)
            exact = exact[places] if len(exact) != len(places) else exact
            low[places] = high[places] = exact
            scored += len(places)
            found(k, places, exact)
        path.append((k, low, high))
    return scored


class _Best:
    """The `k` best (score, id) of each list, higher scores first, ties to smaller ids."""

    def __init__(self, lists: int, k: int) -> None:
        self.k, self.score, self.id, self.row = k, [np.zeros(0, np.int64)] * lists, [np.zeros(0, np.int64)] * lists, [np.zeros(0, np.int64)] * lists

    def least(self, at: int) -> float:
        """A candidate below this score cannot enter list `at`."""
        return float(self.score[at][-1]) if len(self.score[at]) == self.k else -np.inf

    def add(self, at: int, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if len(score) > 4 * self.k:  # sort few; ties at the border stay in
            keep = score >= np.partition(score, len(score) - self.k)[len(score) - self.k]
            score, ids, rows = score[keep], ids[keep], rows[keep]
        score, ids, rows = (np.concatenate(x) for x in ((self.score[at], score), (self.id[at], ids), (self.row[at], rows)))
        best = np.lexsort((rows, ids, -score))[: self.k]
        self.score[at], self.id[at], self.row[at] = score[best], ids[best], rows[best]


def _slices(rows: DataFrame, size: int, slice_rows: int) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: list[tuple] = []
        count, name = 0, TaskContext.get().partitionId() << 20

        def flush() -> pa.RecordBatch:
            ids, labels, asked, whole = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            kind, data = _packed(whole)
            columns = {"slice": [name], "n": pa.array([len(ids)], pa.int32()), "size": pa.array([size], pa.int32()), "kind": [kind]}
            return batch_of(**{k: pa.array(v) if isinstance(v, list) else v for k, v in columns.items()}, ids=pa.array([ids.tobytes()]), labels=pa.array([labels.tobytes()]), asked=pa.array([asked.tobytes()]), whole=pa.array([data]))

        for batch in batches:
            ids, labels = (np.asarray(batch.column(c), np.int64) for c in ("id", "label"))
            asked = np.asarray(batch.column("asked").to_numpy(zero_copy_only=False), bool)
            whole = np.zeros((len(ids), size))
            vector = batch.column("v")
            lengths = np.diff(np.asarray(vector.offsets))
            whole[np.arange(size)[None, :] < lengths[:, None]] = np.asarray(vector.flatten(), np.float64)
            for start in range(0, len(ids), slice_rows):
                part = slice(start, start + slice_rows)
                if count + len(ids[part]) > slice_rows:
                    yield flush()
                    count, name = 0, name + 1
                held.append((ids[part], labels[part], asked[part], whole[part]))
                count += len(ids[part])
        if held:
            yield flush()

    return stored(arrow_map(rows, pack, _SLICE), "slices")


def _matrix(data: bytes, kind: str, size: int) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(-1, size).astype(np.float64) if size else np.zeros((0, 0))


def _anchor_blocks(slices: DataFrame, size: int, most: int) -> DataFrame:
    """Blocks of near anchors (neighbours in the order of their sign codes) with a spanning tree each."""
    turn = np.random.default_rng(13).standard_normal((size, 63))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                places = np.flatnonzero(np.frombuffer(r["asked"], bool))
                whole = _matrix(r["whole"], r["kind"], size) if size else np.zeros((r["n"], 0))
                code = ((whole[places] @ turn > 0) * (1 << np.arange(62, -1, -1, dtype=np.int64))).sum(1)
                yield batch_of(
                    row=r["slice"] * (1 << 20) + places, id=np.frombuffer(r["ids"], np.int64)[places], label=np.frombuffer(r["labels"], np.int64)[places],
                    code=code.astype(np.int64), v=pa.array([x.tobytes() for x in whole[places]], pa.binary()),
                )

    anchors = stored(arrow_map(slices, pick, "row bigint, id bigint, label bigint, code bigint, v binary"), "anchors")
    blocks = max(1, -(-anchors.count() // most))

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table = pa.Table.from_batches(list(batches))  # about `most` rows: a range of the anchors
        for start in range(0, table.num_rows, most):
            part = table.slice(start, most)
            vectors = np.frombuffer(b"".join(part.column("v").to_pylist()), np.float64).reshape(part.num_rows, size)
            order, parents, lengths = spanning_tree(vectors)
            kind, data = _packed(vectors[order])
            columns = {c: pa.array([np.asarray(part.column(c))[order].astype(np.int64).tobytes()]) for c in ("row", "id", "label")}
            yield batch_of(
                block=pa.array([TaskContext.get().partitionId()], pa.int64()), first=pa.array([np.asarray(part.column("row"))[order[0]]], pa.int64()), size=pa.array([size], pa.int32()), kind=pa.array([kind]), rows=columns["row"], ids=columns["id"], labels=columns["label"],
                parents=pa.array([parents.tobytes()]), lengths=pa.array([lengths.tobytes()]), whole=pa.array([data]),
            )

    ranged = anchors.repartitionByRange(blocks, "code", "row").sortWithinPartitions("code", "row")
    out = stored(arrow_map(ranged, plant, _BLOCK), "anchor-blocks")
    drop_stored(anchors)
    return out


def _met(slices: DataFrame, blocks: DataFrame, columns: list[str]) -> DataFrame:
    """Every slice beside every block, in groups of a block and at most about SLICES slices."""
    n, parts = slices.count(), blocks.agg(F.max("block")).first()[0]
    parts = 1 if parts is None else parts + 1
    lanes = max(-(-n // SLICES), min(n, -(-slices.sparkSession.sparkContext.defaultParallelism // parts)), 1)
    each = lambda k: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(k - 1).cast("bigint")))
    left = slices.withColumn("lane", F.pmod(F.xxhash64("slice"), F.lit(lanes))).withColumn("block", each(parts)).drop("asked", "first")
    right = blocks.withColumn("lane", each(lanes)).select("block", "lane", *[F.col(c).alias(f"a_{c}") for c in columns])
    return left.join(right, ["block", "lane"]).sortWithinPartitions("block", "lane")


@tidy
def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100), scale: int = 256, label: Column | None = None,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", anchors: int = ANCHORS, slice_rows: int = SLICE,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score and negative_score.

    Components become floor(scale * x); a score is the inner product of these whole numbers. An anchor's positives are
    its `positives` best other rows of its label (`label`, by default `label_col`). For each, the best `negatives`
    rows of other labels with share[0] * positive <= share[1] * negative <= share[1] * positive are returned. Higher scores come
    first, ties by smaller id.

    Rows with a null id, label or vector, or a null or non-finite component take no part. Every other row is a candidate of its
    own, rows with one id included, and only the very row is not its own positive; equal results are one row. Shorter vectors
    count as filled up with zeros. Scores beyond 64 bits are the nearest 64-bit number. Fewer rows: all. Other columns are not read.
    """
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("id"), (F.col(label_col) if label is None else label).cast("bigint").alias("label"), F.col(vector_col).cast("array<double>").alias("v"),
        F.coalesce(is_anchor, F.lit(False)).alias("asked"),
    )
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").where(fine)
    # of one component more than the double's range, the largest double
    top = F.lit(1.7e308)
    rows = rows.withColumn("v", F.transform("v", lambda x: F.greatest(F.least(F.when(F.abs(x) < 2**52, F.floor(x * scale).cast("double")).otherwise(x * scale), top), -top)))
    size = rows.agg(F.max(F.size("v"))).first()[0] or 0
    slices = _slices(rows, size, slice_rows)
    blocks = _anchor_blocks(slices, size, anchors)

    def search(batches: Iterator[pa.RecordBatch], second: bool) -> Iterator[pa.RecordBatch]:
        now, best, block = None, None, None

        def report() -> pa.RecordBatch:
            counts = [len(x) for x in best.score]
            at = np.repeat(np.arange(len(counts)), counts)
            columns = {"anchor": block["rows"][at // positives if second else at], "id": np.concatenate(best.id), "row": np.concatenate(best.row), "score": np.concatenate(best.score)}
            return batch_of(**columns, place=at % positives if second else np.zeros(len(at), np.int64))

        for batch in batches:
            for r in range(batch.num_rows):
                get = lambda c: batch.column(c)[r].as_py()  # noqa: B023, E731
                mark = (get("block"), get("lane"), get("a_rows"))
                if mark != now:
                    if now is not None:
                        yield report()
                    now = mark
                    numbers = {c: np.frombuffer(get(f"a_{c}"), np.int64) for c in ("rows", "labels", "parents")}
                    block = numbers | {"lengths": np.frombuffer(get("a_lengths"), np.float64), "whole": _matrix(get("a_whole"), get("a_kind"), size)}
                    if not size:
                        block["whole"] = np.zeros((len(block["rows"]), 0))
                    if second:
                        block["windows"] = np.frombuffer(get("a_windows"), np.int64).reshape(-1, positives)
                    best = _Best(len(block["rows"]) * (positives if second else 1), negatives if second else positives)
                ids, labels = (np.frombuffer(get(c), np.int64) for c in ("ids", "labels"))
                whole = _matrix(get("whole"), get("kind"), size) if size else np.zeros((len(ids), 0))
                own = get("slice") * (1 << 20) + np.arange(len(ids))
                for start in range(0, len(ids), CHUNK):
                    part = slice(start, start + CHUNK)
                    _chunk(block, best, ids[part], labels[part], own[part], whole[part], positives, share if second else None)
        if now is not None:
            yield report()

    kinds = "anchor bigint, id bigint, row bigint, score bigint, place bigint"
    first = arrow_map(_met(slices, blocks, ["rows", "labels", "parents", "lengths", "kind", "whole"]), lambda b: search(b, False), kinds)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id", "row")
    chosen = first.select("anchor", "id", "row", "score", F.row_number().over(order).alias("rank")).where(F.col("rank") <= positives)
    chosen = stored(chosen, "positives")

    # the windows travel with the blocks: at most `positives` numbers per anchor
    places = blocks.select("block", "first", "rows")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                own = np.frombuffer(r["rows"], np.int64)
                yield batch_of(anchor=own, block=np.full(len(own), r["block"]), first=np.full(len(own), r["first"]), place=np.arange(len(own)))

    lists = arrow_map(places, listed, "anchor bigint, block bigint, first bigint, place bigint")
    of_block = lists.join(chosen.select("anchor", "rank", "score"), "anchor").groupBy("block", "first").agg(F.collect_list(F.struct("place", "rank", "score")).alias("w"))  # of at most `anchors` anchors

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                n = len(batch.column("rows")[r].as_buffer()) // 8
                out = np.full((n, positives), -1)
                w = batch.column("w")[r].values
                if w is not None and len(w):
                    out[np.asarray(w.field("place")), np.asarray(w.field("rank")) - 1] = np.asarray(w.field("score"))
                one = batch.slice(r, 1)
                yield batch_of(**{c: one.column(c) for c in one.schema.names if c != "w"}, windows=pa.array([out.tobytes()]))

    ready = blocks.join(of_block, ["block", "first"])
    ready = stored(arrow_map(ready.select(*blocks.columns, "w"), windows, _BLOCK + ", windows binary"), "windows")
    met = _met(slices, ready, ["rows", "labels", "parents", "lengths", "kind", "whole", "windows"])
    hits = arrow_map(met, lambda b: search(b, True), kinds)
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id", "row")
    hits = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    own = chosen.select("anchor", (F.col("rank") - 1).cast("bigint").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield batch_of(anchor=np.frombuffer(r["rows"], np.int64), anchor_id=np.frombuffer(r["ids"], np.int64))

    anchor_ids = arrow_map(blocks.select("rows", "ids"), names, "anchor bigint, anchor_id bigint")
    out = hits.join(own, ["anchor", "place"]).join(anchor_ids, "anchor")
    return out.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")).distinct()


def _chunk(block: dict, best: _Best, ids: np.ndarray, labels: np.ndarray, own: np.ndarray, whole: np.ndarray, positives: int, share: tuple[int, int] | None) -> int:
    """One chunk of candidates against all anchors of a block; the number of exact scores. `share` None: positives."""
    marks = {x: labels == x for x in np.unique(block["labels"]).tolist()}

    def wanted(k: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        same = marks[int(block["labels"][k])]
        if share is None:
            return same & (high >= best.least(k))
        out = np.zeros(len(low), bool)
        for j in range(positives):
            top = int(block["windows"][k, j])
            if top >= 0:  # without a positive, or below 0, the window is empty
                out |= (low <= top * (1 + 1e-12)) & (high >= max(top * share[0] / share[1] * (1 - 1e-12), best.least(k * positives + j)))
        return out & ~same

    def found(k: int, places: np.ndarray, exact: np.ndarray) -> None:
        if share is None:
            places, exact = places[own[places] != block["rows"][k]], exact[own[places] != block["rows"][k]]
            best.add(k, exact, ids[places], own[places])
            return
        for j in range(positives):
            top = int(block["windows"][k, j])
            if top >= 0:
                inside = _inside(exact, top, share) & (exact >= best.least(k * positives + j))
                if inside.any():
                    best.add(k * positives + j, exact[inside], ids[places[inside]], own[places[inside]])

    return walk(block["whole"], block["parents"], block["lengths"], whole, wanted, found)


def _inside(score: np.ndarray, top: int, share: tuple[int, int]) -> np.ndarray:
    """share[0] * top <= share[1] * score <= share[1] * top, without overflow."""
    least = -(-share[0] * top // share[1])
    return (score >= least) & (score <= top)


def negatives_sql() -> str:
    """DuckDB SQL for the whole numbers, positives and negatives of anchors whose vec_id is divisible by 100."""
    return """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    ), s AS (
        SELECT a.vec_id AS anchor_id, a.label AS own, x.vec_id, x.label, list_inner_product(a.e, x.e)::BIGINT AS score
        FROM v a, v x WHERE a.vec_id % 100 = 0 AND a.vec_id <> x.vec_id
    ), p AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT p.anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.own AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
    WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
    QUALIFY row_number() OVER w <= 5
    """
