"""Removal of byte strings that occur more than once, by suffix arrays over shared anchors.

1. Every text gives its anchors (about one in 180 bytes at a width of 400). 2. Hashes that occur once
cannot lie in a repeat; the rest are counted with a plain aggregate. 3. Texts with shared anchors
give, for each, the bytes that its windows span. Equal contexts are one item with a count.
4. Items of one anchor are a sparse suffix array; its interval tree gives the maximal repeats.
5. Spans return to the texts. Exact copies of a text are known from its digest and take no part but once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.frames import arrow_map, batch_of, stored, tidy
from barloom.llm.suffixes import GRAM, all_repeats, anchors, gram_hashes, repeats
from barloom.llm.vocabulary import by_bytes
from barloom.llm.words import mixed, text_bytes

#: Occurrences of one anchor that are taken into one suffix array; beyond it, windows are counted by hash.
GROUP = 50_000
_ODD = np.uint64(0xC2B2AE3D27D4EB4F)


def text_key(text: Column) -> Column:
    """The first 16 bytes of a text's SHA-256; texts with equal keys are taken for equal."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _digest(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def _anchor_rows(rows: DataFrame, width: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "text"):
                data, offsets = text_bytes(part.column("text"))
                text, h, at, first, last = anchors(data, offsets, width)
                ends = pa.array(np.searchsorted(text, np.arange(part.num_rows + 1)), pa.int32())
                lists = {n: pa.ListArray.from_arrays(ends, pa.array(x)) for n, x in (("h", h.astype(np.int64)), ("at", at.astype(np.int32)), ("first", first.astype(np.int32)), ("last", last.astype(np.int32)))}
                whole = [hashlib.sha256(data[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                yield batch_of(id=part.column("id"), key=pa.array([x.digest()[:16] for x in whole], pa.binary()), whole=pa.array([x.hexdigest() for x in whole], pa.string()), n_bytes=np.diff(offsets), **lists)

    kind = rows.schema["id"].dataType.simpleString()
    return arrow_map(rows, find, f"id {kind}, key binary, whole string, n_bytes bigint, h array<bigint>, at array<int>, first array<int>, last array<int>")


def _contexts(texts: DataFrame) -> DataFrame:
    """One row per shared anchor: its hash, the text, the first window and the context (item, anchor's offset, bytes or null).

    The bytes stand in the first row of an item in a batch only.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: set[int] = set()
            columns: dict[str, list] = {n: [] for n in ("h", "key", "first", "item", "offset", "seen", "context")}
            size = 0
            for row in range(batch.num_rows):
                text, key = batch.column("text")[row].as_buffer(), batch.column("key")[row].as_py()
                found = (batch.column(c)[row].values.to_pylist() for c in ("h", "at", "first", "until", "seen"))
                view = memoryview(text)
                for h, at, first, until, seen in zip(*found, strict=True):
                    context = bytes(view[first:until])
                    item = _digest(context + (at - first).to_bytes(8, "little"))
                    new = item not in known
                    known.add(item)
                    size += len(context) if new else 0
                    for name, value in zip(columns, (h, key, first, item, at - first, seen, context if new else None), strict=True):
                        columns[name].append(value)
                    if size > 16 << 20:
                        yield made(columns)
                        columns, size = {n: [] for n in columns}, 0
                        known.clear()
            if columns["h"]:
                yield made(columns)

    def made(columns: dict[str, list]) -> pa.RecordBatch:
        kinds = {"h": pa.int64(), "key": pa.binary(), "first": pa.int64(), "item": pa.int64(), "offset": pa.int64(), "seen": pa.int64(), "context": pa.binary()}
        return batch_of(**{n: pa.array(x, kinds[n]) for n, x in columns.items()})

    return arrow_map(texts, cut, "h bigint, key binary, first bigint, item bigint, offset bigint, seen bigint, context binary")


def _groups(items: DataFrame, width: int) -> DataFrame:
    """Maximal repeats of the items of each anchor: item, start, stop (in its context) and repeat_id."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list] = {n: [] for n in ("item", "start", "stop", "repeat_id")}

        def close(group: list[tuple]) -> None:
            held: dict[int, list] = {}
            for item, n, offset, context in group:
                if item in held:
                    held[item][0] += n
                else:
                    held[item] = [n, offset, context]
            names = list(held)
            best: dict[int, set] = {k: set() for k in range(len(names))}
            for k, name in enumerate(names):
                if held[name][0] > 1:
                    best[k].add((0, len(held[name][2])))
            if len(names) > 1:
                left = [x[2][: x[1]][::-1] for x in held.values()]
                right = [x[2][x[1] :] for x in held.values()]
                for k, l, r in repeats(left, right, width):  # noqa: E741
                    best[k].add((held[names[k]][1] - l, held[names[k]][1] + r))
            for k, spans in best.items():
                reach = -1
                for start, stop in sorted(spans, key=lambda x: (x[0], -x[1])):
                    if stop > reach:  # not inside another
                        reach = stop
                        for name, value in zip(found, (names[k], start, stop, _digest(held[names[k]][2][start:stop])), strict=True):
                            found[name].append(value)

        def out() -> pa.RecordBatch:
            batch = batch_of(**{n: pa.array(x, pa.int64()) for n, x in found.items()})
            for x in found.values():
                x.clear()
            return batch

        current, group = None, []
        for batch in batches:
            for h, item, n, offset, context in zip(*(batch.column(c).to_pylist() for c in ("h", "item", "n", "offset", "context")), strict=True):
                if h != current:
                    close(group)
                    current, group = h, []
                group.append((item, n, offset, context))
            if len(found["item"]) > 100_000:
                yield out()
        close(group)
        yield out()

    return arrow_map(items.repartition("h").sortWithinPartitions("h"), scan, "item bigint, start bigint, stop bigint, repeat_id bigint")


def _string_id(data: bytes) -> int:
    """The first 8 bytes of a string's SHA-256, as those of `text_key`."""
    return int.from_bytes(hashlib.sha256(data).digest()[:8], "big", signed=True)


def _long_contexts(texts: DataFrame, width: int, group: int) -> DataFrame:
    """One row per shared anchor: hash, text, and the bytes in which its repeats lie.

    They reach from the byte before the first window to the end of the run of shared anchors: the window
    behind it occurs once, so no repeat goes on. `low` and `high` bound the bytes before the anchor.
    Where an anchor has more than `group` occurrences, each window is its own anchor.
    """
    kinds = {"h": pa.int64(), "key": pa.binary(), "begin": pa.int64(), "item": pa.int64(), "offset": pa.int64(), "low": pa.int64(), "high": pa.int64(), "context": pa.binary()}

    def starts(view: memoryview, h: int, at: int, first: int, last: int, seen: int) -> Iterator[tuple[int, int, int, int]]:
        if seen <= group:
            yield h, at, first, last
        else:
            for s in range(first, last + 1):
                yield _digest(bytes(view[s : s + width])), s, s, s

    def made(columns: dict[str, list]) -> pa.RecordBatch:
        return batch_of(**{n: pa.array(x, kinds[n]) for n, x in columns.items()})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: set[int] = set()
            columns: dict[str, list] = {n: [] for n in kinds}
            size = 0
            for row in range(batch.num_rows):
                view, key = memoryview(batch.column("text")[row].as_buffer()), batch.column("key")[row].as_py()
                h, at, first, until, seen = (batch.column(c)[row].values.to_pylist() for c in ("h", "at", "first", "until", "seen"))
                ends = list(until)
                for k in range(len(ends) - 2, -1, -1):
                    if until[k] - width + 1 == first[k + 1]:
                        ends[k] = ends[k + 1]
                for k in range(len(h)):
                    for one, a, f, z in starts(view, h[k], at[k], first[k], until[k] - width, seen[k]):
                        begin = max(f - 1, 0)
                        context = bytes(view[begin : ends[k]])
                        item = _digest(context + b"".join(x.to_bytes(8, "little", signed=True) for x in (one, a - begin, a - z, a - f)))
                        new = item not in known
                        known.add(item)
                        size += len(context) if new else 0
                        for name, value in zip(columns, (one, key, begin, item, a - begin, a - z, a - f, context if new else None), strict=True):
                            columns[name].append(value)
                        if size > 16 << 20 or len(columns["h"]) > 200_000:
                            yield made(columns)
                            columns, size = {n: [] for n in kinds}, 0
                            known.clear()
            if columns["h"]:
                yield made(columns)

    return arrow_map(texts, cut, "h bigint, key binary, begin bigint, item bigint, offset bigint, low bigint, high bigint, context binary")


def _all_groups(items: DataFrame, width: int) -> DataFrame:
    """Maximal repeats of the items of each anchor, one row for each item that holds it: item, start, stop (in its context) and repeat_id."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list] = {n: [] for n in ("item", "start", "stop", "repeat_id")}

        def out() -> pa.RecordBatch:
            batch = batch_of(**{n: pa.array(x, pa.int64()) for n, x in found.items()})
            for x in found.values():
                x.clear()
            return batch

        def close(group: list[tuple]) -> Iterator[pa.RecordBatch]:
            def strings() -> Iterator[tuple[list[int], int, int]]:
                for k, (_, n, offset, _, high, context) in enumerate(group):
                    if n > 1 and offset == high and len(context) >= width:  # the same start of several texts
                        yield [k], offset, len(context) - offset
                if len(group) > 1:
                    left, right = [x[5][: x[2]][::-1] for x in group], [x[5][x[2] :] for x in group]
                    yield from all_repeats(left, right, [(x[3], x[4]) for x in group], width)

            for held, l, r in strings():  # noqa: E741
                _, _, offset, _, _, context = group[held[0]]
                name = _string_id(context[offset - l : offset + r])
                for k in held:
                    for column, value in zip(found.values(), (group[k][0], group[k][2] - l, group[k][2] + r, name), strict=True):
                        column.append(value)
                if len(found["item"]) > 100_000:
                    yield out()

        current, group = None, []
        for batch in batches:
            for h, *item in zip(*(batch.column(c).to_pylist() for c in ("h", "item", "n", "offset", "low", "high", "context")), strict=True):
                if h != current:
                    yield from close(group)
                    current, group = h, []
                group.append(tuple(item))
        yield from close(group)
        yield out()

    return arrow_map(items.repartition("h").sortWithinPartitions("h"), scan, "item bigint, start bigint, stop bigint, repeat_id bigint")


def _windows(items: DataFrame, width: int) -> DataFrame:
    """The same spans for anchors that occur very often: windows are counted by a 64-bit hash instead of being sorted."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                context = np.frombuffer(batch.column("context")[row].as_buffer(), np.uint8)
                grams, at = gram_hashes(context), np.arange(len(context) - width + 1)
                total = np.zeros(len(at), np.uint64)
                for k in [*range(0, width - GRAM, GRAM), width - GRAM]:
                    total = mixed(total * _ODD + grams[at + k])
                n = len(at)
                yield batch_of(window=total.astype(np.int64), item=np.full(n, batch.column("item")[row].as_py()), start=at, n=np.full(n, batch.column("n")[row].as_py()))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                starts = np.sort(np.asarray(batch.column("starts")[row].values))
                first = np.flatnonzero(np.concatenate([[True], np.diff(starts) > 1]))
                last = np.append(first[1:], len(starts)) - 1
                item = batch.column("item")[row].as_py()
                spans = list(zip(starts[first].tolist(), (starts[last] + width).tolist(), strict=True))
                ids = [_digest(f"{item}:{a}:{b}".encode()) for a, b in spans]
                yield batch_of(item=np.full(len(spans), item), start=np.array([a for a, _ in spans]), stop=np.array([b for _, b in spans]), repeat_id=np.array(ids, np.int64))

    distinct = items.groupBy("item").agg(F.sum("n").alias("n"), F.max("context").alias("context"))
    rows = stored(arrow_map(distinct, hashes, "window bigint, item bigint, start bigint, n bigint"), "windows")
    often = rows.groupBy("window").agg(F.sum("n").alias("_n")).where("_n > 1").select("window")
    starts = rows.join(often, "window").groupBy("item").agg(F.collect_list("start").alias("starts"))  # at most `width` per item
    return arrow_map(starts, runs, "item bigint, start bigint, stop bigint, repeat_id bigint")


def _anchored(docs: DataFrame, width: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(texts: id, key, whole, n_bytes; classes: key, rep, copies; distinct texts with lists of their shared anchors)."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = stored(_anchor_rows(rows, width), "anchors")
    copies = F.count(F.lit(1)).alias("copies")
    classes = stored(found.where(F.col("n_bytes") >= width).groupBy("key").agg(copies, F.min("id").alias("rep")), "classes")
    one = found.where(F.col("n_bytes") >= width).join(classes, "key").where(F.col("id").eqNullSafe(F.col("rep"))).dropDuplicates(["key"])
    places = one.select("key", "rep", F.explode(F.arrays_zip("h", "at", "first", "last")).alias("a")).select("key", "rep", "a.*")
    places = stored(places, "places")
    shared = places.groupBy("h").agg(F.count(F.lit(1)).alias("seen")).where("seen > 1")
    shared = stored(places.join(shared, "h"), "shared")
    entry = F.struct("at", "h", "first", (F.col("last") + width).alias("until"), "seen")
    by_text = shared.groupBy("key", "rep").agg(F.array_sort(F.collect_list(entry)).alias("a"))  # at most one text's anchors
    by_text = by_text.select(F.col("key").alias("_key"), "rep", *[F.col(f"a.{c}").alias(c) for c in ("h", "at", "first", "until", "seen")])
    texts = rows.where(F.octet_length("text") >= width).withColumn("_key", text_key(F.col("text")))
    texts = texts.join(by_text, (texts["_key"] == by_text["_key"]) & texts["id"].eqNullSafe(by_text["rep"])).select(by_text["_key"].alias("key"), "text", "h", "at", "first", "until", "seen")
    return found, classes, texts


@tidy
def _removed_spans(docs: DataFrame, width: int, id_col: str, text_col: str, group: int) -> DataFrame:
    """What goes from the texts that lose bytes: key, gone (the whole text), starts and stops (sorted spans, may overlap)."""
    _, classes, texts = _anchored(docs, width, id_col, text_col)
    contexts = stored(_contexts(texts.withColumn("text", F.col("text").cast("binary"))), "contexts")
    counts = contexts.groupBy("h", "item").agg(F.countDistinct("key", "first").alias("n"), F.max("offset").alias("offset"), F.max("seen").alias("seen"))
    bytes_of = contexts.where(F.col("context").isNotNull()).select("h", "item", "context")
    items = stored(bytes_of.join(counts, ["h", "item"]).dropDuplicates(["h", "item"]), "items")
    spans = _groups(items.where(F.col("seen") <= group), width).unionByName(_windows(items.where(F.col("seen") > group), width))
    spans = stored(spans, "item-spans")
    where = contexts.select("key", "first", "item").distinct().join(spans, "item")
    where = where.select("key", F.struct((F.col("first") + F.col("start")).alias("start"), (F.col("first") + F.col("stop")).alias("stop")).alias("s"))
    merged = where.groupBy("key").agg(F.array_sort(F.collect_set("s")).alias("s"))  # at most one text's spans
    merged = merged.join(classes.where("copies = 1").select("key"), "key").select("key", F.lit(False).alias("gone"), F.col("s.start").alias("starts"), F.col("s.stop").alias("stops"))
    nothing = F.lit(None).cast("array<bigint>")
    return merged.unionByName(classes.where("copies > 1").select("key", F.lit(True).alias("gone"), nothing.alias("starts"), nothing.alias("stops")))


@tidy
def maximal_repeats(docs: DataFrame, width: int = 400, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """Every maximal repeat of at least `width` bytes with all its occurrences: id, start, length and repeat_id of each.

    A maximal repeat occurs more than once, and its occurrences do not all have the same byte before or
    behind them; the ends of a text equal nothing. Repeats inside longer ones are listed too. Equal
    repeat_id means equal bytes. Occurrences of one anchor beyond `group` are dealt by whole windows.
    """
    found, classes, texts = _anchored(docs, width, id_col, text_col)
    contexts = stored(_long_contexts(texts.withColumn("text", F.col("text").cast("binary")), width, group), "long-contexts")
    places = contexts.groupBy("h", "item").agg(F.countDistinct("key", "begin").alias("n"))
    # the item says all but its bytes, which stand in one row of a batch at least
    parts = contexts.where(F.col("context").isNotNull()).dropDuplicates(["h", "item"]).drop("key", "begin")
    spans = stored(_all_groups(parts.join(places, ["h", "item"]), width), "repeat-spans")
    strings = contexts.select("key", "begin", "item").distinct().join(spans, "item")
    strings = strings.select("key", (F.col("begin") + F.col("start")).alias("start"), (F.col("stop") - F.col("start")).alias("length"), "repeat_id")
    whole = found.join(classes.where("copies > 1").select("key"), "key").select(
        "key", F.lit(0).cast("bigint").alias("start"), F.col("n_bytes").alias("length"),
        F.conv(F.hex(F.substring("key", 1, 8)), 16, -10).cast("bigint").alias("repeat_id"),
    )
    every = strings.unionByName(whole).distinct()
    return found.select("id", "key").join(every, "key").drop("key").withColumnRenamed("id", id_col)


def without_repeats(
    docs: DataFrame, width: int = 400, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP, keep: Sequence[str] = ()
) -> DataFrame:
    """For every row: id, n_bytes, n_removed, n_spans, kept_sha256, the text that remains, and the columns `keep` of `docs`.

    A byte goes if some string of `width` bytes that covers it also starts elsewhere, in any row or
    the same one, overlaps included. Texts shorter than `width` stay. Null counts as empty and stays
    null. Repeated rows count as texts of their own; null ids are kept. Of a character cut in two, the
    rest is left out of the text, but not of the digest. Other columns are not read.

    Texts meet their spans in one join; a text that a large share of the rows repeats is one row
    on its other side, so adaptive execution splits it.
    """
    about = _removed_spans(docs, width, id_col, text_col, group)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text_key(text).alias("key"), F.col(text_col).cast("string").alias("text"), F.struct(F.lit(0), *keep).alias("kept"))
    rows = rows.join(about, "key", "left").withColumn("data", F.coalesce("text", F.lit("")))
    gone, empty = F.coalesce("gone", F.lit(False)), F.lit(hashlib.sha256(b"").hexdigest())
    size = F.octet_length("data").cast("bigint")
    plain = rows.where("starts IS NULL").select(
        "id", size.alias("n_bytes"), F.when(gone, size).otherwise(0).alias("n_removed"), gone.cast("bigint").alias("n_spans"),
        F.when(gone, empty).otherwise(F.sha2("data", 256)).alias("kept_sha256"), F.when(gone, F.lit("")).otherwise(F.col("text")).alias("text"), "kept",
    )
    cut = rows.where("starts IS NOT NULL").select("id", F.col("data").cast("binary").alias("data"), "starts", "stops", "kept")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(), "text": pa.string()}
        for batch in batches:
            columns: dict[str, list] = {n: [] for n in kinds}
            for row in range(batch.num_rows):
                data = memoryview(batch.column("data")[row].as_buffer())
                left, reach, runs = [], 0, 0
                for start, stop in zip(batch.column("starts")[row].values.to_pylist(), batch.column("stops")[row].values.to_pylist(), strict=True):
                    if start > reach or not runs:
                        left.append(data[reach:start])
                        runs += 1
                    reach = max(reach, stop)
                rest = b"".join([*left, data[reach:]])
                for name, value in zip(columns, (len(data), len(data) - len(rest), runs, hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "ignore")), strict=True):
                    columns[name].append(value)
            yield batch_of(id=batch.column("id"), **{n: pa.array(x, kinds[n]) for n, x in columns.items()}, kept=batch.column("kept"))

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    changed = arrow_map(cut, remove, f"id {kinds['id']}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, text string, kept {kinds['kept']}")
    out = plain.unionByName(changed)
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256", F.col("text").alias(text_col), *[F.col(f"kept.`{c}`").alias(c) for c in keep])
