"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment over words.

1. The words of the test items are counted over the whole corpus. 2. An item's n-gram is a seed where
chance, by these counts, would rarely make it; an item always keeps its rarest ones. 3. Each text is
searched for seeds; hits near one another on an item are aligned with it, which finds paraphrased
and edited copies. Texts stay where they are read; only counts and hits move.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.frames import arrow_map, batch_of, stored
from barloom.llm.vocabulary import by_bytes, byte_lengths
from barloom.llm.words import WORD_BYTES, mixed, word_hashes

#: Test items that are searched at once; a larger test set is searched in so many passes.
BLOCK = 20_000
#: An n-gram whose chance at a place of a text is at most this is a seed.
RARE = 1e-7
#: Seeds that an item keeps in any case, the rarest ones.
ALWAYS = 4


class Lookup:
    """Positions of 64-bit keys in a sorted table; a bit map turns most misses away."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = np.unique(keys)
        self.bits = max(16, min(24, int(len(self.keys) * 64).bit_length()))
        self.map = np.zeros(1 << self.bits, bool)
        self.map[self.keys >> np.uint64(64 - self.bits)] = True

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in `values`, places in the table) of the values that are in it."""
        at = np.flatnonzero(self.map[values >> np.uint64(64 - self.bits)])
        if not len(at) or not len(self.keys):
            return at[:0], at[:0]
        place = np.minimum(np.searchsorted(self.keys, values[at]), len(self.keys) - 1)
        same = self.keys[place] == values[at]
        return at[same], place[same]


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place, over all words one after the other."""
    if len(words) < n:
        return words[:0]
    out = words[: len(words) - n + 1] * np.uint64(0x9E3779B97F4A7C15)
    for k in range(1, n):
        out = mixed(out) + words[k : len(words) - n + 1 + k]
    return mixed(out)


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(best Smith-Waterman score, end in `text`): match 1, other word -1, gap -1 per word."""
    steps = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    best, end = 0, 0
    for word in item.tolist():
        to = np.zeros_like(row)
        to[1:] = np.maximum(row[:-1] + np.where(text == word, 1, -1), row[1:] - 1)
        to = np.maximum(to, 0)
        row = np.maximum.accumulate(to + steps) - steps  # gaps along the text
        k = int(row.argmax())
        if row[k] > best:
            best, end = int(row[k]), k
    return best, end


@dataclass
class Seeds:
    """Seeds of one size: in order of their hash, the items and the places in them that a seed stands for."""

    n: int
    lookup: Lookup
    starts: np.ndarray
    item: np.ndarray
    place: np.ndarray

    def hits(self, words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, where the item would begin, text) of each seed in texts laid end to end."""
        at, which = self.lookup.find(grams(words, self.n))
        text = np.searchsorted(offsets, at, "right") - 1
        inside = at + self.n <= offsets[text + 1]
        at, which, text = at[inside], which[inside], text[inside]
        many = self.starts[which + 1] - self.starts[which]
        hit = np.repeat(np.arange(len(at)), many)
        entry = np.repeat(self.starts[which] - (np.cumsum(many) - many), many) + np.arange(len(hit))
        return self.item[entry], at[hit] - self.place[entry], text[hit]


@dataclass
class Items:
    """Words and seeds of a block of test items."""

    names: list
    words: list[np.ndarray]
    seeds: list[Seeds]

    def spans(self, words: np.ndarray, offsets: np.ndarray, share: float, least: int) -> Iterator[tuple[int, int, float, int, int]]:
        """(text, item, score share, first word, end word) of every aligned copy in texts laid end to end."""
        item, begin, text = (np.concatenate(x) for x in zip(*(s.hits(words, offsets) for s in self.seeds), strict=True))
        order = np.lexsort((begin, item, text))
        item, begin, text = item[order], begin[order], text[order]
        sizes = np.array([len(x) for x in self.words], np.int64)
        if not len(item):
            return
        new = np.concatenate([[True], (item[1:] != item[:-1]) | (text[1:] != text[:-1]) | (begin[1:] - begin[:-1] > sizes[item[1:]])])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(item)) - 1
        for a, b in zip(first.tolist(), last.tolist(), strict=True):
            t, own = int(text[a]), self.words[item[a]]
            size = len(own)
            low = max(int(begin[a]) - size // 2, int(offsets[t]))
            high = min(int(begin[b]) + size + size // 2 + 1, int(offsets[t + 1]))
            score, end = align(own, words[low:high])
            if score >= max(share * size, min(least, size)):
                back, begin_at = align(own[::-1], words[low : low + end][::-1])
                yield t, int(item[a]), score / size, low + end - begin_at, low + end


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Names and words of the items, at most `block` at once; items without a word are left out."""
    rows = benchmark.select(F.col(item_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL").orderBy("id", "text")
    names, words = [], []
    for row in rows.toLocalIterator():
        found = word_hashes(pa.array([row["text"]]))[0]
        if len(found):
            names.append(row["id"]), words.append(found)
        if len(names) == block:
            yield names, words
            names, words = [], []
    if names:
        yield names, words


def _counts(texts: DataFrame, known: Lookup) -> tuple[np.ndarray, int]:
    """How often each known word stands in all texts, and the number of all words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(known.keys) + 1, np.int64)
        for batch in batches:
            for part in by_bytes(batch, "text", WORD_BYTES):
                words = word_hashes(part.column("text"))[0]
                total[-1] += len(words)
                total[:-1] += np.bincount(known.find(words)[1], minlength=len(known.keys))
        some = np.flatnonzero(total)
        yield batch_of(place=some, n=total[some])

    rows = stored(arrow_map(texts, count, "place bigint, n bigint"), "word-counts").groupBy("place").agg(F.sum("n").alias("n")).collect()  # a row per word of the block at most
    out = np.zeros(len(known.keys) + 1, np.int64)
    for row in rows:
        out[row["place"]] = row["n"]
    return out[:-1], int(out[-1])


def _items(texts: DataFrame, names: list, words: list[np.ndarray], n: int, rare: float, always: int) -> Items:
    known = Lookup(np.concatenate(words))
    counts, total = _counts(texts, known)
    logs = np.log((counts + 1) / (total + len(counts)))
    found: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
    for k, own in enumerate(words):
        size = min(n, len(own))
        chance = logs[np.searchsorted(known.keys, own)]
        chance = np.sum([chance[j : len(chance) - size + 1 + j] for j in range(size)], 0)
        chosen = np.flatnonzero((chance <= np.log(rare)) | (np.argsort(np.argsort(chance, kind="stable")) < always))
        found.setdefault(size, []).append((grams(own, size)[chosen], np.full(len(chosen), k), chosen))
    seeds = []
    for size, parts in found.items():
        keys, item, place = map(np.concatenate, zip(*parts, strict=True))
        lookup, order = Lookup(keys), np.argsort(keys, kind="stable")
        seeds.append(Seeds(size, lookup, np.append(np.searchsorted(keys[order], lookup.keys), len(keys)), item[order], place[order]))
    return Items(names, words, seeds)


def benchmark_copies(
    docs: DataFrame, benchmark: DataFrame, n: int = 3, share: float = 0.35, least: int = 6, rare: float = RARE, always: int = ALWAYS, block: int = BLOCK,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
) -> DataFrame:
    """Aligned copies of test items: id, item, score (alignment score by item words), start_byte, end_byte in the text.

    A copy has a score of at least `share` of the item's words and of `least` (of all words, for
    shorter items). An item of fewer than `n` words is one seed. Null or wordless items and texts give
    nothing; repeated rows and repeated items count each; null ids are kept. The test set is walked
    in blocks of `block` items, each against all texts; texts are never moved. Other columns are not read.
    """
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {kind}, item {item_kind.simpleString()}, score double, start_byte bigint, end_byte bigint"
    found = None
    for names, words in _blocks(benchmark, item_col, "text", block):
        items = docs.sparkSession.sparkContext.broadcast(_items(rows.select("text"), names, words, n, rare, always))

        def search(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in by_bytes(batch, "text", WORD_BYTES):
                    hashes, starts, ends, offsets = word_hashes(part.column("text"))
                    hits = list(items.value.spans(hashes, offsets, share, least))
                    first = np.concatenate([[0], np.cumsum(byte_lengths(part.column("text")))])
                    columns = [[x[k] for x in hits] for k in range(5)]
                    text = np.array(columns[0], np.int64)
                    yield batch_of(
                        id=part.column("id").take(pa.array(text)), item=pa.array([items.value.names[k] for k in columns[1]], part_type), score=pa.array(columns[2], pa.float64()),
                        start_byte=starts[np.array(columns[3], np.int64)] - first[text], end_byte=ends[np.array(columns[4], np.int64) - 1] - first[text],
                    )

        part_type = pa.string() if item_kind.simpleString() == "string" else pa.int64()
        part = arrow_map(rows, search, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], schema)
    return found.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "score", "start_byte", "end_byte")


def without_copies(
    docs: DataFrame, benchmark: DataFrame, n: int = 3, share: float = 0.35, least: int = 6, rare: float = RARE, always: int = ALWAYS, block: int = BLOCK,
    text_col: str = "text", item_col: str = "item_id",
) -> DataFrame:
    """The rows of `docs`, with all columns, that hold no copy of a test item (as `benchmark_copies` finds them)."""
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    for names, words in _blocks(benchmark, item_col, "text", block):
        items = docs.sparkSession.sparkContext.broadcast(_items(texts, names, words, n, rare, always))

        def choose(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in by_bytes(batch, text_col, WORD_BYTES):
                    hashes, _, _, offsets = word_hashes(part.column(text_col))
                    clean = np.ones(part.num_rows, bool)
                    clean[[x[0] for x in items.value.spans(hashes, offsets, share, least)]] = False
                    yield part.filter(pa.array(clean))

        docs = arrow_map(docs, choose, docs.schema)
    return docs
