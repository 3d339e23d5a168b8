"""Quality classifier: ordinal cumulative-link regression on hashed text.

A document has a graded rating 0..K. One weight per hashed feature gives a score f; ordered
thresholds t1 < t2 < ... turn it into P(grade >= k) = sigmoid(f - tk). The expected grade is the sum
of these, the tail probability is the one of the grade asked for.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.frames import arrow_map, batch_of
from barloom.llm.vocabulary import by_bytes

#: Hashed features.
BITS = 18
#: Rated documents that are used for fitting; the only bound, and only there.
SAMPLE = 20_000

_EDGES = ".,;:!?\"'()[]{}*#%&$<>|~^_=+-/\\"


def _crc(texts: list[str], salt: bytes) -> np.ndarray:
    start = zlib.crc32(salt)
    return np.fromiter((zlib.crc32(x.encode("utf-8", "replace"), start) for x in texts), np.int64, len(texts)) & ((1 << BITS) - 1)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed features of each text one after the other, and each text's offset in them.

    Features: words without case and outer punctuation, their first 4 and 5 letters, what stands behind
    a word, words in capitals,
    and, in tenths, the shares of repeated neighbours, capitals, odd endings and distinct words, with
    the magnitude of the length. Whole texts are used; null counts as empty.
    """
    blanks = pc.replace_substring_regex(pc.fill_null(texts, ""), r"[\t\n\r\f\v]", " ")
    lists = pc.split_pattern(blanks, " ")
    offsets = np.asarray(lists.offsets, np.int64)
    coded = lists.flatten().dictionary_encode()
    words, codes = coded.dictionary, np.asarray(coded.indices, np.int64)
    offsets = offsets - offsets[0]
    bare = pc.utf8_trim(pc.utf8_lower(words), _EDGES)
    ending = pc.replace_substring_regex(words, r"^.*[\pL\pN]", "")
    capital = np.asarray(pc.and_(pc.utf8_is_upper(words), pc.greater(pc.utf8_length(words), 1)))
    filled = np.asarray(pc.greater(pc.utf8_length(words), 0))
    endings = ending.dictionary_encode()
    odd = np.asarray(pc.match_substring_regex(endings.dictionary, r"[^.,;:?!]|..")) if len(endings.dictionary) else np.zeros(0, bool)
    end_codes = np.asarray(endings.indices, np.int64)
    odd_word = odd[end_codes] if len(odd) else np.zeros(len(words), bool)
    table = np.stack([
        np.where(filled, _crc(bare.to_pylist(), b"w"), -1),
        np.where(odd_word, _crc(endings.dictionary.to_pylist(), b"e")[end_codes], -1),
        np.where(np.asarray(pc.greater(pc.utf8_length(bare), 4)), _crc(pc.utf8_slice_codeunits(bare, 0, 4).to_pylist(), b"4"), -1),
        np.where(np.asarray(pc.greater(pc.utf8_length(bare), 5)), _crc(pc.utf8_slice_codeunits(bare, 0, 5).to_pylist(), b"5"), -1),
        np.where(capital, _crc(["capital"], b"c")[0], -1),
    ], 1)
    shares = {f"{name}{k}": int(_crc([f"{name}{k}"], b"s")[0]) for name in ("again", "capital", "odd", "kinds", "size") for k in range(64)}
    out, ends = [], [0]
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        c = codes[a:b]
        c = c[filled[c]]
        n = max(len(c), 1)
        kinds = np.unique(c)
        tenth = lambda x, n=n: int(np.ceil(10 * x / n))
        extra = [
            shares[f"again{tenth(int((c[1:] == c[:-1]).sum()))}"], shares[f"capital{tenth(int(capital[c].sum()))}"], shares[f"odd{tenth(int(odd_word[c].sum()))}"],
            shares[f"kinds{tenth(len(kinds)) + 11 * min(len(c) // 64, 3)}"], shares[f"size{len(c).bit_length()}"],
        ]
        found = np.unique(np.concatenate([table[kinds].ravel(), extra]))
        found = found[found >= 0]
        out.append(found)
        ends.append(ends[-1] + len(found))
    return (np.concatenate(out) if out else np.zeros(0, np.int64)), np.array(ends)


@dataclass
class OrdinalModel:
    """Shared weights and ordered thresholds; `thresholds[k - 1]` belongs to P(grade >= k)."""

    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, found: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1..K, one row per text."""
        sums = np.concatenate([[0.0], np.cumsum(self.weights[found])])
        score = sums[ends[1:]] - sums[ends[:-1]]
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -40, 40)))


def fitted(found: np.ndarray, ends: np.ndarray, grades: np.ndarray, top: int, rounds: int = 150, ridge: float = 5e-2, seen: int = 8) -> OrdinalModel:
    """Maximum likelihood with a ridge, by Adam on all given texts; features in fewer than `seen` texts keep weight 0.

    A feature enters with the size of its log ratio between the highest grade and the rest, so that
    the ridge holds back words that say nothing and lets telling ones grow.
    """
    n, size = len(grades), 1 << BITS
    found, text = found.astype(np.int32, copy=False), np.repeat(np.arange(n, dtype=np.int32), np.diff(ends))
    parts = [slice(k, k + (1 << 20)) for k in range(0, len(found), 1 << 20)]  # so that temporary arrays stay small
    count = lambda which: sum((np.bincount(found[p][which(text[p])], minlength=size) for p in parts), np.zeros(size))
    in_top, in_rest = count(lambda t: grades[t] == top), count(lambda t: grades[t] != top)
    ratio = np.log((in_top + 1) / (np.sum(grades == top) + 2)) - np.log((in_rest + 1) / (np.sum(grades != top) + 2))
    scale = np.where(in_top + in_rest >= seen, np.abs(ratio), 0.0)
    weights, gaps = np.zeros(size), np.array([-1.0] + [0.0] * (top - 1))  # first threshold, then logs of the steps
    moments = [np.zeros(size), np.zeros(size), np.zeros(top), np.zeros(top)]
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    for k in range(1, rounds + 1):
        thresholds = np.cumsum(np.concatenate([gaps[:1], np.exp(gaps[1:])]))
        borders = np.concatenate([[-np.inf], thresholds, [np.inf]])
        scaled = weights * scale
        score = sum((np.bincount(text[p], scaled[found[p]], n) for p in parts), np.zeros(n))
        low, high = borders[grades] - score, borders[grades + 1] - score
        below, above = np.where(np.isfinite(low), sigmoid(low), 0.0), np.where(np.isfinite(high), sigmoid(high), 1.0)
        share = np.maximum(above - below, 1e-12)
        d_low, d_high = below * (1 - below) / share, above * (1 - above) / share
        slope = (d_high - d_low) / n  # of the loss, by the score
        at = np.zeros(top + 2)
        np.add.at(at, grades, d_low / n)
        np.add.at(at, grades + 1, -d_high / n)
        by_threshold = at[1:-1]
        by_gap = np.cumsum(by_threshold[::-1])[::-1] * np.concatenate([[1.0], np.exp(gaps[1:])])
        gradient = scale * sum((np.bincount(found[p], slope[text[p]], size) for p in parts), np.zeros(size)) + ridge * weights / np.sqrt(n)
        for value, g, m, v, rate in ((weights, gradient, moments[0], moments[1], 0.1), (gaps, by_gap, moments[2], moments[3], 0.1)):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            value -= rate * min(1.0, 4 * (1 - k / (rounds + 1))) * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return OrdinalModel(weights * scale, np.cumsum(np.concatenate([gaps[:1], np.exp(gaps[1:])])))


def fit_quality(docs: DataFrame, ratings: DataFrame, top: int, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> OrdinalModel | None:
    """A model from `ratings` (id, grade 0..top): the lowest grade of an id counts; null ids and grades are left out.

    At most `sample` rated documents are used, the first in order of a hash of the id; only their
    feature numbers reach the driver. Without any rated document there is no model (None).
    """
    rated = ratings.select(F.col(id_col).alias("id"), F.col("grade").cast("int").alias("grade")).where("id IS NOT NULL AND grade IS NOT NULL")
    rated = rated.groupBy("id").agg(F.min("grade").alias("grade")).orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(rated), "id").select("text", "grade")

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "text"):
                found, ends = features(part.column("text"))
                yield batch_of(grade=part.column("grade"), found=pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found.astype(np.int32))))

    table = arrow_map(rows, collect, "grade int, found array<int>").toArrow().combine_chunks()
    if not table.num_rows:
        return None
    lists = table.column("found").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    grades = np.clip(np.asarray(table.column("grade").combine_chunks()), 0, top).astype(np.int64)
    ends = np.asarray(lists.offsets, np.int64)
    return fitted(np.asarray(lists.flatten()), ends - ends[0], grades, top)


def quality_scores(docs: DataFrame, model: OrdinalModel | None, tail: int, least: float = 0.6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, expected_grade, p_tail = P(grade >= tail) and keep (p_tail >= least) for every row.

    Null and empty texts have the features of an empty text. Without a model both numbers are null
    and every row is kept. Null ids and repeated rows are scored like others; no shuffle.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    if model is None:
        return rows.select(F.col("id").alias(id_col), F.lit(None).cast("double").alias("expected_grade"), F.lit(None).cast("double").alias("p_tail"), F.lit(True).alias("keep"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "text"):
                p = model.at_least(*features(part.column("text")))
                yield batch_of(id=part.column("id"), expected_grade=p.sum(1), p_tail=p[:, tail - 1].copy(), keep=p[:, tail - 1] >= least)

    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map(rows, score, f"id {kind}, expected_grade double, p_tail double, keep boolean").withColumnRenamed("id", id_col)


def kept_by_quality(docs: DataFrame, model: OrdinalModel | None, tail: int, least: float = 0.6, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, with all columns, whose P(grade >= tail) is at least `least`; all rows without a model."""
    if model is None:
        return docs

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, text_col):
                yield part.filter(pa.array(model.at_least(*features(part.column(text_col)))[:, tail - 1] >= least))

    return arrow_map(docs, choose, docs.schema)
