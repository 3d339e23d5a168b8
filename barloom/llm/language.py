"""Language identification by unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability
is the sum over all ways to cut it into pieces, by the forward algorithm; a text's is the product
over its words. Pieces are byte strings and all single bytes are pieces, so every text has one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.decontaminate import Lookup
from barloom.llm.frames import arrow_map, batch_of
from barloom.llm.vocabulary import by_bytes
from barloom.llm.words import mixed, text_bytes

#: Longer words are scored in parts of so many bytes, so that sums stay in the range of a double.
PART = 24
#: Longest piece in bytes.
LONGEST = 16
#: Added to the expected count of each piece.
SMOOTH = 0.5
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """The pieces of a sentencepiece file as byte strings, a leading blank for the start of a word."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        found = {bytes([x]) for x in range(256)}
        for k in range(model.get_piece_size()):
            if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k)):
                piece = model.id_to_piece(k).replace("▁", " ")
                if " " not in piece[1:] and piece.lower() == piece:
                    found.add(piece.encode())
        self.pieces = sorted(x for x in found if len(x) <= LONGEST)
        keys = np.zeros(len(self.pieces), np.uint64)
        for size in range(1, LONGEST + 1):
            at = [k for k, x in enumerate(self.pieces) if len(x) == size]
            if at:
                data = np.frombuffer(b"".join(self.pieces[k] for k in at), np.uint8).reshape(len(at), size)
                h = np.zeros(len(at), np.uint64)
                for j in range(size):
                    h = h * _BASE + data[:, j] + np.uint64(1)
                keys[at] = mixed(h)
        self.lookup = Lookup(keys)
        if len(self.lookup.keys) != len(keys):
            raise ValueError("two pieces share a hash")
        self.number = np.empty(len(keys), np.int64)
        self.number[np.searchsorted(self.lookup.keys, keys)] = np.arange(len(keys))

    def __len__(self) -> int:
        return len(self.pieces)

    def cuts(self, data: np.ndarray) -> list[np.ndarray]:
        """For equally long words (a row of bytes each): piece numbers by length and start; `len(self)` where there is none."""
        h, out = np.zeros(data.shape, np.uint64), []
        for size in range(1, min(LONGEST, data.shape[1]) + 1):
            h = h[:, : data.shape[1] - size + 1] * _BASE + data[:, size - 1 :] + np.uint64(1)
            places, which = self.lookup.find(mixed(h).ravel())
            numbers = np.full(h.size, len(self), np.int32)
            numbers[places] = self.number[which]
            out.append(numbers.reshape(h.shape))
        return out


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def forward(cuts: list[np.ndarray], chance: np.ndarray) -> np.ndarray:
    """Sums over all segmentations up to each place: (models, words, places). `chance` is (models, pieces + 1), the last column 0."""
    n = cuts[0].shape[1]
    alpha = np.zeros((len(chance), len(cuts[0]), n + 1))
    alpha[:, :, 0] = 1
    for end in range(1, n + 1):
        for size in range(1, min(len(cuts), end) + 1):
            alpha[:, :, end] += alpha[:, :, end - size] * chance[:, cuts[size - 1][:, end - size]]
    return alpha


def expected_counts(cuts: list[np.ndarray], chance: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Expected piece counts under one model, for each column of `weights` (words, groups): (groups, pieces)."""
    n = cuts[0].shape[1]
    alpha = forward(cuts, chance[None])[0]
    beta = np.zeros_like(alpha)
    beta[:, n] = 1
    out = np.zeros((weights.shape[1], len(chance)))
    for start in range(n - 1, -1, -1):
        for size in range(1, min(len(cuts), n - start) + 1):
            beta[:, start] += chance[cuts[size - 1][:, start]] * beta[:, start + size]
    for size in range(1, len(cuts) + 1):
        for start in range(n - size + 1):
            numbers = cuts[size - 1][:, start]
            share = alpha[:, start] * chance[numbers] * beta[:, start + size] / alpha[:, n]
            some = np.flatnonzero(share > 1e-9)
            for group in range(weights.shape[1]):
                out[group] += np.bincount(numbers[some], share[some] * weights[some, group], len(chance))
    return out[:, :-1]


def _word_codes(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct word parts, part numbers in order, each text's offset in these)."""
    blanks = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[\t\n\r\f\v]", " ")
    lists = pc.split_pattern(blanks, " ")
    offsets = np.asarray(lists.offsets, np.int64)
    coded = lists.flatten().dictionary_encode()
    return coded.dictionary, np.asarray(coded.indices, np.int64), offsets - offsets[0]


def _by_length(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers of words, their bytes with a blank before) for parts of equal length; a long word gives several parts."""
    data, offsets = text_bytes(words)
    begin, end = offsets[:-1], offsets[1:]
    number = np.arange(len(words))
    first = True
    while len(number):
        size = np.minimum(end - begin, PART - 1 if first else PART)
        for n in np.unique(size[size > 0]).tolist():
            for at in np.array_split(np.flatnonzero(size == n), max(1, int((size == n).sum()) // 20_000 + 1)):
                if len(at):
                    rows = data[begin[at][:, None] + np.arange(n)]
                    yield number[at], np.concatenate([np.full((len(at), 1), 32, np.uint8), rows], 1) if first else rows
        begin = begin + size
        left = begin < end
        begin, end, number, first = begin[left], end[left], number[left], False


@dataclass
class LanguageModel:
    names: list[str]
    chance: np.ndarray  # (languages, pieces + 1)
    prior: np.ndarray

    def scores(self, texts: pa.Array, known: Pieces) -> np.ndarray:
        """Log-probabilities (texts, languages), with the languages' shares."""
        words, codes, offsets = _word_codes(texts)
        table = np.zeros((len(words) + 1, len(self.names)))
        for number, data in _by_length(words):
            table[number] += np.log(forward(known.cuts(data), self.chance)[:, :, -1].T)  # a word has one part of a length at a time
        sums = np.zeros((len(texts), len(self.names)))
        for k in range(len(self.names)):
            column = np.concatenate([[0.0], np.cumsum(table[codes, k])])
            sums[:, k] = column[offsets[1:]] - column[offsets[:-1]]
        return sums + np.log(self.prior)


def fit_languages(docs: DataFrame, vocabulary: str, lang_col: str = "lang", text_col: str = "text") -> LanguageModel | None:
    """Piece probabilities of each non-null language from all rows of `docs`: expected counts over all
    segmentations under equal piece probabilities. A task sends one number per language and piece.
    Null texts are left out. No labelled text: None.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(vocabulary)
        even = np.append(np.full(len(known), 1 / len(known)), 0.0)
        total: dict[str, np.ndarray] = {}
        texts: dict[str, int] = {}
        for batch in batches:
            for part in by_bytes(batch, "text"):
                coded = part.column("lang").dictionary_encode()
                names, group = coded.dictionary.to_pylist(), np.asarray(coded.indices, np.int64)
                words, codes, offsets = _word_codes(part.column("text"))
                weights = np.zeros((len(words), len(names)))
                of_word = np.repeat(group, np.diff(offsets))
                for k, name in enumerate(names):
                    weights[:, k] = np.bincount(codes[of_word == k], minlength=len(words))
                    texts[name] = texts.get(name, 0) + int((group == k).sum())
                for number, data in _by_length(words):
                    added = expected_counts(known.cuts(data), even, weights[number])
                    for k, name in enumerate(names):
                        total[name] = total.get(name, 0) + added[k]
        for name, values in texts.items():
            counts = total.get(name, np.zeros(len(known)))
            some = np.flatnonzero(counts)
            yield batch_of(lang=pa.array([name] * (len(some) + 1)), piece=np.append(some, -1), n=np.append(counts[some], float(values)))

    summed = arrow_map(rows, count, "lang string, piece bigint, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()  # languages x pieces
    if not len(summed):
        return None
    names = sorted(summed["lang"].unique())
    known = pieces(vocabulary)
    counts, prior = np.zeros((len(names), len(known) + 1)), np.zeros(len(names))
    row = summed["lang"].map({x: k for k, x in enumerate(names)}).to_numpy()
    piece, n = summed["piece"].to_numpy(), summed["n"].to_numpy()
    counts[row[piece >= 0], piece[piece >= 0]] = n[piece >= 0]
    prior[row[piece < 0]] = n[piece < 0]
    counts[:, :-1] += SMOOTH
    counts[:, -1] = 0
    return LanguageModel(names, counts / counts.sum(1, keepdims=True), prior / prior.sum())


def identify(docs: DataFrame, model: LanguageModel | None, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """`id_col`, the columns of `keep`, lang_pred and score (the language's posterior probability) for every row.

    The whole text is used, in lower case. A null text, one without a letter, or any text without a
    model is `und` with score 0. Equal posteriors go to the first language in order of name. Null
    ids and repeated rows are scored like others. No shuffle.
    """
    keep = keep or {}
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *[x.alias(name) for name, x in keep.items()])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(vocabulary)
        for batch in batches:
            for part in by_bytes(batch, "text"):
                texts = part.column("text")
                letters = np.asarray(pc.fill_null(pc.match_substring_regex(texts, r"\pL"), False))
                if model is None:
                    names, score = ["und"] * part.num_rows, np.zeros(part.num_rows)
                else:
                    logs = model.scores(texts, known)
                    best = logs.argmax(1)
                    score = np.where(letters, 1 / np.exp(logs - logs.max(1, keepdims=True)).sum(1), 0.0)
                    names = [model.names[k] if fine else "und" for k, fine in zip(best.tolist(), letters.tolist(), strict=True)]
                yield batch_of(id=part.column("id"), **{x: part.column(x) for x in kept}, lang_pred=pa.array(names, pa.string()), score=score)

    kept = list(keep)
    kinds = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[2:])
    return arrow_map(rows, predict, f"id {rows.schema['id'].dataType.simpleString()}{kinds}, lang_pred string, score double").withColumnRenamed("id", id_col)
