"""Exact token ids of many texts, with the tokenizers library called once per new word.

The word tokenizer drops white space and never looks across it, so the ids of a text are the ids
of its pieces between blanks and line feeds, one after the other. A batch is cut there, equal
pieces are found by dictionary encoding, and only pieces that the process has not met go to the
library. A tokenizer file of another kind (white space kept) is refused.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words kept per Python process; beyond it, new words are encoded again in each batch.
CACHE_WORDS = 300_000
#: Bytes of text that are encoded together.
BATCH_BYTES = 8 << 20

# Fixed values of the tokenizer file: the normalizer and the splitting pattern that the shortcut is proven for.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Words for which lower-casing and splitting need no Unicode tables: printable ASCII and Latin-1 letters.
_PLAIN = "^[!-~À-ÖØ-öø-ÿ]+$"
#: The splitting pattern for such words in lower case.
_PIECES = "('s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9 ]+)"


def _laid(flat: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs numbered `which` of `flat`, one after the other; run k is `lengths[k]` long."""
    each = lengths[which]
    stops = np.cumsum(each)
    at = np.repeat((np.cumsum(lengths) - lengths)[which] - (stops - each), each)
    at += np.arange(len(at))
    return flat[at]


class WordEncoder:
    """`encode(texts)` gives what `Tokenizer.encode(text, add_special_tokens=False).ids` gives for each text.

    Null texts count as empty. Special strings inside a text become their special id, the library's default.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        normalizers = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        split = ((spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        if normalizers != _NORMALIZERS or split.get("pattern", {}).get("Regex") != _PATTERN:
            raise ValueError(f"{path}: not a tokenizer that drops white space")
        if any(x["lstrip"] or x["rstrip"] or re.search(r"\s", x["content"]) for x in spec["added_tokens"]):
            raise ValueError(f"{path}: a special token reaches across white space")
        self.full = Tokenizer.from_file(path)
        self.full.no_truncation()
        self.full.no_padding()
        # the same model behind a plain split at blanks, for pieces that are already normal
        self.plain = Tokenizer(self.full.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        size = self.full.get_vocab_size()
        self.ends = np.zeros(size, bool)  # tokens that close a piece
        for token, number in self.full.get_vocab(with_added_tokens=False).items():
            self.ends[number] = token.endswith("</w>")
        self.special = [x["content"] for x in spec["added_tokens"]]
        self.known: dict[str, bytes] = {"": b""}
        self.cache_words = cache_words

    def _new_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of lower-case pieces, each a single match of the splitting pattern."""
        found: list[bytes] = []
        for k in range(0, len(pieces), 4096):
            part = pieces[k : k + 4096]
            ids = np.asarray(self.plain.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            stops = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            if len(stops) != len(part):
                raise AssertionError("pieces and closing tokens do not agree")
            raw = ids.tobytes()
            found += [raw[a:b] for a, b in zip([0, *stops], stops, strict=False)]
        return found

    def _new_words(self, words: list[str]) -> list[bytes]:
        """Ids of words that need the whole tokenizer."""
        found: list[bytes] = []
        for k in range(0, len(words), 1024):
            found += [np.asarray(e.ids, np.uint32).tobytes() for e in self.full.encode_batch_fast(words[k : k + 1024], add_special_tokens=False)]
        return found

    def _looked_up(self, words: pa.Array, make) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words one after the other, and their numbers; what the process has not met is made."""
        texts = words.to_pylist()
        got = list(map(self.known.get, texts))
        if None in got:
            places = [k for k, x in enumerate(got) if x is None]
            new = [texts[k] for k in places]
            made = make(new)
            for k, x in zip(places, made, strict=True):
                got[k] = x
            room = self.cache_words - len(self.known)
            if room > 0:
                self.known.update(zip(new[:room], made[:room], strict=True))
        return np.frombuffer(b"".join(got), np.uint32), np.fromiter(map(len, got), np.int64, len(got)) // 4

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the distinct words, the length of each there, the word numbers in order, and each text's offset in these."""
        blanks = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        lists = pc.split_pattern(blanks, " ")
        offsets = np.asarray(lists.offsets, np.int64)
        coded = lists.flatten().dictionary_encode()
        words, numbers = coded.dictionary, np.asarray(coded.indices)
        plain = pc.match_substring_regex(words, _PLAIN)
        for x in self.special:
            plain = pc.and_not(plain, pc.match_substring(words, x))
        split = pc.split_pattern(pc.utf8_rtrim(pc.replace_substring_regex(pc.utf8_lower(words.filter(plain)), _PIECES, r"\1 "), " "), " ")
        pieces = split.flatten().dictionary_encode()
        flat, lengths = self._looked_up(pieces.dictionary, self._new_pieces)
        which = np.asarray(pieces.indices)
        per_word = np.diff(np.concatenate([[0], np.cumsum(lengths[which])])[np.asarray(split.offsets, np.int64)])
        flat = _laid(flat, lengths, which)
        rest, rest_lengths = self._looked_up(words.filter(pc.invert(plain)), self._new_words)
        # words in the order (plain, rest), and where each distinct word stands in it
        easy = np.asarray(plain)
        place = np.empty(len(easy), np.int64)
        place[easy], place[~easy] = np.arange(easy.sum()), easy.sum() + np.arange((~easy).sum())
        return np.concatenate([flat, rest]), np.concatenate([per_word, rest_lengths]), place[numbers], offsets - offsets[0]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (unsigned 32-bit) and the offset of each text in them, with one more offset at the end."""
        flat, lengths, numbers, offsets = self._words(texts)
        return _laid(flat, lengths, numbers), np.concatenate([[0], np.cumsum(lengths[numbers])])[offsets]

    def count(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text; no ids are laid out."""
        _, lengths, numbers, offsets = self._words(texts)
        return np.diff(np.concatenate([[0], np.cumsum(lengths[numbers])])[offsets])


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder of this process for a file; made once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def byte_lengths(texts: pa.Array) -> np.ndarray:
    return np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64)


def by_bytes(batch: pa.RecordBatch, column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts hold about `limit` bytes; a longer text stands alone."""
    sizes = byte_lengths(batch.column(column))
    ends, start, filled = [], 0, 0
    for k, size in enumerate(sizes.tolist()):
        if k > start and filled + size > limit:
            ends.append((start, k))
            start, filled = k, 0
        filled += size
    if len(sizes) > start:
        ends.append((start, len(sizes)))
    for a, b in ends:
        yield batch.slice(a, b - a)


def pieces_of(text: str, limit: int) -> Iterator[str]:
    """Parts of a long text, cut at a blank or line feed; where none stands within `limit` characters, at the next one."""
    at, n = 0, len(text)
    while n - at > limit:
        cut = max(text.rfind(" ", at, at + limit), text.rfind("\n", at, at + limit))
        if cut <= at:
            after = [x for x in (text.find(" ", at + limit), text.find("\n", at + limit)) if x >= 0]
            if not after:
                break
            cut = min(after)
        yield text[at:cut]
        at = cut
    yield text[at:]
