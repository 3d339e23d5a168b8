"""Token counts, packing and token files against the tokenizers library."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from barloom.llm.frames import table
from barloom.llm.grammar import Frame, compress
from barloom.llm.packing import filling_patterns, pack, sequences, token_pieces
from barloom.llm.token_counts import token_counts
from barloom.llm.token_files import read_token_files, write_token_files
from barloom.llm.vocabulary import WordEncoder, pieces_of

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = WordEncoder(PATH, cache_words=50)
ODD = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "Don't stop, it's 42 GÖßE naïve ﬁne…"), (5, "a<|endoftext|>b <|startoftext|> <|ENDOFTEXT|>"), (6, "é x́y ΣΑΣ İI"),
    (6, "é x́y ΣΑΣ İI"), (None, "no id"), (8, "x" * 50), (9, "日本語 テキスト 　 한국어 emoji 👩‍👩‍👧 done"), (10, "wörd*** \x1c\x85 'S 'll've"),
]


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_encoder_equals_library(texts):
    got, offsets = OWN.encode(pa.array(texts, pa.string()))
    assert [got[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [ids(x) for x in texts]


def test_counts(spark, sf, documents):
    odd = documents(ODD)
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts(odd, PATH, limit=10).collect())
    assert got == sorted((d or 0, len((t or "").encode()), len(ids(t)), len(ids(t)) > 10) for d, t in ODD)
    docs = table(spark, sf, "documents")
    want = {r["doc_id"]: len(ids(r["text"])) for r in docs.collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts(docs, PATH).collect()} == want
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts(docs, PATH, batch_bytes=300).collect()} == want  # every long text is cut
    assert token_counts(odd.limit(0), PATH).count() == 0


def test_long_texts_are_cut_between_words():
    text = "ab cd\nefghijklmnop qr " * 5
    parts = list(pieces_of(text, 7))
    assert "".join(parts) == text and len(parts) > 5
    assert [x for p in parts for x in ids(p)] == ids(text)


@pytest.mark.parametrize("histogram", [{}, {4096: 3}, {1: 10_000}, {2049: 5, 2047: 5}, {k: k % 7 + 1 for k in range(1, 4097)}])
def test_patterns_hold_every_piece(histogram):
    got = defaultdict(int)
    patterns = filling_patterns(histogram, 4096)
    for packs, runs in patterns:
        assert sum(n * c for n, c in runs) <= 4096
        for n, c in runs:
            got[n] += packs * c
    assert dict(got) == histogram
    if histogram:
        assert sum(p for p, _ in patterns) <= 1.05 * sum(n * c for n, c in histogram.items()) / 4096 + 1


def test_packing(spark, sf, documents):
    docs = table(spark, sf, "documents").select("doc_id", "text").unionByName(documents(ODD, "offset").select("doc_id", "text").where("doc_id IS NULL OR doc_id < 3"))
    placed = pack(token_pieces(docs, PATH, length=1000, keep_ids=True), capacity=1000, rank_rows=20).cache()
    rows = placed.collect()
    texts = [r["text"] for r in docs.collect()]
    assert sum(r["length"] for r in rows) == sum(len(ids(t)) + 1 for t in texts)
    by = defaultdict(list)
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and len(r["ids"]) == r["length"]
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1000
    assert len(by) <= 1.02 * sum(r["length"] for r in rows) / 1000 + 1
    whole = sequences(placed, 1000).collect()
    assert len(whole) == len(by) and all(len(r["ids"]) == 1000 for r in whole)
    assert pack(token_pieces(docs.limit(0), PATH)).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=300), st.integers(0, 300), st.integers(0, 300))
def test_grammar_round_trip(values, a, b):
    frame = Frame(compress(np.array(values, np.uint32), min_count=2))
    assert frame.read().tolist() == values and len(frame) == len(values)
    assert frame.read(a, b).tolist() == values[a:b]


def test_grammar_with_large_ids():
    values = np.array([7, 4_000_000_000, 7, 4_000_000_000, 9] * 40, np.uint32)
    assert (Frame(compress(values, min_count=2)).read() == values).all()


def test_token_files(spark, sf, documents, tmp_path):
    docs = table(spark, sf, "documents").select("doc_id", "text").unionByName(documents([(-1, None), (-2, ""), (7, "again 7"), (None, "no id")]).select("doc_id", "text"))
    for k, sizes in enumerate(({}, {"shard_bytes": 30_000, "block_tokens": 5000, "frame_tokens": 700})):
        write_token_files(docs, f"{tmp_path}/{k}", PATH, **sizes)
        rows = sorted(read_token_files(spark, f"{tmp_path}/{k}", keep_ids=True).collect(), key=lambda r: r["start"])
        assert [r["doc_id"] for r in rows] == sorted([r["doc_id"] for r in docs.collect()], key=lambda x: (x is not None, x))
        at, by = 0, defaultdict(list)
        for r in rows:
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["n_tokens"] == len(r["ids"])
            at += r["n_tokens"]
            by[r["doc_id"]].append(r["ids"])
        for r in docs.collect():
            assert ids(r["text"]) + [2] in by[r["doc_id"]]
    write_token_files(docs.limit(0), f"{tmp_path}/none", PATH)
    assert read_token_files(spark, f"{tmp_path}/none").count() == 0
