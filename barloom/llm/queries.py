"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.decontaminate import benchmark_copies
from barloom.llm.frames import table
from barloom.llm.hard_negatives import hard_negatives, negatives_sql
from barloom.llm.jaccard_join import jaccard_components
from barloom.llm.language import fit_languages, identify
from barloom.llm.licenses import license_scan, license_sql
from barloom.llm.neighbours import nearest
from barloom.llm.packing import pack, token_pieces
from barloom.llm.quality import fit_quality, quality_scores
from barloom.llm.style_tree import extract_text
from barloom.llm.suffix_dedup import without_repeats
from barloom.llm.token_counts import token_counts
from barloom.llm.token_files import read_token_files, write_token_files
from barloom.llm.trie import conversation_trie, numbered_turns, rebuilt, trie_sql
from barloom.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), WORD_TOKENIZER, limit=2048)


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(token_pieces(table(spark, sf_dir, "documents"), WORD_TOKENIZER, length=4096, end_id=2), capacity=4096)


@query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, WORD_TOKENIZER, end_id=2)
    return read_token_files(spark, path)


@query
def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), n=5, percent=75)


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the text that remains."""
    return without_repeats(table(spark, sf_dir, "documents"), width=400)


def rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades of `labels`: 2 good and not toxic, 1 one fault, 0 both; a null mark of toxicity counts as none."""
    labels = table(spark, sf_dir, "labels")
    return labels.select("doc_id", (F.col("quality").cast("int") + F.when(F.col("toxic") == 1, 0).otherwise(1)).alias("grade"))


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, fit_quality(docs, rated(spark, sf_dir), top=2), tail=2)


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per text and test item that it copies, with the best copy's score and the number of copies."""
    copies = benchmark_copies(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return copies.groupBy("doc_id", "item_id").agg(F.max("score").alias("score"), F.count(F.lit(1)).alias("n_copies"))


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"), least=0.8)


ORACLES["op3_license_scan"] = license_sql(least=0.8)


@query
def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)



@query
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from rows whose id's CRC is not 1 modulo 3, predicts for all."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    model = fit_languages(docs.where(F.col("doc_id").isNotNull() & ~held_out), PIECES)
    return identify(docs, model, PIECES, keep={"held_out": held_out})


@query
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations first take up to 8 turns of the conversation whose id is the next lower multiple of 5."""
    turns = numbered_turns(table(spark, sf_dir, "conversations"))
    conv = F.col("conv_id")
    return conversation_trie(rebuilt(turns, conv - conv % 5, F.crc32(conv.cast("string").cast("binary")) % 9, most=8))


ORACLES["op11_conversation_trie"] = trie_sql(every=5, most=9)


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row's label is wrong by one, as the task asks."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, positives=5, negatives=5, share=(80, 100), scale=256, label=label)


ORACLES["op13_hard_negatives"] = negatives_sql()


@query
def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))
