"""A corpus from raw documents to packed token sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but the
last return the columns of `documents`. Rows with a null doc_id pass the stages that need an id to
tell rows apart (near duplicates) unchanged; rows that share an id are told apart by their text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.decontaminate import without_copies
from barloom.llm.frames import stored, table
from barloom.llm.jaccard_join import jaccard_components
from barloom.llm.packing import pack, token_pieces
from barloom.llm.quality import fit_quality, kept_by_quality
from barloom.llm.queries import WORD_TOKENIZER, rated
from barloom.llm.suffix_dedup import without_repeats

#: Shortest repeated passage that is removed, in bytes (about 40 words).
REPEAT_BYTES = 200


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likely good and not toxic; the classifier is fitted on the rated ones of `docs`."""
    return kept_by_quality(docs, fit_quality(docs, rated(spark, sf_dir), top=2), tail=2)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    named = docs.where("doc_id IS NOT NULL")
    key = F.col("doc_id")
    if not named.groupBy("doc_id").count().where("count > 1").isEmpty():  # rows that repeat an id: by id, then text
        shifted = key.cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")
        key = F.concat(F.lpad(shifted.cast("decimal(20,0)").cast("string"), 20, "0"), F.coalesce(F.sha2("text", 256), F.lit("")))
        named = named.withColumn("_key", key).dropDuplicates(["_key"]).drop("_key")
    groups = jaccard_components(docs.select(key.alias("_key"), "text"), n=5, percent=75, id_col="_key")
    first = groups.where("component_id = _key").select("_key").distinct()
    return named.withColumn("_key", key).join(first, "_key", "left_semi").unionByName(docs.where("doc_id IS NULL"), allowMissingColumns=True).select(docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that also stand elsewhere."""
    rows = without_repeats(docs, width=REPEAT_BYTES, keep=[c for c in docs.columns if c not in ("doc_id", "text")])
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return rows.select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a test item."""
    return without_copies(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the token ids and their places in sequences of 4096."""
    return pack(token_pieces(docs, WORD_TOKENIZER, length=4096, end_id=2), capacity=4096)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: SQL can express neither the classifier's fit nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage-{k}")
    return docs
