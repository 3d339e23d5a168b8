"""Token counts of whole texts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.frames import arrow_map, batch_of
from barloom.llm.vocabulary import BATCH_BYTES, by_bytes, byte_lengths, encoder, pieces_of


def token_counts(
    docs: DataFrame, tokenizer: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """`id_col`, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) for every row of `docs`.

    `tokenizer` is the place of a tokenizers file that drops white space, the same on every machine.
    Ids are those of the library without added special tokens; special strings inside a text count
    as it does by default. Rows are encoded in batches of about `batch_bytes`; a longer text is cut
    at a blank or line feed, which no token crosses, so memory does not follow the longest text.

    Null and empty texts: 0 bytes, 0 tokens. Null ids and repeated rows are kept, one result each.
    Other columns are not read. An empty table gives an empty result. No shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer)
        for batch in batches:
            for part in by_bytes(batch, "text", batch_bytes):
                texts = part.column("text")
                sizes = byte_lengths(texts)
                if len(sizes) == 1 and sizes[0] > batch_bytes:
                    tokens = np.array([sum(int(words.count(pa.array([x])).sum()) for x in pieces_of(texts[0].as_py(), batch_bytes))], np.int64)
                else:
                    tokens = words.count(texts)
                yield batch_of(id=part.column("id"), n_bytes=sizes, n_tokens=tokens, over_limit=tokens > limit)

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return arrow_map(rows, count, f"id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean").withColumnRenamed("id", id_col)
