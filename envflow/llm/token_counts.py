"""Token counts (1): lengths of byte-level BPE encodings of whole texts.

Arrow batches go through ``bpe.encode_all``: byte-balanced batches, long texts
cut at safe boundaries, and only the lengths come back. No shuffle.

Defined cases: null text counts as empty (0 bytes, 0 tokens); repeated rows and
null ids give a row each; extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envflow.llm.bpe import as_count, encode_all
from envflow.llm.common import on_workers, text_of

TOKEN_LIMIT = 512


def token_counts(
    docs: DataFrame,
    tokenizer: str | None = None,
    limit: int = TOKEN_LIMIT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` for every row of ``docs``."""
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")

    def count(batches):
        for b in batches:
            texts = b.column("_text").to_pylist()
            n = []
            for values in encode_all(texts, path, as_count):
                n += values
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), b.column("_bytes"), pa.array(n, pa.int64())], names=["_id", "_bytes", "_n"]
            )

    src = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    src = src.withColumn("_bytes", F.octet_length("_text").cast("long"))
    kind = src.schema["_id"].dataType.simpleString()
    out = on_workers(src).mapInArrow(count, f"_id {kind}, _bytes long, _n long")
    return out.select(
        F.col("_id").alias(id_col),
        F.col("_bytes").alias("n_bytes"),
        F.col("_n").alias("n_tokens"),
        (F.col("_n") > limit).alias("over_limit"),
    )
