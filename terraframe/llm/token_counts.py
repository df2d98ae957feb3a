"""Token counts of whole texts from prefix dynamic programming, with truncation answers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .word_tokens import shared_tokenizer

LIMIT = 2048


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, path: str | None = None) -> DataFrame:
    """(id_col, n_bytes, n_tokens, over_limit, cut_chars) of every row.

    Null and empty texts have 0 bytes and tokens. ``cut_chars`` is the length in code points of the
    longest prefix within ``limit`` tokens. The vocabulary file's path is resolved on the executor
    unless given.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_tokenizer(path or vocabulary())
        for batch in batches:
            totals, cuts = [], []
            for text in batch.column(2):
                counts = encoder.prefix_counts(text.as_py())
                totals.append(counts.total)
                cuts.append(counts.cut_for(limit))
            n = pa.array(totals, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n, pa.array([t > limit for t in totals]), pa.array(cuts, pa.int64())], [id_col, "n_bytes", "n_tokens", "over_limit", "cut_chars"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(id_col, F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint").alias("_n"), F.col(text_col).cast("string").alias("_t"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean, cut_chars bigint")


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
