"""Operator 1: token counts of whole texts, as lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.llm import tokenizer_files

TOKEN_LIMIT = 2048
#: Texts are encoded in batches of about so many bytes; longer ones are split into windows of so many characters.
BATCH_BYTES = 1 << 20


def _batches(texts: pa.Array, splits: bool) -> Iterator[tuple[list[int], list[str]]]:
    """Batches of about equal bytes: the row of each text or window, and the texts."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    rows: list[int] = []
    batch: list[str] = []
    held = 0
    for row, size in enumerate(sizes):
        if not size:
            continue
        text = texts[row].as_py()
        parts = tokenizer_files.windows(text, BATCH_BYTES) if splits and size > BATCH_BYTES else [text]
        for part in parts:
            share = size * len(part) // len(text)
            if batch and held + share > BATCH_BYTES:
                yield rows, batch
                rows, batch, held = [], [], 0
            rows.append(row)
            batch.append(part)
            held += share
    if batch:
        yield rows, batch


def count_tokens(
    docs: DataFrame, tokenizer: str, limit: int = TOKEN_LIMIT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` of every row.

    One narrow step without a shuffle: an Arrow function deals the texts of a
    batch into groups of about equal bytes, encodes each group in one call and
    returns lengths, never ids. Texts longer than a group are split before white
    space where the file's pre-tokeniser never crosses it; with files of other
    kinds they stay whole. ``tokenizer`` is a ``tokenizers`` file every worker
    can open, such as one of an installed package.

    Null or empty text: 0 bytes, 0 tokens, not over the limit. Repeated rows
    and null ids are counted row by row. No other column is read, so extra
    columns of any name are ignored. An empty table gives no rows.
    """
    identifier = docs.schema[doc_id].dataType

    def lengths(batches):
        library, splits = tokenizer_files.load(tokenizer), tokenizer_files.cuts_at_space(tokenizer)
        for batch in batches:
            tokens = [0] * batch.num_rows
            for rows, texts in _batches(batch.column(1), splits):
                for row, encoding in zip(rows, library.encode_batch_fast(texts, add_special_tokens=False)):
                    tokens[row] += len(encoding)
            size = pc.fill_null(pc.binary_length(batch.column(1)), 0)
            counted = pa.array(tokens, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), size.cast(pa.int64()), counted, pc.greater(counted, limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {identifier.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"
    return slim.mapInArrow(lengths, schema)
