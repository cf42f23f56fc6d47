"""Operator 12: byte-level BPE encoding and decoding of whole texts."""

from __future__ import annotations

import hashlib
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.llm.bpe_stream import TextDecoder, stream_encoder


def _slim(docs: DataFrame, key: str, value: str) -> tuple[DataFrame, str]:
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("doc_id"), F.col(value).alias("value")), kind


def _row_by_row(names: list[str], types: list[pa.DataType], convert):
    """An Arrow function that keeps the first column and adds what ``convert`` makes of each second value."""

    def batches(source):
        for batch in source:
            results = [convert(value.as_py()) for value in batch.column(1)]
            columns = zip(*results) if results else [[] for _ in names]
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", *names])

    return batches


def encode_texts(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``ids``, the token ids of every text, without special tokens of the template.

    One narrow step. Null or empty text: no ids. Repeated rows and null ids are
    encoded row by row; other columns are not read; an empty table gives no rows.
    ``tokenizer`` is a plain byte-level BPE file that every worker can open; any
    other kind raises ``ValueError``.
    """
    slim, kind = _slim(docs, doc_id, text)

    def convert(value):
        ids = array("I")
        for part in stream_encoder(tokenizer).encode(value):
            ids.frombytes(part)
        return (ids.tolist(),)

    return slim.mapInArrow(_row_by_row(["ids"], [pa.list_(pa.int32())], convert), f"doc_id {kind}, ids array<int>")


def decode_ids(encoded: DataFrame, tokenizer: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id`` and ``text`` of every array of token ids; null for null, empty for no ids.

    Bytes that are no UTF-8 become U+FFFD; ids outside the vocabulary and null ids give nothing.
    """
    slim, kind = _slim(encoded, doc_id, ids)

    def convert(value):
        if value is None:
            return (None,)
        decoder = TextDecoder(stream_encoder(tokenizer).table)
        known = array("I", (i for i in value if i is not None and i >= 0))
        return (decoder.feed(known.tobytes()) + decoder.finish(),)

    return slim.mapInArrow(_row_by_row(["text"], [pa.string()], convert), f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``, without the ids or texts themselves.

    Emitted ids go to the digest and to the decoder part by part, so a text of
    any length costs its own size and a window. Rows are treated as in
    ``encode_texts``; null and empty texts give 0 tokens and the digest of nothing.
    """
    slim, kind = _slim(docs, doc_id, text)

    def convert(value):
        encoder = stream_encoder(tokenizer)
        decoder = TextDecoder(encoder.table)
        seen, read, count = hashlib.sha256(), hashlib.sha256(), 0
        for ids in encoder.encode(value):
            count += len(ids) // 4
            seen.update(ids)
            read.update(decoder.feed(ids).encode())
        read.update(decoder.finish().encode())
        return count, seen.hexdigest(), read.hexdigest()

    names, types = ["n_tokens", "ids_sha256", "decoded_sha256"], [pa.int64(), pa.string(), pa.string()]
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return slim.mapInArrow(_row_by_row(names, types, convert), schema)
