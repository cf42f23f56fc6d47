"""Operator 8: best-fit packing of token sequences by hierarchical residual packing."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.llm.wordbpe import encoder
from txnguard.session import materialize

CAPACITY = 2048
#: Bins with at most this share of room left are emitted and not packed again.
SLACK = 0.005
#: Items that one best-fit run takes at most; a task with more makes several runs.
BLOCK = 200_000
#: Pieces that a partition of the first level gets, in the mean; many small ones pack best.
LOCAL = 100_000
#: So many groups of underfull bins meet in one group of the next level.
FAN_IN = 8

_PIECE = "piece int, start long, length long, ids_crc32 long"


def cut_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per piece: the ids of a text and a final id 0, cut every ``capacity`` ids.

    Null text counts as empty and gives one piece of length 1. Every row is cut
    by itself, repeated ids included. Other columns are not read.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def pieces(batches):
        words = encoder(tokenizer)
        for batch in batches:
            rows, numbers, starts, lengths, sums = [], [], [], [], []
            for row, ids in enumerate(words.ids(batch.column(1))):
                data = ids.tobytes() + b"\0\0\0\0"
                for piece, start in enumerate(range(0, len(data) // 4, capacity)):
                    own = data[4 * start : 4 * (start + capacity)]
                    rows.append(row)
                    numbers.append(piece)
                    starts.append(start)
                    lengths.append(len(own) // 4)
                    sums.append(zlib.crc32(own))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(numbers, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (starts, lengths, sums)),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return slim.mapInArrow(pieces, f"doc_id {kind}, {_PIECE}")


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit, longest first: per item its bin and offset, per bin its fill.

    ``room`` has one bit per amount of room that some open bin has, so the bin
    with the least sufficient room is its lowest set bit from the length up.
    """
    bins = np.zeros(len(lengths), np.int64)
    offsets = np.zeros(len(lengths), np.int64)
    fills: list[int] = []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    room = 0
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        fitting = room >> length
        if fitting:
            left = length + (fitting & -fitting).bit_length() - 1
            number = open_bins[left].pop()
            if not open_bins[left]:
                room ^= 1 << left
        else:
            left, number = capacity, len(fills)
            fills.append(0)
        bins[item], offsets[item] = number, fills[number]
        fills[number] += length
        if left > length:
            if not open_bins[left - length]:
                room |= 1 << (left - length)
            open_bins[left - length].append(number)
    return bins, offsets, np.array(fills, np.int64)


def _pack_locally(items: DataFrame, size: str, level: int, capacity: int) -> DataFrame:
    """Each partition by itself: ``bin``, ``bin_offset`` and ``bin_fill`` are added to its rows."""
    schema = items.schema
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)

    def pack(batches):
        # The level and the partition make a bin's number unique; 2 ** 32 bins fit in a partition.
        base = (level << 56) | (TaskContext.get().partitionId() << 32)
        waiting: list[pa.RecordBatch] = []
        rows = 0

        def packed():
            nonlocal base
            block = pa.Table.from_batches(waiting).combine_chunks()
            bins, offsets, fills = best_fit(block.column(size).to_numpy(), capacity)
            for name, values in (("bin", bins + base), ("bin_offset", offsets), ("bin_fill", fills[bins])):
                block = block.append_column(name, pa.array(values, pa.int64()))
            base += len(fills)
            return block.to_batches(max_chunksize=20_000)

        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                if rows + part.num_rows > BLOCK:
                    yield from packed()
                    waiting, rows = [], 0
                waiting.append(part)
                rows += part.num_rows
        if rows:
            yield from packed()

    return items.mapInArrow(pack, f"{kinds}, bin long, bin_offset long, bin_fill long")


def pack(pieces: DataFrame, capacity: int = CAPACITY, slack: float = SLACK) -> DataFrame:
    """``pieces`` (with ``length`` from 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    Pieces are written once and read in partitions of about ``LOCAL``. Every
    partition packs its own pieces by best fit and emits bins that are nearly
    full. The others become items as long as their fill, meet with those
    of seven more partitions and are packed again, until one group is left or a
    level saves nothing. Only bins travel, never pieces, and no task holds more
    than ``BLOCK`` items at once. Each level is written to the shared folder,
    so a lost executor cannot change a bin that others have used.

    Repeated rows are packed as they are; an empty table gives no rows.
    """
    enough = capacity - int(capacity * slack)
    cut = materialize(pieces, "pieces")
    groups = max(1, -(-cut.count() // LOCAL))
    rows = materialize(_pack_locally(cut.coalesce(groups), "length", 0, capacity), "packed")
    under = rows.filter((F.col("bin_offset") == 0) & (F.col("bin_fill") < enough))
    items = under.select("bin", F.col("bin_fill").alias("fill"))
    moves, level, before = None, 0, None
    while True:
        count = items.count()
        if count < 2 or (before is not None and count > 0.95 * before):
            break
        groups, level, before = max(1, -(-groups // FAN_IN), -(-count // BLOCK)), level + 1, count
        dealt = items.select(F.col("bin").alias("from_bin"), "fill").repartition(groups, "from_bin")
        merged = materialize(_pack_locally(dealt, "fill", level, capacity), "merged")
        step = merged.select("from_bin", F.col("bin").alias("to_bin"), F.col("bin_offset").alias("by"))
        if moves is None:
            moves = step
        else:
            later = step.toDF("at_bin", "next_bin", "more")
            moves = moves.join(later, moves.to_bin == later.at_bin, "left").select(
                "from_bin",
                F.coalesce("next_bin", "to_bin").alias("to_bin"),
                (F.col("by") + F.coalesce("more", F.lit(0))).alias("by"),
            )
        if groups == 1:
            break
        items = merged.filter((F.col("bin_offset") == 0) & (F.col("bin_fill") < enough)).select(
            "bin", F.col("bin_fill").alias("fill")
        )
    kept = [F.col(c) for c in pieces.columns]
    if moves is None:
        return rows.select(*kept, F.col("bin").alias("sequence_id"), F.col("bin_offset").alias("offset"))
    return rows.join(moves, rows.bin == moves.from_bin, "left").select(
        *kept,
        F.coalesce("to_bin", "bin").alias("sequence_id"),
        (F.col("bin_offset") + F.coalesce("by", F.lit(0))).alias("offset"),
    )
