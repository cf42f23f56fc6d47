"""Operator 3: document fingerprints from prefix polynomial hashes."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.llm.common import shuffle_width

#: Two prime moduli below 2 ** 31, so products fit in 64 bits, and a base for each.
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_103_515_245, 1_664_525_003)
_BLOCK = 1 << 15
#: Rows of a range of ids, and the ranges that are dealt out at most; a range is read as a stream, so its size is
#: not a limit.
ROWS_PER_RANGE = 4_000
MAX_RANGES = 100_000


def _powers(base: int, prime: int) -> np.ndarray:
    """``base ** j`` for one block, doubled up from the front."""
    out = np.ones(1, np.int64)
    while len(out) < _BLOCK:
        out = np.concatenate((out, out * pow(base, len(out), prime) % prime))
    return out


_TABLES = [_powers(b, p) for b, p in zip(BASES, PRIMES)]


class PrefixHash:
    """Modular prefix arrays of a text: ``H[i] = sum(c[j] * base ** j for j < i)``.

    Any span is then a difference of two entries, and two spans are equal when
    these agree after moving the earlier one up by the distance.
    """

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.size = len(codes)
        self._prefix = []
        for base, prime, table in zip(BASES, PRIMES, _TABLES):
            prefix, total, step = np.zeros(self.size + 1, np.uint32), 0, 1
            for start in range(0, self.size, _BLOCK):
                block = codes[start : start + _BLOCK].astype(np.int64) + 1
                # A code point times a power stays below 2 ** 53, the sum of a block below 2 ** 47.
                sums = np.cumsum(block * table[: len(block)] % prime) % prime
                if start:
                    sums = (sums * step + total) % prime
                prefix[start + 1 : start + 1 + len(block)] = sums
                total, step = int(sums[-1]), step * pow(base, _BLOCK, prime) % prime
            self._prefix.append(prefix)

    def span(self, start: int, stop: int) -> tuple[int, ...]:
        """Hash of a span, still carrying ``base ** start``."""
        return tuple((int(p[stop]) - int(p[start])) % prime for p, prime in zip(self._prefix, PRIMES))


class Spliced:
    """The first ``head`` characters of one text and the first ``tail`` of another, without a new array."""

    def __init__(self, first: PrefixHash, head: int, second: PrefixHash, tail: int):
        self._first, self._head, self._second = first, head, second
        self.size = head + tail

    def span(self, start: int, stop: int) -> tuple[int, ...]:
        head = self._head
        one = self._first.span(min(start, head), min(stop, head))
        two = self._second.span(max(start, head) - head, max(stop, head) - head)
        return tuple(
            (a + b * pow(base, head, prime)) % prime for a, b, base, prime in zip(one, two, BASES, PRIMES)
        )


def spans_equal(x, at_x: int, y, at_y: int, length: int) -> bool:
    """Whether two spans are equal, for any pair of spans in constant time."""
    one, two = x.span(at_x, at_x + length), y.span(at_y, at_y + length)
    return all(
        a * pow(base, max(0, at_y - at_x), prime) % prime == b * pow(base, max(0, at_x - at_y), prime) % prime
        for a, b, base, prime in zip(one, two, BASES, PRIMES)
    )


def _longest(most: int, holds) -> int:
    """The largest length up to ``most`` that holds, for a property that all shorter lengths share."""
    low, high = 0, most
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if holds(middle) else (low, middle - 1)
    return low


def common_prefix(x, y) -> int:
    """Longest common extension to the right from both starts."""
    return _longest(min(x.size, y.size), lambda n: spans_equal(x, 0, y, 0, n))


def common_suffix(x, y) -> int:
    """Longest common extension to the left from both ends."""
    return _longest(min(x.size, y.size), lambda n: spans_equal(x, x.size - n, y, y.size - n, n))


def likeness(x, y) -> float:
    """Share of the longer text in common extensions from both ends; 1 for equal texts, 0 with nothing in common."""
    shorter, longer = sorted((x.size, y.size))
    if not longer:
        return 1.0
    ahead = common_prefix(x, y)
    behind = min(common_suffix(x, y), shorter - ahead) if ahead < shorter else 0
    return (ahead + behind) / longer


def fingerprint(x) -> str:
    """Length and whole-text hash; equal for equal texts."""
    return f"{x.size:x}-" + "".join(f"{h:08x}" for h in x.span(0, x.size))


_RESULT = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def _compare(text: str, own: PrefixHash, next_text: str, following: PrefixHash) -> tuple:
    cut = own.size // 2
    head, tail = own.size - cut, min(cut, following.size)
    edited = Spliced(own, head, following, tail)
    body = (text[:head] + next_text[:tail]).encode("utf-8", "surrogatepass")
    return (
        own.size,
        hashlib.sha256(body).hexdigest(),
        fingerprint(own),
        fingerprint(edited),
        likeness(own, edited),
        likeness(own, following),
    )


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness to the edited and the next text.

    The next document is the one with the next id; the last is followed by the
    first. Ids are cut into ranges of about equal rows, so every range is a stream in
    id order inside one task that holds two texts at a time; the first row of a
    range also goes to the end of the range before it. Texts are shuffled once.

    Null text counts as empty (length 0; two empty texts are alike 1). A single
    row is followed by itself. Rows with one id follow each other in the order
    of their texts; null ids come first. Other columns are not read; an empty
    table gives no rows.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ranges = max(1, min(MAX_RANGES, max(shuffle_width(docs), -(-docs.count() // ROWS_PER_RANGE))))
    # Spark's range exchange, over ids alone, cuts at bounds of a bounded sample; one row per range comes back.
    bounds = slim.select("doc_id").repartitionByRange(ranges, "doc_id").groupBy(F.spark_partition_id().alias("range"))
    bounds = bounds.agg(F.min("doc_id").alias("first"), F.bool_or(F.col("doc_id").isNull()).alias("unknown")).collect()
    starts = sorted(b["first"] for b in bounds if b["first"] is not None)
    # Range 0 takes null ids too; every other range is opened by its least id.
    cuts, unknown = starts[1:], any(b["unknown"] for b in bounds)
    edges = np.array(cuts)

    @F.pandas_udf("int")
    def position(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, ids.to_numpy(), side="right"))

    known = F.coalesce(F.col("doc_id"), F.lit(cuts[0])) if cuts else None
    bucket = F.when(F.col("doc_id").isNull(), 0).otherwise(position(known)) if cuts else F.lit(0)
    placed = slim.withColumn("bucket", bucket)
    # One row per range: what opens it, and the range before it; the last range goes on with the first.
    firsts = list(enumerate([None if unknown else starts[0], *cuts] if starts else [None] * bool(bounds)))
    before = [(firsts[i - 1][0], b, i) for i, (b, _) in enumerate(firsts)]
    spark = docs.sparkSession
    opens = spark.createDataFrame(
        [(firsts[i][1], b, previous) for previous, b, i in before], f"first_id {kind}, first_bucket int, previous int"
    )
    both = placed.join(
        F.broadcast(opens),
        (placed.bucket == opens.first_bucket) & placed.doc_id.eqNullSafe(opens.first_id),
        "left",
    )
    own = F.array(F.struct(F.col("bucket").alias("range"), F.lit(0).alias("tail")))
    extra = F.array(F.struct(F.col("previous").alias("range"), F.lit(1).alias("tail")))
    rows = both.select("doc_id", "text", F.explode(F.when(F.col("previous").isNull(), own).otherwise(F.concat(own, extra))).alias("to"))
    rows = rows.select(F.col("to.range").alias("range"), F.col("to.tail").alias("tail"), "doc_id", "text")
    rows = rows.repartitionByRange(ranges, "range").sortWithinPartitions(
        "range", "tail", F.col("doc_id").asc_nulls_first(), F.col("text")
    )

    def compare(batches):
        waiting = None
        for batch in batches:
            ids, out = [], []
            for row in range(batch.num_rows):
                place, tail = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                if tail and waiting is None:
                    continue
                value = batch.column(3)[row].as_py()
                hashed = PrefixHash(value)
                if waiting is not None:
                    ids.append(waiting[0])
                    out.append(_compare(waiting[1], waiting[2], value, hashed))
                waiting = None if tail else (batch.column(2)[row].as_py(), value, hashed)
            if out:
                kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
                columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                names = [c.split()[0] for c in _RESULT.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field(2).type), *columns], ["doc_id", *names])

    return rows.mapInArrow(compare, f"doc_id {kind}, {_RESULT}")
