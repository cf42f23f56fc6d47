"""Small column expressions the operators are composed from."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnguard.schema import TRANSACTION_TYPES


def flag(condition: Column) -> Column:
    """1.0 where the condition holds, 0.0 where it is false or unknown."""
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


def to_double(column: Column) -> Column:
    return column.try_cast("double")


def to_whole(column: Column) -> Column:
    """Integer with truncation: '1.5' becomes 1, unreadable text becomes null."""
    return column.try_cast("double").try_cast("int")


def trimmed_upper(column: Column) -> Column:
    """Missing becomes empty; outer spaces (only spaces) go; upper case."""
    return F.upper(F.trim(F.coalesce(column.cast("string"), F.lit(""))))


def stripped(column: Column) -> Column:
    """Text without outer white space of any kind."""
    return F.regexp_replace(column.cast("string"), r"^\s+|\s+$", "")


def account_code(column: Column) -> Column:
    """A listed account as cleaned rows spell it: stripped, upper case, empty if missing."""
    return F.upper(stripped(F.coalesce(column, F.lit(""))))


def type_code(column: Column) -> Column:
    """Transaction type with each inner run of white space as one underscore.

    A text that already is a known type is its own code, so the pattern is
    matched only for the others.
    """
    spelled = F.regexp_replace(trimmed_upper(column), r"\s+", "_")
    return F.when(column.isin(*TRANSACTION_TYPES), column).otherwise(spelled)


def present(column: Column, floating: bool = True) -> Column:
    """Neither null nor, for floating point, NaN."""
    return column.isNotNull() & ~F.isnan(column) if floating else column.isNotNull()


def positive_class(name: str) -> Column:
    """Second entry of a class vector column, 0.0 if it is null or shorter."""
    entries = F.when(F.col(name).isNotNull(), vector_to_array(name))
    return F.coalesce(F.get(entries, F.lit(1)), F.lit(0.0))


def hash_bucket(keys: Iterable[str], buckets: int, salt: str = "") -> Column:
    """Stable bucket of a row key in [0, buckets).

    The first eight hex digits of an md5 give the same number on any cluster
    layout and in any engine, unlike rand() or a partition-dependent sampler.
    """
    text = F.concat_ws("|", *[F.col(key).cast("string") for key in keys])
    if salt:
        text = F.concat(F.lit(salt), text)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % F.lit(buckets)


def row_digest(columns: Iterable[str]) -> Column:
    """Identity for rows that carry no key: equal rows get equal digests."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns]
    return F.md5(F.concat_ws("\u0001", *parts))


def evaluate_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that later filters read as values instead of recomputing.

    The optimizer moves a filter below a projection by repeating the projected
    expressions in it, once per mention. It does not move one below a
    generator, so costly expressions (parsing, models) go through a
    one-element array. Columns keep their place; new ones come last.
    """
    packed = F.inline(F.array(F.struct(*[value.alias(name) for name, value in columns.items()])))
    order = [*df.columns, *[name for name in columns if name not in df.columns]]
    return df.select(*[name for name in df.columns if name not in columns], packed).select(*order)
